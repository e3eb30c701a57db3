"""Declared schemas of the records (the reference never declares them)."""

from __future__ import annotations

# Field names and order of the hotel and review records.
HOTEL_FIELDS = [
    "url", "id_hotel", "name_hotel", "address_hotel", "ranking_hotel", "number_of_reviews",
    "amenities", "total_rating", "location_rating", "cleanliness_rating", "service_rating",
    "value_rating", "good_to_know", "class_rating", "popular_mention_tags", "description",
    "location_grade", "surrounding_restaurants", "surrounding_attractions",
]
HOTEL_ARRAYS = {"amenities", "good_to_know", "popular_mention_tags"}
REVIEW_FIELDS = [
    "id_user", "name_user", "review_date", "review_rating", "review_language", "trip_type",
    "helpful_votes", "reviewer_location", "review_title", "review_text", "review_response",
    "responder", "responder_title",
]

HOTEL = ", ".join(f"{f} {'ARRAY<STRING>' if f in HOTEL_ARRAYS else 'STRING'}" for f in HOTEL_FIELDS)
REVIEW = ", ".join(f"{f} STRING" for f in REVIEW_FIELDS)
#: One split object as the sinks write it, partition columns last.
SPLIT_OBJECT = (f"object_key STRING, hotel_key STRING, review_key STRING, meta_data STRUCT<{HOTEL}>, "
                f"review STRUCT<{REVIEW}>, response_status STRING, lang STRING")
RUN_LOG = ("hotel_id STRING, status STRING, n_reviews INT, runtime_s DOUBLE, url STRING, "
           "reason STRING, finish_time TIMESTAMP")

RUN_STATUS_EMPTY = "Empty"
RUN_STATUS_SUCCESS = "Success"
RUN_REASON_FINISHED = "finished"
RUN_REASON_FAILED = "Readmore Element not Found"
