"""Hotel documents: dedup (A2), first page (A3), meta rule (F5), response
status (F6), repack (J1), documents (A1, U1) and the split (P1 body).

Two shapes of the same data:

- typed tables ``hotels(doc_id, hotel_key, ...)`` and
  ``reviews(doc_id, page_no, pos, ...)``, where F5 and J1 are aggregate and join;
- documents, one row per document with ``entries MAP<key, json>``, where F5
  and J1 are row-local (``map_filter`` + ``explode``): no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions import expr as E

HOTEL_META = "g"        # first letter of a hotel key
WITH_RESPONSE = "Y"     # first letter of a review key with a response
NO_RESPONSE = "N"       # ... without one


def with_review_key(reviews: DataFrame) -> DataFrame:
    return reviews.withColumn(
        "review_key", E.review_key("review_response", "review_date", "id_user"))


def dedup_reviews(reviews: DataFrame, doc: str = "doc_id") -> DataFrame:
    """A2: one review per (document, review key); the later one (page, then
    position) wins. ``max_by`` aggregates map-side before the shuffle, and the
    shuffle key includes the review key, so a hot hotel spreads over tasks."""
    r = reviews if "review_key" in reviews.columns else with_review_key(reviews)
    payload = [c for c in r.columns if c not in (doc, "review_key")]
    order = F.struct("page_no", "pos")
    return (r.groupBy(doc, "review_key")
            .agg(F.max_by(F.struct(*payload), order).alias("w"))
            .select(doc, "review_key", "w.*"))


def first_page(pages: DataFrame, group: str, order: str = "page_no") -> DataFrame:
    """A3: the row of the lowest page number per group (NULL fields kept)."""
    payload = [c for c in pages.columns if c != group]
    return (pages.groupBy(group).agg(F.min_by(F.struct(*payload), F.col(order)).alias("w"))
            .select(group, "w.*"))


def meta_documents(hotels: DataFrame, doc: str = "doc_id", key: str = "hotel_key") -> DataFrame:
    """documents with exactly one hotel key, with that hotel's record."""
    payload = [c for c in hotels.columns if c != doc]
    g = hotels.where(F.col(key).startswith(HOTEL_META))
    agg = g.groupBy(doc).agg(F.count(F.lit(1)).alias("_n_meta"),
                             F.min_by(F.struct(*payload), F.col(key)).alias("w"))
    return agg.where(F.col("_n_meta") == 1).select(doc, "w.*")


def response_status(key: Column | str) -> Column:
    """``Y…`` -> response, ``N…`` -> no_response, anything else NULL (dropped)."""
    k = F.col(key) if isinstance(key, str) else key
    first = F.left(k, F.lit(1))
    return (F.when(first == WITH_RESPONSE, F.lit("response"))
            .when(first == NO_RESPONSE, F.lit("no_response")))


def repack(reviews: DataFrame, metas: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Attach the hotel record to each review of the same document.

    Many-to-one equi-join: AQE broadcasts the hotel side if it is small and
    splits a hot document otherwise.
    """
    return reviews.join(metas, doc)


# --------------------------------------------------------------------------- documents

def _json_key(k: Column) -> Column:
    """A key as a JSON string literal, escaped as Spark's JSON writer does."""
    quoted = F.to_json(F.array(k))
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)


def hotel_documents(hotels: DataFrame, reviews: DataFrame, hotel_fields: list[str],
                    review_fields: list[str], doc: str = "doc_id") -> DataFrame:
    """A1 (+U1): one JSON document ``[{hotel_key: {...}, review_key: {...}, ...}]``
    per (document, page).

    Reviews are deduplicated first (A2), so keys are unique; a review belongs to
    the page it won on, and every page's document repeats the hotel entry. A
    hotel without reviews has one document, of page 1. A group holds the reviews
    of one page, whatever the number of pages.
    Output: ``doc, page_no, n_keys, document``.
    """
    r = dedup_reviews(reviews, doc)
    rev_entries = r.select(doc, "page_no", F.col("review_key").alias("key"),
                           F.to_json(F.struct(*review_fields)).alias("value"))
    pages = rev_entries.select(doc, "page_no").distinct()
    hotel_entries = (hotels.join(pages, doc, "left")
                     .select(doc, F.coalesce("page_no", F.lit(1)).alias("page_no"), F.col("hotel_key").alias("key"),
                             F.to_json(F.struct(*hotel_fields)).alias("value")))
    entries = rev_entries.unionByName(hotel_entries)
    pair = F.concat(_json_key(F.col("key")), F.lit(": "), F.col("value"))
    return (entries.groupBy(doc, "page_no")
            .agg(F.count(F.lit(1)).alias("n_keys"),
                 F.array_join(F.array_sort(F.collect_list(pair)), ", ").alias("_body"))
            .select(doc, "page_no", "n_keys",
                    F.concat(F.lit("[{"), F.col("_body"), F.lit("}]")).alias("document")))


def parse_documents(text: DataFrame, value: str = "value") -> DataFrame:
    """S4 parse: JSON text ``[{...}]`` -> ``entries MAP<STRING, STRING>`` of the
    first element (nested objects come back as JSON text). Empty text, an empty
    array or broken JSON give a NULL map; those rows are set apart by the caller."""
    parsed = F.from_json(F.col(value), "array<map<string,string>>", {"mode": "PERMISSIVE"})
    return text.withColumn("entries", F.get(parsed, 0))


def rejected_documents(docs: DataFrame, entries: str = "entries") -> DataFrame:
    """SURVEY D15 and F5: documents the split leaves out, with a reason —
    ``unparsable`` (empty array, broken JSON), ``no hotel key`` or
    ``several hotel keys``. Row-local, like the split."""
    m = F.col(entries)
    n_meta = F.size(F.map_filter(m, lambda k, v: F.left(k, F.lit(1)) == HOTEL_META))
    reason = (F.when(m.isNull(), F.lit("unparsable"))
              .when(n_meta == 0, F.lit("no hotel key"))
              .when(n_meta > 1, F.lit("several hotel keys")))
    return docs.withColumn("reason", reason).where(F.col("reason").isNotNull())


def rejected_reviews(reviews: DataFrame) -> DataFrame:
    """SURVEY D8: extracted reviews without a user id (no link in the block)
    are kept apart instead of ending the page."""
    return reviews.where(F.col("id_user").isNull()).withColumn("reason", F.lit("no user link"))


def pseudonymise(split: DataFrame) -> DataFrame:
    """SURVEY 7.4: replace ``id_user`` and ``name_user`` of split review objects
    by their SHA-256 and rebuild the review and object keys from the hashed id.
    The hash is deterministic, so keys stay stable from run to run and the
    last-wins merges still see one key per review; no raw id is left in a key."""
    hid = F.sha2(F.col("review.id_user"), 256)
    review = F.col("review").withField("id_user", hid).withField(
        "name_user", F.sha2(F.col("review.name_user"), 256))
    key = E.review_key(F.col("review.review_response"), F.col("review.review_date"), hid)
    return (split.withColumn("review", review)
            .withColumn("review_key", key)
            .withColumn("object_key", E.object_key("hotel_key", key)))


def split_documents(docs: DataFrame, review_schema: str, hotel_schema: str,
                    entries: str = "entries") -> DataFrame:
    """P1 on documents, row-local: F5 keeps documents with exactly one ``g`` key,
    each ``Y``/``N`` entry becomes one object with the hotel record attached."""
    m = F.col(entries)
    metas = F.map_filter(m, lambda k, v: F.left(k, F.lit(1)) == HOTEL_META)
    revs = F.map_filter(m, lambda k, v: F.left(k, F.lit(1)).isin(WITH_RESPONSE, NO_RESPONSE))
    # the hotel key comes from the document itself; an incoming column is replaced
    docs = docs.drop("hotel_key", "review_key", "object_key")
    one = docs.where(F.size(metas) == 1).select(
        "*", F.map_keys(metas)[0].alias("hotel_key"), F.map_values(metas)[0].alias("_meta_json"),
        F.explode(revs).alias("review_key", "_review_json"))
    out = one.select(
        "*",
        F.from_json("_meta_json", hotel_schema).alias("meta_data"),
        F.from_json("_review_json", review_schema).alias("review"))
    return (out.withColumn("response_status", response_status("review_key"))
            .withColumn("lang", E.lang_or_null(F.col("review.review_language")))
            .withColumn("object_key", E.object_key("hotel_key", "review_key"))
            .drop(entries, "_meta_json", "_review_json"))


def last_objects(split: DataFrame, *order: str, key: str = "object_key") -> DataFrame:
    """The last object of each key by ``order`` (a later document replaces the
    object that an earlier one left under the same key); equal orders are decided
    by the object itself. ``max_by`` aggregates before the shuffle."""
    payload = [c for c in split.columns if c not in (key, *order)]
    when = F.struct(*order, F.xxhash64(*payload))
    return (split.groupBy(key).agg(F.max_by(F.struct(*payload, *order), when).alias("w"))
            .select(key, *[f"w.{c}" for c in payload]))
