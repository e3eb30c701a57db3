"""A hot key holding a third or more of the rows: results stay whole and
groups stay bounded."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewlake.operators import documents as D
from reviewlake.operators.joins import range_join


def _reviews(spark, hot_n=2500, cold=50):
    rows = [(1, 1 + i // 5, i, f"user{i}", "01-2020", "en", f"text {i}", None) for i in range(hot_n)]
    rows += [(d, 1, 0, "u", "02-2020", "de", "t", "r") for d in range(2, 2 + cold)]
    return spark.createDataFrame(rows, "doc_id long, page_no int, pos long, id_user string, review_date string, "
                                       "review_language string, review_text string, review_response string")


def test_hot_hotel_has_one_document_per_page(spark):
    reviews = _reviews(spark)
    hotels = spark.range(1, 52).select(F.col("id").alias("doc_id"),
                                       F.concat(F.lit("g1000"), F.col("id").cast("string"),
                                                F.lit("-d10000")).alias("hotel_key"),
                                       F.concat(F.lit("g1000"), F.col("id").cast("string"),
                                                F.lit("-d10000")).alias("id_hotel"))
    docs = D.parse_documents(D.hotel_documents(hotels, reviews, ["id_hotel"], ["id_user", "review_text"]), "document").collect()
    hot = [d for d in docs if d.doc_id == 1]
    assert len(hot) == 500 and {d.n_keys for d in hot} == {6}   # five reviews a page and the hotel
    assert all("g10001-d10000" in d.entries for d in hot)       # every page's document carries the hotel
    keys = [k for d in hot for k in d.entries if not k.startswith("g")]
    assert len(keys) == len(set(keys)) == 2500                  # whole: every review once
    assert sum(1 for d in docs if d.doc_id != 1) == 50


def test_dedup_whole_under_skew(spark):
    r = _reviews(spark)
    dup = r.unionByName(r.withColumn("page_no", F.col("page_no") + 100).withColumn("review_text", F.lit("later")))
    d = D.dedup_reviews(dup)
    assert d.count() == r.count()
    assert d.where("doc_id = 1 and review_text <> 'later'").count() == 0


def test_range_join_hot_key_bucketed(spark):
    points = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("other")).otherwise(F.lit("hot")).alias("k"), F.col("id").alias("p"))
    ranges = spark.createDataFrame([("hot", 0, 9999), ("hot", 10000, 19999), ("other", 0, 19999)],
                                   "k string, lo long, hi long")
    j = range_join(points, ranges, "k", "p", "lo", "hi", 1000)
    assert j.count() == 20000
    assert j.groupBy("k", "p").count().where("count > 1").count() == 0
