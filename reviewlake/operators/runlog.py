"""Run log (A6): one row per hotel crawl.

A crawl walks pages 1, 2, ... of a hotel and stops at the first page that is
not ``ok`` (F4). Reviews of the pages before it are kept (SURVEY D1, intended
behaviour); the count is taken before dedup, as the reference counts its list.
Status is ``Success`` only when no page failed; the reason is ``finished``,
or the failure reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake import schemas as S
from reviewlake.functions import expr as E

REASON_OF_STATUS = {"fetch_failed": S.RUN_REASON_FAILED, "banned": "banned"}


def run_log(pages: DataFrame, reviews: DataFrame | None = None, fetches: DataFrame | None = None,
            hotel: str = "doc_id") -> DataFrame:
    """``pages(hotel, page_no, url, status)``, ``reviews(hotel, page_no, ...)``,
    optional ``fetches(hotel, page_no, fetched_at, elapsed_s)`` ->
    ``RUN_LOG`` rows: hotel_id, status, n_reviews, runtime_s, url, reason, finish_time.

    With ``reviews=None`` the pages carry ``n_reviews``, the reviews found on
    each page. Reviews and fetches are summed per (hotel, page) and united with
    the pages; one more aggregate gives one small struct per page of a hotel,
    in page order, from which every column is read row-locally.
    """
    nothing = {"url": "string", "status": "string", "n": "long", "elapsed": "decimal(28,3)", "fetched_at": "timestamp"}

    def facts(df: DataFrame, **known) -> DataFrame:
        return df.select(hotel, "page_no", *[known.get(c, F.lit(None).cast(t)).alias(c) for c, t in nothing.items()])

    found = F.col("n_reviews").cast("long") if reviews is None else F.lit(None).cast("long")
    rows = facts(pages, url=F.col("url"), status=F.col("status"), n=found)
    if reviews is not None:
        rows = rows.unionByName(facts(reviews, n=F.lit(1).cast("long")))
    if fetches is not None:
        rows = rows.unionByName(facts(fetches, elapsed=F.col("elapsed_s").cast("decimal(28,3)"),
                                      fetched_at=F.col("fetched_at").cast("timestamp")))
    per_page = rows.groupBy(hotel, "page_no").agg(
        F.max("url").alias("url"), F.max("status").alias("status"), F.sum("n").alias("n"),
        F.sum("elapsed").alias("elapsed"), F.max("fetched_at").alias("fetched_at"))
    one = per_page.groupBy(hotel).agg(F.array_sort(F.collect_list(
        F.struct("page_no", "status", "url", "n", "elapsed", "fetched_at"))).alias("p"))
    one = one.withColumn("stop", F.get(F.filter("p", lambda x: x["status"] != "ok"), 0))
    before = F.coalesce(F.col("stop.page_no"), F.lit(2**31 - 1))
    read = F.filter("p", lambda x: x["page_no"] < before)
    fetched = F.filter("p", lambda x: x["page_no"] <= before)
    reason = F.coalesce(*[F.when(F.col("stop.status") == k, F.lit(v)) for k, v in REASON_OF_STATUS.items()],
                        F.lit(S.RUN_REASON_FINISHED))
    url = F.get(F.filter("p", lambda x: x["url"].isNotNull()), 0)["url"]
    total = F.aggregate(F.filter(fetched, lambda x: x["elapsed"].isNotNull()), F.lit(0).cast("decimal(28,3)"),
                        lambda a, x: (a + x["elapsed"]).cast("decimal(28,3)"))
    seen = F.exists(fetched, lambda x: x["elapsed"].isNotNull())
    return one.where(url.isNotNull()).select(
        E.hotel_id(url).alias("hotel_id"),
        F.when(F.col("stop").isNull(), F.lit(S.RUN_STATUS_SUCCESS)).otherwise(F.lit(S.RUN_STATUS_EMPTY)).alias("status"),
        F.aggregate(read, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["n"], F.lit(0))).cast("int").alias("n_reviews"),
        F.when(seen, total).cast("double").alias("runtime_s"), url.alias("url"), reason.alias("reason"),
        F.array_max(F.transform(fetched, lambda x: x["fetched_at"])).alias("finish_time"))
