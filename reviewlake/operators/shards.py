"""URL shards: ranges (W1), assignment (J2), pending work (F8), progress (A5),
hotel URL filter (F3) and URL counts (A7).

``urls(file, idx, url)`` is the URL list (S1/S7); ``markers(file, start,
marker)`` the progress markers (S6), one per worker range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.functions import expr as E
from reviewlake.operators.joins import range_join
from reviewlake.operators.ordering import global_row_number
from reviewlake.sources.readers import url_counts

# Bucket width of the range join: near the usual shard length (a sitemap file
# of 50,000 URLs dealt to 8 workers).
RANGE_BUCKET = 6_250


def next_in_order(df: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """``lead(value) over (partition by key order by order)`` without putting a
    whole key in one task: number rows globally by (key, order), then an
    equi-join of each row with its successor on (key, row number + 1)."""
    n = global_row_number(df, [key, order], "_g")
    succ = n.select(F.col(key).alias("_k2"), (F.col("_g") - 1).alias("_g2"),
                    F.col(value).alias(out))
    j = n.join(succ, (F.col(key) == F.col("_k2")) & (F.col("_g") == F.col("_g2")), "left")
    return j.drop("_g", "_k2", "_g2")


def shard_ranges(markers: DataFrame, urls: DataFrame) -> DataFrame:
    """``stop`` = next larger start of the same file − 1; the last shard stops
    at the list length − 1. Files are compared by equality (SURVEY D4)."""
    nxt = next_in_order(markers, "file", "start", "start", "_next")
    counts = url_counts(urls)
    j = nxt.join(counts, "file", "left")
    return j.select("file", "start", "marker",
                    F.coalesce(F.col("_next") - 1, F.col("n_urls") - 1).cast("bigint").alias("stop"))


def shard_assignment(urls: DataFrame, ranges: DataFrame, bucket_width: int = RANGE_BUCKET) -> DataFrame:
    """The shard holding each URL: same file and ``start <= idx <= stop``."""
    return range_join(urls, ranges, "file", "idx", "start", "stop", bucket_width)


def crawl_pending(assigned: DataFrame) -> DataFrame:
    """F8: URLs still to do: ``marker <= idx <= stop``. The URL at the marker is
    redone on restart; an unreadable marker redoes the shard from its start."""
    m = F.coalesce(F.col("marker"), F.col("start"))
    return assigned.where(F.col("idx").between(m, F.col("stop")))


def crawl_progress(markers: DataFrame) -> DataFrame:
    """A5: total of ``marker − start`` over readable markers, the average rounded
    half-even, and the number of unreadable markers. One global aggregate with
    partial sums per task. No readable marker gives NULL, not an error."""
    ok = F.col("marker").isNotNull()
    total = F.sum(F.when(ok, F.col("marker") - F.col("start")))
    n_ok = F.count_if(ok)
    return markers.agg(
        n_ok.alias("n_markers"),
        total.cast("bigint").alias("total_progress"),
        F.bround(total / F.nullif(n_ok, F.lit(0)), 0).cast("bigint").alias("avg_progress"),
        F.count_if(~ok).alias("n_unreadable"))


def hotel_urls(urls: DataFrame) -> DataFrame:
    """URLs with a hotel key (others are reported by :func:`non_hotel_urls`)."""
    return urls.withColumn("hotel_id", E.hotel_id("url")).where(F.col("hotel_id").isNotNull())


def non_hotel_urls(urls: DataFrame) -> DataFrame:
    return urls.where(E.hotel_id("url").isNull())
