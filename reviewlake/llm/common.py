"""Helpers shared by the operators of this subpackage.

Row identity. ``doc_id`` may be null or repeated, so an operator that joins
its decisions back to rows uses ``row_key``: the pair (doc_id, hash of the
text). Rows that repeat both are the same document and get the same result.
Struct keys compare null-safely.

Column names. Operators read the columns they are told to and nothing else;
functions that keep the caller's columns carry them in one struct
(``packed`` / ``unpacked``), so no name of the caller can clash.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.session import scratch_path

TEXTS = 1000              # whole texts that a task's Python works on at once

#: Words of the contracts: runs of anything but space and U+0009 to U+000D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def row_key(doc_id: Column, text: Column) -> Column:
    return F.struct(doc_id.alias("id"), F.xxhash64(text).alias("h"))


def packed(df: DataFrame, **extra: Column) -> DataFrame:
    """All columns of ``df`` as struct ``row`` plus the ``extra`` columns."""
    return df.select(F.struct(*[col(c) for c in df.columns]).alias("row"),
                     *[c.alias(n) for n, c in extra.items()])


def unpacked(columns: list[str], **replaced: Column) -> list[Column]:
    """Select list that turns ``row`` back into ``columns``, some replaced."""
    return [(replaced[c] if c in replaced else F.col("row").getField(c)).alias(c) for c in columns]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder: computed once,
    cut from its lineage, and not lost with an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def few_at_once(spark: SparkSession):
    """What is written here passes whole texts and sets to and from Python ``TEXTS`` at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), TEXTS) if int(before) > 0 else TEXTS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def slices(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The same rows, at most ``TEXTS`` at a time."""
    for rows in parts:
        for at in range(0, len(rows), TEXTS):
            yield rows.iloc[at:at + TEXTS]


def tidied(out: Iterator) -> Iterator:
    """The same, after which the free memory of a Python worker, which Spark keeps
    for other tasks, goes back to the system (as far as its C library can)."""
    try:
        yield from out
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_of(doc_id: Column) -> Column:
    """crc32 of the decimal text of ``doc_id`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def hash_fraction(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the values only: for seeded samples."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def fitted(sample: DataFrame, fit: Callable[[pd.DataFrame], bytes]) -> bytes:
    """Fit a model in one task over a sample whose size the caller has bounded;
    the rows hold bounded features, not texts. If the executor is lost, Spark
    runs the task again. Only the model comes to the driver."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = list(parts)
        if rows:
            yield pd.DataFrame({"model": [fit(pd.concat(rows, ignore_index=True))]})

    got = sample.repartition(1).mapInPandas(run, "model binary").collect()
    return bytes(got[0].model) if got else b""
