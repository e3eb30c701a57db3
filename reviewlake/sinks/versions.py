"""Outputs in versions: a reader sees a finished version or the one before it.

A version is a folder of its own under ``<path>/data``. When all its files are
there, one row is appended to the table ``<path>/versions``: that row is what
makes it visible. A write that fails midway leaves a folder that no row names,
so the earlier version stays as it was; a rerun writes a new folder.

A version may replace one prefix only (``scope``, such as
``response_status=response/lang=en``). The rows of that prefix then come from
it, everything else from the versions before. One writer at a time per path.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

VERSIONS = "version long, folder string, scope string, upto long"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, folder, scope, upto) of the finished versions; empty before the first."""
    try:
        return spark.read.schema(VERSIONS).json(f"{path.rstrip('/')}/versions")
    except AnalysisException as e:      # nothing published there yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], VERSIONS)


def publish(spark: SparkSession, path: str, write: Callable[[str], object], scope: str = "", upto: int | None = None) -> str:
    """Let ``write`` fill a new folder, then make it the version that readers
    see. Returns the folder. ``upto`` is a number kept with the version."""
    path = path.rstrip("/")
    last = versions(spark, path).agg(F.max("version")).first()[0] or 0
    folder = f"{path}/data/v{last + 1:06d}-{uuid.uuid4().hex[:12]}"
    write(folder)
    spark.createDataFrame([(last + 1, folder, scope, upto)], VERSIONS).coalesce(1).write.mode("append").json(f"{path}/versions")
    return folder


def live(spark: SparkSession, path: str) -> list[tuple[str, str, list[str]]]:
    """(folder, scope, scopes that later versions replaced) of the versions that
    still show: the last whole one and the last of each prefix after it, so no
    more than there are prefixes."""
    every = versions(spark, path)
    whole = every.where("scope = ''").agg(F.max("version")).first()[0] or 0
    rows = every.where(F.col("version") >= whole).groupBy("scope").agg(F.max_by(F.struct("version", "folder"), "version").alias("v")).select(
        "scope", "v.*").collect()
    return [(r.folder, r.scope, [s.scope for s in rows if s.version > r.version and s.scope.startswith(r.scope)])
            for r in sorted(rows, key=lambda r: r.version) if not any(s.version > r.version and r.scope.startswith(s.scope) for s in rows)]


def _within(scope: str) -> Column:
    parts = [p.split("=", 1) for p in scope.split("/") if p]
    return reduce(lambda a, b: a & b, [F.col(k).cast("string").eqNullSafe(v) for k, v in parts], F.lit(True))


def read_live(spark: SparkSession, path: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """The rows that show now; ``read`` reads one folder and has the columns that scopes name."""
    frames = []
    for folder, scope, replaced in live(spark, path):
        rows = read(folder)
        frames.append(reduce(lambda df, s: df.where(~_within(s)), replaced, rows.where(_within(scope)) if scope else rows))
    if not frames:
        raise ValueError(f"nothing published under {path}")
    return reduce(DataFrame.unionByName, frames)
