"""Operator 6: exact top-k search by multi-resolution segment statistics.

Components become whole numbers floor(256 x). A vector cut into S segments of
length l has for each the mean m and the deviation d. For query q and
candidate x

    |q - x|^2 >= sum over segments of l ((m_q - m_x)^2 + (d_q - d_x)^2),

so, the lengths being known, q.x <= sum of l (m_q m_x + d_q d_x). The bounds
of 1, 4 and 16 segments, each a small matrix product, are used coarse to fine:
a candidate whose bound is below the k-th best exact product that the query
has found so far is out. What survives all levels gets its exact product.
The first k exact products come from the candidates with the highest bounds.

Queries and candidates meet in blocks: at most about ``QUERY_BLOCK`` queries
and ``CANDIDATE_BLOCK`` candidates by hash of the id. A block returns k rows
per query; the blocks' rows meet in a ranked window, of which Spark keeps k
per query before the shuffle. Neither side is broadcast or collected.

Defined results: vectors that are null or hold null or non-finite components
and rows without vec_id take no part; an empty vector has product 0 with all;
shorter vectors count as filled with zeros; rows that share a vec_id count as
one, with the smallest of their vectors; fewer than k candidates give fewer
rows; equal scores go to the smaller vec_id. Scores are exact while the
products stay below 2^62.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.llm.common import written
from reviewlake.session import table

TOP = 5
SCALE = 256
EVERY = 50               # queries: ids divisible by this
LEVELS = (1, 4, 16)      # segments
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 16384
STRIP = 64               # queries at once inside a block


def whole(vector: Column) -> Column:
    """floor(256 x) of each component; null if the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(l) m and sqrt(l) d of each segment, side by side."""
    cut = x.reshape(len(x), segments, -1).astype(np.float64)
    m, l = cut.mean(axis=2), cut.shape[2]
    d = np.sqrt(((cut - m[:, :, None]) ** 2).mean(axis=2))
    return np.hstack([m, d]) * np.sqrt(l)


def block_top(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, point_ids: np.ndarray,
              k: int = TOP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, point position, product) of each query's k best points;
    ``point_ids`` ascend."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(points).max(initial=0)) * queries.shape[1]
    kind = np.float64 if largest < 2 ** 52 else np.int64     # whole numbers that float64 holds exactly
    q_exact, x_exact = queries.astype(kind), points.astype(kind)
    q_stats = [segment_statistics(queries, s) for s in LEVELS]
    x_stats = [segment_statistics(points, s) for s in LEVELS]
    out = []
    for at in range(0, len(queries), STRIP):
        some = slice(at, at + STRIP)
        own = query_ids[some, None] == point_ids[None, :]
        bound = q_stats[-1][some] @ x_stats[-1].T                 # of the finest level, for the first k only
        seeds = np.argpartition(np.where(own, -np.inf, bound), max(0, len(points) - k - 1), axis=1)[:, -k - 1:]
        first = np.einsum("ij,ikj->ik", q_exact[some], x_exact[seeds]).astype(np.float64)
        first[np.take_along_axis(own, seeds, axis=1)] = -np.inf
        first = np.sort(first, axis=1)[:, ::-1]
        floor = first[:, k - 1] if first.shape[1] >= k else np.full(len(first), -np.inf)
        alive = ~own
        for q, x in zip(q_stats, x_stats):
            left = np.flatnonzero(alive.any(axis=0))
            upper = q[some] @ x[left].T
            alive[:, left] &= upper + 1e-6 * (1 + np.abs(upper)) >= floor[:, None]
        left = np.flatnonzero(alive.any(axis=0))
        exact = q_exact[some] @ x_exact[left].T
        for i in range(len(exact)):
            mine = np.flatnonzero(alive[i, left])
            if len(mine) > k:
                cut = np.partition(exact[i, mine], len(mine) - k)[len(mine) - k]
                mine = mine[exact[i, mine] >= cut]
            best = mine[np.argsort(-exact[i, mine], kind="stable")][:k]
            out.append((np.full(len(best), at + i), left[best], exact[i, best].astype(np.int64)))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(map(np.concatenate, zip(*out)))


def _block(queries: pd.DataFrame, points: pd.DataFrame, k: int) -> pd.DataFrame:
    if queries.empty or points.empty:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    points = points.sort_values("id")
    width = max(1, queries["v"].str.len().max(), points["v"].str.len().max())
    width = -(-int(width) // LEVELS[-1]) * LEVELS[-1]
    q, x = (_whole_matrix(rows["v"], width) for rows in (queries, points))
    ids, of = points["id"].to_numpy(), queries["id"].to_numpy()
    i, j, score = block_top(q, of, x, ids, k)
    return pd.DataFrame({"query_id": of[i], "vec_id": ids[j], "score": score})


def _whole_matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


def top_search(vectors: DataFrame, is_query: Column, k: int = TOP, vec_id: str = "vec_id",
               embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score); ``is_query`` is a condition on ``id``."""
    points = written(
        vectors.select(F.col(f"`{vec_id}`").alias("id"), whole(F.col(f"`{embedding}`")).alias("v"))
        .where("id IS NOT NULL AND v IS NOT NULL").groupBy("id").agg(F.min("v").alias("v")), "points")
    n, n_queries = points.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    n_blocks = max(1, -(-n // CANDIDATE_BLOCK))
    n_query_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    kind = points.schema["id"].dataType.simpleString()

    def dealt(rows: DataFrame, blocks: int, others: int, own: str, other: str) -> DataFrame:
        return rows.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias(own),
                           F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    queries = dealt(points.where(is_query), n_query_blocks, n_blocks, "qb", "cb")
    candidates = dealt(points, n_blocks, n_query_blocks, "cb", "qb")
    best = queries.groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb")).applyInPandas(
        lambda a, b: _block(a, b, k), f"query_id {kind}, vec_id {kind}, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op6_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_search(table(spark, sf_dir, "embeddings"), F.col("id") % EVERY == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
