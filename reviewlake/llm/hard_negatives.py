"""Operator 12: hard-negative mining with disjoint score slots.

For each anchor and each of its positives the hardest rows of other labels are
wanted whose score lies in a window that depends on the positive's score:
``low * positive <= 100 * negative <= high * positive``. Windows of one anchor
overlap, so they aren't searched one by one:

1. Positives: each anchor's ``n_positives`` best other rows of its own label.
2. The distinct upper limits of an anchor's windows cut its scores into
   disjoint slots, numbered downwards from the highest limit; scores above the
   highest limit or below every window's lower limit belong to none.
3. Combiners: while scores are computed, the best ``k`` rows of every slot are
   kept. A window's best k rows lie among its own slot's and the lower slots'.
4. Merges from the lowest slot upwards give for each slot the best k of it and
   all lower ones: the answer to every window with that upper limit, cut off at
   the window's lower limit.

Scores are computed in tiles: about ``ANCHORS`` anchors by hash meet about
``ROWS`` rows by hash. A task reads its anchors first and then streams the rows
past them in chunks, so it holds one block of anchors, one chunk and the best k
per anchor and slot. Labels play no part in the dealing, so a label of a third
of all rows makes no task larger. A tile returns at most k rows per anchor and
slot; Spark ranks these and keeps k per task before the shuffle.

Work grows with anchors times rows, as the contract's exact answer asks: a
stated query set against all rows, in blocks.

Defined results: rows with a null id, a null label, a null vector or null or
non-finite components take no part; an empty vector has product 0 with all,
shorter vectors count as filled with zeros; rows that share an id are rows of
their own, and each may be an anchor, a positive of the others and a negative;
equal scores go to the smaller id; windows of positives with a negative score
are empty; anchors without positives and windows without rows have no result;
an empty table gives an empty table; only the columns named are read, so extra
columns can't clash. Scores are exact while products stay below 2^62.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.llm.common import col, written
from reviewlake.session import table

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90        # window in percent of the positive's score
SCALE = 256
ANCHOR_EVERY = 100
RELABEL_EVERY = 7
LABELS = 10
ANCHORS = 1 << 12         # anchors of a tile
ROWS = 1 << 16            # rows of a tile
CHUNK = 1 << 11           # rows that meet the anchors at once
STRIP = 1 << 8            # anchors that meet a chunk at once
AREA = 1 << 20            # numbers of a strip or chunk: wide vectors come in fewer rows
ALL = np.iinfo(np.int64).max


def whole(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; null if the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrices(vectors: pd.Series, most: int) -> Iterator[tuple[slice, np.ndarray]]:
    """(positions, matrix) of vectors sorted by length: at most ``most`` rows and
    about ``AREA`` numbers each, short vectors filled with zeros."""
    length = vectors.str.len().to_numpy(np.int64)
    at = 0
    while at < len(vectors):
        to = min(len(vectors), at + most)
        while to > at + 1 and (to - at) * length[to - 1] > AREA:
            to = at + (to - at + 1) // 2
        out = np.zeros((to - at, max(1, length[to - 1])), np.int64)
        for k, v in enumerate(vectors.iloc[at:to]):
            out[k, :len(v)] = v
        yield slice(at, to), out
        at = to


def _by_length(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.iloc[np.argsort(rows["v"].str.len().to_numpy(np.int64), kind="stable")].reset_index(drop=True)


class Best:
    """The best k rows per anchor and slot among those seen so far.

    ``limits[a]`` are the anchor's upper limits, descending (filled with the
    least number); a score s lies in the last slot whose limit it doesn't
    exceed. Scores below ``floor[a]`` lie in none.
    """

    def __init__(self, limits: np.ndarray, floor: np.ndarray, k: int):
        self.limits, self.floor, self.k = limits, floor, k
        self.worst = np.full(limits.shape, np.iinfo(np.int64).min)     # the k-th best score, once there are k
        self.held = (np.zeros(0, np.int64),) * 4                       # anchor, slot, score, id of the row

    def add(self, scores: np.ndarray, fit: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` of the anchors with rows ``ids``; ``fit`` says which pairs may count."""
        limits = self.limits
        slot = np.full(scores.shape, -1)
        for j in range(limits.shape[1]):
            slot += scores <= limits[:, j, None]
        fit = fit & (slot >= 0) & (scores >= self.floor[:, None])
        a, r = np.nonzero(fit)
        s, v = slot[a, r], scores[a, r]
        near = v >= self.worst[a, s]
        if not near.any():
            return
        new = (a[near], s[near], v[near], ids[r[near]])
        rows = tuple(map(np.concatenate, zip(self.held, new)))
        order = np.lexsort((rows[3], -rows[2], rows[1], rows[0]))
        rows = tuple(x[order] for x in rows)
        group = rows[0] * limits.shape[1] + rows[1]
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        rank = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
        last = rank == self.k - 1
        self.worst[rows[0][last], rows[1][last]] = rows[2][last]
        keep = rank < self.k
        self.held = tuple(x[keep] for x in rows)


class _Tile:
    """One block of anchors and what has passed by so far."""

    def __init__(self, anchors: pd.DataFrame, k: int, same_label: bool):
        self.same = same_label
        anchors = _by_length(anchors)
        self.strips = list(_matrices(anchors["v"], STRIP))
        self.uid, self.label = anchors["uid"].to_numpy(np.int64), anchors["label"].to_numpy(np.int64)
        limits = np.full((len(anchors), max(map(len, anchors["limits"]))), np.iinfo(np.int64).min)
        for a, own in enumerate(anchors["limits"]):
            limits[a, :len(own)] = own
        floor = anchors["floor"].to_numpy(np.int64)
        self.best = [Best(limits[mine], floor[mine], k) for mine, _ in self.strips]

    def add(self, rows: pd.DataFrame) -> None:
        rows = _by_length(rows)
        uid, label, ids = (rows[c].to_numpy(np.int64) for c in ("uid", "label", "id"))
        for some, y in _matrices(rows["v"], CHUNK):
            for (mine, x), best in zip(self.strips, self.best):
                width = min(x.shape[1], y.shape[1])         # beyond it one side is zero
                u, w = x[:, :width], y[:, :width]
                largest = float(np.abs(u).max(initial=0)) * float(np.abs(w).max(initial=0)) * width
                if largest < 2 ** 52:                       # float64 products are whole numbers then
                    u, w = u.astype(np.float64), w.astype(np.float64)
                scores = (u @ w.T).astype(np.int64)
                fit = self.label[mine, None] == label[some]
                fit = fit & (self.uid[mine, None] != uid[some]) if self.same else ~fit
                best.add(scores, fit, ids[some])

    def found(self) -> pd.DataFrame:
        a, slot, score, ids = (np.concatenate(x) for x in zip(*(
            (best.held[0] + mine.start, *best.held[1:]) for (mine, _), best in zip(self.strips, self.best))))
        return pd.DataFrame({"anchor": self.uid[a], "slot": slot.astype(np.int32), "score": score, "id": ids})


def _streamed(k: int, same_label: bool):
    """Rows sorted by (ab, rb, kind): anchors (kind 0) of each tile, then its rows."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, tile, anchors = None, None, []
        for part in parts:
            for key, rows in part.groupby(["ab", "rb"], sort=False):
                if key != now:
                    if tile is not None:
                        yield tile.found()
                    now, tile, anchors = key, None, []
                first = rows[rows["kind"] == 0]
                if len(first):
                    anchors.append(first)
                rest = rows[rows["kind"] == 1]
                if tile is None and anchors and len(rest):
                    tile = _Tile(pd.concat(anchors, ignore_index=True), k, same_label)
                if tile is not None and len(rest):
                    tile.add(rest)
        if tile is not None:
            yield tile.found()
    return run


def best_by_slot(points: DataFrame, anchors: DataFrame, k: int, same_label: bool) -> DataFrame:
    """(anchor, slot, score, id): the best ``k`` rows of ``points`` (uid, id,
    label, v) per anchor and slot; ``anchors`` (uid, label, v, limits, floor).
    Rows of the anchor's own label but itself, or of other labels."""
    n_rows, n_anchors = points.count(), anchors.count()
    rb, ab = max(1, -(-n_rows // ROWS)), max(1, -(-n_anchors // ANCHORS))
    block = lambda n: F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")              # noqa: E731
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))                # noqa: E731
    none = F.lit(None)
    left = anchors.select(F.lit(0).alias("kind"), "uid", F.lit(0).cast("long").alias("id"), "label", "v", "limits", "floor",
                          block(ab).alias("ab"), every(rb).alias("rb"))
    right = points.select(F.lit(1).alias("kind"), "uid", F.col("id").cast("long").alias("id"), "label", "v",
                          none.cast("array<bigint>").alias("limits"), none.cast("long").alias("floor"),
                          every(ab).alias("ab"), block(rb).alias("rb"))
    tiles = left.unionByName(right).repartition("ab", "rb").sortWithinPartitions("ab", "rb", "kind")
    found = tiles.mapInPandas(_streamed(k, same_label), "anchor long, slot int, score long, id long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def hard_negatives(rows: DataFrame, is_anchor: Column, n_positives: int = POSITIVES, k: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    for ``rows`` of (id, label, vector); ``is_anchor`` is a condition on ``id``.
    ``low`` and ``high`` are percent, 0 <= low, 0 < high."""
    points = written(rows.select("id", F.col("label").cast("long").alias("label"), whole(F.col("vector"), scale).alias("v"))
                     .where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
                     .withColumn("uid", F.monotonically_increasing_id()), "points")      # fixed by the writing
    anchors = points.where(is_anchor)
    every = anchors.select("uid", "label", "v", F.array(F.lit(int(ALL))).alias("limits"),
                           F.lit(-int(ALL)).alias("floor"))
    positives = best_by_slot(points, every, n_positives, same_label=True)
    # at most n_positives in an anchor's array
    own = written(positives.groupBy("anchor").agg(F.collect_list(F.struct(
        F.col("score").alias("score"), F.col("id").alias("id"))).alias("positives")), "positives")
    open_ = "transform(filter(positives, p -> p.score >= 0), p -> {})"
    own = own.select(F.col("anchor").alias("uid"), "positives",
                     F.sort_array(F.array_distinct(F.expr(open_.format(f"p.score * {high} div 100"))), asc=False).alias("limits"),
                     F.array_min(F.expr(open_.format(f"(p.score * {low} + 99) div 100"))).alias("floor")).where(F.size("limits") > 0)
    searched = anchors.select("uid", "label", "v").join(own.select("uid", "limits", "floor"), "uid")
    found = best_by_slot(points, searched, k, same_label=False)

    # merges from the lowest slot upwards: at most k rows a slot
    slots = found.groupBy("anchor").agg(F.collect_list(F.struct(
        F.col("slot").alias("slot"), (-F.col("score")).alias("minus"), F.col("id").alias("id"))).alias("rows"))
    both = own.join(slots, F.col("uid") == F.col("anchor")).join(anchors.select("uid", F.col("id").alias("anchor_id")), "uid")
    for j in reversed(range(n_positives)):
        own_slot = F.transform(F.filter("rows", lambda r: r["slot"] == j), lambda r: F.struct(r["minus"].alias("minus"), r["id"].alias("id")))  # noqa: B023
        lower = [F.col(f"best{j + 1}")] if j + 1 < n_positives else []
        both = both.withColumn(f"best{j}", F.slice(F.array_sort(F.concat(own_slot, *lower)), 1, k))
    merged = (both.withColumn("best", F.array(*[f"best{j}" for j in range(n_positives)]))
              .withColumn("p", F.explode("positives")).where("p.score >= 0"))
    answer = F.get("best", (F.array_position("limits", F.expr(f"p.score * {high} div 100")) - 1).cast("int"))
    inside = F.filter(answer, lambda r: F.col("p.score") * low <= -r["minus"] * 100)
    kind = rows.schema["id"].dataType
    return merged.select("anchor_id", "p", F.posexplode(inside).alias("at", "n")).select(
        "anchor_id", F.col("p.id").cast(kind).alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"),
        F.col("n.id").cast(kind).alias("negative_id"), F.col("p.score").alias("positive_score"), (-F.col("n.minus")).alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(col("vec_id") % RELABEL_EVERY == 0, (col("label") + 1) % LABELS).otherwise(col("label"))
    rows = table(spark, sf_dir, "embeddings").select(col("vec_id").alias("id"), moved.alias("label"), col("embedding").alias("vector"))
    return hard_negatives(rows, F.col("id") % ANCHOR_EVERY == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.uid AS anchor, a.vec_id AS anchor_id, r.uid, r.vec_id, a.label = r.label AS same, list_inner_product(a.e, r.e)::BIGINT AS score
  FROM v a JOIN v r ON a.uid <> r.uid WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor, vec_id AS positive_id, uid, score,
         row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS n FROM s WHERE same),
w AS (
  SELECT s.anchor_id, p.positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.uid ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON p.anchor = s.anchor
  WHERE p.n <= 5 AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM w WHERE rank <= 10
"""
