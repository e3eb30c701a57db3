"""Operator 5: embedding near-dedup by int8 tile products with error bounds.

Equal vectors are one node with a multiplicity (pre-aggregated, so one vector
in a third of all rows costs one node). A node's unit vector x is stored as
x = s q + e with q of int8 and the exact length |e| of what the rounding
lost. For two nodes |x.y - s_x s_y (q_x.q_y)| <= |e_x| (1 + |e_y|) + |e_y|,
so a tile product of the q says which pairs may reach the threshold; only
those are computed in double precision from the vectors as given.

Nodes are dealt to at most ``MAX_PIVOTS`` cells by their nearest pivot (a
bounded seeded sample of the nodes), cells to blocks of about ``BLOCK`` nodes.
Two cells farther apart than their radii and the threshold's angle allow have
no tile. A tile is one pair of blocks: at most about 2 * ``BLOCK`` nodes. It
returns one row per node that links to something: how many vectors, and the
smallest node that its links inside the tile reach (pairs are never emitted).
The links of the tiles are joined by ``components``.

Cells prune clustered vectors; on vectors without clusters nearly every pair
of blocks is a tile, and work grows with the square of the number of distinct
vectors, as any exact comparison of all with all does.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components, and rows without vec_id, link with nothing (0 links,
own component, kept if they have an id); shorter vectors count as filled with
zeros; rows that repeat vec_id and vector are vectors of their own for
n_links; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import hash_fraction, written
from reviewlake.llm.components import components
from reviewlake.session import table

THRESHOLD = 0.9
BLOCK = 4096
MAX_PIVOTS = 128
STRIP = 512
SLACK = 1e-4     # more than float32 products and the bound itself may be rounded by


def usable(vector: Column) -> Column:
    """Finite, not null, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, :len(v)] = v
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)      # no overflow in the squares
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q, s, length of the error) of unit vectors."""
    s = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / s[:, None]).astype(np.int8)
    return q, s, np.sqrt(((unit - q * s[:, None]) ** 2).sum(axis=1))


def possible(left: tuple, right: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of the pairs whose product may reach the threshold. One
    matrix product of the int8 values, the right ones scaled; a row is compared
    with one number, from its own error and the largest on the right, and what
    passes with the errors of both. float32 rounding is far below ``SLACK``."""
    (q, s, e), (r, t, f) = left, right
    product = q.astype(np.float32) @ (r * t[:, None]).astype(np.float32).T
    worst = f.max(initial=0)
    reach = (threshold - SLACK - e * (1 + worst) - worst) / s
    i, j = np.nonzero(product >= reach.astype(np.float32)[:, None])
    near = product[i, j] * s[i] + e[i] * (1 + f[j]) + f[j] >= threshold - SLACK
    return i[near], j[near]


class Forest:
    """Smallest node reached by the links seen so far, for positions 0..n-1."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            np.minimum.at(self.root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def _tile(rows: pd.DataFrame, threshold: float, width: int) -> pd.DataFrame:
    rows = rows.sort_values(["id", "h"], kind="stable").reset_index(drop=True)
    x = _matrix(rows["vector"], width)
    x /= np.abs(x).max(axis=1, keepdims=True)
    norm = np.sqrt((x * x).sum(axis=1))
    q = quantised(x / norm[:, None])
    block, many = rows["block"].to_numpy(), rows["n"].to_numpy()
    first = np.flatnonzero(block == block.min())
    second = np.flatnonzero(block == block.max())
    same = block.min() == block.max()
    if same and rows["tile"].iat[0] != f"{block[0]}-{block[0]}":
        return pd.DataFrame({"id": [], "h": [], "links": [], "root_id": [], "root_h": []})
    links, forest = np.zeros(len(rows), np.int64), Forest(len(rows))
    for at in range(0, len(first), STRIP):
        strip = first[at:at + STRIP]
        i, j = possible(tuple(y[strip] for y in q), tuple(y[second] for y in q), threshold)
        a, b = strip[i], second[j]
        if same:
            a, b = a[a < b], b[a < b]
        for part in range(0, len(a), 1 << 17):
            pa, pb = a[part:part + (1 << 17)], b[part:part + (1 << 17)]
            near = np.einsum("ij,ij->i", x[pa], x[pb]) / (norm[pa] * norm[pb]) >= threshold
            pa, pb = pa[near], pb[near]
            links += np.bincount(pa, weights=many[pb], minlength=len(rows)).astype(np.int64)
            links += np.bincount(pb, weights=many[pa], minlength=len(rows)).astype(np.int64)
            forest.link(pa, pb)
    linked = rows[links > 0]
    roots = rows.iloc[forest.root[links > 0]]
    return pd.DataFrame({"id": linked["id"].to_numpy(), "h": linked["h"].to_numpy(), "links": links[links > 0],
                         "root_id": roots["id"].to_numpy(), "root_h": roots["h"].to_numpy()})


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id",
                 embedding: str = "embedding") -> DataFrame:
    """(id, sig, n_links, component) per row of ``vectors``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{embedding}`").alias("vector"))
    sig = F.struct(F.xxhash64("vector").alias("h"), F.xxhash64(F.lit("second"), "vector").alias("h2"))
    fit = F.col("id").isNotNull() & usable(F.col("vector"))
    keyed = rows.select("id", F.when(fit, sig).alias("sig"), "vector")
    nodes = written(keyed.where("sig IS NOT NULL").groupBy("sig").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"))
        .select("sig", "id", F.col("sig.h").alias("h"), "n", "vector"), "nodes")
    n_nodes, width = nodes.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()

    n_pivots = max(1, min(MAX_PIVOTS, n_nodes // BLOCK))
    near_enough = nodes.where(hash_fraction(F.col("h"), F.lit("pivot")) * max(1, n_nodes) < 4 * n_pivots)
    some = near_enough.select("h", "vector").orderBy("h").limit(n_pivots).toPandas()  # at most MAX_PIVOTS vectors
    if some.empty:
        some = nodes.select("h", "vector").limit(1).toPandas()
    pivots = _unit(_matrix(some["vector"], width)) if len(some) else np.ones((1, width)) / math.sqrt(width)

    def home(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            dot = _unit(_matrix(part["vector"], width)) @ pivots.T
            cell = dot.argmax(axis=1)
            part["cell"] = cell
            part["angle"] = np.arccos(np.clip(dot[np.arange(len(part)), cell], -1, 1))
            yield part[["id", "h", "n", "vector", "cell", "angle"]]

    kind = nodes.schema["id"].dataType.simpleString()
    inner = nodes.schema["vector"].dataType.simpleString()
    dealt = written(nodes.select("id", "h", "n", "vector").mapInPandas(
        home, f"id {kind}, h long, n long, vector {inner}, cell int, angle double"), "cells")
    cells = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).toPandas()
    blocks, radius = np.zeros(len(pivots), np.int64), np.full(len(pivots), -1.0)
    blocks[cells["cell"]], radius[cells["cell"]] = -(-cells["n"] // BLOCK), cells["radius"]
    offset = np.concatenate(([0], np.cumsum(blocks)))
    apart = np.arccos(np.clip(pivots @ pivots.T, -1, 1)) - radius[:, None] - radius
    meet = (apart <= math.acos(threshold) + 1e-6) & (radius[:, None] >= 0) & (radius >= 0)

    def deal(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            cell, h = part["cell"].to_numpy(), part["h"].to_numpy()
            part["block"] = offset[cell] + (h // (1 << 8)) % np.maximum(1, blocks[cell])
            for other in np.flatnonzero(blocks):
                here = part[meet[cell, other]]
                for k in range(offset[other], offset[other + 1]) if len(here) else ():
                    tile = [f"{min(b, k)}-{max(b, k)}" for b in here["block"]]
                    yield here[["id", "h", "n", "vector", "block"]].assign(tile=tile)

    tiles = dealt.mapInPandas(deal, f"id {kind}, h long, n long, vector {inner}, block long, tile string")
    found = written(tiles.groupBy("tile").applyInPandas(
        lambda t: _tile(t, threshold, width), f"id {kind}, h long, links long, root_id {kind}, root_h long"), "tile-links")
    node = F.struct("id", "h")
    joined = components(found.select(node.alias("a"), F.struct(F.col("root_id").alias("id"), F.col("root_h").alias("h")).alias("b")))
    counts = found.groupBy("id", "h").agg(F.sum("links").alias("links"))
    result = (nodes.select("sig", "id", "h", "n").join(counts, ["id", "h"], "left")
              .withColumn("node", node).join(joined, "node", "left")
              .select("sig", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                      F.coalesce("component.id", "id").alias("component")))
    return keyed.select("id", "sig").join(result, "sig", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        (F.col("id") == F.col("component")).alias("kept"))


ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS len FROM v),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (a.len * b.len) >= 0.9),
reach AS (
  SELECT vec_id AS node, vec_id AS got FROM u UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.got = l.a),
lowest AS (SELECT node, min(got) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, coalesce(l.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(l.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counts c ON e.vec_id = c.a LEFT JOIN lowest l ON e.vec_id = l.node
"""
