"""Connected components by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each
step replaces edges by edges to smaller nodes and never has more edges than
there were; it ends when every node points at the smallest of its component.
No component, however large, meets in one task: minima are pre-aggregated and
the joins are plain equi-joins that AQE may split. Each round is written to
the shared scratch folder, so a lost executor repeats one round at most.

Up to ``FEW`` edges, a bound that doesn't grow with the input, are not worth
those rounds of joins: one task reads them, sorted by node by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import written

FEW = 1 << 16


def _codes(nodes: pa.Array) -> np.ndarray:
    """Columns of numbers, equal where the nodes are."""
    if pa.types.is_struct(nodes.type):
        return np.hstack([_codes(f) for f in nodes.flatten()])
    return pc.fill_null(nodes.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False).reshape(-1, 1)


def _smallest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, edge), two of each edge and sorted by node: (node, component)."""
    held = [b for b in parts if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held).combine_chunks()
    nodes = rows["node"].chunk(0)
    codes = _codes(nodes)
    new = np.append(True, (codes[1:] != codes[:-1]).any(axis=1))
    ends = (np.cumsum(new) - 1)[np.argsort(rows["edge"].to_numpy(), kind="stable")].reshape(-1, 2)
    root = np.arange(new.sum())
    while True:
        low = root[ends]
        apart = low[:, 0] != low[:, 1]
        if not apart.any():
            break
        np.minimum.at(root, low[apart].max(axis=1), low[apart].min(axis=1))
        while (root[root] != root).any():
            root = root[root]
    own = nodes.take(pa.array(np.flatnonzero(new)))
    yield pa.RecordBatch.from_arrays([own, own.take(pa.array(root))], ["node", "component"])


def _of_few(edges: DataFrame) -> DataFrame:
    kind = edges.schema["u"].dataType.simpleString()
    ends = edges.select(F.explode(F.array("u", "v")).alias("node"), F.col("edge"))
    return ends.repartition(1).sortWithinPartitions("node").mapInArrow(_smallest, f"node {kind}, component {kind}")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge to another; component
    is the smallest node reachable. Nodes are of any type with an order."""
    pair = edges.where(F.col(a) != F.col(b))
    now = written(pair.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"),
                              F.monotonically_increasing_id().alias("edge")), "edges")
    if now.count() <= FEW:
        return written(_of_few(now), "few")
    now = written(now.select("u", "v").distinct(), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def extended(known: DataFrame, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``known`` (node, component) with more ``edges`` between its nodes or new
    ones: only the components that an edge touches are worked on again."""
    of = lambda s: known.select(F.col("node").alias(s), F.col("component").alias(f"{s}_component"))
    between = (edges.join(of(a), a, "left").join(of(b), b, "left")
               .select(F.coalesce(f"{a}_component", a).alias("a"), F.coalesce(f"{b}_component", b).alias("b")))
    moved = written(components(between).select(F.col("node").alias("component"), F.col("component").alias("lower")), "moved")
    both = known.join(moved, "component", "left").select("node", F.coalesce("lower", "component").alias("component"))
    new = moved.select(F.col("component").alias("node"), F.col("lower").alias("component")).join(known.select("node"), "node", "left_anti")
    return both.unionByName(new)


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())
