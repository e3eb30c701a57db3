"""Operator 4: mixing sources to target weights by capped water-filling.

Size of a document: its number of words (``WORD_PATTERN``), 0 for null. The
sources share the words of the whole table by weight; a source may be read at
most ``max_epochs`` times, so its target stops at ``max_epochs`` times its
size, and what it can't use goes to the others by weight until none is above.
That is one water level: target = min(level * weight, cap). The level rises
round by round: each round is one aggregate over the sources (clamped caps,
weights still free), with one row for the driver.

A source of size s and target t is read floor(t / s) whole times; the rest
r < s is a seeded sample of its documents. Documents fall into 1024 * 1024
hash cells by the MD5 of (seed, doc_id, text); cells are taken in order until r is
reached, found with two histograms (the second over the one cell the first
stops in), so no source is sorted or gathered: a source with a third of all
rows is pre-aggregated like any other. The last cell goes in if it brings the
source nearer to its target. Runs with one seed agree.

Defined results: null and empty texts have size 0 and take 0 words; a null
source is a source of its own, ranked last; sources of size 0 have target 0;
rows that repeat doc_id and text fall into the same cell and are taken
together; an empty table gives an empty table. Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.llm.common import WORD_PATTERN, col, packed, unpacked, written
from reviewlake.operators.ordering import global_row_number
from reviewlake.session import table

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
CELLS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _cells(doc_id: Column, text: Column, seed: int) -> list[Column]:
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")),
                          F.coalesce(text, F.lit(""))))
    return [(F.conv(F.substring(h, at, 4), 16, 10).cast("int") % CELLS).alias(c) for c, at in (("c1", 1), ("c2", 5))]


def sized(docs: DataFrame, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, c1, c2): all that the plan of the mix needs."""
    return docs.select(col(doc_id).alias("doc_id"), col(source).alias("source"), word_count(col(text)).alias("size"),
                       *_cells(col(doc_id), col(text), seed))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) by water-filling."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size")) \
        .withColumn("unnamed", F.col("source").isNull())
    ranked = global_row_number(totals, ["unnamed", "source"], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    rows = written(ranked.select("source", "source_size", weight.alias("weight")), "mix-sources")
    cap = F.col("source_size") * max_epochs
    level = 0.0
    while True:
        above = F.lit(level) * F.col("weight") > cap
        total, clamped, free = rows.agg(F.sum("source_size"), F.sum(F.when(above, cap).otherwise(0)),
                                        F.sum(F.when(above, 0).otherwise(F.col("weight")))).first()
        if not free:  # no rows, or every source is at its cap
            break
        found = (total - clamped) / free
        if found <= level:
            break
        level = found
    return rows.withColumn("target", F.least(F.lit(level) * F.col("weight"), cap.cast("double")))


def mix_plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source_size, target, whole (epochs of every document)
    and the cells (cut1, cut2) below which a document is read once more."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = (source_targets(sizes, weights, max_epochs).withColumn("whole", whole)
            .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    plan = written(plan, "mix-plan")
    named = plan.select(F.col("source").alias("named"), "rest")

    def running(cell: str, rows: DataFrame) -> DataFrame:
        before = Window.partitionBy("source").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
        sums = rows.groupBy("source", cell).agg(F.sum("size").alias("size")).where("size > 0")
        return sums.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))

    joined = running("c1", sizes).join(named, F.col("source").eqNullSafe(F.col("named")))
    first = (joined.where((F.col("start") < F.col("rest")) & (F.col("start") + F.col("size") > F.col("rest")))
             .select("named", F.col("c1").alias("cut1"), F.col("rest") - F.col("start").alias("left")))
    first = written(first.toDF("named", "cut1", "left"), "mix-cut")
    inside = sizes.join(first, F.col("source").eqNullSafe(F.col("named")) & (F.col("c1") == F.col("cut1"))) \
        .select("source", "c2", "size")
    second = (running("c2", inside).join(first, F.col("source").eqNullSafe(F.col("named")))
              .where(F.col("start") + F.col("size") / 2 <= F.col("left"))
              .groupBy("source").agg((F.max("c2") + 1).alias("cut2"))
              .select(F.col("source").alias("found"), "cut2"))
    cuts = first.join(second, F.col("named").eqNullSafe(F.col("found")), "left").select("named", "cut1", "cut2")
    # without a cell that the rest stops in, the rest is 0 or ends exactly with a cell
    even = (joined.where(F.col("start") + F.col("size") <= F.col("rest"))
            .groupBy("source").agg((F.max("c1") + 1).alias("cut")).select(F.col("source").alias("whole_cells"), "cut"))
    done = (plan.join(cuts, F.col("source").eqNullSafe(F.col("named")), "left")
            .join(even, F.col("source").eqNullSafe(F.col("whole_cells")), "left")
            .select("source", "source_size", "target", "whole",
                    F.coalesce("cut1", "cut", F.lit(0)).alias("cut1"), F.coalesce("cut2", F.lit(0)).alias("cut2")))
    return written(done, "mix-cuts")


def with_epochs(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (source, c1, c2, ...) with source_size, target and epochs. The
    plan is a small table on disk: Spark broadcasts it if its size is below
    spark.sql.autoBroadcastJoinThreshold and shuffles otherwise."""
    named = plan.withColumnRenamed("source", "named")
    more = (F.col("c1") < F.col("cut1")) | ((F.col("c1") == F.col("cut1")) & (F.col("c2") < F.col("cut2")))
    return (rows.join(named, F.col("source").eqNullSafe(F.col("named")))
            .withColumn("epochs", F.col("whole") + more.cast("long"))
            .drop("named", "whole", "cut1", "cut2"))


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix reads it."""
    plan = mix_plan(written(sized(docs, seed), "mix-sizes"))
    rows = packed(docs, source=col("source"), **dict(zip(("c1", "c2"), _cells(col("doc_id"), col("text"), seed))))
    read = with_epochs(rows, plan).where("epochs > 0")
    return (read.select("row", F.explode(F.sequence(F.lit(1), F.col("epochs"))).alias("epoch"))
            .select(*unpacked(docs.columns)))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = written(sized(table(spark, sf_dir, "documents")), "mix-sizes")
    return with_epochs(sizes, mix_plan(sizes)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken"))


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('0|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS h FROM documents),
docs AS (
  SELECT doc_id, source, size, ('0x' || h[1:4])::INTEGER % 1024 AS c1, ('0x' || h[5:8])::INTEGER % 1024 AS c2 FROM sized),
src AS (
  SELECT source, s, 3 * s AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM (SELECT source, sum(size)::BIGINT AS s FROM docs GROUP BY source)),
ladder AS (
  SELECT *, (SELECT sum(s) FROM src)
            - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY cap::DOUBLE / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM src),
water AS (
  SELECT coalesce(arg_min(rest::DOUBLE / free::DOUBLE, cap::DOUBLE / w), 0) AS level FROM ladder
  WHERE rest::DOUBLE / free::DOUBLE * w <= cap),
goal AS (
  SELECT source, s, least(level * w, cap::DOUBLE) AS target FROM src, water),
plan AS (
  SELECT source, s, target, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END::BIGINT AS whole FROM goal),
need AS (SELECT *, target - whole * s AS rest FROM plan),
h1 AS (
  SELECT source, c1, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY c1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM (SELECT source, c1, sum(size) AS size FROM docs GROUP BY source, c1 HAVING sum(size) > 0)),
cut1 AS (
  SELECT h1.source, c1, rest - b AS goal FROM h1 JOIN need n ON h1.source IS NOT DISTINCT FROM n.source
  WHERE b < rest AND b + size > rest),
even AS (
  SELECT h1.source, max(c1) + 1 AS c1 FROM h1 JOIN need n ON h1.source IS NOT DISTINCT FROM n.source
  WHERE b + size <= rest GROUP BY h1.source),
h2 AS (
  SELECT source, c2, size, goal, coalesce(sum(size) OVER (PARTITION BY source ORDER BY c2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM (SELECT d.source, d.c2, min(goal) AS goal, sum(d.size) AS size FROM docs d JOIN cut1 c
        ON d.source IS NOT DISTINCT FROM c.source AND d.c1 = c.c1 GROUP BY d.source, d.c2 HAVING sum(d.size) > 0)),
cut2 AS (SELECT source, max(c2) + 1 AS c2 FROM h2 WHERE b + size::DOUBLE / 2 <= goal GROUP BY source),
cuts AS (
  SELECT n.*, coalesce(c.c1, e.c1, 0) AS k1, coalesce(c2.c2, 0) AS k2 FROM need n
  LEFT JOIN cut1 c ON n.source IS NOT DISTINCT FROM c.source LEFT JOIN even e ON n.source IS NOT DISTINCT FROM e.source
  LEFT JOIN cut2 c2 ON n.source IS NOT DISTINCT FROM c2.source)
SELECT d.doc_id, d.size, c.s AS source_size, c.target,
       (d.size * (c.whole + CASE WHEN d.c1 < c.k1 OR (d.c1 = c.k1 AND d.c2 < c.k2) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM docs d JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""
