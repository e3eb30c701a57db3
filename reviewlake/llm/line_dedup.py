"""Operator 1: line dedup over overlapping three-line windows.

A document's lines are split at U+000A. Every run of ``width`` consecutive
lines is a window, identified by two chained 64-bit hashes of its lines. A
window that occurs more than once anywhere keeps its first occurrence, by
(doc_id, hash of the text, position); the lines covered by every later
occurrence go. Positions covered by several windows are removed once, so
overlapping windows merge into longer passages.

Every distinct line survives at least once: the earliest place of a line is
never inside a later occurrence, since the first occurrence of that window
would hold the same line still earlier.

Defined results:

- null text: kept null, 0 lines; text of fewer than ``width`` lines: unchanged;
- windows of blank lines only (spaces and U+0009 to U+000D) are never removed;
- rows that repeat doc_id and text are one document and get the same result;
- a null doc_id sorts before every other; an empty table gives an empty table.

Plan: one pass over the windows for the first places (partial aggregation, so
a window in a third of all documents is combined before the shuffle), one
join of the windows with the repeated ones (plain equi-join, split by AQE when
a window is hot), and one join of the removed positions with the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.functions.common import let
from reviewlake.llm.common import col, packed, row_key, unpacked
from reviewlake.session import table

WIDTH = 3


def windows(docs: DataFrame, text: str, doc_id: str, width: int = WIDTH) -> DataFrame:
    """(h1, h2, key, pos): one row per window that is not blank."""
    at = lambda i: [F.col("lines")[i + k] for k in range(width)]
    lines = docs.select(row_key(col(doc_id), col(text)).alias("key"), F.split(col(text), "\n", -1).alias("lines")) \
        .where(F.size("lines") >= width)
    found = F.transform(F.sequence(F.lit(0), F.size("lines") - width), lambda i: F.struct(
        F.xxhash64(*at(i)).alias("h1"), F.xxhash64(F.lit("second"), *at(i)).alias("h2"), i.alias("pos"),
        F.concat(*at(i)).rlike(r"[^\x20\x09-\x0D]").alias("said")))
    return (lines.select("key", F.explode(found).alias("w")).where("w.said")
            .select("w.h1", "w.h2", "key", "w.pos"))


def removed_starts(docs: DataFrame, text: str, doc_id: str, width: int = WIDTH) -> DataFrame:
    """(key, starts): where the later occurrences of repeated windows begin."""
    found = windows(docs, text, doc_id, width)
    place = F.struct("key", "pos")
    repeated = (found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                .where(F.col("first") != F.col("last")).select("h1", "h2", "first"))
    later = found.join(repeated, ["h1", "h2"]).where(F.col("first") != F.struct("key", "pos"))
    return later.groupBy("key").agg(F.collect_set("pos").alias("starts"))


def line_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """row (the caller's columns), key, n_lines, n_removed, clean (the text left)."""
    rows = packed(docs, key=row_key(col(doc_id), col(text)), text=col(text))
    found = rows.join(removed_starts(docs, text, doc_id, width), "key", "left")
    lines = F.split("text", "\n", -1)
    covered = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + width - 1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    # the lines are bound once: inside the lambda they would be cut from the text for every line
    clean = F.when(F.col("starts").isNull(), F.col("text")).otherwise(
        let(lines, lambda own: F.array_join(F.transform(kept, lambda p: own[p]), "\n")))
    return found.select(
        "row", "key", n_lines.alias("n_lines"),
        F.when(F.col("starts").isNull(), 0).otherwise(n_lines - F.size(kept)).alias("n_removed"),
        clean.alias("clean"))


def deduped_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with cleaned texts; a document of which no word is left goes."""
    found = line_dedup(docs)
    left = (F.col("n_removed") == 0) | F.col("clean").rlike(r"[^\x20\x09-\x0D]")
    return found.where(left).select(*unpacked(
        docs.columns, text=F.col("clean"),
        n_chars=F.when(F.col("n_removed") == 0, F.col("row.n_chars"))
        .otherwise(F.length("clean").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else None))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", F.col("clean").alias("text"))


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (
  SELECT doc_id, text, p, md5(l[p]) || md5(l[p + 1]) || md5(l[p + 2]) AS h
  FROM (SELECT doc_id, text, l, unnest(range(1, len(l) - 1)) AS p FROM lines WHERE len(l) >= 3)
  WHERE regexp_matches(l[p] || l[p + 1] || l[p + 2], '[^\x20\x09-\x0D]')),
later AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS k FROM w) WHERE k > 1),
gone AS (
  SELECT DISTINCT doc_id, p + d AS p FROM later, (SELECT unnest([0, 1, 2]) AS d)),
each AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM lines WHERE text IS NOT NULL),
kept AS (
  SELECT e.doc_id, count(*) AS n_lines, count(g.p) AS n_removed,
         coalesce(string_agg(CASE WHEN g.p IS NULL THEN e.line END, chr(10) ORDER BY e.p), '') AS text
  FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0)::INTEGER AS n_lines, coalesce(k.n_removed, 0)::INTEGER AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE k.text END AS text
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
