"""Roll-up of review objects: gate (F7), chunks (W2), last-wins merge (A4).

Input rows: ``object_pos`` (listing position), ``object_key``, ``review_text``,
``review_response``; the gate tags the response language itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.language import language_tag
from reviewlake.operators.ordering import global_row_number
from reviewlake.session import written

# Fixed values of the gate.
TRUNCATED_MIN_CHARS = 760        # "longer than 760 characters ..."
TRUNCATION_MARK = "…"            # "... and ending in U+2026"
REASON_TRUNCATED = "truncated"
REASON_NOT_ENGLISH = "response not english"
VERDICT_KEEP = "keep"
VERDICT_DROPPED = "dropped"      # no hotel key, no review or no text: no record kept
KEEP_LANGUAGE = "en"


def _no_review(key: Column, text: Column) -> Column:
    return ~F.coalesce(key.startswith("g"), F.lit(False)) | text.isNull()


def _truncated(text: Column) -> Column:
    return (F.length(text) > TRUNCATED_MIN_CHARS) & (F.right(text, F.lit(1)) == TRUNCATION_MARK)


def with_verdict(objects: DataFrame, key: str = "object_key", text: str = "review_text",
                 response: str = "review_response") -> DataFrame:
    """Add ``detected_lang`` and ``verdict`` (first rule wins).

    The language tag is computed only for rows that reach rule (c): a CASE
    branch is evaluated lazily, so dropped and truncated rows skip tokenising.
    """
    k, t, r = F.col(key), F.col(text), F.col(response)
    early = F.when(_no_review(k, t), F.lit(VERDICT_DROPPED)).when(_truncated(t), F.lit(REASON_TRUNCATED))
    lang = F.when(early.isNull(), language_tag(r))
    out = objects.withColumn("detected_lang", lang)
    verdict = F.coalesce(
        early,
        F.when(F.coalesce(F.col("detected_lang"), F.lit("")) != KEEP_LANGUAGE, F.lit(REASON_NOT_ENGLISH)),
        F.lit(VERDICT_KEEP))
    return out.withColumn("verdict", verdict)


def verdict_counts(gated: DataFrame) -> DataFrame:
    return gated.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def with_chunks(objects: DataFrame, chunk_size: int, key: str = "object_key",
                pos: str = "object_pos") -> DataFrame:
    """Consecutive chunks of ``chunk_size`` in listing order (key, then position)."""
    numbered = global_row_number(objects, [key, pos], "list_no")
    return numbered.withColumn("chunk_id", F.floor(F.col("list_no") / chunk_size).cast("bigint"))


def merge_last_wins(gated: DataFrame, key: str = "object_key", pos: str = "object_pos") -> DataFrame:
    """A4: per chunk, one kept object and one reject per key; the later one wins.

    Keeps and rejects are merged separately, so a key may sit in both. Dropped
    rows leave no record. ``max_by`` aggregates partially before the shuffle.
    """
    rows = gated.where(F.col("verdict") != VERDICT_DROPPED).withColumn(
        "is_bad", F.col("verdict") != VERDICT_KEEP)
    payload = [c for c in rows.columns if c not in ("chunk_id", "is_bad", key)]
    best = (rows.groupBy("chunk_id", "is_bad", key)
            .agg(F.max_by(F.struct(*payload), F.col(pos)).alias("w")))
    return best.select("chunk_id", "is_bad", key, "w.*")


def verdicts(objects: DataFrame, key: str = "object_key", pos: str = "object_pos") -> DataFrame:
    """``(pos, key, verdict, detected_lang)`` of every object: the only pass that
    reads the texts. Narrow rows, written once: range sampling, numbering, merge
    and the dropped count read them."""
    return written(with_verdict(objects, key).select(pos, key, "verdict", "detected_lang"), "verdicts")


def rollup_winners(objects: DataFrame, chunk_size: int | None = None, key: str = "object_key",
                   pos: str = "object_pos") -> DataFrame:
    """P3 body on narrow rows: gate, chunk, merge. ``chunk_size=None`` puts
    everything in chunk 0 (P4).

    Output ``chunk_id, is_bad, object_key, object_pos, verdict, detected_lang``:
    one kept and/or one rejected object per key and chunk."""
    return _winners(verdicts(objects, key, pos), chunk_size, key, pos)


def _winners(gated: DataFrame, chunk_size: int | None, key: str, pos: str) -> DataFrame:
    if chunk_size is None:
        chunked = gated.withColumn("chunk_id", F.lit(0).cast("bigint"))
    else:
        chunked = with_chunks(gated, chunk_size, key, pos).drop("list_no")
    return merge_last_wins(chunked, key, pos)


def rollup(objects: DataFrame, chunk_size: int | None = None, key: str = "object_key", pos: str = "object_pos",
           gated: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(winners, kept, rejects)``.

    ``kept`` = the whole objects that won as keeps, every column of ``objects``,
    with their ``chunk_id``: the one wide join of the job, on the key and the
    position, which are columns of the data and unique together. ``rejects`` =
    ``chunk_id, object_key, reason``. ``winners`` is a narrow written table;
    ``gated`` are the objects' :func:`verdicts`, if there are any yet."""
    gated = verdicts(objects, key, pos) if gated is None else gated
    winners = written(_winners(gated, chunk_size, key, pos), "winners")
    keep = winners.where(~F.col("is_bad")).select(key, pos, "chunk_id", "detected_lang")
    kept = objects.join(keep, [key, pos])
    rejects = winners.where(F.col("is_bad")).select("chunk_id", key, F.col("verdict").alias("reason"))
    return winners, kept, rejects


def dropped_count(gated: DataFrame) -> DataFrame:
    """One row ``(verdict, n)``: how many objects leave no record (rule (a))."""
    n = gated.agg(F.count_if(F.col("verdict") == VERDICT_DROPPED).alias("n"))
    return n.select(F.lit(VERDICT_DROPPED).alias("verdict"), "n")
