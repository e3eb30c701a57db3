"""Incremental split (P5) with Structured Streaming.

The reference walks its URL list with a saved position and splits each
hotel document as it lands. Here a file stream over the landed documents
plays that role: the checkpoint is the saved position, so a restart reads
only new files. The body is the batch split job (P1), run in
``foreachBatch`` because the meta rule (F5) and the repack (J1) compare
entries of one document, which the row-local document form does per row.

A micro-batch may run again after a failure, so each batch overwrites a
path that carries its batch id; a rerun replaces, never duplicates. Within a
batch the last landed document decides an object key; across batches the last
batch does, when the output is read.

Batches are merged into a base at intervals (``compact``): the objects that
count, one per key, in ``BUCKETS`` folders by hash of the key. The base is a
version (``sinks.versions``) that names the last batch it holds; a read takes
the base and the batches after it. A merge that is killed leaves no version, so
the old base and all batches still stand. What a finished merge has taken over
is emptied by the next one, when no reader of the version before is left; so
the files are those of two bases and the batches since the older one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewlake import schemas as S
from reviewlake import sinks as K
from reviewlake.operators.documents import last_objects, parse_documents, rejected_documents
from reviewlake.plans.jobs import OBJECT_COLUMNS, split_job
from reviewlake.sinks import versions as V


BUCKETS = 32     # folders of the base


def _writer(out_path: str, compact_every: int | None = None):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        docs = parse_documents(batch)
        split = split_job(docs).select(*OBJECT_COLUMNS, "landed", "source")
        K.write_split_reviews(last_objects(split, "landed", "source"), f"{out_path}/batch_id={batch_id}")
        rejected = rejected_documents(docs).select("source", "value", "reason")
        K.write_rejects(rejected, f"{rejects_path(out_path)}/batch_id={batch_id}")
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, out_path)
    return write_batch


def _base_path(out_path: str) -> str:
    return f"{out_path.rstrip('/')}-base"


def _base(spark: SparkSession, out_path: str) -> tuple[str | None, int]:
    """(folder of the base, the last batch it holds); (None, -1) before the first merge."""
    last = V.versions(spark, _base_path(out_path)).agg(F.max_by(F.struct("folder", "upto"), "version")).first()[0]
    return (last.folder, last.upto) if last else (None, -1)


def _rows(spark: SparkSession, out_path: str) -> DataFrame:
    """Base and later batches, each row with its ``batch_id``."""
    folder, upto = _base(spark, out_path)
    schema = f"{S.SPLIT_OBJECT}, batch_id LONG"
    rows = spark.read.schema(schema).json(out_path).where(F.col("batch_id") > upto)     # a partition filter
    if folder is None:
        return rows
    return rows.unionByName(spark.read.schema(f"{schema}, bucket INT").json(folder).drop("bucket"))


def compact(spark: SparkSession, out_path: str) -> str | None:
    """Merge the batches into a new base; returns its folder, None if there is no new batch."""
    old, upto = _base(spark, out_path)
    newest = spark.read.schema("batch_id LONG").json(out_path).agg(F.max("batch_id")).first()[0]
    if newest is None or newest <= upto:
        return None
    earlier = [r.upto for r in V.versions(spark, _base_path(out_path)).orderBy(F.desc("version")).limit(2).collect()]
    merged = last_objects(_rows(spark, out_path).withColumn("_batch", F.col("batch_id")), "_batch")
    merged = merged.withColumn("bucket", F.pmod(F.xxhash64("object_key"), F.lit(BUCKETS)).cast("int"))

    def write(folder: str) -> None:
        merged.hint("rebalance", "bucket").write.partitionBy("bucket").json(folder)

    folder = V.publish(spark, _base_path(out_path), write, upto=newest)
    _empty(spark, out_path, earlier)
    return folder


def _empty(spark: SparkSession, out_path: str, earlier: list[int]) -> None:
    """Empty the bases before the last two and the batches that the older of those two holds."""
    def clear(folder: str) -> None:      # partitioned, an empty output has no data file
        spark.createDataFrame([], "value string, part string").write.mode("overwrite").partitionBy("part").json(folder)

    old = V.versions(spark, _base_path(out_path)).orderBy(F.desc("version")).collect()[2:3]     # earlier ones are empty
    for row in old:
        clear(row.folder)
    if earlier:
        since = old[0].upto if old else -1
        done = spark.read.schema("batch_id LONG").json(out_path).where(f"batch_id > {since} AND batch_id <= {earlier[0]}")
        for row in done.select("batch_id").distinct().collect():      # the batches of one interval
            clear(f"{out_path.rstrip('/')}/batch_id={row.batch_id}")


def rejects_path(out_path: str) -> str:
    """Where the documents that the split leaves out go."""
    return f"{out_path.rstrip('/')}-rejected"


def start_split_stream(spark: SparkSession, docs_glob: str, out_path: str, checkpoint: str,
                       max_files_per_trigger: int | None = None,
                       available_now: bool = True, compact_every: int | None = None) -> StreamingQuery:
    """Stream landed documents (one JSON document per line) through P1.

    ``available_now`` processes everything present and stops (the resumable
    batch the reference runs); otherwise the query keeps watching the folder.
    ``compact_every`` merges the output into its base after so many batches.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(docs_glob).select(
        "value", F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_modification_time").alias("landed"))
    writer = (stream.writeStream.foreachBatch(_writer(out_path, compact_every))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_stream_output(spark: SparkSession, out_path: str) -> DataFrame:
    """The objects the stream has written so far, the last batch's per key."""
    return last_objects(_rows(spark, out_path), "batch_id")
