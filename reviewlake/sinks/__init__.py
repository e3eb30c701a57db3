"""Writers (K1-K5). Each returns the path it wrote; files are few per partition.

Spark names its own part files, so the reference's per-object file names
become columns and partition directories:

- K1 hotel documents: one JSON array per line, ``file_id=<id>/`` directories
- K2 split reviews:   ``response_status=<..>/lang=<..>/`` directories
- K3 roll-up:         ``compiled/chunk_id=<n>/`` and ``bad/chunk_id=<n>/``
- K4 run log:         CSV without header, appended
- K5 URL lists:       parquet partitioned by sitemap file
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_hotel_documents(docs: DataFrame, path: str) -> str:
    """K1: ``docs(file_id, ..., document)`` -> text, one document per line.

    Overwrite mode replaces an earlier run, as the reference replaces the
    previous file of a hotel.
    """
    (docs.select("file_id", "document").hint("rebalance", "file_id")
     .write.mode("overwrite").partitionBy("file_id").text(path))
    return path


def write_split_reviews(split: DataFrame, path: str) -> str:
    """K2: one JSON object per review, filed by response status and language.

    ``lang`` is already ``'null'`` for a missing language, so no row lands in
    ``__HIVE_DEFAULT_PARTITION__``. The ``rebalance`` hint brings the rows of a
    directory together and lets AQE split a hot directory over several tasks
    (it never splits a ``repartition`` by column). Object keys are unique in
    ``split`` (``documents.last_objects``), so none is written twice.
    """
    (split.hint("rebalance", "response_status", "lang")
     .write.mode("overwrite").partitionBy("response_status", "lang").json(path))
    return path


def write_rollup(kept: DataFrame, rejects: DataFrame, path: str) -> tuple[str, str]:
    """K3: kept objects to ``compiled/``, rejects (key, reason) to ``bad/``, by chunk.

    The ``rebalance`` hint brings a chunk's rows together and lets AQE split a
    chunk larger than a task's share. It takes no sample, so the wide join that
    gives ``kept`` runs once."""
    good, bad = f"{path}/compiled", f"{path}/bad"
    for rows, to in ((kept, good), (rejects, bad)):
        (rows.hint("rebalance", "chunk_id").sortWithinPartitions("chunk_id", "object_key")
         .write.mode("overwrite").partitionBy("chunk_id").json(to))
    return good, bad


def write_rejects(rejected: DataFrame, path: str) -> str:
    """Documents or reviews left out, with their reason."""
    rejected.write.mode("overwrite").partitionBy("reason").json(path)
    return path


def append_run_log(run_log: DataFrame, path: str) -> str:
    """K4: one CSV row per hotel run, no header, appended."""
    run_log.write.mode("append").option("header", "false").csv(path)
    return path


def write_url_lists(urls: DataFrame, path: str) -> str:
    """K5: extracted URL lists kept so later runs skip the unzip."""
    urls.write.mode("overwrite").partitionBy("file").parquet(path)
    return path
