"""Composed batch jobs: P1-P4 and the crawl's parse stage (pages -> documents)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake import schemas as S
from reviewlake import sinks as K
from reviewlake.functions import expr as E
from reviewlake.operators import documents as D
from reviewlake.operators import rollup as R
from reviewlake.sinks import versions as V
from reviewlake.sources import readers as SRC


def split_job(docs: DataFrame) -> DataFrame:
    """Parsed documents (``entries``) -> one row per review object.

    Row-local: F5, F6, J1, E15, E16 need no shuffle on documents."""
    return D.split_documents(docs, S.REVIEW, S.HOTEL)


OBJECT_COLUMNS = ["object_key", "hotel_key", "review_key", "meta_data", "review", "response_status", "lang"]


def backfill_resplit(spark: SparkSession, prefix: str, whole_file: bool = False) -> DataFrame:
    """Split every raw document under ``prefix`` (halves and workers vanish:
    Spark splits the files into tasks). The last landed document decides an
    object key that several documents hold."""
    return _resplit(SRC.read_hotel_documents(spark, prefix, whole_file))


def _resplit(docs: DataFrame) -> DataFrame:
    return D.last_objects(split_job(docs).select(*OBJECT_COLUMNS, "landed", "source"), "landed", "source")


def split_to_sink(spark: SparkSession, prefix: str, out: str, whole_file: bool = False,
                  pseudonymise: bool = False) -> str:
    """P1/P2 with the K2 sink; ``pseudonymise`` hashes the user fields first. The
    output is a new version of ``out``; returns its folder. The documents left
    out stand beside it in ``<folder>-rejected`` with their reason."""
    docs = SRC.read_hotel_documents(spark, prefix, whole_file)
    split = _resplit(docs)
    if pseudonymise:
        split = D.pseudonymise(split)

    def write(folder: str) -> None:
        K.write_rejects(D.rejected_documents(docs).select("source", "value", "reason"), f"{folder}-rejected")
        K.write_split_reviews(split, folder)

    return V.publish(spark, out, write)


def rollup_job(objects: DataFrame, out: str, chunk_size: int | None) -> tuple[str, str]:
    """P3 (``chunk_size``) / P4 (``None``: one chunk): gate, chunk, merge, write.

    The gate (language tagging) reads the texts once; verdicts and winners are
    narrow written tables that everything else reads, the kept objects are read
    once more for their wide join. ``dropped`` holds the number of rows
    that leave no record (SURVEY D10). All three are one new version of ``out``."""
    gated = R.verdicts(objects)
    _, kept, rejects = R.rollup(objects, chunk_size, gated=gated)

    def write(folder: str) -> None:
        R.dropped_count(gated).write.json(f"{folder}/dropped")
        K.write_rollup(kept, rejects, folder)

    folder = V.publish(objects.sparkSession, out, write)
    return f"{folder}/compiled", f"{folder}/bad"


def review_objects_for_rollup(spark: SparkSession, split_prefix: str, response_status: str = "response",
                              lang: str = "en") -> DataFrame:
    """S5 for the roll-up: the whole objects of one prefix, with the gate's fields.

    Object keys are unique within a split prefix (``documents.last_objects``);
    ``object_pos`` is the hash of the object itself, the same in every read."""
    o = SRC.read_review_objects(spark, split_prefix, response_status, lang)
    return o.select(F.xxhash64("meta_data", "review").alias("object_pos"), "object_key", "meta_data", "review",
                    F.col("review.review_text").alias("review_text"),
                    F.col("review.review_response").alias("review_response"))


def daily_name(run_date: str):
    return E.daily_file_name(F.to_date(F.lit(run_date)))


def pages_to_documents(pages: DataFrame, as_of=None, starts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The crawl's parse stage as one job: landed pages -> hotel documents (A1).

    ``pages(url, html)`` and ``starts(url)``, the URL list the crawl began with
    (without it: the pages that no link names). One row-local pass reads each
    page once and writes what it holds: status, next link (X4), hotel record
    (X1) and raw reviews (X2); the HTML is never shuffled, and only this table is
    joined by URL.
    The next links chain each start's pages (J3). A chain ends at its first
    failed or banned page (F4, SURVEY D1), since such a page has no next link;
    what was read before it is kept. The hotel record comes from page 1 (A3),
    reviews are deduplicated, the later page winning (A2). Returns
    ``(documents, run_log)``; documents as ``hotel_documents`` makes them, by
    ``hotel_key``.
    """
    from reviewlake.operators import extract as X
    from reviewlake.session import written

    return facts_to_documents(written(X.page_facts(pages), "page-facts"), as_of, starts)


def facts_to_documents(facts: DataFrame, as_of=None, starts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``pages_to_documents`` from written ``page_facts``. Reviews without a user
    link have no key and stay out of the documents (SURVEY D8)."""
    from reviewlake.operators import extract as X
    from reviewlake.operators.pagination import pagination_chain
    from reviewlake.operators.runlog import run_log
    from reviewlake.session import written

    found = written(X.reviews_of(facts.where("status = 'ok'").select("url", "reviews"), as_of=as_of)
                    .withColumnRenamed("block_pos", "pos"), "page-reviews")
    chain = pagination_chain(facts.select("url", "next_url"), starts)
    meta = written(chain.join(facts.select("url", "status", "n_reviews"), "url").select(
        "url", "page_no", "status", "n_reviews", E.hotel_id("root_url").alias("hotel_key"))
        .where(F.col("hotel_key").isNotNull()), "crawled-pages")
    ok = meta.where(F.col("status") == "ok").select("url", "hotel_key", "page_no")
    hotels = facts.select("url", "hotel").join(ok.where("page_no = 1").select(F.col("url"), "hotel_key"), "url") \
        .select("hotel_key", "hotel.*")
    reviews = found.where(F.col("id_user").isNotNull()).join(ok, "url").drop("url")
    docs = D.hotel_documents(hotels, reviews, S.HOTEL_FIELDS, S.REVIEW_FIELDS, doc="hotel_key")
    return docs, run_log(meta, None, None, hotel="hotel_key")


def parse_to_sink(spark: SparkSession, pages: DataFrame, out: str, as_of=None, starts: DataFrame | None = None) -> str:
    """The parse stage with its outputs, one new version of ``out``: ``documents``
    (by ``hotel_key``), ``run_log``, and ``rejected`` with a reason each: reviews
    without a user link (SURVEY D8) and start URLs without a hotel key (F3).
    Returns the folder."""
    from reviewlake.operators import extract as X
    from reviewlake.operators.shards import non_hotel_urls
    from reviewlake.session import written
    facts = written(X.page_facts(pages), "page-facts")
    docs, log = facts_to_documents(facts, as_of, starts)
    lost = D.rejected_reviews(X.reviews_of(facts.where("status = 'ok'").select("url", "reviews"), as_of=as_of)).select("url", "reason")
    first = facts.select("url") if starts is None else starts.select("url")
    other = non_hotel_urls(first).select("url", F.lit("no hotel key").alias("reason"))

    def write(folder: str) -> None:
        docs.write.json(f"{folder}/documents")
        K.append_run_log(log, f"{folder}/run_log")
        K.write_rejects(lost.unionByName(other), f"{folder}/rejected")

    return V.publish(spark, out, write)
