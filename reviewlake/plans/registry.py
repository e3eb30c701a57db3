"""

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the operator on fixture
views derived from the driver tables under ``sf_dir``; ``ORACLE[name]`` is
DuckDB SQL over the same tables giving the same rows. Column names match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake import schemas as S
from reviewlake import sinks as K
from reviewlake.functions import expr as E
from reviewlake.functions.language import language_tag, language_tag_sql
from reviewlake.operators import documents as D
from reviewlake.operators import extract as X
from reviewlake.operators import rollup as R
from reviewlake.operators import shards as SH
from reviewlake.operators import sitemaps as SM
from reviewlake.operators.documents import first_page
from reviewlake.operators.pagination import pagination_chain
from reviewlake.operators.runlog import run_log
from reviewlake.plans import fixtures as FX
from reviewlake.plans import jobs as J
from reviewlake.plans import render as RD
from reviewlake.plans.fixtures import with_views
from reviewlake.session import checkpoint_root, scratch_path
from reviewlake.session import table
from reviewlake.sources import readers as SRC
from reviewlake.streaming.split_stream import read_stream_output, start_split_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Fixed query parameters.
CHUNK_SIZE = 100                  # objects per roll-up chunk in the fixtures
RUN_DATE = "2020-12-31"           # run date stamped on the daily roll-up
STREAM_FILES_PER_BATCH = 16       # landed files per micro-batch of the incremental split


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------- language

@register("language_tag", language_tag_sql("documents", "doc_id", "text", "doc_id"))
def q_language_tag(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", language_tag(F.col("text")).alias("lang_detected"))


# --------------------------------------------------------------------------- roll-up

_GATE_SQL = f"""
    e AS (SELECT o.*,
                 CASE WHEN NOT coalesce(starts_with(object_key, 'g'), false) OR review_text IS NULL THEN 'dropped'
                      WHEN length(review_text) > {R.TRUNCATED_MIN_CHARS} AND right(review_text, 1) = '{R.TRUNCATION_MARK}'
                      THEN 'truncated' END AS early
          FROM fx_review_objects o),
    todo AS (SELECT object_pos, review_response FROM e WHERE early IS NULL),
    l AS ({language_tag_sql("todo", "object_pos", "review_response")}),
    g AS (SELECT e.*, l.lang_detected AS response_lang,
                 coalesce(early, CASE WHEN coalesce(l.lang_detected, '') <> 'en' THEN 'response not english' END,
                          'keep') AS verdict
          FROM e LEFT JOIN l ON l.id = e.object_pos)"""

_CHUNK_SQL = f"""
    c AS (SELECT g.*, (row_number() OVER (ORDER BY object_key, object_pos) - 1) // {CHUNK_SIZE} AS chunk_id FROM g)"""

_MERGE_SQL = """
    m AS (SELECT * FROM (
            SELECT c.*, verdict <> 'keep' AS is_bad,
                   row_number() OVER (PARTITION BY chunk_id, verdict <> 'keep', object_key
                                      ORDER BY object_pos DESC) AS rn
            FROM c WHERE verdict <> 'dropped') WHERE rn = 1)"""


@register("rollup_gate", with_views(f"WITH {_GATE_SQL} SELECT verdict, count(*) AS n FROM g GROUP BY verdict",
                                    "fx_review_objects"))
def q_rollup_gate(spark, sf_dir):
    return R.verdict_counts(R.with_verdict(FX.fx_review_objects(spark, sf_dir)))


@register("rollup_chunks", with_views(
    f"""WITH g AS (SELECT * FROM fx_review_objects), {_CHUNK_SQL}
        SELECT object_pos, object_key, chunk_id FROM c""", "fx_review_objects"))
def q_rollup_chunks(spark, sf_dir):
    o = FX.fx_review_objects(spark, sf_dir).select("object_pos", "object_key")
    return R.with_chunks(o, CHUNK_SIZE).select("object_pos", "object_key", "chunk_id")


@register("rollup_merge", with_views(
    f"""WITH {_GATE_SQL}, {_CHUNK_SQL}, {_MERGE_SQL}
        SELECT chunk_id, is_bad, object_key, object_pos, verdict FROM m""", "fx_review_objects"))
def q_rollup_merge(spark, sf_dir):
    winners = R.rollup_winners(FX.fx_review_objects(spark, sf_dir), CHUNK_SIZE)
    return winners.select("chunk_id", "is_bad", "object_key", "object_pos", "verdict")


# --------------------------------------------------------------------------- documents


FX_REVIEW_FIELDS = ["id_user", "review_date", "review_language", "review_text", "review_response"]
FX_HOTEL_FIELDS = ["id_hotel", "name_hotel", "total_rating"]
N_SITEMAP_FILES = 4   # documents are filed under file_id = doc_id mod 4 (a sitemap file id)

_REVIEW_KEY_SQL = """concat_ws('-', CASE WHEN coalesce(length(review_response), 0) > 0 THEN 'Y' ELSE 'N' END,
                              coalesce(review_date, 'None'), coalesce(id_user, 'None'))"""
_DEDUP_SQL = f"""
    rk AS (SELECT *, {_REVIEW_KEY_SQL} AS review_key FROM fx_reviews),
    dd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, review_key
                                                       ORDER BY page_no DESC, pos DESC) AS rn FROM rk)
           WHERE rn = 1)"""
_META_SQL = """
    mt AS (SELECT doc_id, min(hotel_key) AS hotel_key, min(name_hotel) AS name_hotel,
                  min(total_rating) AS total_rating
           FROM fx_hotels WHERE starts_with(hotel_key, 'g') GROUP BY doc_id HAVING count(*) = 1)"""
_SPLIT_SQL = f"""{_DEDUP_SQL}, {_META_SQL},
    sp AS (SELECT concat_ws('-', mt.hotel_key, dd.review_key) AS object_key,
                  CASE WHEN left(review_key, 1) = 'Y' THEN 'response' ELSE 'no_response' END AS response_status,
                  coalesce(nullif(review_language, ''), 'null') AS lang,
                  mt.hotel_key, mt.name_hotel, dd.review_key, dd.id_user, dd.review_date,
                  dd.review_text, dd.review_response
           FROM dd JOIN mt USING (doc_id))"""
_SPLIT_COLS = ["object_key", "response_status", "lang", "hotel_key", "name_hotel", "review_key",
               "id_user", "review_date", "review_text", "review_response"]


def _fx_hotels_typed(spark, sf_dir):
    return FX.fx_hotels(spark, sf_dir).withColumn("id_hotel", F.col("hotel_key"))


def _fx_documents(spark, sf_dir):
    """A1 over the fixtures, with the sitemap file id each document is filed under."""
    docs = D.hotel_documents(_fx_hotels_typed(spark, sf_dir), FX.fx_reviews(spark, sf_dir),
                             FX_HOTEL_FIELDS, FX_REVIEW_FIELDS)
    return docs.withColumn("file_id", (F.col("doc_id") % N_SITEMAP_FILES).cast("string"))


_ENTRY_SQL = f"""{_DEDUP_SQL},
    pp AS (SELECT DISTINCT doc_id, page_no FROM dd),
    en AS (SELECT doc_id, page_no, review_key AS entry_key, id_user, review_date, review_language, review_text,
                  review_response, NULL AS name_hotel, NULL AS total_rating FROM dd
           UNION ALL
           SELECT h.doc_id, coalesce(pp.page_no, 1), h.hotel_key, NULL, NULL, NULL, NULL, NULL, h.name_hotel,
                  h.total_rating
           FROM fx_hotels h LEFT JOIN pp USING (doc_id))"""
_ENTRY_FIELDS = ["id_user", "review_date", "review_language", "review_text", "review_response", "name_hotel",
                 "total_rating"]


def _entries(docs, *cols):
    """One row per document entry, with the fields of its JSON value."""
    fields = ", ".join(f"{c} string" for c in _ENTRY_FIELDS)
    e = docs.select(*cols, F.explode("entries").alias("entry_key", "v"))
    return e.select(*cols, "entry_key", F.from_json("v", fields).alias("f")).select(*cols, "entry_key", "f.*")


def _split_select(split):
    return split.select("object_key", "response_status", "lang", "hotel_key",
                        F.col("meta_data.name_hotel").alias("name_hotel"), "review_key",
                        "review.id_user", "review.review_date", "review.review_text",
                        "review.review_response")


def _split_docs(docs):
    return D.split_documents(D.parse_documents(docs, "document"), S.REVIEW, S.HOTEL)


def _written_documents(spark, sf_dir):
    path = K.write_hotel_documents(_fx_documents(spark, sf_dir), scratch_path(spark, "hotel_docs"))
    return path


@register("review_dedup", with_views(
    f"WITH {_DEDUP_SQL} SELECT doc_id, review_key, page_no, pos FROM dd", "fx_reviews"))
def q_review_dedup(spark, sf_dir):
    return D.dedup_reviews(FX.fx_reviews(spark, sf_dir)).select("doc_id", "review_key", "page_no", "pos")


@register("document_meta_rule", with_views(
    f"WITH {_META_SQL} SELECT doc_id, hotel_key FROM mt", "fx_hotels"))
def q_document_meta_rule(spark, sf_dir):
    return D.meta_documents(FX.fx_hotels(spark, sf_dir)).select("doc_id", "hotel_key")


@register("response_status_filter", with_views(
    f"""WITH {_DEDUP_SQL},
        k AS (SELECT doc_id, hotel_key AS key FROM fx_hotels UNION ALL SELECT doc_id, review_key FROM dd)
        SELECT doc_id, key, CASE left(key, 1) WHEN 'Y' THEN 'response' WHEN 'N' THEN 'no_response' END
               AS response_status
        FROM k WHERE left(key, 1) IN ('Y', 'N')""", "fx_hotels", "fx_reviews"))
def q_response_status_filter(spark, sf_dir):
    keys = (FX.fx_hotels(spark, sf_dir).select("doc_id", F.col("hotel_key").alias("key"))
            .unionByName(D.dedup_reviews(FX.fx_reviews(spark, sf_dir))
                         .select("doc_id", F.col("review_key").alias("key"))))
    return (keys.withColumn("response_status", D.response_status("key"))
            .where(F.col("response_status").isNotNull()))


@register("review_repack", with_views(
    f"""WITH {_DEDUP_SQL}, {_META_SQL}
        SELECT doc_id, hotel_key, name_hotel, total_rating, review_key, page_no, pos
        FROM dd JOIN mt USING (doc_id)""", "fx_hotels", "fx_reviews"))
def q_review_repack(spark, sf_dir):
    d = D.dedup_reviews(FX.fx_reviews(spark, sf_dir))
    m = D.meta_documents(FX.fx_hotels(spark, sf_dir))
    return D.repack(d, m).select("doc_id", "hotel_key", "name_hotel", "total_rating", "review_key",
                                 "page_no", "pos")


@register("hotel_document", with_views(
    f"""WITH {_ENTRY_SQL}
        SELECT doc_id, CAST(page_no AS INTEGER) AS page_no, count(*) OVER (PARTITION BY doc_id, page_no) AS n_keys,
               entry_key, {', '.join(_ENTRY_FIELDS)} FROM en""", "fx_hotels", "fx_reviews"))
def q_hotel_document(spark, sf_dir):
    return _entries(D.parse_documents(_fx_documents(spark, sf_dir), "document"), "doc_id", "page_no", "n_keys")


@register("split_job", with_views(f"WITH {_SPLIT_SQL} SELECT * FROM sp", "fx_hotels", "fx_reviews"))
def q_split_job(spark, sf_dir):
    return _split_select(_split_docs(_fx_documents(spark, sf_dir)))


@register("hotel_document_sink", with_views(
    f"""WITH {_ENTRY_SQL}
        SELECT file_id, entry_key, count(*) AS n, min(review_text) AS first_text, max(name_hotel) AS name_hotel
        FROM (SELECT CAST(doc_id % {N_SITEMAP_FILES} AS VARCHAR) AS file_id, * FROM en) GROUP BY file_id, entry_key""",
    "fx_hotels", "fx_reviews"))
def q_hotel_document_sink(spark, sf_dir):
    docs = SRC.read_hotel_documents(spark, _written_documents(spark, sf_dir))
    e = _entries(docs.withColumn("file_id", F.col("file_id").cast("string")), "file_id")
    return e.groupBy("file_id", "entry_key").agg(
        F.count(F.lit(1)).alias("n"), F.min("review_text").alias("first_text"), F.max("name_hotel").alias("name_hotel"))


@register("scan_hotel_documents", with_views(
    f"""WITH {_ENTRY_SQL}
        SELECT CAST(doc_id % {N_SITEMAP_FILES} AS VARCHAR) AS file_id, entry_key, {', '.join(_ENTRY_FIELDS)} FROM en""",
    "fx_hotels", "fx_reviews"))
def q_scan_hotel_documents(spark, sf_dir):
    docs = SRC.read_hotel_documents(spark, _written_documents(spark, sf_dir))
    return _entries(docs.withColumn("file_id", F.col("file_id").cast("string")), "file_id")


@register("backfill_resplit", with_views(f"WITH {_SPLIT_SQL} SELECT * FROM sp", "fx_hotels", "fx_reviews"))
def q_backfill_resplit(spark, sf_dir):
    # every document landed twice: the later one replaces the objects of the earlier one
    path = _written_documents(spark, sf_dir)
    docs = spark.read.text(path)
    docs.write.mode("append").partitionBy("file_id").text(path)
    return _split_select(J.backfill_resplit(spark, path))


def _written_split(spark, sf_dir):
    split = _split_docs(_fx_documents(spark, sf_dir)).select(*J.OBJECT_COLUMNS)
    return K.write_split_reviews(split, scratch_path(spark, "split"))


@register("review_split_sink", with_views(
    f"WITH {_SPLIT_SQL} SELECT * FROM sp", "fx_hotels", "fx_reviews"))
def q_review_split_sink(spark, sf_dir):
    return _split_select(SRC.read_review_objects(spark, _written_split(spark, sf_dir)))


@register("scan_review_objects", with_views(
    f"""WITH {_SPLIT_SQL} SELECT object_key, response_status, lang, hotel_key, review_key, review_text
        FROM sp""", "fx_hotels", "fx_reviews"))
def q_scan_review_objects(spark, sf_dir):
    # the whole split output (the root prefix); a status/language prefix is the
    # same reader with partition filters (tests/test_plans.py)
    objs = SRC.read_review_objects(spark, _written_split(spark, sf_dir))
    return objs.select("object_key", "response_status", "lang", "hotel_key", "review_key",
                       "review.review_text")


# --------------------------------------------------------------------------- roll-up jobs



def _read_rollup(spark, good: str, bad: str):
    keep = (spark.read.schema("object_key string, object_pos bigint, chunk_id bigint, review_text string, "
                              "review_response string").json(good)
            .select("chunk_id", "object_key", "object_pos", F.lit("keep").alias("kind"), "review_text", "review_response"))
    rej = (spark.read.schema("object_key string, reason string, chunk_id bigint").json(bad)
           .select("chunk_id", "object_key", F.lit(None).cast("bigint").alias("object_pos"), F.col("reason").alias("kind"),
                   F.lit(None).cast("string").alias("review_text"), F.lit(None).cast("string").alias("review_response")))
    return keep.unionByName(rej)


_ROLLUP_SQL = """SELECT chunk_id, object_key, CASE WHEN is_bad THEN NULL ELSE object_pos END AS object_pos,
               CASE WHEN is_bad THEN verdict ELSE 'keep' END AS kind,
               CASE WHEN is_bad THEN NULL ELSE review_text END AS review_text,
               CASE WHEN is_bad THEN NULL ELSE review_response END AS review_response FROM m"""


@register("rollup_job", with_views(f"WITH {_GATE_SQL}, {_CHUNK_SQL}, {_MERGE_SQL} {_ROLLUP_SQL}", "fx_review_objects"))
def q_rollup_job(spark, sf_dir):
    good, bad = J.rollup_job(FX.fx_review_objects(spark, sf_dir), scratch_path(spark, "rollup"), CHUNK_SIZE)
    return _read_rollup(spark, good, bad)


@register("rollup_sink", with_views(
    f"""WITH {_GATE_SQL}, {_CHUNK_SQL}, {_MERGE_SQL}
        SELECT chunk_id, concat('en_reviews_', CAST(chunk_id AS VARCHAR), '.json') AS file_name,
               concat('bad_reviews', CAST(chunk_id AS VARCHAR), '.json') AS reject_file_name,
               count(*) FILTER (WHERE NOT is_bad) AS n_kept, count(*) FILTER (WHERE is_bad) AS n_rejected
        FROM m GROUP BY chunk_id""", "fx_review_objects"))
def q_rollup_sink(spark, sf_dir):
    good, bad = J.rollup_job(FX.fx_review_objects(spark, sf_dir), scratch_path(spark, "rollup"), CHUNK_SIZE)
    rows = _read_rollup(spark, good, bad)
    return rows.groupBy("chunk_id").agg(
        E.chunk_file_name(F.col("chunk_id")).alias("file_name"),
        E.reject_file_name(F.col("chunk_id")).alias("reject_file_name"),
        F.count_if(F.col("kind") == "keep").alias("n_kept"),
        F.count_if(F.col("kind") != "keep").alias("n_rejected"))


@register("daily_rollup", with_views(
    f"""WITH {_GATE_SQL}, c AS (SELECT g.*, 0 AS chunk_id FROM g), {_MERGE_SQL}
        SELECT 'en_reviews-{RUN_DATE[8:10]}-{RUN_DATE[5:7]}-{RUN_DATE[0:4]}.json' AS file_name, r.* EXCLUDE (chunk_id)
        FROM ({_ROLLUP_SQL}) r""", "fx_review_objects"))
def q_daily_rollup(spark, sf_dir):
    good, bad = J.rollup_job(FX.fx_review_objects(spark, sf_dir), scratch_path(spark, "daily"), None)
    rows = _read_rollup(spark, good, bad)
    return rows.drop("chunk_id").withColumn("file_name", J.daily_name(RUN_DATE))


# --------------------------------------------------------------------------- URLs and shards


_RANGES_SQL = """
    nu AS (SELECT file, count(*) AS n_urls FROM fx_urls GROUP BY file),
    rg AS (SELECT m.file, m.start, m.marker,
                  CAST(coalesce(lead(m.start) OVER (PARTITION BY m.file ORDER BY m.start) - 1, nu.n_urls - 1)
                       AS BIGINT) AS stop
           FROM fx_markers m LEFT JOIN nu USING (file)),
    asg AS (SELECT u.file, u.idx, u.url, rg.start, rg.stop, rg.marker
            FROM fx_urls u JOIN rg ON u.file = rg.file AND u.idx BETWEEN rg.start AND rg.stop)"""


def _fx_ranges(spark, sf_dir):
    return SH.shard_ranges(FX.fx_markers(spark, sf_dir), FX.fx_urls(spark, sf_dir))


def _fx_urls(spark, sf_dir):
    return FX.fx_urls(spark, sf_dir).select("file", "idx", "url")


@register("shard_ranges", with_views(
    f"WITH {_RANGES_SQL} SELECT file, start, marker, stop FROM rg", "fx_markers"))
def q_shard_ranges(spark, sf_dir):
    return _fx_ranges(spark, sf_dir)


@register("shard_assignment", with_views(
    f"WITH {_RANGES_SQL} SELECT file, idx, url, start, stop FROM asg", "fx_markers"))
def q_shard_assignment(spark, sf_dir):
    a = SH.shard_assignment(_fx_urls(spark, sf_dir), _fx_ranges(spark, sf_dir), FX.SHARD_EVERY)
    return a.select("file", "idx", "url", "start", "stop")


@register("crawl_pending", with_views(
    f"""WITH {_RANGES_SQL} SELECT file, start, idx, url FROM asg
        WHERE idx BETWEEN coalesce(marker, start) AND stop""", "fx_markers"))
def q_crawl_pending(spark, sf_dir):
    a = SH.shard_assignment(_fx_urls(spark, sf_dir), _fx_ranges(spark, sf_dir), FX.SHARD_EVERY)
    return SH.crawl_pending(a).select("file", "start", "idx", "url")


@register("crawl_progress", with_views(
    """SELECT count(marker) AS n_markers, CAST(sum(marker - start) AS BIGINT) AS total_progress,
              CAST(round_even(sum(marker - start) / nullif(count(marker), 0), 0) AS BIGINT) AS avg_progress,
              count(*) FILTER (WHERE marker IS NULL) AS n_unreadable
       FROM fx_markers""", "fx_markers"))
def q_crawl_progress(spark, sf_dir):
    return SH.crawl_progress(FX.fx_markers(spark, sf_dir))


@register("scan_markers", with_views("SELECT file, start, marker FROM fx_markers", "fx_markers"))
def q_scan_markers(spark, sf_dir):
    m = FX.fx_markers(spark, sf_dir)
    name = E.marker_name(F.concat(F.lit("sitemap-en_CA-hotel_review-"), F.col("file"), F.lit(".xml.gz")),
                         F.col("start"))
    path = scratch_path(spark, "markers")
    (m.select(name.alias("name"), F.coalesce(F.col("marker").cast("string"), F.lit("")).alias("value"))
     .write.partitionBy("name").text(path))
    return SRC.read_markers(spark, path, "*_marker_*.txt/part-*").select("file", "start", "marker")


@register("url_index", with_views(
    """WITH nu AS (SELECT file, count(*) AS n_urls FROM fx_urls GROUP BY file)
       SELECT m.file, m.start, m.marker, u.url, nu.n_urls
       FROM fx_markers m LEFT JOIN fx_urls u ON u.file = m.file AND u.idx = m.marker
       LEFT JOIN nu ON nu.file = m.file
       WHERE m.marker IS NOT NULL""", "fx_markers"))
def q_url_index(spark, sf_dir):
    urls = _fx_urls(spark, sf_dir)
    pos = (FX.fx_markers(spark, sf_dir).where(F.col("marker").isNotNull())
           .withColumn("idx", F.col("marker").cast("bigint")))
    looked = SRC.url_at(urls, pos)
    return (looked.join(SRC.url_counts(urls), "file", "left")
            .select("file", "start", "marker", "url", "n_urls"))


@register("hotel_url_filter", with_views(
    r"""SELECT file, idx, url, regexp_extract(url, 'g\d{4,}-d\d{5,}', 0) AS hotel_id FROM fx_urls
        WHERE regexp_extract(url, 'g\d{4,}-d\d{5,}', 0) <> ''""", "fx_urls"))
def q_hotel_url_filter(spark, sf_dir):
    return SH.hotel_urls(_fx_urls(spark, sf_dir))


@register("object_counts", with_views(
    "SELECT file, count(*) AS n_urls FROM fx_urls GROUP BY file", "fx_urls"))
def q_object_counts(spark, sf_dir):
    return SRC.url_counts(_fx_urls(spark, sf_dir))


@register("sitemap_urls", with_views("SELECT file, idx, url FROM fx_urls", "fx_urls"))
def q_sitemap_urls(spark, sf_dir):
    # real gzip files: one per (file, part), read back by the sitemap reader
    docs = SM.sitemap_documents(_fx_urls(spark, sf_dir))
    path = scratch_path(spark, "sitemaps")
    name = F.concat(F.lit("sitemap-en_CA-hotel_review-"), "file", F.lit("_"), F.col("part").cast("string"), F.lit(".xml"))
    docs.select(name.alias("name"), "value").write.partitionBy("name").option("compression", "gzip").text(path)
    fp = F.split("file", "_")
    return SRC.read_sitemaps(spark, path).select(
        F.get(fp, 0).alias("file"), (F.get(fp, 1).cast("bigint") * SM.SITEMAP_MAX_URLS + F.col("idx")).alias("idx"), "url")


@register("url_list_sink", with_views(
    "SELECT file, idx, url FROM fx_urls", "fx_urls"))
def q_url_list_sink(spark, sf_dir):
    path = K.write_url_lists(q_sitemap_urls(spark, sf_dir), scratch_path(spark, "url_lists"))
    return spark.read.parquet(path).select(F.col("file").cast("string").alias("file"), "idx", "url")


@register("robots_sitemaps", with_views(
    "SELECT pos, replace(line, 'Sitemap: ', '') AS sitemap_url FROM fx_robots WHERE contains(line, 'Sitemap')",
    "fx_robots"))
def q_robots_sitemaps(spark, sf_dir):
    return SRC.parse_robots(FX.fx_robots(spark, sf_dir)).select("pos", "sitemap_url")


@register("sitemap_index_select", with_views(
    """SELECT arg_min(replace(line, 'Sitemap: ', ''), pos)
                  FILTER (WHERE contains(replace(line, 'Sitemap: ', ''), 'CA_index')) AS index_url
       FROM fx_robots WHERE contains(line, 'Sitemap')""", "fx_robots"))
def q_sitemap_index_select(spark, sf_dir):
    return SM.index_select(SRC.parse_robots(FX.fx_robots(spark, sf_dir)))


@register("sitemap_file_filter", with_views(
    """SELECT pos, url, string_split(url, '/')[-1] AS file_name FROM fx_sitemap_index
       WHERE contains(url, '-hotel_review-')""", "fx_sitemap_index"))
def q_sitemap_file_filter(spark, sf_dir):
    return SM.hotel_sitemap_files(FX.fx_sitemap_index(spark, sf_dir))


# --------------------------------------------------------------------------- pages


_PAGES_SQL = f"""
    np AS (SELECT doc_id, max(page_no) AS n_pages FROM fx_reviews GROUP BY doc_id),
    pg AS (SELECT doc_id, n_pages, CAST(p AS INTEGER) AS page_no
           FROM (SELECT doc_id, n_pages, unnest(range(1, n_pages + 1)) AS p FROM np)),
    pgs AS (SELECT doc_id, page_no, n_pages, {RD.PAGE_URL_SQL.format(d='doc_id', p='page_no')} AS url,
                   {RD.PAGE_STATUS_SQL.format(d='doc_id', p='page_no')} AS status FROM pg)"""


def _rendered(spark, sf_dir):
    return RD.render_hotel_pages(spark, sf_dir).withColumn("status", X.page_gate("html"))


def _ok_pages(spark, sf_dir):
    return _rendered(spark, sf_dir).where(F.col("status") == "ok")


def _joined(c):
    return F.array_join(F.col(c), "|").alias(c)


@register("page_gate", with_views(f"WITH {_PAGES_SQL} SELECT url, status FROM pgs", "fx_reviews"))
def q_page_gate(spark, sf_dir):
    return _rendered(spark, sf_dir).select("url", "status")


@register("scan_pages", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def q_scan_pages(spark, sf_dir):
    return SRC.read_pages(spark, f"{sf_dir.rstrip('/')}/pages.parquet").select(
        "page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


@register("extract_links", with_views(
    f"""WITH {_PAGES_SQL}
        SELECT url, page_no = n_pages AS next_disabled,
               CASE WHEN page_no < n_pages THEN {RD.PAGE_URL_SQL.format(d='doc_id', p='page_no + 1')} END
               AS next_url
        FROM pgs WHERE status = 'ok'""", "fx_reviews"))
def q_extract_links(spark, sf_dir):
    return X.extract_links(_ok_pages(spark, sf_dir)).select("url", "next_disabled", "next_url")


_REVIEWS_OUT_SQL = f"""
    rvt AS (SELECT *, doc_id * 1000 + pos AS rid FROM fx_reviews),
    lg AS ({language_tag_sql("rvt", "rid", "review_text", "rid")}),
    xr AS (SELECT p.url, CAST(row_number() OVER (PARTITION BY r.doc_id, r.page_no ORDER BY r.pos) - 1 AS INTEGER)
                  AS block_pos,
                  r.id_user, r.id_user AS name_user, r.review_date,
                  concat(CAST(r.pos % 5 + 1 AS VARCHAR), '.0') AS review_rating,
                  lg.lang_detected AS review_language,
                  CASE r.pos % 3 WHEN 0 THEN 'Trip type: Traveled as a couple'
                                 WHEN 1 THEN 'Trip type: Traveled solo' END AS trip_type,
                  CASE WHEN r.pos % 4 = 1 THEN concat(CAST(r.pos % 7 + 1 AS VARCHAR), ' Helpful votes') END
                  AS helpful_votes,
                  concat('City ', CAST(r.doc_id % 9 AS VARCHAR)) AS reviewer_location,
                  concat('Stay é’……&lt; ', CAST(r.pos AS VARCHAR)) AS review_title,
                  r.review_text,
                  nullif(r.review_response, '') AS review_response,
                  CASE WHEN coalesce(length(r.review_response), 0) = 0 THEN NULL
                       WHEN r.doc_id % 3 = 0 THEN concat('Owner ', CAST(r.doc_id AS VARCHAR))
                       WHEN r.doc_id % 3 = 1 THEN 'Response from Front desk'
                       ELSE 'Response from A, B, C' END AS responder,
                  CASE WHEN coalesce(length(r.review_response), 0) > 0 AND r.doc_id % 3 = 0
                       THEN ' General Manager' END AS responder_title,
                  r.doc_id, r.page_no, r.pos
           FROM rvt r JOIN pgs p USING (doc_id, page_no) JOIN lg USING (rid)
           WHERE p.status = 'ok')"""
_REVIEW_OUT_COLS = ["url", "block_pos", "id_user", "name_user", "review_date", "review_rating",
                    "review_language", "trip_type", "helpful_votes", "reviewer_location", "review_title",
                    "review_text", "review_response", "responder", "responder_title"]


@register("extract_reviews", with_views(
    f"WITH {_PAGES_SQL}, {_REVIEWS_OUT_SQL} SELECT {', '.join(_REVIEW_OUT_COLS)} FROM xr", "fx_reviews"))
def q_extract_reviews(spark, sf_dir):
    r = X.extract_reviews(_ok_pages(spark, sf_dir))
    return r.select(*_REVIEW_OUT_COLS)


_RATING_SQL = "CASE WHEN doc_id % 8 = 7 THEN NULL ELSE concat(CAST((doc_id + ({c} - doc_id % 4 + 4) % 4) % 5 + 1 AS VARCHAR), '.0') END"
_HOTEL_OUT_SQL = f"""
    xh AS (SELECT url, page_no, doc_id,
                  concat('g', CAST(100000 + doc_id AS VARCHAR), '-d', CAST(1000000 + doc_id AS VARCHAR)) AS id_hotel,
                  concat('Hotel ', CAST(doc_id AS VARCHAR)) AS name_hotel,
                  concat(CAST(doc_id AS VARCHAR), ' Main Street') AS address_hotel,
                  concat('#', CAST(doc_id % 50 + 1 AS VARCHAR), ' of 50 hotels') AS ranking_hotel,
                  concat(CAST(doc_id * 3 % 1000 AS VARCHAR), ' reviews') AS number_of_reviews,
                  CASE doc_id % 3 WHEN 0 THEN 'Free WiFi|Pool' WHEN 1 THEN 'Parking' ELSE '' END AS amenities,
                  concat(CAST(doc_id % 5 AS VARCHAR), '.5') AS total_rating,
                  {_RATING_SQL.format(c=0)} AS location_rating,
                  {_RATING_SQL.format(c=1)} AS cleanliness_rating,
                  {_RATING_SQL.format(c=2)} AS service_rating,
                  {_RATING_SQL.format(c=3)} AS value_rating,
                  CASE WHEN doc_id % 2 = 0 THEN 'Languages Spoken|English' ELSE '' END AS good_to_know,
                  CASE WHEN doc_id % 7 = 6 THEN NULL ELSE concat(CAST(doc_id % 5 + 1 AS VARCHAR), '.0') END
                  AS class_rating,
                  CASE WHEN doc_id % 2 = 0 THEN 'breakfast|staff' ELSE '' END AS popular_mention_tags,
                  CASE WHEN doc_id % 4 = 3 THEN NULL
                       ELSE concat('Line one of ', CAST(doc_id AS VARCHAR), chr(10), 'Line two') END AS description,
                  CASE WHEN doc_id % 5 = 4 THEN NULL ELSE CAST(doc_id % 100 AS VARCHAR) END AS location_grade,
                  CASE WHEN doc_id % 5 = 4 THEN NULL ELSE CAST(doc_id % 30 AS VARCHAR) END AS surrounding_restaurants,
                  CASE WHEN doc_id % 5 = 4 THEN NULL ELSE CAST(doc_id % 20 AS VARCHAR) END AS surrounding_attractions
           FROM pgs WHERE status = 'ok')"""
_HOTEL_OUT_COLS = ["url", "id_hotel", "name_hotel", "address_hotel", "ranking_hotel", "number_of_reviews",
                   "amenities", "total_rating", "location_rating", "cleanliness_rating", "service_rating",
                   "value_rating", "good_to_know", "class_rating", "popular_mention_tags", "description",
                   "location_grade", "surrounding_restaurants", "surrounding_attractions"]
_ARRAY_COLS = {"amenities", "good_to_know", "popular_mention_tags"}


def _extracted_hotels(spark, sf_dir):
    h = X.extract_hotels(_ok_pages(spark, sf_dir))
    return h.select("doc_id", "page_no", *[_joined(c) if c in _ARRAY_COLS else c for c in _HOTEL_OUT_COLS])


@register("extract_hotels", with_views(
    f"WITH {_PAGES_SQL}, {_HOTEL_OUT_SQL} SELECT {', '.join(_HOTEL_OUT_COLS)} FROM xh", "fx_reviews"))
def q_extract_hotels(spark, sf_dir):
    return _extracted_hotels(spark, sf_dir).select(*_HOTEL_OUT_COLS)


@register("subrating_align", with_views(
    f"""WITH {_PAGES_SQL}, {_HOTEL_OUT_SQL}
        SELECT url, location_rating, cleanliness_rating, service_rating, value_rating FROM xh""", "fx_reviews"))
def q_subrating_align(spark, sf_dir):
    p = _ok_pages(spark, sf_dir)
    return p.select("url", X.subratings(F.col("html")).alias("s")).select("url", "s.*")


@register("hotel_first_page", with_views(
    f"""WITH {_PAGES_SQL}, {_HOTEL_OUT_SQL}
        SELECT id_hotel, page_no, url, name_hotel FROM (
            SELECT *, row_number() OVER (PARTITION BY id_hotel ORDER BY page_no) AS rn FROM xh) WHERE rn = 1""",
    "fx_reviews"))
def q_hotel_first_page(spark, sf_dir):
    h = _extracted_hotels(spark, sf_dir).select("id_hotel", "page_no", "url", "name_hotel")
    return first_page(h, "id_hotel")


_RUN_LOG_SQL = r"""
    st AS (SELECT doc_id, min(page_no) FILTER (WHERE status <> 'ok') AS stop_page,
                  arg_min(status, page_no) FILTER (WHERE status <> 'ok') AS stop_status,
                  arg_min(url, page_no) AS url
           FROM pgs GROUP BY doc_id),
    nr AS (SELECT r.doc_id, count(*) AS n FROM fx_reviews r JOIN st USING (doc_id)
           WHERE r.page_no < coalesce(st.stop_page, 2147483647) GROUP BY r.doc_id),
    ft AS (SELECT p.doc_id, CAST(round(sum(CAST(e.value AS DECIMAL(18, 3))), 3) AS DOUBLE) AS runtime_s,
                  max(e.ts) AS finish_time
           FROM pgs p JOIN st USING (doc_id) JOIN events e ON e.event_id = p.doc_id * 8 + p.page_no
           WHERE p.page_no <= coalesce(st.stop_page, 2147483647) GROUP BY p.doc_id),
    rl AS (SELECT regexp_extract(st.url, 'g\d{4,}-d\d{5,}', 0) AS hotel_id,
                  CASE WHEN stop_page IS NULL THEN 'Success' ELSE 'Empty' END AS status,
                  CAST(coalesce(nr.n, 0) AS INTEGER) AS n_reviews, ft.runtime_s, st.url,
                  CASE stop_status WHEN 'fetch_failed' THEN 'Readmore Element not Found'
                                   WHEN 'banned' THEN 'banned' ELSE 'finished' END AS reason,
                  strftime(ft.finish_time, '%Y-%m-%d %H:%M:%S') AS finish_time
           FROM st LEFT JOIN nr USING (doc_id) LEFT JOIN ft USING (doc_id))"""


def _run_log(spark, sf_dir):
    # one pass over the page HTML gives a narrow page table; it is checkpointed
    # so the three uses below do not render and gate the pages three times
    pages = _rendered(spark, sf_dir).select(
        "doc_id", "page_no", "url", "status",
        F.when(F.col("status") == "ok", X.count_blocks("html")).otherwise(F.lit(0)).alias("n_reviews"))
    checkpoint_root(spark)
    pages = pages.checkpoint(eager=True)
    fetches = RD.fetch_log(spark, sf_dir, pages.select("doc_id", "page_no"))
    return run_log(pages, None, fetches)


def _fmt_finish(df):
    return df.withColumn("finish_time", F.date_format("finish_time", "yyyy-MM-dd HH:mm:ss"))


@register("run_log", with_views(f"WITH {_PAGES_SQL}, {_RUN_LOG_SQL} SELECT * FROM rl", "fx_reviews"))
def q_run_log(spark, sf_dir):
    return _fmt_finish(_run_log(spark, sf_dir))


@register("run_log_sink", with_views(f"WITH {_PAGES_SQL}, {_RUN_LOG_SQL} SELECT * FROM rl", "fx_reviews"))
def q_run_log_sink(spark, sf_dir):
    path = K.append_run_log(_run_log(spark, sf_dir), scratch_path(spark, "run_log"))
    back = spark.read.schema(S.RUN_LOG).option("header", "false").csv(path)
    return _fmt_finish(back)


_PARSE_FIELDS = ["id_user", "review_date", "review_rating", "review_language", "trip_type", "review_title",
                 "review_text", "review_response", "responder", "name_hotel", "address_hotel", "total_rating",
                 "value_rating"]
_PARSE_SQL = f"""
    sp AS (SELECT doc_id, min(page_no) FILTER (WHERE status <> 'ok') AS stop FROM pgs GROUP BY doc_id),
    rx AS (SELECT xr.*, {_REVIEW_KEY_SQL} AS entry_key FROM xr JOIN sp USING (doc_id)
           WHERE xr.page_no < coalesce(sp.stop, 2147483647)),
    rw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, entry_key
                                                       ORDER BY page_no DESC, pos DESC) AS rn FROM rx) WHERE rn = 1),
    hw AS (SELECT xh.* FROM xh WHERE page_no = 1),
    pw AS (SELECT DISTINCT doc_id, page_no FROM rw),
    ent AS (SELECT doc_id, page_no, entry_key, id_user, review_date, review_rating, review_language, trip_type,
                   review_title, review_text, review_response, responder, NULL AS name_hotel, NULL AS address_hotel,
                   NULL AS total_rating, NULL AS value_rating FROM rw
            UNION ALL
            SELECT hw.doc_id, coalesce(pw.page_no, 1), hw.id_hotel, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
                   name_hotel, address_hotel, total_rating, value_rating
            FROM hw LEFT JOIN pw USING (doc_id))"""


@register("parse_job", with_views(
    f"""WITH {_PAGES_SQL}, {_REVIEWS_OUT_SQL}, {_HOTEL_OUT_SQL}, {_PARSE_SQL}
        SELECT concat('g', CAST(100000 + doc_id AS VARCHAR), '-d', CAST(1000000 + doc_id AS VARCHAR)) AS hotel_key,
               CAST(page_no AS INTEGER) AS page_no, entry_key, {', '.join(_PARSE_FIELDS)} FROM ent""", "fx_reviews"))
def q_parse_job(spark, sf_dir):
    """The parse stage from landed pages and the URL list (page 1 of every hotel)."""
    pages = RD.render_hotel_pages(spark, sf_dir)
    docs, _ = J.pages_to_documents(pages.select("url", "html"), starts=pages.where("page_no = 1").select("url"))
    parsed = D.parse_documents(docs, "document")
    fields = ", ".join(f"{c} string" for c in _PARSE_FIELDS)
    e = parsed.select("hotel_key", "page_no", F.explode("entries").alias("entry_key", "v"))
    return (e.select("hotel_key", "page_no", "entry_key", F.from_json("v", fields).alias("f"))
            .select("hotel_key", "page_no", "entry_key", "f.*"))


@register("pagination_chain", with_views(
    """WITH RECURSIVE ch(root_url, url, next_url, page_no) AS (
           SELECT url, url, next_url, 1 FROM fx_page_links WHERE page_id % 5 = 0
           UNION ALL
           SELECT ch.root_url, l.url, l.next_url, ch.page_no + 1
           FROM ch JOIN fx_page_links l ON l.url = ch.next_url)
       SELECT root_url, url, CAST(page_no AS INTEGER) AS page_no FROM ch""", "fx_page_links"))
def q_pagination_chain(spark, sf_dir):
    links = FX.fx_page_links(spark, sf_dir)
    return pagination_chain(links, links.where(F.col("page_id") % 5 == 0))


# --------------------------------------------------------------------------- streaming



@register("stream_split", with_views(f"WITH {_SPLIT_SQL} SELECT * FROM sp", "fx_hotels", "fx_reviews"))
def q_stream_split(spark, sf_dir):
    docs = _written_documents(spark, sf_dir)
    out = scratch_path(spark, "stream_out")
    # a few files per micro-batch: the landed documents arrive in several batches
    q = start_split_stream(spark, f"{docs}/*", out, scratch_path(spark, "stream_ckpt"),
                           max_files_per_trigger=STREAM_FILES_PER_BATCH)
    q.awaitTermination()
    objs = read_stream_output(spark, out)
    return objs.select("object_key", "response_status", "lang", "hotel_key",
                       F.col("meta_data.name_hotel").alias("name_hotel"), "review_key",
                       "review.id_user", "review.review_date", "review.review_text", "review.review_response")


# --------------------------------------------------------------------------- scalar expressions

def _event_fields(spark, sf_dir):
    """Review-page field texts derived from ``events`` (FIXTURES: month text of E3)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    t = F.col("ts").cast("timestamp")
    when_text = (F.when(F.col("event_type") == "view", F.date_format(t, "MMMM yyyy"))
                 .when(F.col("event_type") == "signup", F.date_format(t, "MMM yyyy"))
                 .when(F.col("event_type") == "purchase", F.date_format(t, "MMM d, yyyy"))
                 .otherwise(F.lit("nonsense")))
    raw = F.concat(F.lit(E.REVIEW_PREFIX), when_text)
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    header = F.when(F.col("event_type") == "error", F.array(user)).otherwise(F.array(user, raw))
    u = F.col("user_id")
    bubble = F.concat(F.lit("ui_bubble_rating bubble_"), (u % 5 + 1).cast("string"), ((u % 2) * 5).cast("string"))
    resp = (F.when(u % 3 == 0, F.concat(F.lit("Response from U"), u.cast("string"), F.lit(", Owner at Inn")))
            .when(u % 3 == 1, F.lit("Response from Desk")))
    eid = F.col("event_id")
    url = F.when(eid % 7 == 3, F.lit("https://h.example/other")).otherwise(F.concat(
        F.lit("https://h.example/Hotel_Review-g"), (eid + 1000).cast("string"), F.lit("-d"),
        (eid * 3 + 10000).cast("string"), F.lit("-R.html")))
    href = F.concat(F.lit("/Hotel_Review-or"), (u * 5).cast("string"), F.lit(".html"))
    return ev.select("event_id", header.alias("header"), raw.alias("raw"), bubble.alias("bubble"),
                     resp.alias("resp"), url.alias("url"), href.alias("href"), user.alias("user"))


@register("scalar_expressions", r"""
    SELECT event_id,
           CASE WHEN event_type IN ('view', 'signup', 'purchase') THEN strftime(ts, '%m-%Y') ELSE '00-0000' END
           AS review_date,
           CASE WHEN event_type IN ('view', 'signup', 'purchase') THEN strftime(ts, '%m-%Y')
                ELSE ' wrote a review nonsense' END AS processed,
           concat(CAST(user_id % 5 + 1 AS VARCHAR), '.', CAST((user_id % 2) * 5 AS VARCHAR)) AS review_rating,
           CASE user_id % 3 WHEN 0 THEN concat('U', CAST(user_id AS VARCHAR))
                            WHEN 1 THEN 'Response from Desk' END AS responder,
           CASE WHEN user_id % 3 = 0 THEN ' Owner' END AS responder_title,
           CASE WHEN event_id % 7 = 3 THEN NULL
                ELSE concat('g', CAST(event_id + 1000 AS VARCHAR), '-d', CAST(event_id * 3 + 10000 AS VARCHAR)) END
           AS hotel_id,
           concat('https://www.tripadvisor.ca/Hotel_Review-or', CAST(user_id * 5 AS VARCHAR), '.html') AS next_url,
           concat(CASE WHEN user_id % 3 = 2 THEN 'N' ELSE 'Y' END, '-',
                  CASE WHEN event_type IN ('view', 'signup', 'purchase') THEN strftime(ts, '%m-%Y') ELSE '00-0000' END,
                  '-u', CAST(user_id AS VARCHAR)) AS review_key
    FROM events""")
def q_scalar_expressions(spark, sf_dir):
    f = _event_fields(spark, sf_dir)
    name, title = E.responder("resp")
    date = E.review_month("header")
    return f.select(
        "event_id", date.alias("review_date"), E.process_date("raw").alias("processed"),
        E.bubble_rating("bubble").alias("review_rating"), name.alias("responder"), title.alias("responder_title"),
        E.hotel_id("url").alias("hotel_id"), E.next_page_url("href").alias("next_url"),
        E.review_key("resp", date, "user").alias("review_key"))
