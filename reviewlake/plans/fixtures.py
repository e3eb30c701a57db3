"""Fixture views over the driver tables (see FIXTURES.md).

Every view exists twice: as a DataFrame built from the parquet tables (what
the registered queries run on) and as DuckDB SQL (what the oracle runs on).
Both are derived from the tables only, so their size grows with the data.

Deviations from FIXTURES.md, row-for-row equal on the driver tables (page ids
are dense from 0) but for the page numbers:

- ``fx_urls.idx`` is ``page_id div 4`` instead of a ``row_number`` per file:
  a window partitioned by four file ids would put a quarter of all URLs in
  one task.
- ``fx_markers`` is derived from ``fx_urls`` (a shard starts every
  ``SHARD_EVERY`` URLs) instead of a fixed VALUES list, so it grows with
  the data.
- ``fx_reviews.page_no`` is ``turn div 2 + 1`` (one review per page), so hotels
  have enough pages for a failed page in the middle.
- ``fx_hotels`` uses ``explode(array(0, 1))`` instead of a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.session import table

# Fixed fixture parameters (shared by the Spark views and the SQL views).
SHARD_EVERY = 25          # a progress marker starts every 25 URLs of a file
TRUNCATION_MARK = "…"     # U+2026, appended to every fifth review text


def _s(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


# --------------------------------------------------------------------------- Spark

def fx_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    hotel_url = F.concat(
        F.lit("https://h.example/Hotel_Review-g"), _s(F.lit(100000) + F.col("page_id")),
        F.lit("-d"), _s(F.lit(1000000) + F.col("page_id") * 7), F.lit("-Reviews-X.html"))
    return p.select(
        _s(F.col("page_id") % 4).alias("file"),
        F.expr("page_id div 4").cast("bigint").alias("idx"),
        F.when(F.col("page_id") % 10 == 9, F.col("url")).otherwise(hotel_url).alias("url"),
        F.col("page_id"),
    )


def fx_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = fx_urls(spark, sf_dir)
    return u.where(F.col("idx") % SHARD_EVERY == 0).select(
        "file",
        F.col("idx").cast("int").alias("start"),
        F.when(F.col("page_id") % 7 == 3, F.lit(None).cast("int"))
        .otherwise((F.col("idx") + (F.col("page_id") * 13) % 29).cast("int")).alias("marker"),
    )


def fx_hotels(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    k = c.select("conv_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    k = k.where(((F.col("k") == 0) & (F.col("conv_id") % 11 != 3))
                | ((F.col("k") == 1) & (F.col("conv_id") % 13 == 5)))
    return k.select(
        F.col("conv_id").alias("doc_id"),
        F.concat(F.lit("g"), _s(F.lit(100000) + F.col("conv_id") + F.col("k")),
                 F.lit("-d"), _s(F.lit(1000000) + F.col("conv_id"))).alias("hotel_key"),
        F.concat(F.lit("Hotel "), _s("conv_id")).alias("name_hotel"),
        F.concat(_s(F.col("conv_id") % 5), F.lit(".5")).alias("total_rating"),
    )


def fx_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = c.select("conv_id", "turn", "role", "text",
                 F.lead("role").over(w).alias("next_role"),
                 F.lead("text").over(w).alias("next_text"))
    half = F.floor(F.col("turn") / 2).cast("int")
    return t.where(F.col("role") == "user").select(
        F.col("conv_id").alias("doc_id"),
        (F.floor(F.col("turn") / 2).cast("int") + 1).alias("page_no"),
        F.col("turn").alias("pos"),
        F.concat(F.lit("user"), _s((F.col("conv_id") + half) % 2)).alias("id_user"),
        F.when(F.col("conv_id") % 6 == 1, F.lit("00-0000"))
        .otherwise(F.concat(F.lpad(_s(F.lit(1) + F.col("conv_id") % 12), 2, "0"), F.lit("-2020")))
        .alias("review_date"),
        F.when(F.col("conv_id") % 4 == 0, "en").when(F.col("conv_id") % 4 == 1, "de")
        .when(F.col("conv_id") % 4 == 2, "").alias("review_language"),
        F.col("text").alias("review_text"),
        F.when(F.col("next_role") == "assistant", F.col("next_text")).alias("review_response"),
    )


def fx_review_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    r = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("review_response"),
        F.col("lang").alias("response_lang"))
    j = d.join(r, "doc_id", "left")
    m50 = F.col("doc_id") % 50
    key = F.concat(
        F.when(F.col("doc_id") % 23 == 7, "x").otherwise("g"), _s(F.lit(100000) + m50),
        F.lit("-d"), _s(F.lit(1000000) + m50), F.lit("-Y-"),
        F.lpad(_s(F.lit(1) + F.col("doc_id") % 3), 2, "0"), F.lit("-2020-user"),
        _s(F.col("doc_id") % 2))
    text = (F.when(F.col("doc_id") % 29 == 4, F.lit(None).cast("string"))
            .when(F.col("doc_id") % 5 == 0, F.concat(F.col("text"), F.lit(TRUNCATION_MARK)))
            .otherwise(F.col("text")))
    return j.select(F.col("doc_id").alias("object_pos"), key.alias("object_key"),
                    text.alias("review_text"), "review_response", "response_lang")


def fx_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    n = p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next_url"),
                 F.col("page_id").alias("n_id"))
    n = n.where(F.col("n_id") % 5 != 0).drop("n_id")
    return p.join(n, "page_id", "left")


def fx_robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Robots lines, one per page: sitemap lines (some naming the CA index),
    disallow lines and user-agent lines. ``pos`` = line position."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    sitemap = F.concat(F.lit("Sitemap: "), F.col("url"),
                       F.when(F.col("page_id") % 7 == 5, F.lit("/sitemap_en_CA_index.xml"))
                       .otherwise(F.lit("/sitemap.xml")))
    line = (F.when(F.col("page_id") % 3 == 0, sitemap)
            .when(F.col("page_id") % 3 == 1, F.concat(F.lit("Disallow: /p"), _s("page_id")))
            .otherwise(F.lit("User-agent: *")))
    return p.select(F.col("page_id").alias("pos"), line.alias("line"))


def fx_sitemap_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``<loc>`` list of a sitemap index: half hotel review sitemaps."""
    p = table(spark, sf_dir, "pages").select("page_id")
    kind = F.when(F.col("page_id") % 2 == 0, "hotel_review").otherwise("attraction_review")
    return p.select(F.col("page_id").alias("pos"), F.concat(
        F.lit("https://h.example/sitemaps/sitemap-en_CA-"), kind, F.lit("-"), _s("page_id"),
        F.lit(".xml.gz")).alias("url"))


# --------------------------------------------------------------------------- DuckDB

VIEW_SQL = {
    "fx_urls": """
        SELECT CAST(page_id % 4 AS VARCHAR) AS file,
               CAST(page_id // 4 AS BIGINT) AS idx,
               CASE WHEN page_id % 10 = 9 THEN url
                    ELSE concat('https://h.example/Hotel_Review-g', CAST(100000 + page_id AS VARCHAR),
                                '-d', CAST(1000000 + page_id * 7 AS VARCHAR), '-Reviews-X.html') END AS url,
               page_id
        FROM pages""",
    "fx_markers": f"""
        SELECT file, CAST(idx AS INTEGER) AS start,
               CASE WHEN page_id % 7 = 3 THEN CAST(NULL AS INTEGER)
                    ELSE CAST(idx + (page_id * 13) % 29 AS INTEGER) END AS marker
        FROM fx_urls WHERE idx % {SHARD_EVERY} = 0""",
    "fx_hotels": """
        SELECT conv_id AS doc_id,
               concat('g', CAST(100000 + conv_id + k AS VARCHAR), '-d', CAST(1000000 + conv_id AS VARCHAR)) AS hotel_key,
               concat('Hotel ', CAST(conv_id AS VARCHAR)) AS name_hotel,
               concat(CAST(conv_id % 5 AS VARCHAR), '.5') AS total_rating
        FROM (SELECT conv_id, unnest([0, 1]) AS k FROM (SELECT DISTINCT conv_id FROM conversations))
        WHERE (k = 0 AND conv_id % 11 <> 3) OR (k = 1 AND conv_id % 13 = 5)""",
    "fx_reviews": """
        SELECT conv_id AS doc_id,
               CAST(floor(turn / 2) AS INTEGER) + 1 AS page_no,
               turn AS pos,
               concat('user', CAST((conv_id + CAST(floor(turn / 2) AS INTEGER)) % 2 AS VARCHAR)) AS id_user,
               CASE WHEN conv_id % 6 = 1 THEN '00-0000'
                    ELSE concat(lpad(CAST(1 + conv_id % 12 AS VARCHAR), 2, '0'), '-2020') END AS review_date,
               CASE conv_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN '' END AS review_language,
               text AS review_text,
               CASE WHEN next_role = 'assistant' THEN next_text END AS review_response
        FROM (SELECT conv_id, turn, role, text,
                     lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
                     lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
              FROM conversations) t
        WHERE role = 'user'""",
    "fx_review_objects": f"""
        SELECT d.doc_id AS object_pos,
               concat(CASE WHEN d.doc_id % 23 = 7 THEN 'x' ELSE 'g' END, CAST(100000 + d.doc_id % 50 AS VARCHAR),
                      '-d', CAST(1000000 + d.doc_id % 50 AS VARCHAR), '-Y-',
                      lpad(CAST(1 + d.doc_id % 3 AS VARCHAR), 2, '0'), '-2020-user',
                      CAST(d.doc_id % 2 AS VARCHAR)) AS object_key,
               CASE WHEN d.doc_id % 29 = 4 THEN CAST(NULL AS VARCHAR)
                    WHEN d.doc_id % 5 = 0 THEN concat(d.text, '{TRUNCATION_MARK}') ELSE d.text END AS review_text,
               r.text AS review_response,
               r.lang AS response_lang
        FROM documents d LEFT JOIN documents r ON r.doc_id = d.doc_id + 1""",
    "fx_robots": """
        SELECT page_id AS pos,
               CASE page_id % 3
                    WHEN 0 THEN concat('Sitemap: ', url, CASE WHEN page_id % 7 = 5 THEN '/sitemap_en_CA_index.xml'
                                                              ELSE '/sitemap.xml' END)
                    WHEN 1 THEN concat('Disallow: /p', CAST(page_id AS VARCHAR))
                    ELSE 'User-agent: *' END AS line
        FROM pages""",
    "fx_sitemap_index": """
        SELECT page_id AS pos,
               concat('https://h.example/sitemaps/sitemap-en_CA-',
                      CASE WHEN page_id % 2 = 0 THEN 'hotel_review' ELSE 'attraction_review' END, '-',
                      CAST(page_id AS VARCHAR), '.xml.gz') AS url
        FROM pages""",
    "fx_page_links": """
        SELECT p.page_id, p.url, n.url AS next_url
        FROM pages p LEFT JOIN pages n ON n.page_id = p.page_id + 1 AND n.page_id % 5 <> 0""",
}

# views a view reads, in the order they must be defined
_DEPENDS = {"fx_markers": ["fx_urls"]}


def with_views(sql: str, *views: str) -> str:
    """Prefix ``sql`` with a WITH clause defining ``views`` (and what they need)."""
    order: list[str] = []
    for v in views:
        for dep in _DEPENDS.get(v, []) + [v]:
            if dep not in order:
                order.append(dep)
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v]})" for v in order)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
