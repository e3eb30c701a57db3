"""Sitemap selection (F1, F2) and sitemap documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.functions.entities import encode_entities

# Fixed values.
INDEX_MARK = "CA_index"              # the sitemap index to read
HOTEL_SITEMAP_MARK = "-hotel_review-"  # sitemap files of hotel review pages
SITEMAP_MAX_URLS = 50_000            # sitemap protocol: at most 50,000 URLs per file


def index_select(sitemaps: DataFrame, url: str = "sitemap_url", pos: str = "pos") -> DataFrame:
    """the first sitemap (by position) whose URL contains ``CA_index``, else NULL.

    One global ``min_by`` with partial aggregation: one row out."""
    hit = F.col(url).contains(INDEX_MARK)
    return sitemaps.agg(F.min_by(F.when(hit, F.col(url)), F.when(hit, F.col(pos))).alias("index_url"))


def hotel_sitemap_files(locs: DataFrame, url: str = "url") -> DataFrame:
    """sitemap URLs containing ``-hotel_review-``; file name = last path part."""
    return locs.where(F.col(url).contains(HOTEL_SITEMAP_MARK)).withColumn(
        "file_name", F.element_at(F.split(F.col(url), "/"), -1))


def sitemap_documents(urls: DataFrame) -> DataFrame:
    """Sitemap XML text of a URL list: one document per (file, part) of at most
    50,000 URLs, the protocol's limit, so every group is bounded.
    Output: ``file, part, value``; ``idx`` of a URL = part * 50,000 + position."""
    part = F.floor(F.col("idx") / SITEMAP_MAX_URLS).cast("bigint")
    entry = F.struct(F.col("idx"), F.concat(F.lit("<url><loc>"), encode_entities(F.col("url")),
                                            F.lit("</loc></url>")).alias("xml"))
    docs = urls.groupBy("file", part.alias("part")).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    body = F.array_join(F.transform("e", lambda x: x["xml"]), "")
    return docs.select(
        "file", "part",
        F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>'
                       '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
                 body, F.lit("</urlset>")).alias("value"))
