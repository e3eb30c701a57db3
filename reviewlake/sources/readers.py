"""Readers of landed files.

- S1 sitemaps: gzip XML, ``<loc>`` texts in order. A sitemap file holds at most
  50,000 URLs and 50 MB by the sitemap protocol, so reading one file whole
  (one row, one task) is bounded; gzip is not splittable anyway.
- S2 robots text: lines that name a sitemap.
- S3 pages: ``(page_id, url, html)`` parquet.
- S4 hotel documents: JSON ``[{...}]`` per line (as K1 writes) or per file.
- S5 split review objects: partitioned JSON; filters on ``response_status`` and
  ``lang`` become partition filters.
- S6 progress markers: file ``<xml stem>_marker_<start>.txt`` holding the index.
- S7 URL index lookups on the S1 table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake import schemas as S
from reviewlake.functions import expr as E
from reviewlake.functions.common import let
from reviewlake.functions.entities import decode_entities
from reviewlake.operators.documents import parse_documents, response_status as response_status_of

SITEMAP_LINE = "Sitemap"          # fixed: robots lines naming a sitemap contain this
SITEMAP_PREFIX = "Sitemap: "      # fixed: removed from such a line


def parse_sitemaps(docs: DataFrame, value: str = "value", file: str = "file") -> DataFrame:
    """S1 parse: one row per ``<loc>`` of each XML text, ``idx`` 0-based in order.

    The text is read as XML: the ``loc`` of each ``url`` of a sitemap or of each
    ``sitemap`` of an index, under any namespace prefix, from text or CDATA,
    with entities decoded and blanks around it gone; comments and other
    elements' ``loc`` (images, videos) don't count. A text that isn't well-formed
    XML (a bare ``&``, cut off) is read tag by tag instead, outside of comments.
    """
    entry = "array<struct<loc: string>>"
    text = F.regexp_replace(F.col(value), "^[\\ufeff\\s]+", "")
    # one ``loc`` of a list, whatever its name; a broken text gives null
    xml = F.from_xml(text, f"url {entry}, sitemap {entry}, _broken string",
                     {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken", "ignoreNamespace": "true"})
    bare = F.regexp_replace(text, r"(?s)<!--.*?-->", "")
    tags = F.transform(F.regexp_extract_all(bare, F.lit(r"(?s)<(?:\w+:)?loc\s*>\s*(.*?)\s*</(?:\w+:)?loc\s*>"), F.lit(1)),
                       lambda u: F.when(u.startswith("<![CDATA["), F.regexp_replace(u, r"(?s)^<!\[CDATA\[\s*|\s*\]\]>$", ""))
                       .otherwise(decode_entities(u)))

    def locs(x: Column) -> Column:
        well = x["_broken"].isNull() & (x["url"].isNotNull() | x["sitemap"].isNotNull())
        empty = F.array().cast(entry)
        both = F.concat(F.coalesce(x["sitemap"], empty), F.coalesce(x["url"], empty))
        return F.when(well, F.filter(F.transform(both, lambda e: e["loc"]), lambda u: u.isNotNull())).otherwise(tags)

    return docs.select(F.col(file), F.posexplode(let(xml, locs)).alias("idx", "url")).select(
        file, F.col("idx").cast("bigint").alias("idx"), F.trim("url").alias("url"))


def read_sitemaps(spark: SparkSession, path: str, num_partitions: int | None = None) -> DataFrame:
    """``(file, idx, url)`` from ``.xml`` or ``.xml.gz`` files under ``path``.

    ``file`` is the file id (E13): text after the last ``-`` of the name. A
    landed folder ``<name>.xml/part-*`` counts as the file of that name. A
    gzip file is one task; ``num_partitions`` spreads the URLs afterwards.
    """
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/=]*\.xml(\.gz)?)(/part-[^/]*)?$", 1)
    stem = F.regexp_replace(name, r"\.xml(\.gz)?$", "")
    raw = spark.read.text(path, wholetext=True).select(
        "value", E.sitemap_file_id(F.concat(stem, F.lit(".xml.gz"))).alias("file"))
    urls = parse_sitemaps(raw)
    return urls.repartition(num_partitions) if num_partitions else urls


def parse_robots(lines: DataFrame, line: str = "line") -> DataFrame:
    """S2 parse: keep lines containing ``Sitemap``; drop the ``Sitemap: `` prefix."""
    return lines.where(F.col(line).contains(SITEMAP_LINE)).withColumn(
        "sitemap_url", F.replace(F.col(line), F.lit(SITEMAP_PREFIX), F.lit("")))


def read_robots(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, line, sitemap_url)``. A robots file is one small text; read
    whole so the line position is exact."""
    raw = spark.read.text(path, wholetext=True)
    lines = raw.select(F.posexplode(F.split(F.col("value"), "\r?\n")).alias("pos", "line"))
    return parse_robots(lines)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """S3: landed pages."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_hotel_documents(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """One row per document with ``entries`` (NULL for empty, ``[]`` or broken).

    ``whole_file=True`` reads the reference layout (one indented JSON array per
    file); otherwise one document per line, as the K1 sink writes. ``source``
    names the file and ``landed`` its time; an empty file gives no row.
    """
    raw = (spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
           if whole_file else spark.read.text(path))
    raw = raw.select("*", F.col("_metadata.file_path").alias("source"),
                     F.col("_metadata.file_modification_time").alias("landed"))
    return parse_documents(raw.where(F.length(F.trim("value")) > 0))


def read_review_objects(spark: SparkSession, path: str, response_status: str | None = None,
                        lang: str | None = None, whole_file: bool = False) -> DataFrame:
    """Split review objects; the two filters prune directories.

    The schema is declared, so no file is read to infer it and a prefix whose
    objects all lack a field reads like any other. ``whole_file=True`` reads the
    reference layout, one JSON file ``{object_key: {meta_data, review}}`` per
    object; status and language then come from the object."""
    if whole_file:
        raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
        of = f"map<string, struct<meta_data: struct<{S.HOTEL}>, review: struct<{S.REVIEW}>>>"
        df = (raw.select(F.explode(F.from_json("value", of)).alias("object_key", "o"))
              .select("object_key", F.regexp_extract("object_key", E.HOTEL_KEY_PATTERN, 0).alias("hotel_key"),
                      F.regexp_extract("object_key", E.HOTEL_KEY_PATTERN + "-(.*)", 1).alias("review_key"),
                      "o.meta_data", "o.review")
              .withColumn("response_status", response_status_of("review_key"))
              .withColumn("lang", E.lang_or_null(F.col("review.review_language"))))
    else:
        df = spark.read.schema(S.SPLIT_OBJECT).json(path)
    if response_status is not None:
        df = df.where(F.col("response_status") == response_status)
    if lang is not None:
        df = df.where(F.col("lang") == lang)
    return df


MARKER_GLOB = "*_marker_*.txt"


def parse_markers(landed: DataFrame) -> DataFrame:
    """S6 on a landed table ``(name, value)``: ``(name, file, start, marker)``."""
    return landed.select(
        "name",
        F.regexp_extract("name", r"-([^-/]*)_marker_", 1).alias("file"),
        E.marker_start("name").try_cast("int").alias("start"),
        F.trim("value").try_cast("int").alias("marker"))


def read_markers(spark: SparkSession, path: str, glob: str = MARKER_GLOB, names: DataFrame | None = None) -> DataFrame:
    """``(name, file, start, marker)``; ``marker`` NULL when the content is
    not a number (an unreadable marker).

    One ``binaryFile`` source lists and reads the files, the same in every
    session. A landed folder ``<marker name>/part-*`` counts as the marker of
    that name. Spark's file sources never hand out files of zero bytes: give the
    expected ``names(name)`` (W1 knows them, one per worker range), and a marker
    that is empty or missing comes back with a NULL ``marker`` too."""
    content = spark.read.format("binaryFile").load(f"{path.rstrip('/')}/{glob}").select(
        F.regexp_extract("path", r"([^/]*_marker_[^/]*?\.txt)", 1).alias("name"),
        F.decode(F.col("content"), "UTF-8").alias("value"))
    if names is not None:
        content = names.select("name").join(content, "name", "left")
    return parse_markers(content)


def url_counts(urls: DataFrame) -> DataFrame:
    """S7 length: number of URLs per file (partial aggregation, skew-safe)."""
    return urls.groupBy("file").agg(F.count(F.lit(1)).alias("n_urls"))


def url_at(urls: DataFrame, positions: DataFrame) -> DataFrame:
    """S7 lookup: URL at ``(file, idx)`` for each requested position."""
    return positions.join(urls, ["file", "idx"], "left")
