"""Plan properties of every registered query (scale rules as tests)."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from reviewlake.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tools.plan_report import plan_text, summarize

# Queries whose plan may hold an Exchange SinglePartition, and why:
# a global one-row aggregate, or the per-partition count table of
# ordering.global_row_number (one row per partition).
SINGLE_PARTITION_OK = {
    "crawl_progress": "global aggregate, one row",
    "sitemap_index_select": "global min_by, one row",
    "rollup_chunks": "offsets over per-partition counts",
    "rollup_merge": "offsets over per-partition counts",
    "shard_ranges": "offsets over per-partition counts",
    "shard_assignment": "offsets over per-partition counts",
    "crawl_pending": "offsets over per-partition counts",
}


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_text(fn(spark, SF_SMALL)) for name, fn in QUERIES.items()}


def test_no_cartesian_nested_loop_or_python(plans):
    for name, text in plans.items():
        s = summarize(text)
        assert s["nested_loop"] == 0, name
        assert s["python_udf"] == 0, name


def test_single_partition_only_where_bounded(plans):
    for name, text in plans.items():
        if summarize(text)["single_partition"]:
            assert name in SINGLE_PARTITION_OK, name


def test_offsets_window_is_over_partition_counts(plans):
    for name in ("rollup_chunks", "shard_ranges"):
        text = plans[name]
        # the only un-partitioned window sums the per-partition counts
        for m in re.finditer(r"Window \[(.*)\]", text):
            if "windowspecdefinition(_part" in m.group(1):
                assert "sum(_n" in m.group(1)


def test_scans_are_pruned(plans):
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plans["language_tag"]
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plans["hotel_url_filter"]
    assert "ReadSchema: struct<page_id:bigint>" in plans["sitemap_file_filter"]


def test_partition_filters_reach_the_scan(spark):
    from reviewlake.plans.registry import _written_split
    from reviewlake.sources.readers import read_review_objects
    q = read_review_objects(spark, _written_split(spark, SF_SMALL), "response", "en")
    text = plan_text(q)
    assert re.search(r"PartitionFilters: \[.*response_status.*\]", text)
    assert re.search(r"PartitionFilters: \[.*lang.*\]", text)


def test_split_of_documents_has_no_shuffle(spark):
    from reviewlake import schemas as S
    from reviewlake.operators import documents as D
    docs = spark.createDataFrame([('[{"g1-d1": {}, "Y-a-b": {}}]',)], "value string")
    text = plan_text(D.split_documents(D.parse_documents(docs), S.REVIEW, S.HOTEL))
    assert "Exchange" not in text


def test_language_tag_has_no_shuffle(spark):
    from reviewlake.functions.language import language_tag
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert "Exchange" not in plan_text(d.select(language_tag(F.col("text"))))
