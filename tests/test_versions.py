"""Versioned outputs: a failed write, one prefix, and the stream's base."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from reviewlake.plans import jobs as J
from reviewlake.plans.registry import _fx_documents, _split_docs
from reviewlake import sinks as K
from reviewlake.sinks import versions as V
from reviewlake.streaming import split_stream as ST
from tests.conftest import SF_SMALL


def _read(spark):
    return lambda folder: spark.read.schema("k long, part string, v string").json(folder)


def _rows(spark, path):
    return sorted((r.k, r.part, r.v) for r in V.read_live(spark, path, _read(spark)).collect())


def _table(spark, part, v, n=20):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(part).alias("part"), F.lit(v).alias("v"))


def test_a_write_that_fails_midway_leaves_the_old_version(spark, scratch):
    path = f"{scratch}/out"
    with pytest.raises(ValueError):
        V.read_live(spark, path, _read(spark))
    V.publish(spark, path, lambda to: _table(spark, "a", "old").write.partitionBy("part").json(to))
    before = _rows(spark, path)
    bad = _table(spark, "a", "new").repartition(4).withColumn(
        "v", F.when(F.col("k") == 13, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception):
        V.publish(spark, path, lambda to: (_table(spark, "b", "half").write.json(f"{to}/part=b"), bad.write.partitionBy("part").json(to)))
    assert _rows(spark, path) == before and len(before) == 20
    V.publish(spark, path, lambda to: _table(spark, "a", "new", 5).write.partitionBy("part").json(to))
    assert _rows(spark, path) == [(k, "a", "new") for k in range(5)]


def test_a_rerun_of_one_prefix_replaces_it_only(spark, scratch):
    path = f"{scratch}/out"
    both = _table(spark, "a", "1", 3).unionByName(_table(spark, "b", "1", 3))
    V.publish(spark, path, lambda to: both.write.partitionBy("part").json(to))
    for v in ("2", "3"):
        V.publish(spark, path, lambda to, v=v: _table(spark, "b", v, 2).write.partitionBy("part").json(to), scope="part=b")
    V.publish(spark, path, lambda to: _table(spark, "c", "4", 1).write.partitionBy("part").json(to), scope="part=c")
    assert _rows(spark, path) == sorted([(k, "a", "1") for k in range(3)] + [(k, "b", "3") for k in range(2)] + [(0, "c", "4")])
    assert len(V.live(spark, path)) == 3
    V.publish(spark, path, lambda to: both.write.partitionBy("part").json(to))
    assert len(V.live(spark, path)) == 1 and {r[2] for r in _rows(spark, path)} == {"1"}


def test_rejected_reviews_and_urls_are_written(spark, scratch):
    page = ('<html><div class="_2wrUUKlw"><a href="/Profile/ann">Ann</a><q class="IRsGHoPm"><span>The room was clean</span></q></div>'
            '<div class="_2wrUUKlw"><b>nobody</b><q class="IRsGHoPm"><span>text</span></q></div></html>')
    url = "https://x/Hotel_Review-g1234-d12345-Reviews-V.html"
    pages = spark.createDataFrame([(url, page)], "url string, html string")
    starts = spark.createDataFrame([(url,), ("https://x/Tourism-g1.html",)], "url string")
    folder = J.parse_to_sink(spark, pages, f"{scratch}/out", starts=starts)
    rejected = sorted((r.url, r.reason) for r in spark.read.json(f"{folder}/rejected").collect())
    assert rejected == [("https://x/Hotel_Review-g1234-d12345-Reviews-V.html", "no user link"), ("https://x/Tourism-g1.html", "no hotel key")]
    docs = spark.read.json(f"{folder}/documents").collect()
    assert len(docs) == 1 and "ann" in docs[0].document and "None" not in docs[0].document
    assert V.live(spark, f"{scratch}/out") == [(folder, "", [])]



def test_stream_base_and_batches(spark, scratch):
    """Merged and unmerged outputs read alike; a killed merge loses nothing; files stay few."""
    K.write_hotel_documents(_fx_documents(spark, SF_SMALL), f"{scratch}/docs")
    def read(out):
        return sorted((r.object_key, str(r.review)) for r in ST.read_stream_output(spark, out).collect())
    plain, merged = f"{scratch}/plain", f"{scratch}/merged"
    ST.start_split_stream(spark, f"{scratch}/docs/*", plain, f"{scratch}/c1", 1).awaitTermination()
    ST.start_split_stream(spark, f"{scratch}/docs/*", merged, f"{scratch}/c2", 1, compact_every=1).awaitTermination()
    want = read(plain)
    assert want and read(merged) == want
    n = len(os.listdir(f"{scratch}/c2/commits")) if os.path.isdir(f"{scratch}/c2/commits") else 0
    assert n >= 3
    kept = [b for b in os.listdir(merged) if b.startswith("batch_id=") and any(f.endswith(".json") and os.path.getsize(os.path.join(r, f))
            for r, _, fs in os.walk(f"{merged}/{b}") for f in fs)]
    assert len(kept) <= 2       # of the last two merges; earlier ones are emptied
    base, upto = ST._base(spark, merged)
    assert ST.compact(spark, merged) is None and ST._base(spark, merged) == (base, upto)
    files = [f for r, _, fs in os.walk(base) for f in fs if f.endswith(".json")]
    assert 0 < len(files) <= ST.BUCKETS * 8


def test_a_killed_merge_loses_nothing(spark, scratch, monkeypatch):
    K.write_hotel_documents(_fx_documents(spark, SF_SMALL), f"{scratch}/docs")
    out = f"{scratch}/out"
    ST.start_split_stream(spark, f"{scratch}/docs/*", out, f"{scratch}/c", 1).awaitTermination()
    before = sorted(r.object_key for r in ST.read_stream_output(spark, out).collect())
    real = V.publish

    def killed(spark, path, write, **kw):
        def half(folder):
            write(folder)
            raise RuntimeError("killed")
        return real(spark, path, half, **kw)
    monkeypatch.setattr(ST.V, "publish", killed)
    with pytest.raises(RuntimeError):
        ST.compact(spark, out)
    assert sorted(r.object_key for r in ST.read_stream_output(spark, out).collect()) == before
    monkeypatch.setattr(ST.V, "publish", real)
    assert ST.compact(spark, out)
    assert sorted(r.object_key for r in ST.read_stream_output(spark, out).collect()) == before
