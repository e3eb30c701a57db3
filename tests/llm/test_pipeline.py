"""The registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from reviewlake.llm.common import written
from reviewlake.llm.registry import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm import odd
from tests.llm.test_joins import shingles
from tests.llm.test_text_operators import brute_lines
from tests.test_oracle import _norm


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL)
    want = duck.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    rows = sorted(tuple(_norm(r[c]) for c in order) for r in got.collect())
    assert rows == sorted(tuple(_norm(r[want.columns.index(c)]) for c in order) for r in want.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, at = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        at[name] = docs
        docs = written(stage(spark, docs, SF_SMALL), f"test-{name}")
        if name != "encoding":
            assert docs.columns == columns
    rows = {name: df.collect() for name, df in at.items()}
    # language ID keeps every document with words in a known language
    assert len(rows["line_dedup"]) == len(rows["language_id"])
    # line dedup against brute force
    want = brute_lines([(r.doc_id, r.text) for r in rows["line_dedup"]])
    got = {r.doc_id: r.text for r in rows["near_duplicates"]}
    assert got == {i: t for (i, _), t in want.items() if t.strip(" \t\n\x0b\x0c\r")}
    # one document of each group stays, no clean document goes
    sets = {r.doc_id: shingles(r.text, 5) for r in rows["near_duplicates"]}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert sorted(r.doc_id for r in rows["mixing"]) == sorted(set(root.values()))
    # the mix reads a document at most three times
    times = Counter(r.doc_id for r in rows["encoding"])
    assert set(times) <= {r.doc_id for r in rows["mixing"]} and max(times.values()) <= 3
    # what was encoded decodes to the text
    text = {r.doc_id: r.text for r in rows["encoding"]}
    out = docs.collect()
    assert Counter(r.doc_id for r in out) == times
    assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() for r in out)
    assert all(len(r.ids) == 4 * r.n_tokens for r in out)


def test_pipeline_on_odd_rows_and_nothing(spark):
    for docs in (odd.documents(spark), odd.empty(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, ""), f"odd-{name}")
            assert name == "encoding" or docs.columns == columns
        docs.count()


def test_run_is_registered(spark):
    import __spark_entry__ as E
    assert E.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in E.oracle_sql()
