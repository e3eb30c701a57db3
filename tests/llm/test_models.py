"""Held-out accuracy of the fitted operators, and their defined results on odd rows."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewlake.llm import langid, quality, secrets, toxicity
from tests.conftest import SF_CHECK
from tests.llm import odd

SF_LARGE = "/root/testdata/sf0.1"


def auc(score: pd.Series, label: pd.Series) -> float:
    ranks, good = score.rank(), label == 1
    return (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_langid_held_out(spark):
    got = langid.op7_langid(spark, SF_CHECK).toPandas().merge(
        spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 250 and (held.lang_pred == held.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_langid_odd_rows(spark):
    docs = odd.documents(spark)
    model = langid.train(docs)
    got = docs.select("doc_id", "text", langid.predicted(docs.text, model).alias("p")).collect()
    for r in got:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.p.lang, r.p.score) == ("und", 0.0)
        else:
            assert r.p.lang in ("en", "de", "fr") and 0 <= r.p.score <= 1
    assert langid.known_language(docs).columns == docs.columns
    assert langid.known_language(odd.empty(spark)).count() == 0
    nothing = docs.select(langid.predicted(docs.text, b"").alias("p")).collect()
    assert {(r.p.lang, r.p.score) for r in nothing} == {("und", 0.0)}


def test_kernel_is_presence():
    s = langid.Spectrum()
    assert (s.of("Abc abc, ABC!") == s.of("abc abc abc abc")).all()
    assert len(s.of("12 .!")) == 0 and len(s.of(None)) == 0


def test_toxicity_held_out_and_location(spark):
    got = toxicity.op3_toxicity(spark, SF_LARGE).toPandas().merge(
        spark.read.parquet(f"{SF_LARGE}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert auc(held.score, held.toxic) > 0.95
    assert ((held.predicted == 1) == (held.toxic == 1)).mean() > 0.95
    assert (got.predicted == (got.score >= 0.5)).all() and got.score.between(0, 1).all()


def test_toxicity_finds_the_sentence(spark):
    clean = ["the house is green and big.", "we walk É to the river today.", "a cat sleeps near the door."]
    rows, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        parts = [clean[k % 3], "you are a grumblewort.\n" if bad else "you are a friend.\n", clean[(k + 1) % 3], f"number {k}"]
        rows.append((k, " ".join(parts), "en", "a", 1))
        labels.append((k, int(bad)))
    docs = odd.documents(spark, rows)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = docs.select("doc_id", "text", toxicity.scored(docs.text, model, 0.5).alias("s")).collect()
    for r in got:
        assert (r.s.score >= 0.5) == (r.doc_id % 4 == 0)
        assert ["grumblewort" in r.text[x.start:x.end] for x in r.s.offending] == [True] * (r.doc_id % 4 == 0)


def test_toxicity_odd_rows(spark):
    docs = odd.documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (8, 0), (11, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels, docs).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 for r in got if r.doc_id in (3, 4, 5))
    none = toxicity.toxicity(docs, labels.limit(0), docs).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.toxicity(odd.empty(spark), labels, docs).count() == 0


def test_quality_held_out(spark):
    got = quality.op2_quality(spark, SF_CHECK).toPandas().merge(
        spark.read.parquet(f"{SF_CHECK}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert auc(held["tail"], held.quality) > 0.97
    assert (held.keep == (held.quality == 1)).mean() > 0.95
    assert got.expected_grade.between(0, 2).all() and got["tail"].between(0, 1).all()


def test_quality_odd_rows(spark):
    docs = odd.documents(spark)
    ratings = spark.createDataFrame([(1, 2), (1, 0), (8, 4), (11, None), (10, 2), (7, 0)], "doc_id long, grade int")
    got = docs.select(quality.scored(docs.text, quality.train(docs, ratings)).alias("s")).collect()
    assert len(got) == docs.count() and all(0 <= r.s.expected <= 4 and 0 <= r.s.tail <= 1 for r in got)
    one = quality.train(docs, ratings.where("grade = 2"))
    assert {(r.s.expected, r.s.tail) for r in docs.select(quality.scored(docs.text, one).alias("s")).collect()} == {(2.0, 1.0)}
    assert odd.empty(spark).select(quality.scored(F.col("text"), one).alias("s")).count() == 0


def test_ordered_thresholds():
    rows = pd.DataFrame({"order": range(300), "text": [f"{'good ' * (k % 4)}{'bad ' * (3 - k % 4)}x{k}" for k in range(300)],
                         "grade": [k % 4 for k in range(300)]})
    import io

    import numpy as np
    got = np.load(io.BytesIO(quality.fit(rows)))
    assert (np.diff(got["thresholds"]) > 0).all() and list(got["grades"]) == [0, 1, 2, 3]


def test_secrets(spark):
    got = secrets.op8_secrets(spark, SF_LARGE).toPandas()
    assert set(got[got.begins == "AKIA"].kept) <= {True}
    assert got.kept.any() and not got.kept.all()
    digits = got[(got.length == 16) & ~got.begins.str.contains("[A-Za-z]")]
    assert len(digits) and not digits.kept.any()


def test_secrets_odd_rows(spark):
    key = "AKIA" + "Q7" * 8
    rows = [(1, f"my key is {key} ok", "en", None, 1), (1, f"my key is {key} ok", "en", None, 1), (None, "card 4111111111111111 paid", "en", "a", 1),
            (2, None, "en", "a", 1), (3, "", "en", "a", 1), (4, f"{key} 4111111111111111 token = \"{'ab12' * 10}\"", "en", "a", 1)]
    docs = odd.documents(spark, rows)
    found = secrets.features(secrets.candidates(docs), secrets.corpus_words(docs))
    got = sorted((str(r.doc_id), r.nth, r.found[:4], r.left.strip()[-3:]) for r in found.collect())
    assert got == [("1", 0, "AKIA", " is"), ("1", 0, "AKIA", " is"), ("4", 0, "AKIA", ""), ("4", 1, "4111", ""),
                   ("4", 2, "ab12", "= \""), ("None", 0, "4111", "ard")]
    many = odd.documents(spark, [(i, r[1], "en", "a", 1) for i in range(20) for r in rows])
    found = secrets.features(secrets.candidates(many), secrets.corpus_words(many))
    model = secrets.train(secrets.weak_labels(found))
    kept = {r.found[:4]: r.kept for r in secrets.scored(found, model).collect()}
    assert kept == {"AKIA": True, "ab12": True, "4111": False}
    assert {r.score for r in secrets.scored(found, None).collect()} == {0.5}
    assert secrets.candidates(odd.empty(spark)).count() == 0


@pytest.mark.parametrize("name", ["op2_quality", "op3_toxicity", "op7_langid", "op8_secrets", "op9_bpe"])
def test_registered(name):
    import __spark_entry__ as E
    assert name in E.queries()
