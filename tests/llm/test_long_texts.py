"""Very long and adversarial texts, and scores checked against plain Python."""

from __future__ import annotations

import io
import re
import time

import numpy as np
from pyspark.sql import functions as F

from reviewlake.llm import line_dedup, secrets, toxicity
from reviewlake.llm.hashed_text import Hasher, cells
from tests.llm import odd


def test_line_dedup_of_a_long_log_is_linear(spark):
    lines = [f"line {k} of the log" for k in range(200_000)]
    lines[150_000:150_003] = lines[7:10]
    rows = [(1, "\n".join(lines), "en", "a", 1), (2, "other\ntext", "en", "a", 1)]
    docs = odd.documents(spark, rows)
    start = time.time()
    got = {r.row.doc_id: r for r in line_dedup.line_dedup(docs).collect()}
    assert time.time() - start < 60
    assert got[1].n_removed == 3 and got[1].clean == "\n".join(lines[:150_000] + lines[150_003:])
    assert got[2].clean == "other\ntext"


def test_secrets_in_long_texts(spark):
    texts = {1: "abc123abc123" + ".abc123" * 700_000, 2: "password=" + "!" * 200_000 + "x", 3: "a" * 1_000_000, 4: "token=" * 50_000,
             5: "eyJhbGciOiJIUzI1NiJ9" + ".eyJzdWIiOiIxMjM0" * 100_000, 6: "=" * 300_000, 7: "A1" * 500_000, 8: "bearer " * 100_000, 9: "." * 300_000}
    docs = odd.documents(spark, [(i, t, "en", "a", 1) for i, t in texts.items()])
    start = time.time()
    rows = secrets.candidates(docs).select("doc_id", F.length("found").alias("n"), F.length("left").alias("l")).collect()
    assert time.time() - start < 120
    n = {i: [r.n for r in rows if r.doc_id == i] for i in texts}
    assert n[1][0] == 12 + 7 * secrets.PARTS and n[2] == [200_010] and not n[9] and n[7] == [1_000_000]
    assert all(r.l <= secrets.CONTEXT for r in rows)


def test_secrets_of_an_empty_table(spark):
    docs = odd.empty(spark)
    words = secrets.corpus_words(docs)
    found = secrets.features(secrets.candidates(docs), words)
    assert secrets.scored(found, secrets.train(secrets.weak_labels(found))).count() == 0


def test_secret_candidates_are_what_re_finds(spark):
    texts = [f"{a}{b}{c}" for a in ("", "key ", "x=", "path/", "'") for b in ("abc123def456", "AKIA" + "Q7" * 8, "abc123abc123.abc123", "short1", "a" * 20)
             for c in ("", " end", ".", ".com and more", "'")]
    docs = odd.documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    run = r"[A-Za-z0-9+/=_-]"
    known = rf"(?:AKIA|ASIA)[A-Z0-9]{{16}}(?!{run})"
    plain = re.compile(rf"(?<!{run})(?:{known}|(?={run}*[0-9]){run}{{12,}}(?:\.(?={run}*[0-9]){run}{{6,}}){{0,{secrets.PARTS}}})")
    got = {}
    for r in secrets.candidates(docs).orderBy("doc_id", "nth").collect():
        got.setdefault(r.doc_id, []).append(r.found)
    assert got == {i: plain.findall(t) for i, t in enumerate(texts) if plain.findall(t)}


def _model(spark):
    rows = [(k, f"number {k} went home early. {'the grumblewort is back again' if k % 4 == 0 else 'a friend came by'}.", "en", "a", 1) for k in range(200)]
    docs = odd.documents(spark, rows)
    return toxicity.train(docs, spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(200)], "doc_id long, toxic int"))


def test_toxicity_is_a_noisy_or(spark):
    """Scores of few sentences, summed one by one from the model's own weights."""
    got = np.load(io.BytesIO(model := _model(spark)), allow_pickle=False)
    weights, bias, (mean, deviation, limit, share) = got["weights"].astype(float), float(got["bias"]), got["clean"]

    def z(sentence):
        total, hasher = bias, Hasher()
        for word in sentence.split():
            for n, salt in ((None, 0), *((n, n) for n in toxicity.BEGINNINGS)):
                data = np.frombuffer(word[:n].encode(), np.uint8)
                h = hasher.spans(hasher.running(data), np.array([0]), np.array([len(data)]))
                total += weights[cells(h, salt)[0]]
        return total

    def score(sentences):
        over = [max(0.0, np.logaddexp(0, z(s)) - np.logaddexp(0, bias)) for s in dict.fromkeys(sentences)]
        n, strong = len(over), sum(x > limit for x in over)
        toxic = max(0.0, strong - share * n - toxicity.SPREAD * (share * n) ** .5)
        e = sum(over) - mean * (n - toxic) - toxicity.SPREAD * deviation * (n - toxic) ** .5
        return 1 - np.exp(-max(0, e, max(np.logaddexp(0, z(s)) for s in sentences)))

    cases = [["a friend came by"], ["the grumblewort is back again"], ["a friend came by", "a friend came by", "number seven went home"],
             ["the grumblewort sang", "the grumblewort sang", "a grumblewort", "home early"]]
    texts = [". ".join(c) + "." for c in cases]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {r.i: r.s.score for r in rows.select("i", toxicity.scored(F.col("t"), model).alias("s")).collect()}
    assert np.allclose([found[i] for i in range(len(cases))], [score(c) for c in cases], atol=1e-6)


def test_toxicity_grows_with_different_toxic_sentences(spark):
    weak = _model(spark)
    got = dict(np.load(io.BytesIO(weak), allow_pickle=False))
    # a model whose one toxic sentence is worth 0.25: only several of them pass 0.5
    hasher = Hasher()
    data = np.frombuffer(b"grumblewort", np.uint8)
    at = cells(hasher.spans(hasher.running(data), np.array([0]), np.array([len(data)])), 0)
    got["weights"] = np.zeros_like(got["weights"])
    got["weights"][at] = np.log(0.25 / 0.75) - float(got["bias"])
    out = io.BytesIO()
    np.savez_compressed(out, **got)
    other = ["mild", "cold", "long", "dark", "slow", "loud"]
    sentences = [f"{a} {b} grumblewort" for a in other for b in other]
    rows = spark.createDataFrame([(n, ". ".join(sentences[:n]) + ".") for n in (1, 2, 5, 10, 30)], "n int, t string")
    score = {r.n: r.s.score for r in rows.select("n", toxicity.scored(F.col("t"), out.getvalue()).alias("s")).collect()}
    assert score[1] < 0.5 and score[1] < score[2] < score[5] < score[10] < score[30] and score[30] > 0.99
    same = spark.createDataFrame([(". ".join(sentences[:1] * 30) + ".",)], "t string").select(toxicity.scored(F.col("t"), out.getvalue()).alias("s"))
    assert abs(same.first().s.score - score[1]) < 1e-9
