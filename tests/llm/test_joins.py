"""Components, embedding dedup, vector search and the n-gram join against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd
import pytest

from reviewlake.llm import components as components_module
from reviewlake.llm import embedding_dedup, ngram_join, vector_search
from reviewlake.llm.components import components, extended
from pyspark.sql import functions as F
from tests.llm import odd


def smallest_reached(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("kind", ["long", "string", "struct<id: string, h: long>"])
def test_components_of_few_edges_take_no_rounds(spark, monkeypatch, kind):
    """Few edges are written and solved once; more go through the rounds, with the same result."""
    names = []
    written = components_module.written
    monkeypatch.setattr(components_module, "written", lambda df, name: (names.append(name), written(df, name))[1])
    node = {"long": lambda k: k, "string": lambda k: f"n{k:03d}"}.get(kind, lambda k: (None if k < 3 else f"n{k // 3:03d}", k % 3))
    pairs = [(k, k + 1) for k in range(40)] + [(60, k) for k in range(61, 70)] + [(80, 81), (81, 80), (90, 90)]
    edges = spark.createDataFrame([(node(a), node(b)) for a, b in pairs], f"a {kind}, b {kind}")
    links = [p for p in pairs if p[0] != p[1]]
    want = {node(k): node(low) for k, low in smallest_reached({x for p in links for x in p}, links).items()}
    assert {(r.node, r.component) for r in components(edges).collect()} == set(want.items())
    assert names == ["edges", "few"]
    monkeypatch.setattr(components_module, "FEW", 1)
    assert {(r.node, r.component) for r in components(edges).collect()} == set(want.items())
    assert "small-star" in names


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] + [(k, k + 1) for k in range(300, 340)] + [(500, k) for k in range(501, 560)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == smallest_reached(nodes, edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    # the same in two steps
    half = components(spark.createDataFrame(edges[::2], "a long, b long"))
    more = extended(half, spark.createDataFrame(edges[1::2], "a long, b long"))
    assert {r.node: r.component for r in more.collect()} == got


VECTORS = "vec_id long, embedding array<float>, label int, tile string, h long"


def vectors(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, 10))
    rows = []
    for k in range(n):
        v = base[rng.integers(12)] + rng.normal(size=10) * rng.choice([0.0, 0.2, 0.4, 3])
        rows.append((k, [float(np.float32(x)) for x in v]))
    inf, nan = float("inf"), float("nan")
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * 10), (n + 3, [1.0, None]), (n + 4, [nan] * 10), (n + 5, [inf] + [0.0] * 9),
             (n + 6, rows[3][1]), (n + 7, rows[3][1]), (n + 7, rows[3][1]), (n + 8, [1.0]), (n + 9, [2.0] + [0.0] * 9), (None, rows[3][1]),
             (n + 10, [1e30] * 10), (n + 11, [-1e-30] * 10)]
    return spark.createDataFrame([(*r, 1, "t", 5) for r in rows], VECTORS), rows


def padded(v, n=10):
    return np.array([*v, *[0.0] * (n - len(v))], np.float64)


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("block,pivots", [(4096, 128), (40, 6)])
def test_embedding_dedup(spark, monkeypatch, block, pivots):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "MAX_PIVOTS", pivots)
    monkeypatch.setattr(embedding_dedup, "STRIP", 16)
    df, rows = vectors(spark)
    x = [padded(v) if i is not None and usable(v) else None for i, v in rows]
    n_links, links = [0] * len(rows), []
    unit = [v / np.abs(v).max() if v is not None else None for v in x]
    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and unit[a] @ unit[b] / (np.linalg.norm(unit[a]) * np.linalg.norm(unit[b])) >= 0.9:
                n_links[a] += 1
                n_links[b] += 1
                links.append((rows[a][0], rows[b][0]))
    root = smallest_reached({i for i, _ in rows if i is not None}, links)
    got = sorted(((r.id, r.n_links, r.component) for r in embedding_dedup.near_vectors(df).collect()), key=str)
    assert got == sorted(((i, k, root.get(i)) for (i, _), k in zip(rows, n_links)), key=str)


def test_quantisation_bound_is_rigorous():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for threshold in (-0.2, 0.0, 0.1, 0.3):
        found = np.zeros((200, 200), bool)
        found[embedding_dedup.possible(embedding_dedup.quantised(x), embedding_dedup.quantised(x), threshold)] = True
        assert not (((x @ x.T) >= threshold) & ~found).any()
        assert found.sum() < 1.3 * ((x @ x.T) >= threshold).sum()      # and it leaves little to recompute


def test_embedding_dedup_empty(spark):
    assert embedding_dedup.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("blocks", [(1024, 16384, 64), (5, 60, 2)])
def test_vector_search(spark, monkeypatch, blocks):
    for name, size in zip(("QUERY_BLOCK", "CANDIDATE_BLOCK", "STRIP"), blocks):
        monkeypatch.setattr(vector_search, name, size)
    df, rows = vectors(spark)
    df = df.where("vec_id IS NULL OR vec_id < 310")     # 310 and 311 are beyond the exact range
    points = {i: np.floor(256 * padded(v)).astype(np.int64) for i, v in rows
              if i is not None and i < 310 and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in sorted(points):
        if q % 10 == 0:
            best = sorted((-int(points[q] @ x), i) for i, x in points.items() if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    got = sorted(tuple(r) for r in vector_search.top_search(df, F.col("id") % 10 == 0).collect())
    assert got == want
    assert vector_search.top_search(spark.createDataFrame([], VECTORS), F.col("id") % 10 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0], 1, "", 1), (1, [2.0], 1, "", 1), (2, [2.0], 1, "", 1)], VECTORS)
    assert sorted(map(tuple, vector_search.top_search(few, F.col("id") == 0).collect())) == [(0, 1, 1, 131072), (0, 2, 2, 131072)]


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute_join(rows, n, num, den):
    sets = [shingles(t, n) if i is not None else set() for i, t in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                links.append((rows[a][0], rows[b][0]))
    root = smallest_reached({i for i, _ in rows if i is not None}, links)
    return sorted(((i, len(shingles(t, n)), root.get(i)) for i, t in rows), key=str)


def family(seed, docs=260):
    """Near copies of a few texts, edited now and then, beside short and odd ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([4, 30, 60, 400]))] for _ in range(8)]
    rows = []
    for i in range(docs):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            at = rng.randrange(len(words))
            words[at:at + rng.choice([0, 1])] = [rng.choice(vocabulary).upper()] if rng.random() < 0.7 else []
        rows.append((i, " ".join(words)))
    return rows + [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "one\x0btwo"), (None, "one two")]


@pytest.mark.parametrize("seed,block,n,num", [(0, 2048, 3, 90), (1, 16, 3, 90), (2, 2048, 5, 80)])
def test_ngram_join(spark, monkeypatch, seed, block, n, num):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "PAIRS", 500)
    rows = family(seed)
    docs = odd.documents(spark, [(*r, "en", "a", 1) for r in rows])
    got = sorted(((r.id, r.n_shingles, r.component.id) for r in ngram_join.ngram_join(docs, n, num, 100).collect()), key=str)
    assert got == brute_join(rows, n, num, 100)


def test_ngram_join_settles_pairs_once(spark, monkeypatch):
    """N-grams of one document go nowhere, and a pair that round one has verified brings no member rows to round two."""
    counts = {}
    written = ngram_join.written

    def counted(df, name):
        found = written(df, name)
        counts.setdefault(name, found.count())
        return found

    monkeypatch.setattr(ngram_join, "written", counted)
    rows = [(1000 + k, " ".join(f"x{k // 2}y{j}" if j < 55 + k % 2 * 5 else f"z{k}y{j}" for j in range(64))) for k in range(80)]
    rows += family(0, 40)
    docs = odd.documents(spark, [(*r, "en", "a", 1) for r in rows])
    got = sorted(((r.id, r.n_shingles, r.component.id) for r in ngram_join.ngram_join(docs, 3, 90, 100).collect()), key=str)
    assert got == brute_join(rows, 3, 90, 100)
    assert counts["shared"] < 0.7 * sum(len(shingles(t, 3)) for _, t in rows)
    for settled, comps, kept in (([None, None], [1, 2], [5, 9]), ([[9], [5]], [1, 2], []), ([None, None], [1, 1], [])):
        rows = pd.DataFrame({"gram": 1, "i": 0, "j": 0, "n": 100, "gid": [5, 9], "block": 0, "bits": [bytes(64)] * 2,
                             "low": comps, "high": comps, "settled": settled})
        assert [g for out in ngram_join._meeting(90, 100)(iter([rows])) for g in out["gid"]] == kept


def test_ngram_join_reads_few_texts_at_once(spark, monkeypatch):
    """No batch of texts in Python holds more than TEXTS, and the session's setting stays as it was."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    seen = []
    written = ngram_join.written
    monkeypatch.setattr(ngram_join, "written", lambda df, name: (seen.append((name, int(spark.conf.get(key)))), written(df, name))[1])
    rows = family(0, 30)
    docs = odd.documents(spark, [(*r, "en", "a", 1) for r in rows])
    got = sorted(((r.id, r.n_shingles, r.component.id) for r in ngram_join.ngram_join(docs, 3, 90, 100).collect()), key=str)
    assert got == brute_join(rows, 3, 90, 100)
    assert {name for name, most in seen if most <= ngram_join.TEXTS} >= {"survey", "prefixes", "sets"}
    assert spark.conf.get(key) == before
    # rows whose bitmap is left out pass by their sizes; those that no other row suits aren't looked at again
    tile = pd.DataFrame({"gram": 1, "i": 0, "j": 0, "n": [100, 101, 300], "gid": [5, 9, 7], "block": 0, "bits": [bytes(64), None, None]})
    assert [g for out in ngram_join._possible(90, 100)(iter([tile])) for g in out["gid"]] == [5, 9]


def test_ngram_join_odd_rows(spark):
    docs = odd.documents(spark)
    kept = ngram_join.first_of_each(docs, 5, 80, 100)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x) == list(range(1, 12)) and ids.count(None) == 2   # 12 holds all of 1 and a word more
    assert ngram_join.ngram_join(odd.empty(spark)).count() == 0


def test_ngram_join_makes_sets_of_allowed_pairs_only(spark, monkeypatch):
    """Whole sets are made of the texts only whose bitmaps allow them to link, and of each once."""
    counts = {}
    written = ngram_join.written

    def counted(df, name):
        found = written(df, name)
        counts[name] = counts.get(name, 0) + found.count()
        return found

    monkeypatch.setattr(ngram_join, "written", counted)
    bodies = [" ".join(f"b{k}y{j}" for j in range(88)) for k in range(2)]
    passage = [" ".join(f"p{k}y{j}" for j in range(13)) for k in range(30)]
    rows = [(2 * k + s, f"{passage[k]} {bodies[s]}") for k in range(30) for s in range(2)]     # near by prefix only
    rows += [(100 + k, " ".join(f"c{j}" for j in range(100)) + f" end{k}") for k in range(2)]
    rows += rows[-1:] + rows[:2]                                                               # rows that come twice
    docs = odd.documents(spark, [(*r, "en", "a", 1) for r in rows])
    got = {(r.id, r.component.id) for r in ngram_join.ngram_join(docs, 3, 90, 100).collect()}
    assert got == {(i, 100 if i > 99 else i) for i, _ in rows}
    assert counts["touched"] >= 40 and counts["bitmaps"] == counts["touched"] and counts["sets"] == 2
