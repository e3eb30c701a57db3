"""Line dedup, mixing and BPE against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from reviewlake.llm import bpe, line_dedup, mixing
from reviewlake.llm.common import written
from tests.llm import odd


def brute_lines(rows):
    """{(id, text): text left} by the definition."""
    docs = {(i, t): t.split("\n") for i, t in rows if t is not None}
    seen, gone = set(), defaultdict(set)
    for key in sorted(docs, key=lambda k: (k[0] is not None, k[0] or 0, k[1])):
        lines = docs[key]
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if not re.search(r"[^\x20\x09-\x0D]", "".join(w)):
                continue
            if w in seen:
                gone[key] |= {p, p + 1, p + 2}
            seen.add(w)
    return {k: "\n".join(x for p, x in enumerate(v) if p not in gone[k]) for k, v in docs.items()}


def test_line_dedup_odd_rows(spark):
    docs = odd.documents(spark)
    got = line_dedup.line_dedup(docs).collect()
    assert len(got) == docs.count()
    want = brute_lines([(r.doc_id, r.text) for r in docs.collect() if r.doc_id != 2])
    for r in got:
        if r.row.text is None:
            assert r.clean is None and (r.n_lines, r.n_removed) == (0, 0)
        elif r.row.doc_id != 2:
            assert r.clean == want[r.row.doc_id, r.row.text]
    assert {r.clean for r in got if r.row.doc_id == 2} == {"", "other words in the same document id"}
    assert [r.clean for r in got if r.row.doc_id == 9] == ["x\n".rstrip("\n") + "\n"]
    assert line_dedup.line_dedup(odd.empty(spark)).count() == 0


def test_line_dedup_random(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice("abcd ") for _ in range(rng.randint(0, 9))), "en", "a", 1) for i in range(300)]
    got = {(r.row.doc_id, r.row.text): r.clean for r in line_dedup.line_dedup(odd.documents(spark, rows)).collect()}
    assert got == brute_lines([r[:2] for r in rows])


def test_deduped_documents_keep_columns_and_clean_rows(spark):
    docs = odd.documents(spark)
    left = line_dedup.deduped_documents(docs)
    assert left.columns == docs.columns
    ids = Counter(r.doc_id for r in left.collect())
    assert ids[2] == 1 and ids[3] == 1 and ids[4] == 1 and ids[None] == 2   # emptied copies went, empty texts stayed


def brute_targets(sizes, weights, epochs=3):
    free, target = set(sizes), {}
    total = sum(sizes.values())
    while free:
        level = (total - sum(target.values())) / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > epochs * sizes[s]}
        if not over:
            return target | {s: level * weights[s] for s in free}
        target |= {s: epochs * sizes[s] for s in over}
        free -= over
    return target


@pytest.mark.parametrize("seed", [0, 1])
def test_mixing_targets_and_takes(spark, seed):
    rng = random.Random(seed)
    names = ["a", "B", "é", "", None, "zz"]
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), "en", names[min(5, int(rng.expovariate(0.6)))], 1) for i in range(800)]
    docs = odd.documents(spark, rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    order = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    want = brute_targets(dict(sizes), {s: k % 3 + 1 for k, s in enumerate(order)})
    sized = written(mixing.sized(docs, seed), "sizes")
    got = mixing.with_epochs(sized, mixing.mix_plan(sized)).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] and 0 <= r.epochs <= 3
        taken[r.source] += r.size * r.epochs
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 30      # one document at most
    assert Counter(r.doc_id for r in mixing.mixed_documents(docs, seed).collect()) == {r.doc_id: r.epochs for r in got if r.epochs}


def test_mixing_odd_rows(spark):
    docs = odd.documents(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    first = sorted(map(str, mixed.collect()))
    assert first == sorted(map(str, mixing.mixed_documents(docs).collect()))
    sizes = mixing.sized(odd.empty(spark))
    assert mixing.with_epochs(sizes, mixing.mix_plan(sizes)).count() == 0
    blank = odd.documents(spark, [(1, None, "en", "a", 1), (2, "", "en", None, 1)])
    sizes = mixing.sized(blank)
    assert {(r.size, r.source_size, r.target) for r in mixing.with_epochs(sizes, mixing.mix_plan(sizes)).collect()} == {(0, 0, 0.0)}


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(*bpe.public_vocabulary())


def _reference(codec):
    import public_tokenizers
    import tiktoken
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.merges.ranks, special_tokens={})
    return lambda t: np.array(enc.encode_ordinary(t), "<u4").tobytes()


def test_bpe_matches_the_library(codec):
    rng, ref = random.Random(5), _reference(codec)
    letters = "aaabbAB  \n\t0123'’éüßñ中文日本語 \x1c\x85.,!?-_<|endoftext|>🙂ⅷ²"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * k for k in range(120)] + ["ab" * k for k in range(60)] + ["aba" * 50, "", " ", "\n\n\n", "don't we'll"]
    assert codec.encode(texts) == [ref(t) for t in texts]


def test_bpe_very_long_pretoken_and_text(codec, monkeypatch):
    ref, rng = _reference(codec), random.Random(7)
    pretoken = "".join(rng.choice("thereinandtionschkeit") for _ in range(60_000))
    assert codec.encode([pretoken]) == [ref(pretoken)]
    monkeypatch.setattr(bpe, "CHUNK", 1000)
    text = odd.LONG[:20_000]
    assert codec.encode(["short", text, "x"]) == [ref("short"), ref(text), ref("x")]


def test_bpe_bitmap():
    queue, kept, rng = bpe.RankBitmap(50_000), set(), random.Random(1)
    assert queue.first() == -1
    for _ in range(3000):
        r = rng.randrange(50_000)
        (queue.add, kept.add)[0](r)
        kept.add(r)
        if rng.random() < 0.5:
            low = queue.first()
            assert low == min(kept)
            queue.drop(low)
            kept.discard(low)


def test_bpe_query_and_round_trip(spark, codec):
    docs, ref = odd.documents(spark), _reference(codec)
    got = Counter(map(tuple, bpe.digests(docs).collect()))
    want = Counter()
    for r in docs.collect():
        ids = ref(r.text or "")
        want[r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert got == want
    assert bpe.digests(odd.empty(spark)).count() == 0
    two = docs.select("text", bpe.encoded(docs.text, *bpe.public_vocabulary()).alias("ids"))
    back = two.select("text", bpe.decoded(two.ids, *bpe.public_vocabulary()).alias("b")).collect()
    assert all(bytes(r.b).decode() == (r.text or "") for r in back)
