"""SentencePiece encoding against the library."""

from __future__ import annotations

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from reviewlake.llm import pieces
from tests.llm import odd

PATH = public_tokenizers.path(pieces.VOCABULARY)
ODD = ["", " ", "  ", "   ▁ a", "▁▁x ▁", "x\n\ty", "a\x00b", "<s></s><unk><0x41>", "été 日本 😀 ａﬁ", "aaaaaaaaaaaaa " * 9,
       "�\U0010ffff", "a" * 9000, "日本語" * 3000, "x9" * 5000 + " " * 40, "́́ ​", "\r\n\x85 ", "." * 70 + " 1234567890" * 9]


@pytest.fixture(scope="module")
def lib():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return pieces.pieces_of(pieces.read_model(PATH))


def same(own, lib, texts):
    for text, ids in zip(texts, own.encode(texts)):
        got = np.frombuffer(ids, "<i4")
        assert got.tolist() == lib.encode(text), text[:80]
        assert own.decode(got) == lib.decode(got.tolist())


def test_odd_texts(own, lib):
    same(own, lib, ODD)


def test_random_texts(own, lib):
    rng = random.Random(5)
    pools = ["ab", "the and ing er", "aeiou▁ ", "日本語です。", "01239 .,", "".join(map(chr, range(0x20, 0x400))), "=-_*# \n\t"]
    same(own, lib, ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 60))) for _ in range(3000)])
    same(own, lib, ["".join(rng.choice(pool) for _ in range(400)) for pool in pools for _ in range(40)])


def test_random_ids_decode_as_the_library_does(own, lib):
    rng = random.Random(6)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(262), 28705, 1526, 259]) for _ in range(rng.randint(0, 9))]
        assert own.decode(np.array(ids, np.int64)) == lib.decode(ids), ids


def test_full_cache_changes_nothing(own, lib, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(pieces, "RUN", 50)
    fresh = pieces.Pieces(pieces.read_model(PATH))
    same(fresh, lib, ["one two three four five one two " * 3, "six one seven"] * 4)
    assert len(fresh.kept) <= 3


def test_a_wrong_cut_is_found(lib, monkeypatch):
    fresh = pieces.Pieces(pieces.read_model(PATH))
    key = next(k for k, i in fresh.pair.items() if i == lib.piece_to_id("the"))
    fresh.pair.pop(key)
    fresh.made[fresh.keys == key] = -1
    texts = ["the cat", "a dog", "brea" + "the" * 40, ""]
    ids = fresh.encode(texts, check=True)
    got = [fresh.agrees(t, x, True) for t, x in zip(texts, ids)]
    assert got == [fresh.agrees(t, x, "whole") for t, x in zip(texts, ids)] and got[1] and not got[2]


def test_long_run_without_space_is_not_quadratic(own, lib):
    rng = random.Random(7)
    text = "".join(rng.choice("abcdefgh") for _ in range(400_000))
    start = time.time()
    own.encode([text])
    assert time.time() - start < 30
    same(own, lib, [text])


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(Exception):
        pieces.read_model(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def test_query_rows(spark, lib):
    docs = odd.documents(spark)
    model = pieces.read_model(PATH)
    got = pieces.piece_digests(docs, model).collect()
    assert len(got) == docs.count() and all(r.agrees for r in got)
    want = set()
    for r in docs.collect():
        ids = lib.encode(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    assert {tuple(r)[:4] for r in got} == want
    assert pieces.piece_digests(odd.empty(spark), model).count() == 0
    whole = pieces.piece_digests(docs, model, check="whole").collect()
    assert all(r.agrees for r in whole) and {tuple(r)[:4] for r in whole} == want
    unchecked = pieces.piece_digests(docs, model, check=False).collect()
    assert all(r.agrees is None for r in unchecked) and {tuple(r)[:4] for r in unchecked} == want


def test_decoded_column(spark, lib):
    model = pieces.read_model(PATH)
    rows = spark.createDataFrame([([],), (None,), ([259, 1526, 13],)], "ids array<int>")
    assert [r.t for r in rows.select(pieces.decoded_pieces(F.col("ids"), model).alias("t")).collect()] == ["", None, lib.decode([259, 1526, 13])]
