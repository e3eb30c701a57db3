"""Operator 9: byte-level BPE encoding and decoding with a rank queue.

A text is cut by a pattern into pre-tokens; each pre-token that is a token is
that token, every other one is merged. The merges of all new pre-tokens of a
batch run together over one array of linked tokens, in which no link crosses
from one pre-token to the next:

- ``cur[p]`` is the rank of the pair that starts at position p, or -1;
- a bucket per rank holds positions; a three-level bitmap of 64-bit words says
  which buckets are not empty, and find-first-set gives the next rank;
- an entry whose ``cur`` is no longer the bucket's rank is stale and skipped;
- a rank whose token can't form a pair of a lower rank is merged at all its
  places at once, alternately where places overlap; any other rank goes one
  place per pre-token at a time, leftmost first, and returns to its bucket.

So one pre-token of megabytes costs about as much per byte as many short ones.
Encoded pre-tokens are kept in a bounded cache per Python worker, and in
``round_trip`` until the task ends.

Ids are stored as binary: little-endian unsigned 32-bit integers.

Defined results: null text encodes and decodes as empty; special tokens don't
exist; ids outside the vocabulary raise an error when decoded. Everything is
row-local: no shuffle, and a lost executor costs its rows only.

The ranks are read on the driver and sent along with the function (less than
1 MB, the fixed size of a vocabulary).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import slices, tidied
from reviewlake.session import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CACHE_ENTRIES = 1 << 19   # pre-tokens kept per Python worker
CACHE_CHARS = 128         # longer ones are not kept
CHUNK = 4 << 20           # characters cut into pre-tokens at a time


def read_ranks(path: str) -> bytes:
    """The content of a rank file: a base64 token and its rank per line."""
    with open(path, "rb") as f:
        return f.read()


class RankBitmap:
    """Set of ranks; three levels of 64-bit words."""

    def __init__(self, n: int):
        self.levels = []
        while True:
            n = (n + 63) // 64
            self.levels.append([0] * n)
            if n == 1:
                break

    def add(self, r: int) -> None:
        for words in self.levels:
            words[r >> 6] |= 1 << (r & 63)
            r >>= 6

    def drop(self, r: int) -> None:
        for words in self.levels:
            words[r >> 6] &= ~(1 << (r & 63))
            if words[r >> 6]:
                return
            r >>= 6

    def first(self) -> int:
        """The lowest rank, -1 if there is none."""
        r = 0
        for words in reversed(self.levels):
            w = words[r]
            if not w:
                return -1
            r = r << 6 | (w & -w).bit_length() - 1
        return r


class Merges:
    def __init__(self, rank_file: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in rank_file.splitlines() if x)}
        self.size = max(self.ranks.values()) + 1
        self.token = [b""] * self.size
        for token, r in self.ranks.items():
            self.token[r] = token
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [(left << 32 | right, r) for token, r in self.ranks.items() for i in range(1, len(token))
                 if (left := self.ranks.get(token[:i])) is not None and (right := self.ranks.get(token[i:])) is not None]
        both = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.keys, self.pair_rank = both[:, 0].copy(), both[:, 1].copy()
        lowest = np.full(self.size, self.size, np.int64)  # of the pairs that a token is part of
        np.minimum.at(lowest, self.keys >> 32, self.pair_rank)
        np.minimum.at(lowest, self.keys & 0xFFFFFFFF, self.pair_rank)
        self.rising = lowest > np.arange(self.size)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.pair_rank[at], -1)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as bytes; none of the pieces is empty."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(lengths)
        n = int(ends[-1])
        ids = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[ends - 1] = -1
        prv[ends - lengths] = -1
        cur, merged = np.full(n, -1, np.int64), np.zeros(n, bool)
        inner = np.flatnonzero(nxt >= 0)
        cur[inner] = self.rank_of(ids[inner], ids[inner + 1])

        many: dict[int, list[np.ndarray]] = {}  # buckets: runs of positions, and single ones
        few: dict[int, list[int]] = {}
        queue = RankBitmap(self.size)

        def put(ranks: np.ndarray, places: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for q, a, b in zip(ranks[np.concatenate(([0], cuts))].tolist(), [0, *cuts.tolist()], [*cuts.tolist(), len(ranks)]):
                many.setdefault(q, []).append(places[a:b])
                queue.add(q)

        paired = inner[cur[inner] >= 0]
        if len(paired):
            put(cur[paired], paired)
        while (r := queue.first()) >= 0:
            queue.drop(r)
            runs = many.pop(r, [])
            if r in few:
                runs.append(np.array(few.pop(r)))
            pos = runs[0] if len(runs) == 1 else np.concatenate(runs)
            if len(pos) > 1 and (len(runs) > 1 or (pos[1:] <= pos[:-1]).any()):
                pos = np.unique(pos)
            if not self.rising[r] and owner[pos[0]] == owner[pos[-1]]:  # one pre-token: step to its first live place
                k = 0
                while k < len(pos) and cur[pos[k]] != r:
                    k += 1
                rest, pos = pos[k + 1:], pos[k:k + 1]
            else:
                pos = pos[cur[pos] == r]
                rest = pos[:0]
                if not self.rising[r]:
                    lead = np.ones(len(pos), bool)
                    lead[1:] = owner[pos[1:]] != owner[pos[:-1]]
                    rest, pos = pos[~lead], pos[lead]
                elif len(pos) > 1 and (chained := nxt[pos[:-1]] == pos[1:]).any():
                    starts = np.concatenate(([True], ~chained))
                    k = np.arange(len(pos))
                    pos = pos[(k - np.maximum.accumulate(np.where(starts, k, 0))) % 2 == 0]
            if len(rest):
                many[r] = [rest]
                queue.add(r)
            if not len(pos):
                continue
            gone = nxt[pos]
            after = nxt[gone]
            ids[pos], nxt[pos], cur[gone], merged[gone] = r, after, -1, True
            prv[after[after >= 0]] = pos[after >= 0]
            before = prv[pos]
            left = np.concatenate((before[before >= 0], pos))
            right = nxt[left]
            new = np.where(right >= 0, self.rank_of(ids[left], ids[right]), -1)
            cur[left] = new
            if len(left) > 64:
                if (new >= 0).any():
                    put(new[new >= 0], left[new >= 0])
                continue
            for q, p in zip(new.tolist(), left.tolist()):
                if q >= 0:
                    if q in few:
                        few[q].append(p)
                    else:
                        few[q] = [p]
                        queue.add(q)

        kept = np.flatnonzero(~merged)
        counts = np.bincount(owner[kept], minlength=len(pieces))
        packed = ids[kept].astype("<u4").tobytes()
        cuts = np.concatenate(([0], np.cumsum(counts) * 4)).tolist()
        return [packed[a:b] for a, b in zip(cuts, cuts[1:])]


class Codec:
    def __init__(self, rank_file: bytes, pattern: str):
        import regex
        self.merges = Merges(rank_file)
        self.pattern = regex.compile(pattern)
        self.kept: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; about ``CHUNK`` characters are cut at a time."""
        out: list[bytes] = []
        held: list[list[str]] = []
        size = 0
        for text in texts:
            if len(text) > CHUNK:  # a very long text goes in runs of pre-tokens
                out += self._ids_of(held)
                held, size = [], 0
                found = (m.group() for m in self.pattern.finditer(text))
                runs = iter(lambda: list(islice(found, CHUNK // 4)), [])
                out.append(b"".join(self._ids_of([run])[0] for run in runs))
                continue
            held.append(self.pattern.findall(text))
            size += len(text)
            if size > CHUNK:
                out += self._ids_of(held)
                held, size = [], 0
        return out + self._ids_of(held)

    def _ids_of(self, cut: list[list[str]]) -> list[bytes]:
        known = self.kept
        new = list(set().union(*cut).difference(known))
        ranks = [self.merges.ranks.get(p) for p in map(str.encode, new)]
        known.update((p, r.to_bytes(4, "little")) for p, r in zip(new, ranks) if r is not None)
        todo = [p for p, r in zip(new, ranks) if r is None]
        if todo:
            known.update(zip(todo, self.merges.merge(list(map(str.encode, todo)))))
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in cut]
        over = len(known) - CACHE_ENTRIES
        for k, p in enumerate(reversed(new)):  # when full, the earlier ones stay: frequent pre-tokens come early
            if k < over or len(p) > CACHE_CHARS:
                del known[p]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.merges.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[int, Codec] = {}


def codec(rank_file: bytes, pattern: str) -> Codec:
    """One codec per Python worker and vocabulary."""
    key = hash((rank_file, pattern))
    if key not in _CODECS:
        _CODECS[key] = Codec(rank_file, pattern)
    return _CODECS[key]


def encoded(text: Column, rank_file: bytes, pattern: str) -> Column:
    """Ids of ``text`` as binary."""

    @F.pandas_udf("binary")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(rank_file, pattern)
        for texts in slices(parts):
            yield pd.Series(own.encode(texts.fillna("").tolist()), dtype=object)

    return encode(text)


def decoded(ids: Column, rank_file: bytes, pattern: str) -> Column:
    """Bytes that binary ``ids`` stand for."""

    @F.pandas_udf("binary")
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(rank_file, pattern)
        for rows in slices(parts):
            yield pd.Series([own.decode(x or b"") for x in rows], dtype=object)

    return decode(ids)


def _coded(parts: Iterator[pd.Series], rank_file: bytes, pattern: str) -> Iterator[pd.DataFrame]:
    own = codec(rank_file, pattern)
    try:
        for texts in slices(parts):
            ids = own.encode(texts.fillna("").tolist())
            yield pd.DataFrame({"ids": ids, "decoded": [own.decode(x) for x in ids]}, dtype=object)
    finally:
        own.kept.clear()  # the worker stays


def round_trip(text: Column, rank_file: bytes, pattern: str) -> Column:
    """struct<ids, decoded>: the ids of ``text`` and the bytes they decode to, in one pass."""

    @F.pandas_udf("ids binary, decoded binary")
    def both(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from tidied(_coded(parts, rank_file, pattern))

    return both.asNondeterministic()(text)


def public_vocabulary(name: str = VOCABULARY) -> tuple[bytes, str]:
    import public_tokenizers
    return read_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN


def digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes."""
    rows = docs.select("doc_id", round_trip(F.col("text"), *public_vocabulary(vocabulary)).alias("coded"))
    return rows.select("doc_id", F.floor(F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("coded.ids", 256).alias("ids_sha256"), F.sha2("coded.decoded", 256).alias("decoded_sha256"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
