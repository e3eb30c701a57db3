"""Operator 10: n-gram Jaccard join by grouped prefixes.

A document's set holds the 64-bit hashes of its distinct word n-grams (A-Z
lower-cased; fewer words than n: the whole sequence as one). Two documents
link when den * |x & y| >= num * |x | y|.

1. Equal sets are one node (pre-aggregated, so thousands of copies cost one).
2. One global order of the n-grams, rare ones first. It comes from a sketch of
   fixed size (``CELLS`` counters over all documents); the order affects the
   work only, any order gives the same links. The prefix of a set of n is its
   first n - ceil(n num / den) + 1 n-grams: linked sets share one of them.
3. Nodes with the same prefix and size are one group. Groups meet where they
   share a prefix n-gram. Group pairs are filtered by size and by a bound: of
   two linked sets x and y with the needed overlap o, the one whose prefix
   ends first misses at most |x| - o of its prefix in the other's, so
   the prefixes differ in at most 2 (|x| - o) + |P_y| - |P_x| n-grams. Parity
   bitmaps of the prefixes differ in no more bits than the prefixes do.
4. Round one takes for each group and n-gram the nearest group that passes (no
   other n-gram is looked at again: where none passes, none ever will),
   pairs its members with that group's first member (and members of one group
   with their own first) and verifies these pairs: by parity bitmaps of their whole
   sets, then, where these allow a link, on the whole sets. Round two
   expands every passing group pair to those member pairs that aren't connected
   by then and filters them by parity bitmaps of their whole sets, which differ
   in no more bits than the sets differ in n-grams. Of what passes, a tile hands
   on a spanning forest between components: if its edges verify, as nearly all
   do, every other pair of the tile joins documents that are connected already.
   If any edge fails, round three verifies all pairs that still pass and aren't
   connected. So components are exact, and the pairs of one large group are
   never emitted.

An n-gram in the prefixes of more than ``BLOCK`` groups is split into blocks
that meet pairwise, so no task holds more than about 2 * ``BLOCK`` groups of
one n-gram.

Defined results: null texts and texts without a word have an empty set and
link with nothing; rows without a doc_id link with nothing and have no
component; rows that repeat doc_id and text are one document; an empty table
gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import TEXTS, col, few_at_once, packed, row_key, tidied, unpacked, written  # noqa: F401
from reviewlake.llm.components import components, extended
from reviewlake.llm.embedding_dedup import Forest
from reviewlake.llm.hashed_text import Hasher, cells
from reviewlake.session import table

CELL_BITS = 21            # counters of the sketch: 2^21
PARTS = 64                # the sketch travels in this many pieces
BLOCK = 2048
PAIRS = 1 << 16           # pairs looked at at once
WORDS, WIDE = 8, 64       # 64-bit words of a prefix bitmap, and of a long prefix
LONG_PREFIX = 128
SET_WORDS = ((512, 64), (2048, 128))  # words of a set's bitmap up to so many n-grams; beyond them:
MAX_SET_WORDS = 256
SETTLED = 16              # verified pairs that a group remembers
MARK_BITS = 23            # marks of the documents whose bitmaps or sets are made: 2^23 bits

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def shingle_sets(hasher: Hasher, texts: list[str | None], n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    for chunk in hasher.chunks(texts):
        word = ~_SPACE[chunk.raw]
        edges = np.flatnonzero(word[1:] != word[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        w = _mixed(hasher.spans(hasher.running(_LOWER[chunk.raw]), starts, ends) + np.uint64(n))
        gram = np.zeros(max(0, len(w) - n + 1), np.uint64)
        for k in range(n):
            gram = _mixed(gram * np.uint64(0x9E3779B97F4A7C15) + w[k:k + len(gram)])
        first = np.searchsorted(starts, chunk.first)
        last = np.append(first[1:], len(starts))
        for a, b in zip(first.tolist(), last.tolist()):
            if b - a >= n:
                yield np.unique(gram[a:b - n + 1])
            elif b > a:
                h = np.zeros(1, np.uint64) + np.uint64(b - a)
                for k in range(a, b):
                    h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[k:k + 1])
                yield h
            else:
                yield gram[:0]


def _cell(grams: np.ndarray) -> np.ndarray:
    return cells(grams, 7, CELL_BITS)


def _survey(n: int):
    """Per row (id, h, size, signature); per partition its part of the sketch."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, counts = Hasher(), np.zeros(1 << CELL_BITS, np.uint32)
        for rows in parts:
            sizes, one, two = [], [], []
            for s in shingle_sets(hasher, rows["text"].tolist(), n):
                sizes.append(len(s))
                one.append(int(_mixed(s).sum(dtype=np.uint64).astype(np.int64)))
                two.append(int(np.bitwise_xor.reduce(_mixed(s * np.uint64(3) + np.uint64(1)), initial=np.uint64(0)).astype(np.int64)))
                counts[_cell(s)] += 1
            yield pd.DataFrame({"part": -1, "id": rows["id"], "h": rows["h"], "n": sizes, "s1": one, "s2": two, "counts": None})
        if counts.any():
            yield pd.DataFrame([{"part": k, "id": None, "h": 0, "n": 0, "s1": 0, "s2": 0, "counts": zlib.compress(c.tobytes(), 1)}
                                for k, c in enumerate(np.split(counts, PARTS))])
    return run


def _summed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[int, np.ndarray] = {}
    for rows in parts:
        for k, c in zip(rows["part"], rows["counts"]):
            got = np.frombuffer(zlib.decompress(c), np.uint32)
            total[k] = total.get(k, np.zeros(len(got), np.uint64)) + got
    yield pd.DataFrame({"part": list(total), "counts": [np.rint(8 * np.log2(1.0 + c)).clip(0, 255).astype(np.uint8).tobytes()
                                                       for c in total.values()]})


def _bitmap(grams: np.ndarray, words: int) -> np.ndarray:
    """Parity of the n-grams in each of 64 * words bits; a wide bitmap folds into
    a narrow one."""
    bit = (_mixed(grams + np.uint64(11)) >> np.uint64(64 - 14)).astype(np.int64) & (64 * words - 1)
    odd = (np.bincount(bit, minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little")


def _prefixes(n: int, num: int, den: int, rarity: bytes):
    """Per row its prefix, the prefix's hash and bitmaps."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, level = Hasher(), np.frombuffer(rarity, np.uint8)
        for rows in parts:
            keep, sizes, prefix, ph, bits = [], [], [], [], []
            for k, s in enumerate(shingle_sets(hasher, rows["text"].tolist(), n)):
                if not len(s):
                    continue
                p = len(s) - -(-len(s) * num // den) + 1
                first = s[np.lexsort((s, level[_cell(s)]))[:p]]
                keep.append(k)
                sizes.append(len(s))
                prefix.append(first.astype(np.int64))
                ph.append(int(_mixed(first).sum(dtype=np.uint64).astype(np.int64)))
                bits.append(_bitmap(first, WIDE if p > LONG_PREFIX else WORDS).tobytes())
            if keep:
                yield pd.DataFrame({"id": rows["id"].to_numpy()[keep], "h": rows["h"].to_numpy()[keep],
                                    "n": sizes, "prefix": prefix, "ph": ph, "bits": bits})
    return run


def _whole_bitmaps(n: int):
    """Per row its whole set's bitmap and size."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for rows in parts:
            if len(rows):
                sizes, bits = [], []
                for s in shingle_sets(hasher, rows["text"].tolist(), n):
                    sizes.append(len(s))
                    bits.append(_bitmap(s, next((w for most, w in SET_WORDS if len(s) <= most), MAX_SET_WORDS)).tobytes())
                yield pd.DataFrame({"id": rows["id"], "h": rows["h"], "all": bits, "size": sizes})
    return run


def _sets(n: int):
    """Per row its whole set."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for rows in parts:
            if len(rows):
                yield pd.DataFrame({"id": rows["id"], "h": rows["h"],
                                    "grams": [s.astype(np.int64) for s in shingle_sets(hasher, rows["text"].tolist(), n)]})
    return run


def _marks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per piece of the marks its bits, one set for each hash of a node in it."""
    each: dict[int, np.ndarray] = {}
    for rows in parts:
        for k, own in rows.groupby("part")["h"]:
            at = own.to_numpy().astype(np.uint64) & np.uint64((1 << MARK_BITS) - 1)
            each.setdefault(k, np.zeros((1 << MARK_BITS) // PARTS, bool))[(at // np.uint64(PARTS)).astype(np.int64)] = True
    yield pd.DataFrame({"part": list(each), "bits": [np.packbits(b, bitorder="little").tobytes() for b in each.values()]})


def _marked(nodes: DataFrame):
    """Whether the hash of an id and a text's hash may be one of the ``nodes``': a
    filter of fixed size, so that a join with many nodes need not shuffle all texts."""
    rows = nodes.select(F.xxhash64("node.id", "node.h").alias("h")).distinct().withColumn("part", F.pmod("h", F.lit(PARTS)).cast("int"))
    pieces = rows.repartition(PARTS, "part").mapInPandas(_marks, "part int, bits binary").collect()   # 2^MARK_BITS bits in all
    empty = bytes((1 << MARK_BITS) // PARTS // 8)
    held = {r.part: bytes(r.bits) for r in pieces}
    bits = b"".join(held.get(k, empty) for k in range(PARTS))

    @F.pandas_udf("boolean")
    def run(h: pd.Series) -> pd.Series:
        at = (h.to_numpy().astype(np.uint64) & np.uint64((1 << MARK_BITS) - 1)).astype(np.int64)
        part, place = at % PARTS, at // PARTS
        byte = np.frombuffer(bits, np.uint8)[part * len(empty) + (place >> 3)]
        return pd.Series((byte >> (place & 7) & 1).astype(bool))
    return run


def _folded(bits: pd.Series, words: int = WORDS) -> np.ndarray:
    """All bitmaps at ``words`` words (a wide one is folded by parity)."""
    out = np.zeros((len(bits), words), np.uint64)
    for k, b in enumerate(bits):
        out[k] = np.bitwise_xor.reduce(np.frombuffer(b, np.uint64).reshape(-1, words), axis=0)
    return out


def _needed(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """The overlap that sets of these sizes need to link."""
    return -(-num * (a + b) // (num + den))


def _prefix_slack(na, nb, num: int, den: int) -> np.ndarray:
    """In how many n-grams the prefixes of linked sets of these sizes may differ."""
    need = _needed(na, nb, num, den)
    pa, pb = (n - -(-n * num // den) + 1 for n in (na, nb))
    return np.maximum(2 * (na - need) + pb - pa, 2 * (nb - need) + pa - pb)


def _spans(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of positions whose counts sum to about ``PAIRS`` at most."""
    ends, at = np.cumsum(counts), 0
    while at < len(counts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
        yield at, to
        at = to


def _paired(first: np.ndarray, counts: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): position at + k with each of the counts[k] positions from first[k]."""
    a = np.repeat(np.arange(at, at + len(counts)), counts)
    return a, np.repeat(first, counts) + np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)


def _by_tile(of):
    """Calls ``of`` with the rows of whole tiles, which arrive sorted by (gram, i, j)."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for rows in parts:
            held = rows if held is None else pd.concat([held, rows], ignore_index=True)
            last = held[["gram", "i", "j"]].iloc[-1]
            open_ = (held["gram"] == last["gram"]) & (held["i"] == last["i"]) & (held["j"] == last["j"])
            if not open_.all():
                yield of(held[~open_].reset_index(drop=True))
                held = held[open_]
        if held is not None and len(held):
            yield of(held.reset_index(drop=True))
    return run


def _tiles_of(rows: pd.DataFrame) -> np.ndarray:
    return (rows[["gram", "i", "j"]].diff().fillna(1) != 0).any(axis=1).to_numpy().cumsum()


def _size_stop(tile: np.ndarray, n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Where the rows of the same tile end that aren't too large (sorted by tile, n)."""
    big = np.int64(n.max()) * den // num + 2
    return np.searchsorted(tile * big + n, tile * big + n * den // num, side="right")


def _passing(rows: pd.DataFrame, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, off): positions of the groups of each tile that pass the filters, and
    in how many bits their prefixes differ at least."""
    n, block = rows["n"].to_numpy(np.int64), rows["block"].to_numpy()
    across = (rows["i"] != rows["j"]).to_numpy()
    counts = np.maximum(0, _size_stop(_tiles_of(rows), n, num, den) - np.arange(len(rows)) - 1)
    known = rows["bits"].notna().to_numpy()                 # without a bitmap only the sizes count
    bits = _folded(rows["bits"].where(known, bytes(8 * WORDS)))
    long = known & (rows["bits"].str.len() > 8 * WORDS).to_numpy()
    wide = {k: np.frombuffer(rows["bits"].iat[k], np.uint64) for k in np.flatnonzero(long)}
    for at, to in _spans(counts):
        a, b = _paired(np.arange(at + 1, to + 1), counts[at:to], at)
        ok = ~across[a] | (block[a] != block[b])
        a, b = a[ok], b[ok]
        slack = _prefix_slack(n[a], n[b], num, den)
        off = np.where(known[a] & known[b], np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64), 0)
        a, b, off, slack = (x[off <= slack] for x in (a, b, off, slack))
        for k in np.flatnonzero(long[a] & long[b]):
            off[k] = int(np.bitwise_count(wide[a[k]] ^ wide[b[k]]).sum())
        yield tuple(x[off <= slack] for x in (a, b, off))


def _possible(num: int, den: int):
    """Rows of groups, sorted by (gram, i, j, n): those that pass with another in their tile."""
    def of(rows: pd.DataFrame) -> pd.DataFrame:
        keep = np.zeros(len(rows), bool)
        for a, b, _ in _passing(rows, num, den):
            keep[a] = keep[b] = True
        return rows.loc[keep, ["gram", "i", "j", "gid", "block"]]

    return _by_tile(of)


def _nearest(num: int, den: int):
    """Rows of groups, sorted by (gram, i, j, n): each group's nearest (b) in its
    tile and the n-gram, at which both are looked at again."""
    def of(rows: pd.DataFrame) -> pd.DataFrame:
        none = np.iinfo(np.int64).max
        best = np.full(len(rows), none)
        for a, b, off in _passing(rows, num, den):
            np.minimum.at(best, a, off * len(rows) + b)     # the nearest, then the first
            np.minimum.at(best, b, off * len(rows) + a)
        a = np.flatnonzero(best < none)
        g = rows["gid"].to_numpy()
        return pd.DataFrame({"gram": rows["gram"].to_numpy()[a], "a": g[a], "b": g[best[a] % len(rows)]}).drop_duplicates()

    return _by_tile(of)


def _pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(np.minimum(a, b).astype(np.uint64)) + np.maximum(a, b).astype(np.uint64)


def _meeting(num: int, den: int):
    """Rows of groups, sorted by (gram, i, j, n), with the span of their members'
    components: those that pass with another in their tile without being all of
    one component or settled with it, and groups of several components themselves."""
    def of(rows: pd.DataFrame) -> pd.DataFrame:
        low, high, gid = rows["low"].to_numpy(), rows["high"].to_numpy(), rows["gid"].to_numpy()
        known = rows["settled"].dropna()
        other = np.concatenate([np.zeros(0, np.int64), *known])
        settled = np.unique(_pair_key(np.repeat(gid[known.index], known.str.len()), other.astype(np.int64)))
        keep = (low != high) & (rows["i"] == rows["j"]).to_numpy()
        for a, b, _ in _passing(rows, num, den):
            apart = np.minimum(low[a], low[b]) != np.maximum(high[a], high[b])
            a, b = a[apart], b[apart]
            new = ~np.isin(_pair_key(gid[a], gid[b]), settled)
            keep[a[new]] = keep[b[new]] = True
        return rows.loc[keep, ["gram", "i", "j", "gid", "block"]]

    return _by_tile(of)


def _forest(x: np.ndarray, y: np.ndarray, comp: np.ndarray, forest: Forest) -> np.ndarray:
    """Positions of pairs that connect what all pairs (x, y) connect, beyond what
    ``forest`` over components has connected before."""
    chosen, left = [], np.arange(len(x))
    while True:
        a, b = forest.root[comp[x[left]]], forest.root[comp[y[left]]]
        left, a, b = left[a != b], a[a != b], b[a != b]
        if not len(left):
            return np.concatenate(chosen) if chosen else left
        first = np.full(len(forest.root), len(x))      # one pair per component that is still apart
        np.minimum.at(first, a, left)
        np.minimum.at(first, b, left)
        some = np.unique(first[first < len(x)])
        chosen.append(some)
        forest.link(comp[x[some]], comp[y[some]])


def _unconnected(num: int, den: int, every: bool):
    """Rows of members, sorted by (gram, i, j, n, gid): group pairs that pass,
    expanded to the member pairs that may link and aren't connected; a spanning
    forest of them, or ``every`` one."""
    def of(rows: pd.DataFrame) -> pd.DataFrame:
        tile, gid, n = _tiles_of(rows), rows["gid"].to_numpy(), rows["n"].to_numpy(np.int64)
        comp = np.unique(rows["comp"].to_numpy(), return_inverse=True)[1]
        forest = Forest(len(rows))
        heads = np.flatnonzero(np.concatenate(([True], (tile[1:] != tile[:-1]) | (gid[1:] != gid[:-1]))))
        many = np.diff(np.append(heads, len(rows)))
        gn, block = n[heads], rows["block"].to_numpy()[heads]
        across = (rows["i"] != rows["j"]).to_numpy()[heads]
        bits = _folded(rows["bits"].iloc[heads])
        counts = np.maximum(1, _size_stop(tile[heads], gn, num, den) - np.arange(len(heads)))    # with itself
        narrow = _folded(rows["all"], SET_WORDS[0][1])
        width = rows["all"].str.len().to_numpy() // 8
        whole = {k: np.frombuffer(rows["all"].iat[k], np.uint64) for k in np.flatnonzero(width > narrow.shape[1])}
        out = []
        for at, to in _spans(counts):
            a, b = _paired(np.arange(at, to), counts[at:to], at)
            ok = np.where(across[a], block[a] != block[b], (a != b) | (many[a] > 1))
            a, b = a[ok], b[ok]
            off = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
            ok = off <= _prefix_slack(gn[a], gn[b], num, den)
            a, b = a[ok], b[ok]
            k, left = _paired(heads[a], many[a], 0)         # a row per pair and member of a
            right, size = heads[b[k]], many[b[k]]
            for lo, hi in _spans(size):
                x, y = _paired(right[lo:hi], size[lo:hi], 0)
                x = left[lo:hi][x]
                ok = (x != y) & (comp[x] != comp[y]) & ((gid[x] != gid[y]) | (x < y))
                x, y = x[ok], y[ok]
                slack = n[x] + n[y] - 2 * _needed(n[x], n[y], num, den)
                ok = np.bitwise_count(narrow[x] ^ narrow[y]).sum(axis=1, dtype=np.int64) <= slack
                x, y, slack = x[ok], y[ok], slack[ok]
                both = np.minimum(width[x], width[y])
                for p in np.flatnonzero(both > narrow.shape[1]):
                    u, v = (np.bitwise_xor.reduce(whole[z].reshape(-1, both[p]), axis=0) for z in (x[p], y[p]))
                    if np.bitwise_count(u ^ v).sum() > slack[p]:
                        x[p] = y[p]                         # not a pair
                x, y = x[x != y], y[x != y]
                if not every:
                    some = _forest(x, y, comp, forest)
                    x, y = x[some], y[some]
                out.append((x, y))
        x, y = (np.concatenate([p[k] for p in out]) for k in (0, 1)) if out else (np.zeros(0, np.int64),) * 2
        node = rows["nid"].to_numpy()
        return pd.DataFrame({"a": np.minimum(node[x], node[y]), "b": np.maximum(node[x], node[y])}).drop_duplicates()

    return _by_tile(of)


def _shared(firsts: DataFrame) -> DataFrame:
    """(gram, gid, m) rows of the n-grams of m groups that may make documents
    meet: several groups share them, or a group of several members holds them."""
    grams = firsts.select("gid", "size", F.explode("prefix").alias("gram"))
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.max("size").alias("most")).where("m > 1 OR most > 1")
    return grams.join(counts, "gram").select("gram", "gid", "m")


def _counted(grams: DataFrame) -> DataFrame:
    """(gram, gid) rows with m, the number of rows of the n-gram."""
    return grams.join(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("m")), "gram")


def _dealt(grams: DataFrame) -> DataFrame:
    """(gram, gid, m) rows of n-grams that several groups share, dealt to tiles: one
    tile per n-gram, or every pair (i, j) of its blocks."""
    shared = grams.where("m > 1").withColumn("nb", F.ceil(F.col("m") / BLOCK).cast("int"))
    shared = shared.withColumn("block", F.pmod(F.xxhash64("gid"), F.col("nb")).cast("int"))
    return (shared.select("gram", "gid", "block", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("k"))
            .select("gram", "gid", "block", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j")))


def _may_link(num: int, den: int):
    """Whether the bitmaps and sizes of two sets allow them to link."""
    @F.pandas_udf("boolean")
    def run(x: pd.Series, y: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        n, m = n.to_numpy(np.int64), m.to_numpy(np.int64)
        off = np.zeros(len(x), np.int64)
        for k, (u, v) in enumerate(zip(x, y)):
            u, v = np.frombuffer(u, np.uint64), np.frombuffer(v, np.uint64)
            words = min(len(u), len(v))
            off[k] = np.bitwise_count(np.bitwise_xor.reduce(u.reshape(-1, words), axis=0)
                                      ^ np.bitwise_xor.reduce(v.reshape(-1, words), axis=0)).sum()
        return pd.Series(off <= n + m - 2 * _needed(n, m, num, den))
    return run


def _named(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row for each (id, h) of ``rows`` that is one of the ``nodes``."""
    own = nodes.select(F.col("node.id").alias("id"), F.col("node.h").alias("h"))
    return rows.join(own, ["id", "h"], "left_semi").dropDuplicates(["id", "h"])


def _verified(pairs: DataFrame, bits: DataFrame, texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs of nodes (a, b) that link: bitmaps first, then the sets of the
    pairs that their bitmaps allow; no other set is made, written or shuffled.
    Bitmaps that no pair names aren't shuffled as long as the pairs are few
    enough to be broadcast."""
    def sides(pairs: DataFrame, of: DataFrame, *values: str) -> DataFrame:
        names = pairs
        for s in "ab":
            named = names.select(F.col(s).alias("node")).distinct()
            own = of.select("node", *values).join(named, "node", "left_semi")
            pairs = pairs.join(own.select(F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in values]), s)
        return pairs

    narrow = sides(pairs, bits, "all", "size")
    pairs = written(narrow.where(_may_link(num, den)("all_a", "all_b", "size_a", "size_b")).select("a", "b"), "allowed")
    if pairs.isEmpty():
        return pairs
    nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "named")
    some = _named(texts.where(_marked(nodes)(F.xxhash64("id", "h"))), nodes)
    kind = texts.schema["id"].dataType.simpleString()
    with few_at_once(texts.sparkSession):
        sets = written(some.mapInPandas(lambda parts: tidied(_sets(n)(parts)), f"id {kind}, h long, grams array<long>")
                       .select(F.struct("id", "h").alias("node"), "grams"), "sets")
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    both = sides(pairs, sets, "grams")
    return both.where(common * F.lit(den) >= (F.size("grams_a") + F.size("grams_b") - common) * F.lit(num)).select("a", "b")


def _open_pairs(grams: DataFrame, touched: DataFrame, groups: DataFrame, bits: DataFrame, found: DataFrame,
                settled: DataFrame, num: int, den: int, every: bool) -> DataFrame:
    """Pairs (a, b) of nodes that pass all filters and that ``found`` doesn't connect,
    but for groups that are ``settled`` with each other."""
    now = touched.join(found, "node", "left").withColumn("comp", F.xxhash64(F.coalesce("component", "node")))
    now = written(now.select("gid", "node", F.xxhash64("node").alias("nid"), "comp"), "now")
    span = written(now.groupBy("gid").agg(F.min("comp").alias("low"), F.max("comp").alias("high")), "span")
    near = written(grams.join(span, "gid").select("gram", "gid", "low", "high"), "open-grams")
    several = near.groupBy("gram").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low != high")
    open_ = written(near.join(several.select("gram"), "gram", "left_semi"), "open")
    # a group whose members differ meets itself: it counts as two
    twice = F.explode(F.sequence(F.lit(1), F.when(F.col("low") != F.col("high"), 2).otherwise(1)))
    tiles = _dealt(_counted(open_.select("gram", "gid", twice.alias("copy")).drop("copy"))).distinct()
    # groups first, as narrow rows: the members' wide ones go to the tiles in which their group meets another
    facts = span.join(groups.select("gid", "n", "bits"), "gid").join(settled, "gid", "left")
    narrow = tiles.join(facts, "gid").repartition("gram", "i", "j") \
        .sortWithinPartitions("gram", "i", "j", "n", "gid")
    tiles = written(narrow.select("gram", "i", "j", "n", "gid", "block", "bits", "low", "high", "settled").mapInPandas(
        _meeting(num, den), "gram long, i int, j int, gid long, block int"), "meeting")
    members = now.join(tiles.select("gid").distinct(), "gid", "left_semi").join(groups.select("gid", "n", "bits"), "gid")
    rows = tiles.join(members.join(bits, "node").drop("node"), "gid").repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j", "n", "gid", "nid")
    rest = written(rows.select("gram", "i", "j", "n", "gid", "nid", "block", "bits", "all", "comp").mapInPandas(
        _unconnected(num, den, every), "a long, b long").distinct(), "rest")
    named = now.select("nid", "node")
    return (rest.join(named.toDF("a", "na"), "a").join(named.toDF("b", "nb"), "b")
            .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")))


def ngram_join(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, text: str = "text",
               doc_id: str = "doc_id") -> DataFrame:
    """(id, h, n_shingles, node, component) of every distinct (doc_id, text);
    node and component are structs (id, h): the first document with the same
    set, and the first that links reach."""
    spark = docs.sparkSession
    key = row_key(col(doc_id), col(text))
    texts = docs.select(key["id"].alias("id"), key["h"].alias("h"), col(text).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    with few_at_once(spark):
        survey = written(texts.mapInPandas(
            lambda parts: tidied(_survey(n)(parts)), f"part int, id {kind}, h long, n int, s1 long, s2 long, counts binary"), "survey")
    pieces = survey.where("part >= 0").select("part", "counts").repartition(PARTS, "part").mapInPandas(
        _summed, "part int, counts binary").collect()       # PARTS rows, 2^CELL_BITS bytes in all
    rarity = b"".join(bytes(r.counts) for r in sorted(pieces, key=lambda r: r.part)) or bytes(1 << CELL_BITS)

    own = survey.where("part < 0").select(F.struct("id", "h").alias("key"), F.col("n").alias("n_shingles"), "s1", "s2").distinct()
    linkable = own.where("n_shingles > 0 AND key.id IS NOT NULL")
    nodes = written(linkable.groupBy("n_shingles", "s1", "s2").agg(F.min("key").alias("node")), "nodes")

    prefixed = texts.where("id IS NOT NULL").mapInPandas(
        lambda parts: tidied(_prefixes(n, num, den, rarity)(parts)), f"id {kind}, h long, n int, prefix array<long>, ph long, bits binary")
    rows = prefixed.select(F.struct("id", "h").alias("node"), "n", "prefix", "ph", "bits")
    with few_at_once(spark):
        rows = written(rows.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])
                       .withColumn("gid", F.xxhash64("ph", "n")), "prefixes")
    members = rows.select("node", "gid")
    groups = rows.groupBy("gid").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.count(F.lit(1)).alias("size"),
                                     F.min("node").alias("head"))
    groups = written(groups, "groups")
    heads = groups.select("gid", "head")
    firsts = rows.join(groups.select("gid", "head", "size"), "gid").where("node = head")
    grams = written(_shared(firsts), "shared")

    # round one: each group's nearest, against the first member; and each member against its own first
    # (first without the wide bitmaps of long prefixes, which few rows need)
    def tiled(tiles: DataFrame, bits: Column) -> DataFrame:
        return tiles.join(groups.select("gid", "n", bits.alias("bits")), "gid").repartition("gram", "i", "j") \
            .sortWithinPartitions("gram", "i", "j", "n", "gid").select("gram", "i", "j", "n", "gid", "block", "bits")

    thin = F.when(F.octet_length("bits") <= 8 * WORDS, F.col("bits"))
    tiles = written(tiled(_dealt(grams), thin).mapInPandas(
        _possible(num, den), "gram long, i int, j int, gid long, block int"), "possible")
    nearest = written(tiled(tiles, F.col("bits")).mapInPandas(_nearest(num, den), "gram long, a long, b long"), "nearest")
    near = written(nearest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near")
    # a group meets others at no n-gram but those at which one of them is its nearest, and itself where it has members
    grams = written(nearest.select("gram", F.col("a").alias("gid")).union(
        grams.join(groups.where("size > 1").select("gid"), "gid", "left_semi").select("gram", "gid")).distinct(), "passing")
    inside = members.join(heads, "gid").where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    pairs = (near.join(members.select(F.col("gid").alias("a"), "node"), "a")
             .join(heads.select(F.col("gid").alias("b"), "head"), "b")
             .select(F.col("node").alias("a"), F.col("head").alias("b")))
    pairs = written(pairs.unionByName(inside).distinct(), "pairs")
    touched = near.select(F.col("a").alias("gid")).union(near.select("b")) \
        .union(groups.where("size > 1").select("gid")).distinct()
    touched = written(members.join(touched, "gid"), "touched")      # (gid, node): all that a pair can name from here on
    # bitmaps before the shuffle, so that no text passes it; whole sets are made for the pairs only that bitmaps allow
    with few_at_once(spark):
        own_bits = texts.where(_marked(touched)(F.xxhash64("id", "h"))).mapInPandas(
            lambda parts: tidied(_whole_bitmaps(n)(parts)), f"id {kind}, h long, all binary, size int")
        bits = written(_named(own_bits, touched).select(F.struct("id", "h").alias("node"), "all", "size"), "bitmaps")
    links = written(_verified(pairs, bits, texts, n, num, den), "links")
    found = written(components(links), "round-one")

    # groups of one member each whose pair was verified: a few per group are remembered, the others are looked at again
    lone = groups.where("size = 1").select("gid")
    done = near.join(lone.toDF("a"), "a", "left_semi").join(lone.toDF("b"), "b", "left_semi")
    done = done.select(F.col("a").alias("gid"), F.col("b").alias("other")).union(done.select("b", "a"))
    settled = written(done.groupBy("gid").agg(F.slice(F.collect_set("other"), 1, SETTLED).alias("settled")), "settled")

    # round two: a spanning forest of what passes the filters and isn't connected
    tried = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    spanning = written(_open_pairs(grams, touched, groups, bits.select("node", "all"), found, settled, num, den, every=False), "spanning")
    untried = written(spanning.join(tried, ["a", "b"], "left_anti"), "untried")
    more = written(_verified(untried, bits, texts, n, num, den), "links-two")
    final = found
    if not more.isEmpty():
        final = written(extended(found, more), "round-two")
    # round three, if the forest isn't connected now: everything that still passes and may be cut by a failed edge.
    # Pairs that pass join documents that the forest would connect, so only what it would connect over such an edge is open
    comp_of = lambda s: final.select(F.col("node").alias(s), F.col("component").alias(f"c{s}"))
    apart = spanning.join(comp_of("a"), "a", "left").join(comp_of("b"), "b", "left") \
        .where(F.coalesce("ca", "a") != F.coalesce("cb", "b"))
    if not apart.isEmpty():
        tried = written(tried.unionByName(spanning).distinct(), "tried")
        forest = written(extended(found, spanning), "forest")
        cut = forest.join(apart.select(F.col("a").alias("node")).distinct(), "node", "left_semi").select("component").distinct()
        cut = written(forest.join(cut, "component", "left_semi").select("node"), "cut")
        rest = _open_pairs(grams, touched.join(cut, "node", "left_semi"), groups, bits.select("node", "all"), final, settled, num, den, every=True)
        rest = written(rest.join(tried, ["a", "b"], "left_anti"), "untried")
        more = written(_verified(rest, bits, texts, n, num, den), "links-three")
        if not more.isEmpty():
            final = written(extended(final, more), "round-three")
    by_set = nodes.join(final, "node", "left").select("n_shingles", "s1", "s2", "node", F.coalesce("component", "node").alias("component"))
    linked = linkable.join(by_set, ["n_shingles", "s1", "s2"], "left")
    alone = own.where("n_shingles = 0 OR key.id IS NULL").select(
        "key", "n_shingles", F.col("key").alias("node"), F.col("key").alias("component"))
    return linked.select("key", "n_shingles", "node", "component").unionByName(alone).select(
        "key.id", "key.h", "n_shingles", "node", "component")


def first_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document per linked group: the first by (doc_id, hash
    of the text). Rows that repeat doc_id and text all stay or all go."""
    found = ngram_join(docs, n, num, den)
    gone = written(found.where((F.struct("id", "h") != F.col("component"))).select(F.struct("id", "h").alias("key")), "near-copies")
    return packed(docs, key=row_key(col("doc_id"), col("text"))).join(gone, "key", "left_anti").select(*unpacked(docs.columns))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = ngram_join(docs).select("id", "h", F.col("n_shingles").cast("long").alias("n_shingles"), F.col("component.id").alias("component_id"))
    key = row_key(F.col("doc_id"), F.col("text"))
    rows = docs.select("doc_id", key["h"].alias("h"))
    same = rows["doc_id"].eqNullSafe(found["id"]) & (rows["h"] == found["h"])
    return rows.join(found, same).select("doc_id", "n_shingles", "component_id")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents WHERE text IS NOT NULL),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) >= 3 THEN w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] ELSE array_to_string(w, ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM w WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT p.a, p.b FROM p JOIN c x ON p.a = x.doc_id JOIN c y ON p.b = y.doc_id WHERE 100 * p.k >= 90 * (x.n + y.n - p.k)),
reach AS (SELECT doc_id AS node, doc_id AS got FROM documents UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.got = l.a),
lowest AS (SELECT node, min(got) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, l.component_id
FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN lowest l ON d.doc_id = l.node
"""
