"""Operator 13: SentencePiece encoding and decoding for merge-type vocabularies.

A text becomes symbols, one a character (each space is U+2581, and one U+2581
goes in front of a text that isn't empty). Every two neighbours whose joined
string is a piece stand in an agenda ordered by the piece's score, higher
first, then by the left symbol's position. The first entry is taken and its
pair merged; the pairs that the new symbol forms with its neighbours enter the
agenda. An entry whose pair has changed since is stale and skipped. What is no
piece at the end is written as its UTF-8 bytes, one byte piece each.

A merge can't join two characters that stand next to each other in no piece,
so a text is cut there first, and the cuts' agendas are independent: exact for
any vocabulary, as the cuts come from its pieces. Texts are cut before every
run of U+2581 if no piece holds one after another character; a cut longer than
``SHORT`` is cut again at such pairs of characters. Encoded cuts are kept in a
bounded cache per Python worker.

The agendas of short cuts are the rows of a matrix, an entry per left position:
a row's least number is its first entry, the leftmost of equals, and one step
merges the first entries of all rows. A longer cut has a heap of its own.

``encoded_pieces`` works on Arrow batches. With ``check`` the sentencepiece
library encodes what a batch encodes anew, every cut as a text of its own, and
``agrees`` says whether all cuts of a text got the library's ids; with ``check``
"whole" it encodes every whole text of the batch again (about twice the work).
The ids returned are always the agenda's.

Limits: vocabularies of merge type with byte pieces, identity normalisation and
kept white space; any other raises an error before the job starts. One cut of
n characters needs about 100 n bytes while it is encoded.

Defined results: null and empty texts have no ids and decode as empty; control
pieces in a text are ordinary characters; ids outside the vocabulary raise an
error when decoded; bytes that aren't UTF-8 decode as U+FFFD each. Everything
is row-local: no shuffle, and a lost executor costs its rows only. Columns are
named by the caller, so extra columns can't clash; an empty table gives an
empty table.

The model file (about 0.5 MB, the fixed size of a vocabulary) is read on the
driver and sent along with the function.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.session import table

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
BASE = 1 << 20            # more than there are symbols
SHORT = 64                # characters of a cut whose agenda is a row
WIDTHS = (6, 8, 10, 12, 16, 24, 32, SHORT)    # of the matrices
WIDTH_OF = [next(w for w in WIDTHS if n <= w) for n in range(SHORT + 1)]
CACHE_ENTRIES = 1 << 18   # cuts kept per Python worker; longer ones than SHORT are not kept
RUN = 1 << 20             # characters of text that are cut and encoded at a time


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("reviewlake-each-byte", _each_byte)


def _loaded(model: bytes):
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_proto=model)


def read_model(path: str) -> bytes:
    """The content of a model file, after a look at what it asks for."""
    with open(path, "rb") as f:
        model = f.read()
    lib = _loaded(model)
    n = lib.get_piece_size()
    if sum(lib.is_byte(i) for i in range(n)) != 256:
        raise ValueError("the vocabulary has no byte pieces")
    if any(lib.is_unused(i) for i in range(n)):
        raise ValueError("unused pieces aren't supported")
    if lib.normalize("  ａ ﬁ\t a ") != "   ａ ﬁ\t a ".replace(" ", SPACE):
        raise ValueError("only identity normalisation with a space in front is supported")
    scores = [lib.get_score(i) for i in range(n)]
    if any(s > 0 or s != int(s) for s in scores):     # merge-type scores are minus the merge's rank
        raise ValueError("the vocabulary isn't of merge type")
    return model


class Pieces:
    def __init__(self, model: bytes):
        self.lib = lib = _loaded(model)
        n = lib.get_piece_size()
        names = [lib.id_to_piece(i) for i in range(n)]
        special = [lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) for i in range(n)]
        self.symbol = {p: i for i, p in enumerate(names) if not special[i]}
        self.byte_id = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        ordinary = list(self.symbol.items())
        order = {s: r for r, s in enumerate(sorted({lib.get_score(i) for _, i in ordinary}, reverse=True))}
        self.rank = [order.get(lib.get_score(i), 0) for i in range(n)]
        self.n = n
        # a character that is no piece of its own but part of one is a symbol beyond the vocabulary
        chars = {c for p, _ in ordinary for c in p}
        for c in sorted(chars - self.symbol.keys()):
            self.symbol[c] = n + len(self.symbol)
        self.pair = {self.symbol[p[:k]] * BASE + self.symbol[p[k:]]: i for p, i in ordinary
                     for k in range(1, len(p)) if p[:k] in self.symbol and p[k:] in self.symbol}
        both = np.array(sorted(self.pair.items()), np.int64).reshape(-1, 2)
        self.keys, self.made = np.append(both[:, 0], -1), np.append(both[:, 1], -1).astype(np.int32)  # the last one is for no pair
        self.order = np.array(self.rank + [0], np.int32)
        self.code = np.full(0x110000, -1, np.int32)
        for c in chars:
            self.code[ord(c)] = self.symbol[c]
        self.names = {i: p for p, i in self.symbol.items()}
        beside = {ord(a) << 21 | ord(b) for p, _ in ordinary for a, b in zip(p, p[1:])}
        self.beside = np.array([*sorted(beside), -1], np.int64)
        by_space = all(SPACE not in p.lstrip(SPACE) for p, _ in ordinary)
        self.cuts = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if by_space else "(?s:.+)")
        self.kept: dict[str, bytes] = {}
        self.differing: set[str] = set()      # cuts whose ids aren't the library's
        surface = [b"" if lib.is_control(i) else lib.decode([i]).encode() if lib.is_unknown(i)
                   else bytes([self.byte_id.index(i)]) if special[i]
                   else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.length = np.array([len(x) for x in surface], np.int32)
        self.begin = np.cumsum(self.length, dtype=np.int32) - self.length
        self.control = np.array([lib.is_control(i) for i in range(n)])
        self.spaced = np.array([p.startswith(SPACE) and not special[i] for i, p in enumerate(names)])

    def _merged(self, text: str) -> list[int]:
        """Symbols of one cut after all merges; characters that are none are -1."""
        symbols = [self.symbol.get(c, -1) for c in text]
        n = len(symbols)
        if n == 1:
            return symbols
        pair, rank = self.pair, self.rank
        made = [pair.get(a * BASE + b, -1) for a, b in zip(symbols, symbols[1:])]
        made.append(-1)
        agenda = [rank[m] * n + i for i, m in enumerate(made) if m >= 0]
        if not agenda:
            return symbols
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        symbols, made, after, before = (array("q", x) for x in (symbols, made, after, before))
        heapify(agenda)
        while agenda:
            r, i = divmod(heappop(agenda), n)
            m = made[i]
            if m < 0 or rank[m] != r:
                continue                                  # stale
            gone = after[i]
            k = after[gone]
            symbols[i], after[i], made[gone] = m, k, -1
            new = -1
            if k < n:
                before[k] = i
                new = pair.get(m * BASE + symbols[k], -1)
                if new >= 0:
                    heappush(agenda, rank[new] * n + i)
            made[i] = new
            p = before[i]
            if p >= 0:
                new = made[p] = pair.get(symbols[p] * BASE + m, -1)
                if new >= 0:
                    heappush(agenda, rank[new] * n + p)
        out, i = [], 0
        while i < n:
            out.append(symbols[i])
            i = after[i]
        return out

    def _ids(self, cut: str, symbols: list[int]) -> bytes:
        """Ids of a cut; a symbol that is no piece is one character, written as bytes."""
        out, at = array("i"), 0
        for s in symbols:
            if 0 <= s < self.n:
                out.append(s)
                at += len(self.names[s])
            else:
                out.extend(self.byte_id[b] for b in cut[at].encode())
                at += 1
        return out.tobytes()

    def _paired(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols make, -1 for none."""
        key = left.astype(np.int64) * BASE + right
        at = np.searchsorted(self.keys[:-1], key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.made[at], np.int32(-1))

    def _rows(self, cuts: list[str], width: int) -> list[bytes]:
        """Ids of cuts of at most ``width`` characters: an agenda a row."""
        none = np.iinfo(np.int32).max
        code = np.frombuffer("".join(c.ljust(width, "\0") for c in cuts).encode("utf-32-le"), "<u4").reshape(-1, width)
        length = np.fromiter(map(len, cuts), np.int64, len(cuts))
        symbols = np.where(np.arange(width) < length[:, None], self.code[code], np.int32(-1))
        last = np.full((len(cuts), 1), -1, np.int32)
        made = np.hstack([self._paired(symbols[:, :-1], symbols[:, 1:]), last])
        agenda = np.where(made >= 0, self.order[made], np.int32(none))
        live = np.arange(len(cuts))
        done_symbols, done_length = np.empty_like(symbols), length.copy()
        place = np.arange(width)
        while len(live):
            first = agenda.argmin(axis=1)
            row = np.arange(len(live))
            open_ = agenda[row, first] < none
            if not open_.all():
                done_symbols[live[~open_]] = symbols[~open_]
                live, symbols, made, agenda, first = (x[open_] for x in (live, symbols, made, agenda, first))
                row = row[:len(live)]
                if not len(live):
                    break
            new = made[row, first]
            moved = np.minimum(place + (place > first[:, None]), width - 1)      # the right symbol goes
            symbols, made, agenda = (np.take_along_axis(x, moved, axis=1) for x in (symbols, made, agenda))
            symbols[row, first] = new
            symbols[:, -1], made[:, -1], agenda[:, -1] = -1, -1, none
            done_length[live] -= 1
            for at in (first - 1, first):
                ok = (at >= 0) & (at < width - 1)
                r, p = row[ok], at[ok]
                made[r, p] = m = self._paired(symbols[r, p], symbols[r, p + 1])
                agenda[r, p] = np.where(m >= 0, self.order[m], np.int32(none))
        used = place < done_length[:, None]
        packed = done_symbols[used].astype("<i4").tobytes()
        ends = (np.cumsum(done_length) * 4).tolist()
        out = [packed[a:b] for a, b in zip([0, *ends], ends)]
        for k in np.flatnonzero((used & ((done_symbols < 0) | (done_symbols >= self.n))).any(axis=1)):
            out[k] = self._ids(cuts[k], done_symbols[k, :done_length[k]].tolist())
        return out

    def _cut(self, text: str) -> list[str]:
        """Cuts of a text; each starts with U+2581."""
        return self.cuts.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def _parts(self, cut: str) -> list[str]:
        """A cut in parts, between characters that are neighbours in no piece."""
        code = np.frombuffer(cut.encode("utf-32-le"), "<u4").astype(np.int64)
        both = code[:-1] << 21 | code[1:]
        at = np.searchsorted(self.beside[:-1], both)
        bounds = [0, *(np.flatnonzero(self.beside[at] != both) + 1).tolist(), len(cut)]
        return [cut[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str], check: bool = False) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; with ``check`` new
        cuts that the library encodes otherwise go to ``differing``."""
        out: list[bytes] = []
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(self._cut(text))
            size += len(text)
            if size > RUN:
                out += self._encoded(held, check)
                held, size = [], 0
        return out + self._encoded(held, check)

    def _check(self, cuts: list[str]) -> None:
        """A cut is the text behind its first U+2581, which the library puts in front."""
        for cut, ids in zip(cuts, self.lib.encode([c[1:] for c in cuts], num_threads=1)):
            if array("i", ids).tobytes() != self.kept[cut]:
                self.differing.add(cut)

    def _encoded(self, held: list[list[str]], check: bool) -> list[bytes]:
        known = self.kept
        fresh = list(set().union(*held).difference(known))
        parted = {c: self._parts(c) for c in fresh if len(c) > SHORT}
        todo = set(fresh).difference(parted).union(*parted.values()).difference(known)
        by_width: dict[int, list[str]] = {}
        for cut in todo:
            by_width.setdefault(WIDTH_OF[len(cut)] if len(cut) <= SHORT else 0, []).append(cut)
        for width, cuts in by_width.items():
            if width:
                known.update(zip(cuts, self._rows(cuts, width)))
            else:
                known.update((c, self._ids(c, self._merged(c))) for c in cuts)
        known.update((c, b"".join(map(known.__getitem__, parts))) for c, parts in parted.items())
        if check:
            self._check([c for c in fresh if c != SPACE])
        out = [b"".join(map(known.__getitem__, cuts)) for cuts in held]
        for cut in (*parted, *(c for c in todo if len(c) > SHORT)):
            known.pop(cut, None)
        over = len(known) - CACHE_ENTRIES
        if over > 0:                                  # the earlier ones stay: frequent cuts come early
            for cut in list(known)[-over:]:
                del known[cut]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """As the library decodes: one U+2581 in front of the first piece goes."""
        out = []
        for at in range(0, len(ids), RUN):
            some = ids[at:at + RUN]
            length = self.length[some]
            ends = np.cumsum(length)
            place = np.repeat(self.begin[some] - (ends - length), length)
            place += np.arange(len(place))
            out.append(self.surface[place].tobytes())
        data = b"".join(out)
        first = ids[:1] if len(ids) and not self.control[ids[0]] else ids[~self.control[ids]][:1]
        return data[int(self.spaced[first].any()):].decode("utf-8", "reviewlake-each-byte")

    def agrees(self, text: str, ids: bytes, check: bool | str) -> bool | None:
        """Whether the library agrees: on all cuts of the text, on the whole text,
        or null if it wasn't asked."""
        if check == "whole":
            return self.lib.encode(text) == np.frombuffer(ids, "<i4").tolist()
        return self.differing.isdisjoint(self._cut(text) if self.differing else ()) if check else None


_LOADED: dict[int, Pieces] = {}


def pieces_of(model: bytes) -> Pieces:
    """One set of tables per Python worker and vocabulary."""
    key = hash(model)
    if key not in _LOADED:
        _LOADED[key] = Pieces(model)
    return _LOADED[key]


def _slices(texts: pa.Array) -> Iterator[list[str]]:
    """The texts of a batch, about ``RUN`` bytes at a time."""
    size = pc.coalesce(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).cumsum()
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + RUN)))
        yield [t or "" for t in texts.slice(at, to - at).to_pylist()]
        at = to


def encoded_pieces(text: Column, model: bytes, check: bool | str = False) -> Column:
    """struct<ids, decoded, agrees>: ids of ``text``, what they decode to and,
    with ``check``, whether the library gives the same ids (null without)."""

    @F.arrow_udf("ids array<int>, decoded string, agrees boolean")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = pieces_of(model)
        for batch in parts:
            for texts in _slices(batch):
                ids = own.encode(texts, bool(check))
                ends = np.cumsum([0] + [len(x) // 4 for x in ids], dtype=np.int32)
                yield pa.StructArray.from_arrays([
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4"))),
                    pa.array([own.decode(np.frombuffer(x, "<i4")) for x in ids], pa.string()),
                    pa.array([own.agrees(t, x, check) for t, x in zip(texts, ids)], pa.bool_())], ["ids", "decoded", "agrees"])

    return run.asNondeterministic()(text)


def decoded_pieces(ids: Column, model: bytes) -> Column:
    """The text that an array of ids decodes to; null ids stay null."""

    @F.arrow_udf("string")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = pieces_of(model)
        for batch in parts:
            yield pa.array([None if x is None else own.decode(np.asarray(x, np.int64)) for x in batch.to_pylist()], pa.string())

    return run(ids)


def public_model(name: str = VOCABULARY) -> bytes:
    import public_tokenizers
    return read_model(public_tokenizers.path(name))


def piece_digests(docs: DataFrame, model: bytes, check: bool | str = True) -> DataFrame:
    """doc_id, n_tokens, the digests of the ids and of the decoded text, and
    whether the library agrees."""
    rows = docs.select("doc_id", encoded_pieces(F.col("text"), model, check).alias("coded"))
    decimal = F.concat_ws(",", F.col("coded.ids").cast("array<string>"))
    return rows.select("doc_id", F.size("coded.ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"),
                       F.sha2("coded.decoded", 256).alias("decoded_sha256"), F.col("coded.agrees").alias("agrees"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), public_model())
