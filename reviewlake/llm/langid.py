"""Operator 7: language ID by string kernels.

Kernel: blended-spectrum presence. G(x) is the set of the letter n-grams of 1
to ``MAX_N`` characters of a text (lower case, everything that is not a letter
read as one space), hashed into ``CELLS`` cells; k(x, y) = |G(x) & G(y)| /
sqrt(|G(x)| |G(y)|). ``LANDMARKS`` training texts, dealt over the languages,
span the Nyström approximation phi(x) = k(x, L) K_LL^(-1/2); one ridge
regression per language (one against the rest, targets -1 and 1) is fitted on
phi. Scoring a batch is presence x (landmarks x coefficients): the second
product is made once when fitting, so a batch costs one sparse product.

Whether the language found claims a text is another question, as the outputs
of all languages sum to a constant: it does if the text's n-grams are
familiar. Familiarity is the share of G(x) seen in the training texts, plus
``SHORT`` / sqrt(|G(x)|) for chance in short texts. A language's limit is
``CLAIM`` times the lowest thousandth of its training texts' familiarity, each
measured against the other texts only; it doesn't depend on the number of
languages.

The fit uses at most about ``TRAIN_ROWS`` distinct texts (the parameter),
equally from each language, chosen by hash; all texts are scored whole.

Defined results: null texts and texts without a letter get ``und`` and score
0 and aren't claimed; without any training row every text does; equal scores go to the smaller
language by code point; rows are scored by their text alone, so repeated rows
agree; an empty table gives an empty table.
"""

from __future__ import annotations

import io
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import col, crc_of, few_at_once, fitted, hash_fraction, packed, row_key, slices, tidied, unpacked, written
from reviewlake.session import table

MAX_N = 3
CELLS = 1 << 16
TRAIN_ROWS = 4000
LANDMARKS = 256
RIDGE = 1e-2
UNKNOWN = "und"
CLAIM = 0.8         # of the familiarity of the least familiar training texts
SHORT = 0.5         # standard deviation of one n-gram's being seen

_LETTERS: list[np.ndarray] = []


def _lower_letters() -> np.ndarray:
    """Lower case of each code point that is a letter, 0 for the others."""
    if not _LETTERS:
        low = np.zeros(0x110000, np.uint32)
        for c in range(0x32000):
            if unicodedata.category(ch := chr(c))[0] == "L":
                low[c] = ord(ch.lower()[0])
        _LETTERS.append(low)
    return _LETTERS[0]


class Spectrum:
    """G(x) of one text after the other."""

    def __init__(self):
        self.letters = _lower_letters()
        self.seen = np.zeros(CELLS, bool)

    def of(self, text: str | None) -> np.ndarray:
        """Sorted cells of the text's n-grams; empty if it has no letter."""
        low = self.letters[np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)]
        letter = low > 0
        if not letter.any():
            return np.zeros(0, np.int64)
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        low = low[keep]
        c = np.concatenate(([0], low if low[-1] else low[:-1], [0])).astype(np.uint32) + np.uint32(1)
        h = np.zeros(len(c), np.uint32)
        for n in range(1, MAX_N + 1):
            h = h[:len(c) - n + 1] * np.uint32(0x01000193) + c[n - 1:]
            self.seen[((h + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(16)] = True
        cells = np.flatnonzero(self.seen)
        self.seen[cells] = False
        return cells


def _spectra(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    spectrum = Spectrum()
    for rows in parts:
        yield pd.DataFrame({"lang": rows["lang"], "order": rows["order"],
                            "cells": [spectrum.of(t).astype("<u4").tobytes() for t in rows["text"]]})


def _familiarity(shared: np.ndarray, size: np.ndarray) -> np.ndarray:
    return shared / size + SHORT / np.sqrt(size)


def fit(rows: pd.DataFrame) -> bytes:
    """(languages, weights per cell and language, bias, cells seen, limit per
    language) of a sample of spectra."""
    rows = rows[rows["cells"].str.len() > 0].sort_values(["order", "lang"], kind="stable").reset_index(drop=True)
    if rows.empty:
        return b""
    cells = [np.frombuffer(b, "<u4").astype(np.int64) for b in rows["cells"]]
    langs = sorted(rows["lang"].unique())
    of = rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
    turn = rows.groupby("lang").cumcount().to_numpy()
    marks = np.lexsort((of, turn))[:LANDMARKS]
    base = np.zeros((CELLS, len(marks)), np.float32)
    for k, i in enumerate(marks):
        base[cells[i], k] = 1 / np.sqrt(len(cells[i]))
    kernel = np.stack([base[c].sum(0) / np.sqrt(len(c)) for c in cells]).astype(float)
    values, vectors = np.linalg.eigh(kernel[marks])
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    phi = np.hstack([kernel @ root, np.ones((len(cells), 1))])
    target = np.where(of[:, None] == np.arange(len(langs)), 1.0, -1.0)
    penalty = RIDGE * len(cells) / 100 * np.eye(phi.shape[1])
    penalty[-1, -1] = 0
    ridge = np.linalg.solve(phi.T @ phi + penalty, phi.T @ target)
    texts = np.bincount(np.concatenate(cells), minlength=CELLS)
    familiar = _familiarity(np.array([(texts[c] > 1).sum() for c in cells]), np.array(list(map(len, cells))))
    limits = [CLAIM * np.quantile(familiar[of == i], 0.001) for i in range(len(langs))]
    out = io.BytesIO()
    np.savez(out, langs=np.array(langs, dtype=np.str_), bias=ridge[-1], seen=texts > 0, limits=np.array(limits),
             weights=(base @ (root @ ridge[:-1]).astype(np.float32)))
    return out.getvalue()


def train(docs: DataFrame, rows: int = TRAIN_ROWS, text: str = "text", lang: str = "lang") -> bytes:
    """Model of the rows of ``docs`` that have a language, equally from each."""
    known = docs.where(col(lang).isNotNull() & col(text).isNotNull()).select(col(lang).alias("lang"), col(text).alias("text"))
    known = known.withColumn("h", F.xxhash64("text"))
    counts = written(known.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang-counts")
    each = rows / max(1, counts.count())
    order = hash_fraction(F.col("text"))
    chosen = (known.join(counts, "lang").withColumn("order", order)
              .where(F.col("order") * F.col("n") < F.lit(each)).select("lang", "order", "text", "h")
              .dropDuplicates(["lang", "h"]))
    with few_at_once(docs.sparkSession):
        return fitted(chosen.mapInPandas(lambda parts: tidied(_spectra(parts)), "lang string, order double, cells binary"), fit)


def _found(parts: Iterator[pd.Series], model: bytes) -> Iterator[pd.DataFrame]:
    """(lang, score, claimed) of each text; a slice's spectra are held at a time."""
    spectrum = Spectrum()
    if model:
        got = np.load(io.BytesIO(model), allow_pickle=False)
        langs, weights, bias, seen, limits = (got[k] for k in ("langs", "weights", "bias", "seen", "limits"))
    for texts in slices(parts):
        lang, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        claimed = np.zeros(len(texts), bool)
        cells = [spectrum.of(t) if model else np.zeros(0, np.int64) for t in texts]
        sizes = np.array(list(map(len, cells)), dtype=np.int64)
        full = np.flatnonzero(sizes)
        for some in np.array_split(full, max(1, int(sizes.sum()) >> 18)):
            if len(some):
                starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
                all_cells = np.concatenate([cells[i] for i in some])
                f = np.add.reduceat(weights[all_cells], starts, axis=0)
                f = f / np.sqrt(sizes[some])[:, None] + bias
                best = f.argmax(1)
                lang[some] = langs[best]
                score[some] = np.clip((f[np.arange(len(some)), best] + 1) / 2, 0, 1)
                shared = np.add.reduceat(seen[all_cells], starts, dtype=np.int64)
                claimed[some] = _familiarity(shared, sizes[some]) >= limits[best]
        yield pd.DataFrame({"lang": lang, "score": score, "claimed": claimed})


def predicted(text: Column, model: bytes) -> Column:
    """struct<lang, score, claimed> of each whole text."""

    @F.pandas_udf("lang string, score double, claimed boolean")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from tidied(_found(parts, model))

    return predict.asNondeterministic()(text)  # so that no filter repeats it


def learnable(docs: DataFrame) -> DataFrame:
    """The documents that a prediction may be learned from."""
    return docs.where(crc_of(F.col("doc_id")) % 3 != 1)


def known_language(docs: DataFrame) -> DataFrame:
    """``docs`` without those that no learned language claims. Only the keys of
    those that go are written, and texts pass to Python few at a time meanwhile."""
    model = train(learnable(docs))
    key = row_key(col("doc_id"), col("text"))
    with few_at_once(docs.sparkSession):
        found = docs.select(key.alias("key"), predicted(col("text"), model).alias("found"))
        gone = written(found.where(~F.col("found.claimed")).select("key").distinct(), "unclaimed")
    return packed(docs, key=key).join(gone, "key", "left_anti").select(*unpacked(docs.columns))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(learnable(docs))
    return docs.select("doc_id", (crc_of(F.col("doc_id")) % 3 == 1).alias("held_out"),
                       predicted(F.col("text"), model).alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
