"""Operator 2: quality by ordinal cumulative-link regression.

Ratings are ordered grades 0, 1, ..., K-1. A text has one latent value
z = mean weight of its hashed features, and P(grade <= k) = sigmoid(t_k - z)
with ordered thresholds t_0 < t_1 < ...: the weights are shared by all grades,
only the thresholds differ (t_k = t_(k-1) + exp(d_k) keeps them in order).
Results: the expected grade, sum over k of P(grade >= k), and the tail
probability P(grade >= ``selected``), by which documents are selected.

Features of each run of characters between white space, hashed into 2^18
cells: its words, its shape (runs of small, capital, digit and other
characters), the characters around words, and whether its word repeats the
one before.

The fit uses at most about ``TRAIN_ROWS`` rated rows of at most
``TRAIN_CHARS`` characters, chosen by hash; every text is scored whole.

Defined results: null texts and texts without a word have z = 0 features and
get the grade that the thresholds alone give; with fewer than two distinct
grades to learn from every text gets that grade (0 without any) and tail 1 or
0; of several ratings of a doc_id the lowest counts, a null rating is none;
repeated rows score alike; an empty table gives an empty table.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import crc_of, fitted, hash_fraction
from reviewlake.llm.hashed_text import BITS, Chunk, Hasher, cells
from reviewlake.session import table

TRAIN_ROWS = 8000
TRAIN_CHARS = 20_000
STEPS = 80
LEARNING_RATE = 0.2
PENALTY = 1e-3
GAIN = 20.0            # features are shares of a text's words; this brings z to a useful scale
SELECTED = 1           # grade from which a document is selected

_CLASS = np.full(256, 4, np.uint8)   # other
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[128:] = 1


def _features(hasher: Hasher, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells, their texts (positions in the chunk) and the words of each text."""
    n_docs = len(chunk.docs)
    running = hasher.running(chunk.data)
    word = hasher.spans(running, chunk.starts, chunk.ends)
    doc = np.searchsorted(chunk.first, chunk.starts, side="right") - 1
    # what stands between two words, with the bytes next to it left out
    gap_from, gap_to = chunk.ends, np.append(chunk.starts[1:], len(chunk.data) - 1)
    gap = hasher.spans(running, gap_from, np.minimum(gap_to, gap_from + 8))
    # shape: classes with runs shortened to at most two, hashed like text
    kind = _CLASS[chunk.raw]
    kept = np.ones(len(kind), bool)
    kept[2:] = (kind[2:] != kind[1:-1]) | (kind[2:] != kind[:-2])
    at = np.cumsum(kept) - kept
    shapes = hasher.running(kind[kept])
    shape = hasher.spans(shapes, at[chunk.starts], at[np.minimum(gap_to, gap_from + 3)])
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    features = np.concatenate([cells(word, 1), cells(gap, 2), cells(shape, 3),
                               cells(again.astype(np.uint64), 4)])
    return features, np.tile(doc, 4), np.maximum(1, np.bincount(doc, minlength=n_docs))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: pd.DataFrame) -> bytes:
    """Shared weights and ordered thresholds from texts with grades."""
    rows = rows.sort_values(["order", "text", "grade"], kind="stable").drop_duplicates("text")
    grades = np.array(sorted(rows["grade"].unique()), np.int64)
    out = io.BytesIO()
    if len(grades) < 2:
        np.savez_compressed(out, weights=np.zeros(1 << BITS, np.float32), thresholds=np.zeros(0),
                            grades=grades if len(grades) else np.zeros(1, np.int64))
        return out.getvalue()
    y = np.searchsorted(grades, rows["grade"].to_numpy())
    hasher, feature, doc, words = Hasher(), [], [], []
    for chunk in hasher.chunks(rows["text"].tolist()):
        f, d, n = _features(hasher, chunk)
        feature.append(f)
        doc.append(d + chunk.docs.start)
        words.append(n)
    feature, doc, words = map(np.concatenate, (feature, doc, words))
    both, count = np.unique(feature * len(y) + doc, return_counts=True)
    spread = np.bincount(both // len(y), minlength=1 << BITS)
    common = spread[both // len(y)] >= 5
    used, feature = np.unique(both[common] // len(y), return_inverse=True)
    doc = both[common] % len(y)
    value = GAIN * count[common] / words[doc]
    share = np.bincount(y, minlength=len(grades)) / len(y)
    start = np.log(np.cumsum(share)[:-1] / (1 - np.cumsum(share)[:-1]))
    w, steps_up = np.zeros(len(used)), np.concatenate(([start[0]], np.log(np.maximum(1e-3, np.diff(start)))))
    m = v = mt = vt = 0.0
    for step in range(1, STEPS + 1):
        t = np.cumsum(np.concatenate((steps_up[:1], np.exp(steps_up[1:]))))
        z = np.bincount(doc, weights=w[feature] * value, minlength=len(y))
        ends = np.concatenate(([-np.inf], t, [np.inf]))
        high, low = _sigmoid(ends[y + 1] - z), _sigmoid(ends[y] - z)
        chance = np.maximum(high - low, 1e-9)
        dh, dl = high * (1 - high) / chance, low * (1 - low) / chance     # of log chance by the upper and lower threshold
        gz = (dh - dl) / len(y)
        gw = np.bincount(feature, weights=gz[doc] * value, minlength=len(used)) + PENALTY * w
        by_threshold = np.array([dl[y == k + 1].sum() - dh[y == k].sum() for k in range(len(t))]) / len(y)
        gt = np.cumsum(by_threshold[::-1])[::-1] * np.concatenate(([1.0], np.exp(steps_up[1:])))
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mt, vt = 0.9 * mt + 0.1 * gt, 0.99 * vt + 0.01 * gt * gt
        rate = LEARNING_RATE * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
        w = w - rate * m / (np.sqrt(v) + 1e-4)
        steps_up = steps_up - rate / 2 * mt / (np.sqrt(vt) + 1e-4)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = w
    np.savez_compressed(out, weights=weights, grades=grades,
                        thresholds=np.cumsum(np.concatenate((steps_up[:1], np.exp(steps_up[1:])))))
    return out.getvalue()


def train(docs: DataFrame, ratings: DataFrame, rows: int = TRAIN_ROWS) -> bytes:
    """Model of ``docs`` (doc_id, text) rated by ``ratings`` (doc_id, grade)."""
    rated = ratings.where("grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    n = max(1, rated.count())
    chosen = rated.where(hash_fraction(F.col("doc_id"), F.lit("quality")) * n < rows)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= TRAIN_CHARS))
    return fitted(texts.join(chosen, "doc_id").select(hash_fraction(F.col("text")).alias("order"), "text", "grade"), fit)


def scored(text: Column, model: bytes, selected: int = SELECTED) -> Column:
    """struct<expected, tail> of each whole text."""

    @F.pandas_udf("expected double, tail double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        if model:
            got = np.load(io.BytesIO(model), allow_pickle=False)
            weights, thresholds, grades = got["weights"].astype(np.float64), got["thresholds"], got["grades"]
        else:
            weights, thresholds, grades = np.zeros(1 << BITS), np.zeros(0), np.zeros(1, np.int64)
        for texts in parts:
            z = np.zeros(len(texts))
            for chunk in hasher.chunks(texts.tolist()):
                feature, doc, words = _features(hasher, chunk)
                z[chunk.docs.start:chunk.docs.stop] = GAIN * np.bincount(doc, weights=weights[feature], minlength=len(words)) / words
            above = _sigmoid(z[:, None] - thresholds)      # P(grade >= grades[k + 1])
            expected = grades[0] + above @ np.diff(grades)
            k = int(np.searchsorted(grades, selected))
            tail = np.ones(len(z)) if k == 0 else np.zeros(len(z)) if k == len(grades) else above[:, k - 1]
            yield pd.DataFrame({"expected": expected.astype(np.float64), "tail": tail})

    return score.asNondeterministic()(text)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades from the labels: 0 low quality, 1 good but toxic, 2 good and clean.
    Learned where crc32(doc_id as text) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = crc_of(F.col("doc_id")) % 5 != 0
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) == 1, 1).when(F.col("quality") == 1, 2)
    ratings = table(spark, sf_dir, "labels").where(learned).select("doc_id", grade.alias("grade"))
    model = train(docs.where(learned), ratings)
    found = docs.select("doc_id", scored(F.col("text"), model).alias("found"))
    return found.select("doc_id", (crc_of(F.col("doc_id")) % 5 == 0).alias("held_out"),
                        F.col("found.expected").alias("expected_grade"), F.col("found.tail").alias("tail"),
                        (F.col("found.tail") >= 0.5).alias("keep"))
