"""Operator 3: toxicity by multiple-instance learning.

A document is a bag of sentences (ended by a line feed, ".", "!" or "?"). A
sentence has z = bias + sum of the weights of its hashed words and word
beginnings and the probability s = 1 / (1 + exp(-z)); a bag has the noisy-or
1 - prod(1 - s). Only documents are labelled: the fit maximises the
likelihood of their labels through the noisy-or, so it finds by itself which
sentences make a document toxic, and the same s locates them.

A document's score is that noisy-or, 1 - exp(-E), where E sums the evidence
-log(1 - s) of its distinct sentences (by their words) over that of a sentence
without telling words. A long clean text would add up chance evidence, so E
leaves out what the text's clean sentences have by chance: their number times
the mean, and ``SPREAD`` standard deviations, of clean documents' sentences in
the fit. Clean are all sentences but those strong ones that exceed what chance
gives: a strong sentence has more evidence than mean and ``SPREAD`` deviations,
and as large a share of them as in clean documents, and ``SPREAD`` deviations of
that number, is chance. E is never below the evidence of the strongest sentence.

The fit uses labelled rows chosen by hash, at most about ``TRAIN_ROWS`` rows
and ``TRAIN_CHARS`` characters in all; a text's length doesn't decide whether
it is chosen, and none is cut. Every text is scored whole.

Defined results: null and empty texts have no sentence and score 0; without
toxic and other labels every text scores 0; a null label is no label; of
several labels of one doc_id the highest counts; repeated rows score alike;
an empty table gives an empty table.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import crc_of, fitted, hash_fraction
from reviewlake.llm.hashed_text import _STOP, BITS, Chunk, Hasher, cells
from reviewlake.session import table

TRAIN_ROWS = 8000
TRAIN_CHARS = 16_000_000  # of all rows of the fit together
BEGINNINGS = (4, 5, 7)   # bytes of a word's beginning that are features of their own
STEPS = 60
LEARNING_RATE = 0.3
PENALTY = 1e-4
SPREAD = 2.0             # standard deviations that the evidence of clean sentences may reach by chance
MIN_Z = 3.0              # standard deviations between a feature's toxic documents and those expected by chance


def _features(hasher: Hasher, chunk: Chunk) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Cells of each word (one array per kind), its sentence, each sentence's
    document and the hash of its words in order."""
    running = hasher.running(chunk.data)
    words = hasher.spans(running, chunk.starts, chunk.ends)
    kinds = [cells(words, 0)]
    for n in BEGINNINGS:
        kinds.append(cells(hasher.spans(running, chunk.starts, np.minimum(chunk.starts + n, chunk.ends)), n))
    stops = np.cumsum(_STOP[chunk.raw], dtype=np.int32)[chunk.starts]
    new = np.ones(len(stops), bool)
    new[1:] = stops[1:] != stops[:-1]
    sentence = np.cumsum(new) - 1
    doc = np.searchsorted(chunk.first, chunk.starts[new], side="right") - 1
    place = np.arange(len(sentence)) - np.flatnonzero(new)[sentence] if len(sentence) else sentence
    mixed = (words ^ (words >> np.uint64(31))) * (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD6E8FEB86659FD93) | np.uint64(1))
    same = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), np.flatnonzero(new)) if len(sentence) else words
    return kinds, sentence, doc, same


def _evidence(z: np.ndarray, doc: np.ndarray, same: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct sentence of a document (by its words) the document and
    its evidence over that of a sentence without telling words."""
    order = np.lexsort((same, doc))
    new = np.ones(len(z), bool)
    new[1:] = (same[order][1:] != same[order][:-1]) | (np.diff(doc[order]) != 0)
    some = order[new]
    return doc[some], np.maximum(0, np.logaddexp(0, z[some]) - np.logaddexp(0, bias))


def _noisy_or(of: np.ndarray, over: np.ndarray, docs: int, clean: np.ndarray) -> np.ndarray:
    """E of each of ``docs`` documents from their distinct sentences; ``clean``: mean,
    deviation, limit of strong sentences and their share in clean documents."""
    mean, deviation, limit, share = clean
    n = np.bincount(of, minlength=docs)
    strong = np.bincount(of, weights=over > limit, minlength=docs)
    toxic = np.maximum(0, strong - share * n - SPREAD * np.sqrt(share * n))
    by_chance = mean * (n - toxic) + SPREAD * deviation * np.sqrt(n - toxic)
    return np.bincount(of, weights=over, minlength=docs) - by_chance


def fit(rows: pd.DataFrame) -> bytes:
    """Weights, bias and the evidence of a clean sentence, and bias from texts with labels."""
    rows = rows.sort_values(["order", "text", "toxic"], kind="stable").drop_duplicates("text", keep="last")
    label = rows["toxic"].to_numpy(np.float64)
    if not 0 < label.sum() < len(label):
        return b""
    hasher, feature, sentence, doc, same = Hasher(), [], [], [], []
    n_sentences = 0
    for chunk in hasher.chunks(rows["text"].tolist()):
        kinds, of, in_doc, words = _features(hasher, chunk)
        same.append(words)
        feature.append(np.concatenate(kinds))
        sentence.append(np.tile(of + n_sentences, len(kinds)))
        doc.append(in_doc + chunk.docs.start)
        n_sentences += len(in_doc)
    feature, sentence, doc, same = map(np.concatenate, (feature, sentence, doc, same))
    both = np.unique(feature * len(label) + doc[sentence])              # a feature counts once per document
    cell, bag = both // len(label), both % len(label)
    toxic = np.bincount(cell, weights=label[bag], minlength=1 << BITS)
    expected = np.bincount(cell, minlength=1 << BITS) * label.mean()
    telling = np.abs(toxic - expected) / np.sqrt(expected + 1) >= MIN_Z
    common = telling[feature]
    used, feature = np.unique(feature[common], return_inverse=True)
    sentence = sentence[common]
    w, bias = np.zeros(len(used)), -4.0
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(sentence, weights=w[feature], minlength=n_sentences)
        s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        off = np.bincount(doc, weights=np.logaddexp(0, z), minlength=len(label))   # -log of the chance of no toxic sentence
        pull = np.where(label > 0, -1 / np.expm1(np.clip(off, 1e-9, 50)), 1.0)
        g = s * pull[doc] / len(label)
        gw = np.bincount(feature, weights=g[sentence], minlength=len(used)) + PENALTY * w
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * g.sum(), 0.99 * vb + 0.01 * g.sum() ** 2
        rate = LEARNING_RATE * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
        w -= rate * m / (np.sqrt(v) + 1e-5)
        bias -= rate * mb / (np.sqrt(vb) + 1e-5)
    z = bias + np.bincount(sentence, weights=w[feature], minlength=n_sentences)
    of, over = _evidence(z, doc, same, bias)
    over = over[label[of] == 0]
    if not len(over):
        over = np.zeros(1)
    limit = over.mean() + SPREAD * over.std()
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = w
    out = io.BytesIO()
    np.savez_compressed(out, weights=weights, bias=bias, clean=[over.mean(), over.std(), limit, (over > limit).mean()])
    return out.getvalue()


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> bytes:
    """Model of the labelled rows of ``docs``; ids only join the labels."""
    marked = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    n, size = texts.select("doc_id", F.length("text").alias("size")).join(marked.select("doc_id"), "doc_id") \
        .agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    share = min(1.0, rows / max(1, n), chars / max(1, size))
    chosen = marked.where(hash_fraction(F.col("doc_id"), F.lit("toxicity")) < share)
    return fitted(texts.join(chosen, "doc_id").select(hash_fraction(F.col("text")).alias("order"), "text", "toxic"), fit)


def scored(text: Column, model: bytes, locate: float | None = None) -> Column:
    """struct<score, offending>: the score of each whole text and, if
    ``locate`` is given, the sentences (character positions) of at least that
    probability."""

    @F.pandas_udf("score double, offending array<struct<start:int,end:int,p:double>>")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        if model:
            got = np.load(io.BytesIO(model), allow_pickle=False)
            weights, bias, clean = got["weights"].astype(np.float64), float(got["bias"]), got["clean"]
        for texts in parts:
            out = np.zeros(len(texts))
            found: list[list[dict]] = [[] for _ in range(len(texts))]
            for chunk in hasher.chunks(texts.tolist()) if model else ():
                kinds, sentence, doc, same = _features(hasher, chunk)
                if not len(doc):
                    continue
                z = bias + np.bincount(sentence, weights=sum(weights[k] for k in kinds))
                off = _noisy_or(*_evidence(z, doc, same, bias), len(chunk.docs), clean)
                np.maximum.at(off, doc, np.logaddexp(0, z))
                out[chunk.docs.start:chunk.docs.stop] = -np.expm1(-np.maximum(off, 0))
                if locate is not None:
                    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                    heads = np.flatnonzero(np.diff(sentence, prepend=-1))
                    tails = np.append(heads[1:], len(sentence)) - 1
                    for k in np.flatnonzero(p >= locate):
                        a, b, d = chunk.starts[heads[k]], chunk.ends[tails[k]], doc[k]
                        before = len(bytes(chunk.raw[chunk.first[d]:a]).decode("utf-8", "replace"))
                        found[chunk.docs.start + d].append(
                            {"start": before, "end": before + len(bytes(chunk.raw[a:b]).decode("utf-8", "replace")), "p": float(p[k])})
            yield pd.DataFrame({"score": np.clip(out, 0, 1), "offending": found})

    return score.asNondeterministic()(text)


def toxicity(docs: DataFrame, labels: DataFrame, learn_from: DataFrame, locate: float | None = 0.5) -> DataFrame:
    """``doc_id``, ``score`` and ``offending`` of every row of ``docs``."""
    model = train(learn_from, labels)
    return docs.select("doc_id", scored(F.col("text"), model, locate).alias("found")).select("doc_id", "found.*")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = crc_of(F.col("doc_id")) % 5 != 0
    found = toxicity(docs, table(spark, sf_dir, "labels").where(learned), docs.where(learned))
    return found.select("doc_id", (crc_of(F.col("doc_id")) % 5 == 0).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"),
                        F.size("offending").alias("n_offending"))
