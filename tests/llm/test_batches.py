"""Python holds few whole texts at a time."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pandas as pd

from reviewlake.llm import bpe, common, langid
from tests.llm import odd

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _peak(run, texts: pd.Series) -> tuple[int, list[pd.DataFrame]]:
    """Most bytes held beside what has been handed on, and the results."""
    next(run(iter([texts[:10]])))
    out, held, most = [], 0, 0
    tracemalloc.start()
    for got in run(iter([texts])):
        most = max(most, tracemalloc.get_traced_memory()[1] - held)
        out.append(got)
        held = tracemalloc.get_traced_memory()[0]
        tracemalloc.reset_peak()
    tracemalloc.stop()
    return most, out


def test_memory_of_a_large_batch(spark):
    rng = np.random.default_rng(0)
    alphabet = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    texts = pd.Series(["".join(rng.choice(alphabet, 1500)) for _ in range(8000)])
    model = langid.train(odd.documents(spark, [(k, f"{texts[k]} of", "en" if k % 2 else "de", "a", 1) for k in range(40)]))
    most, found = _peak(lambda parts: langid._found(parts, model), texts)
    assert most < 40e6 and max(map(len, found)) <= common.TEXTS and sum(map(len, found)) == 8000     # 8000 spectra are 77 MB
    single = pd.concat(langid._found((texts[k:k + 1] for k in range(0, 8000, 400)), model), ignore_index=True)
    pd.testing.assert_frame_equal(single, pd.concat(found, ignore_index=True)[::400].reset_index(drop=True))
    few = texts[:2500].str[:200]
    coded = list(bpe._coded(iter([few]), *bpe.public_vocabulary()))
    assert list(map(len, coded)) == [1000, 1000, 500]
    assert [bytes(b).decode() for part in coded for b in part["decoded"]] == few.tolist()


def test_known_language_reads_few_texts_at_once(spark, monkeypatch):
    before, seen, written = spark.conf.get(KEY), {}, langid.written
    monkeypatch.setattr(langid, "written", lambda df, name: (seen.update({name: int(spark.conf.get(KEY))}), written(df, name))[1])
    rows = [(k % 30, f"the house and the garden of number {k % 30}", "en", "a", 1) for k in range(40)]
    rows += [(None, "the house", "en", "a", 1), (50, "...", "en", "a", 1), (50, "...", "en", "a", 1), (51, None, "en", "a", 1), (50, "the garden", "en", "a", 1)]
    kept = langid.known_language(odd.documents(spark, rows))
    assert sorted(kept.toPandas()["text"]) == sorted(t for _, t, *_ in rows if t not in (None, "..."))
    assert seen["unclaimed"] <= common.TEXTS and spark.conf.get(KEY) == before


def test_memory_goes_back_after_a_task():
    """What a worker that stays has left of a task: no cache of pre-tokens, and no heap that could go back."""
    def held():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    ranks, pattern = bpe.public_vocabulary()
    list(bpe._coded(iter([pd.Series(["some words and more"])]), ranks, pattern))
    assert not bpe.codec(ranks, pattern).kept

    def work():
        before = held()
        some = [bytes(50_000) + b"x" for _ in range(4000)]      # below what malloc maps on its own
        some[:-1] = []
        yield before, len(some)
        del some

    (before, _), = common.tidied(work())
    assert held() - before < 100e6
