"""Hard-negative mining against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.llm import hard_negatives as hn

SCHEMA = "id long, label int, vector array<double>, uid string, slot int"


def brute(rows, every=3, n_positives=5, k=10, low=30, high=90):
    ok = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, lab, v) in enumerate(ok):
        if i % every:
            continue
        score = [(-sum(x * y for x, y in zip(v, w)), j, m != lab) for b, (j, m, w) in enumerate(ok) if b != a]
        for minus, p, _ in sorted(x for x in score if not x[2])[:n_positives]:
            negatives = sorted(x for x in score if x[2] and low * -minus <= 100 * -x[0] <= high * -minus)[:k]
            out += [(i, p, r, j, -minus, -s) for r, (s, j, _) in enumerate(negatives, 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hn.hard_negatives(df, F.col("id") % 3 == 0, **kw).collect())


def vectors(n, seed, spread, labels=3, dup=False):
    rng = random.Random(seed)
    return [(rng.randrange(n // 2) if dup else i, rng.randrange(labels), [rng.choice(spread) for _ in range(6)]) for i in range(n)]


@pytest.mark.parametrize("rows", [
    vectors(150, 1, [0.1, 0.2, 0.3]),                       # ties everywhere
    vectors(150, 2, [-1.0, -0.5, 0.0, 0.25, 0.5, 1.0, 1.5]),      # negative and zero scores
    vectors(120, 3, [0.1, 0.4, 0.9], dup=True),             # ids shared by rows
], ids=["ties", "signs", "shared-ids"])
def test_brute_force(spark, monkeypatch, rows):
    for name, value in (("ANCHORS", 16), ("ROWS", 40), ("CHUNK", 7), ("STRIP", 5)):
        monkeypatch.setattr(hn, name, value)
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows, n_positives=2, k=3, low=0, high=100) == brute(rows, n_positives=2, k=3, low=0, high=100)


def test_odd_rows(spark):
    wide = [1.0] * 300_000
    rows = [(0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.5]), (2, 2, [0.5, 0.5]), (3, 2, [0.5, 0.5, 9.0]), (6, None, [1.0, 1.0]), (9, 1, None),
            (12, 1, [1.0, None]), (15, 1, [float("nan"), 1.0]), (18, 1, [float("inf"), 1.0]), (None, 1, [1.0, 1.0]), (21, 1, []),
            (24, 5, [1.0]), (27, 1, wide), (30, 2, wide), (2, 2, [0.5, 0.5]), (2, 2, [0.5, 0.5])]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == []


def test_large_numbers_stay_exact():
    x = np.array([[2 ** 30, 1]], np.int64)
    import pandas as pd
    anchors = pd.DataFrame({"uid": [1], "label": [1], "v": list(x), "limits": [[hn.ALL]], "floor": [-hn.ALL]})
    rows = pd.DataFrame({"uid": [2, 3], "label": [1, 1], "id": [2, 3], "v": [x[0], x[0] + [0, 1]]})
    tile = hn._Tile(anchors, 2, True)
    tile.add(rows)
    assert sorted(tile.found()["score"]) == [2 ** 60 + 1, 2 ** 60 + 2]


def test_wide_vectors_come_in_small_matrices():
    import pandas as pd
    v = pd.Series([np.ones(n, np.int64) for n in (1, 2, 3, 1000, 2 ** 20, 2 ** 20)])
    got = list(hn._matrices(v, 4))
    assert [s.start for s, _ in got] == [0, *[s.stop for s, _ in got][:-1]] and got[-1][0].stop == 6
    assert all(m.size <= 2 * hn.AREA for _, m in got)
