"""Conversation repair against exhaustive search and plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from reviewlake.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, times int, ck string, sha string"
PATTERN = re.compile("(s?(ua)+)?")
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    """(initial, must go, truncated) and counts of rows (turn, role, text) in order."""
    seen, items, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        kind = 3
        if not VISIBLE.search(text):
            kind = 0
        elif (role, text) in seen:
            kind = 1
        elif VISIBLE.findall(text)[-1] not in ".!?":
            kind = 2
        seen.add((role, text))
        if kind < 3:
            counts[kind] += 1
        items.append((role[:1], kind < 2, kind == 2))
    return items, counts


def exhaustive(items):
    """(cost, letters) by trying every row of edits with at most two inserts in a gap."""
    best = [(3 * len(items) + 1, "")]

    def go(at, cost, audit, made, inserts):
        if cost > best[0][0]:
            return
        if at == len(items) and PATTERN.fullmatch(made):
            best[0] = min(best[0], (cost, audit))
        if inserts < 2:
            for c in "ua":
                go(at, cost + 2, audit + "I", made + c, inserts + 1)
        if at < len(items):
            initial, must_go, cut = items[at]
            go(at + 1, cost + 3, audit + "D", made, 0)
            if not must_go:
                if initial:
                    go(at + 1, cost + cut, audit + "K", made + initial, 0)
                for c in "ua":
                    go(at + 1, cost + 2 + cut, audit + "R", made + c, 0)
    go(0, 0, "", "", 0)
    return best[0]


def plain(rows):
    """Result rows of (conv_id, turn, role, text), solved without fragments."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        items, counts = faults(own)
        cost, audit = cv.shortest(items, cv.ENDS)[0]
        turns = {t for t, _, _ in own if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in {"su", "ua", "au"} for a, b in zip(own, own[1:]))
        state, left, at = "", [], 0
        for letter in audit:      # roles of R and I follow from what stands before
            want = "assistant" if state.endswith("u") else "user"
            if letter == "K":
                want = own[at][1]
            if letter != "D":
                left.append(want + ":" + ("" if letter == "I" else own[at][2]))
                state += want[0]
            at += letter != "I"
        assert PATTERN.fullmatch(state) and at == len(own)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit,
                     hashlib.sha256("\n".join(left).encode()).hexdigest())
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "clash", "clash") for r in rows], SCHEMA)


def solved(spark, rows):
    got = cv.repair(frame(spark, rows)).collect()
    out = {r.conv_id: tuple(r)[1:] for r in got}
    assert len(out) == len(got)
    return out


def talk(rng, conv, n, turns=None):
    roles = ["user", "assistant", "system", "tool", "", "user", "assistant"]
    texts = ["Yes.", "no", "Why? ", " ", "", "Done!", "a longer text.", "x" * 30]
    return [(conv, rng.choice(turns) if turns else k, rng.choice(roles), rng.choice(texts) + ("" if rng.random() < .5 else str(rng.randrange(4)) + "."))
            for k in range(n)]


def test_shortest_is_the_least_of_all():
    rng = random.Random(1)
    for _ in range(400):
        items = [(rng.choice("uuaasx"), rng.random() < .2, rng.random() < .3) for _ in range(rng.randint(0, 4))]
        assert cv.shortest(items, cv.ENDS)[0] == exhaustive(items), items


@pytest.mark.parametrize("fragment,fan", [(512, 64), (1, 2), (3, 2)])
def test_fragments_change_nothing(spark, monkeypatch, fragment, fan):
    monkeypatch.setattr(cv, "FRAGMENT", fragment)
    monkeypatch.setattr(cv, "FAN", fan)
    rng = random.Random(fragment)
    rows = [r for c in range(40) for r in talk(rng, c, rng.randint(1, 12))] + talk(rng, 99, 150)
    assert solved(spark, rows) == plain(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(cv, "FRAGMENT", 4)
    rng = random.Random(4)
    long = "lang " * 200_000
    rows = [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (1, None, None, None), (2, 5, "user", "a."), (2, 5, "user", "a."),
            (2, 5, "user", "a."), (3, None, "user", "x"), (3, None, "assistant", "y."), (4, 2 ** 62, "user", long), (4, -2 ** 61, "system", "s."),
            (4, 2 ** 62 - 1, "assistant", long + "."), (5, 1, "usher", "kept by its initial."), (5, 2, "agent", "same  ."),
            (6, 1, "user", "\t\n\x0b\x0c\r "), (7, 1, "user", "a.\x0c"), (7, 2, "assistant", "buff"), (7, 3, "user", "f")]
    rows += talk(rng, 8, 30, [None, 1, 1, 2, 9]) + [(9, 3, "user", "same.")] * 50
    got = solved(spark, rows)
    assert got == plain(rows)
    assert got[2][6] == "KIDD" or got[2][5] == plain(rows)[2][5]
    assert solved(spark, []) == {}


def test_repaired_messages(spark, monkeypatch):
    monkeypatch.setattr(cv, "FRAGMENT", 2)
    rng = random.Random(9)
    rows = [r for c in range(20) for r in talk(rng, c, rng.randint(1, 9))]
    want = solved(spark, rows)
    left = {}
    for r in sorted(cv.repaired_messages(frame(spark, rows)).collect(), key=lambda r: (r.conv_id, r.part, r.seq, r.pos)):
        left.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, row in want.items():
        assert hashlib.sha256("\n".join(left.get(conv, [])).encode()).hexdigest() == row[-1]


def test_query_on_damaged_rows(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text or " ")}.get(kind, text)
        left += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    want = plain(left)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = cv.op11_conversation_repair(spark, sf)
    assert [c for c in got.columns] == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r)[1:] for r in got.collect()} == {c: want.get(c, nothing) for c in {r[0] for r in rows}}
