"""Operator 11: conversation structure repair by a shortest path over whole numbers.

A conversation's rows in order are kept (K), given the role user or assistant
(R), deleted (D), and rows with empty text may be inserted (I), so that the
initials of the roles read ``(s?(ua)+)?``. The cheapest edits win, and among
equally cheap ones those whose letters come first.

One whole number is the weight of a path: its high digits are the cost, below
them stand ``W`` octal digits, the letters of the edits from the first on
(D < I < K < R are 1 to 4) and zeros behind. In front of a path an edit adds its
cost, moves the letters down by one digit and puts its own on top. So the least
number is the cheapest path with the least letters, and an ordinary minimum
over the graph of (rows left, state of the pattern), from the end to the start,
decides everything.

Long conversations. Rows are range-partitioned by conversation and order and
cut into fragments of at most ``FRAGMENT`` rows, so a conversation of a third of
all rows spreads over tasks. A fragment that is a whole conversation is solved
where it is found. Any other one gives the least weight for each pair of
states before and after it; up to ``FAN`` neighbours are joined at a time, level
by level, until one is left. Two paths through the same rows between the same
states never differ only in further letters at the end (these would be inserts,
which cost), so the least of each part makes the least whole. The states chosen
go back down the levels to the fragments, which write their rows; the digest
reads them in order, one row a fragment.

Only a conversation's letters and its digest are made in one place, as the
result has one row a conversation.

Rows of one conversation are ordered by turn (nulls first), then role, then the
MD5 of the text; equal rows are neighbours.

Defined results: a null role or text is one space; a row whose role is empty or
has another initial can't be kept; a null id is a conversation of its own; a
conversation without rows to repair has zeros, no letters and the digest of the
empty string; repeated rows are duplicates of the first; an empty table gives
an empty table; only the four columns are read, so extra ones can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.llm.common import col, written
from reviewlake.session import table

FRAGMENT = 512            # rows solved at once
FAN = 64                  # fragments or nodes joined at once
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_D, _I, _K, _R = 1, 2, 3, 4
_LETTERS = str.maketrans("1234", "DIKR")
_DIGITS = str.maketrans("DIKR", "1234")

# states of the pattern: nothing yet, after s, after u, after a
STATES = 4
ENDS = (0, 3)
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
MADE = (2, 2, 3, 2)       # state after a row whose role is chosen: the only one that fits
NAME = ("user", "user", "assistant", "user")
BREAKS = {"su", "ua", "au"}
SPACES = " \\t\\n\\u000B\\u000C\\r"

STATS = "n long, blank long, duplicate long, truncated long, illegal long, first string, last string, lo string, hi string, turns long"
MATRIX = "array<struct<s:int,t:int,cost:long,audit:string,path:array<int>>>"
NODE = f"ck string, idx long, {STATS}, matrix {MATRIX}"
PART = (f"ck string, part int, seq long, whole boolean, {STATS}, matrix {MATRIX}, roles array<string>, texts array<string>, "
        "sha string")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


class Weights:
    """Whole numbers for paths of at most ``width`` letters."""

    def __init__(self, width: int):
        self.bits = 3 * width
        self.mask = (1 << self.bits) - 1

    def edit(self, letter: int, cost: int) -> int:
        """What an edit in front adds, beside moving the letters down."""
        return (cost << self.bits) + (letter << max(0, self.bits - 3))

    def behind(self, cost: int, audit: str) -> tuple[int, int]:
        """The same for several edits, and how far the letters move."""
        move = 3 * len(audit)
        return (cost << self.bits) + ((int(audit.translate(_DIGITS), 8) if audit else 0) << (self.bits - move)), move

    def read(self, w: int) -> tuple[int, str]:
        """(cost, letters) of a weight."""
        width = self.bits // 3
        return w >> self.bits, format(w & self.mask, "o").zfill(width).rstrip("0").translate(_LETTERS)


def shortest(items: list[tuple[str, bool, bool]], goals: tuple[int, ...]) -> list[tuple[int, str] | None]:
    """For each state before the rows (cost, letters) of the cheapest edits that
    reach one of ``goals``; ``items`` are (initial, must go, truncated)."""
    weights = Weights(4 * len(items) + 3)
    bits, mask, none = weights.bits, weights.mask, 1 << (weights.bits + 62)

    def before(w: int, add: int) -> int:
        low = w & mask
        return (w ^ low) + (low >> 3) + add if w < none else none

    insert, delete = weights.edit(_I, INSERT), weights.edit(_D, DELETE)
    keep = [weights.edit(_K, c) for c in (0, TRUNCATED)]
    rerole = [weights.edit(_R, REROLE + c) for c in (0, TRUNCATED)]

    def inserted(v: list[int]) -> list[int]:
        a, b = min(v[2], before(v[3], insert)), min(v[3], before(v[2], insert))
        x = before(a, insert)
        return [min(v[0], x), min(v[1], x), a, b]

    now = inserted([0 if s in goals else none for s in range(STATES)])
    for initial, must_go, cut in reversed(items):
        new = [before(w, delete) for w in now]
        if not must_go:
            after = NEXT.get(initial, {})
            for s in range(STATES):
                new[s] = min(new[s], before(now[MADE[s]], rerole[cut]))
                if s in after:
                    new[s] = min(new[s], before(now[after[s]], keep[cut]))
        now = inserted(new)
    return [weights.read(w) if w < none else None for w in now]


def rendered(state: int, audit: str, roles: list[str], texts: list[str]) -> list[tuple[str, str]]:
    """(role, text) of the rows that the edits leave, from ``state`` on."""
    out, at = [], 0
    for letter in audit:
        if letter == "I":
            out.append((NAME[state], ""))
            state = MADE[state]
            continue
        if letter == "K":
            out.append((roles[at], texts[at]))
            state = NEXT[roles[at][:1]][state]
        elif letter == "R":
            out.append((NAME[state], texts[at]))
            state = MADE[state]
        at += 1
    return out


def digest(rows: list[tuple[str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows).encode()).hexdigest()


class _Fragment:
    def __init__(self):
        self.roles, self.texts, self.items, self.turns = [], [], [], []
        self.blank = self.duplicate = self.truncated = 0

    def add(self, turn: int | None, role: str, text: str, last: str, seen: bool) -> None:
        blank = last == ""
        cut = not blank and not seen and last not in (".", "!", "?")
        self.blank += blank
        self.duplicate += seen and not blank
        self.truncated += cut
        self.roles.append(role)
        self.texts.append(text)
        self.items.append((role[:1], blank or seen, cut))
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    def stats(self) -> dict:
        initials = [i[0] for i in self.items]
        return {"n": len(self.items), "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": sum(a + b not in BREAKS for a, b in zip(initials, initials[1:])),
                "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
                "lo": str(self.turns[0]) if self.turns else None, "hi": str(self.turns[-1]) if self.turns else None, "turns": len(self.turns)}

    def row(self, ck: str, part: int, seq: int, whole: bool, keep: bool) -> dict:
        out = {"ck": ck, "part": part, "seq": seq, "whole": whole, **self.stats(), "roles": None, "texts": None, "sha": None}
        if whole:
            cost, audit = shortest(self.items, ENDS)[0]
            out["matrix"] = [{"s": 0, "t": None, "cost": cost, "audit": audit, "path": None}]
            out["sha"] = digest(rendered(0, audit, self.roles, self.texts))
        else:
            out["matrix"] = [{"s": s, "t": t, "cost": got[0], "audit": got[1], "path": None}
                             for t in range(STATES) for s, got in enumerate(shortest(self.items, (t,))) if got]
        if keep or not whole:
            out["roles"], out["texts"] = self.roles, self.texts
        return out


def _cut(keep: bool):
    """Rows sorted by conversation and order, cut into fragments. A conversation
    is known to be whole if others of the same partition stand around it."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        now, before, seq, open_ = None, None, 0, _Fragment()
        convs = at = 0
        names = _names(PART)
        out: list[dict] = []

        def close(ends: bool) -> None:
            nonlocal open_, seq, at
            out.append(open_.row(now, part, seq, ends and convs > 1 and at == 0, keep))
            open_, seq, at = _Fragment(), seq + 1, at + 1

        for rows in parts:
            for ck, has, turn, role, text, last, h, later, times in zip(*(rows[c] for c in (
                    "ck", "has_turn", "turn", "role", "text", "last", "h", "later", "times"))):
                if ck != now:
                    if now is not None:
                        close(True)
                    now, before, at, convs = ck, None, 0, convs + 1
                for k in range(times):
                    if len(open_.items) == FRAGMENT:
                        close(False)
                    key = (has, turn, role, h)
                    open_.add(int(turn) if has else None, role, text, last, bool(later) or key == before)
                    before = key
            if out:
                yield pd.DataFrame(out, columns=names, dtype=object)
                out = []
        if now is not None:
            close(False)
            yield pd.DataFrame(out, columns=names, dtype=object)
    return run


def _joined(rows: pd.DataFrame) -> pd.DataFrame:
    """Neighbours (ck, up, idx and node columns) joined into one node."""
    rows = rows.sort_values("idx")
    total = {c: int(rows[c].sum()) for c in ("n", "blank", "duplicate", "truncated", "illegal", "turns")}
    full = rows[rows["n"] > 0]
    total["illegal"] += sum(a + b not in BREAKS for a, b in zip(full["last"], full["first"].iloc[1:]))
    dated = rows[rows["turns"] > 0]
    total["turns"] -= int(sum(a == b for a, b in zip(dated["hi"], dated["lo"].iloc[1:])))
    ends = {"first": full["first"].iloc[0] if len(full) else None, "last": full["last"].iloc[-1] if len(full) else None,
            "lo": dated["lo"].iloc[0] if len(dated) else None, "hi": dated["hi"].iloc[-1] if len(dated) else None}
    matrices = [{(e["s"], e["t"]): (int(e["cost"]), e["audit"]) for e in m} for m in rows["matrix"]]
    weights = Weights(sum(max(len(a) for _, a in m.values()) for m in matrices))
    steps = [{st: weights.behind(*edits) for st, edits in m.items()} for m in matrices]
    matrix = []
    for t in range(STATES):
        now: dict[int, tuple[int, tuple]] = {t: (0, (t, None))}
        for step in reversed(steps):
            new: dict[int, tuple[int, tuple]] = {}
            for (s, m), (add, move) in step.items():
                if m in now:
                    w, path = now[m]
                    low = w & weights.mask
                    w = (w ^ low) + (low >> move) + add
                    if s not in new or w < new[s][0]:
                        new[s] = (w, (s, path))
            now = new
        for s, (w, path) in now.items():
            cost, audit = weights.read(w)
            states = []
            while path:
                states.append(path[0])
                path = path[1]
            matrix.append({"s": s, "t": t, "cost": cost, "audit": audit, "path": states})
    return pd.DataFrame([{"ck": rows["ck"].iat[0], "idx": int(rows["up"].iat[0]), **total, **ends, "matrix": matrix}],
                        columns=_names(NODE), dtype=object)


def _written_rows(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fragments with their state and letters: the rows that are left."""
    for part in rows:
        left = [rendered(int(s), a, list(r), list(t)) for s, a, r, t in zip(part["s"], part["audit"], part["roles"], part["texts"])]
        yield part[["ck", "part", "seq"]].assign(messages=[[{"role": r, "text": t} for r, t in x] for x in left])


def _digests(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fragments' rows in order of (ck, part, seq): one digest a conversation, nothing held."""
    now, sha, empty = None, hashlib.sha256(), True
    for part in parts:
        done = []
        for ck, messages in zip(part["ck"], part["messages"]):
            if ck != now:
                if now is not None:
                    done.append((now, sha.hexdigest()))
                now, sha, empty = ck, hashlib.sha256(), True
            for m in messages:
                sha.update((("" if empty else "\n") + f"{m['role']}:{m['text']}").encode())
                empty = False
        yield pd.DataFrame(done, columns=["ck", "sha"])
    if now is not None:
        yield pd.DataFrame([(now, sha.hexdigest())], columns=["ck", "sha"])


def _solved(rows: DataFrame, keep: bool) -> tuple[DataFrame, DataFrame]:
    """Per conversation (ck, stats, cost, audit, sha), and per fragment (ck, part,
    seq, s, audit, roles, texts) for fragments that carry their texts. ``rows``:
    conv_id, turn, role, text, times (0: the row is gone, its conversation stays)."""
    ck = F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n"))
    last = F.expr(f"right(trim(TRAILING '{SPACES}' FROM text), 1)")
    rows = rows.select(ck.alias("ck"), F.col("turn").isNotNull().alias("has_turn"),
                       F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "times")
    rows = rows.withColumn("last", last).withColumn("h", F.md5(F.col("text").cast("binary")))
    at = F.struct("has_turn", "turn")
    # texts that come back at a later turn; copies at the same turn are neighbours
    again = written(rows.where("times > 0 AND last <> ''").groupBy("ck", "role", "h")
                    .agg(F.min(at).alias("early"), F.max(at).alias("late")).where("early < late").drop("late"), "again")
    rows = rows.join(again, ["ck", "role", "h"], "left").withColumn("later", F.coalesce(at > F.col("early"), F.lit(False))).drop("early")
    order = ["ck", "has_turn", "turn", "role", "h"]
    found = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_cut(keep), PART), "fragments")

    narrow = found.where("NOT whole").drop("whole", "roles", "texts", "sha")
    first = Window.partitionBy("ck").orderBy("part", "seq")
    levels = [written(narrow.withColumn("idx", (F.row_number().over(first) - 1).cast("long")), "level")]
    while (levels[-1].agg(F.max("idx")).first()[0] or 0) > 0:
        up = levels[-1].drop("part", "seq").withColumn("up", F.expr(f"idx div {FAN}"))
        levels.append(written(up.groupBy("ck", "up").applyInPandas(_joined, NODE), "level"))

    best = F.array_min(F.transform(F.filter("matrix", lambda e: (e["s"] == 0) & e["t"].isin(*ENDS)),
                                   lambda e: F.struct(e["cost"].alias("cost"), e["audit"].alias("audit"), e["t"].alias("t"))))
    stats = _names(STATS)
    roots = levels[-1].withColumn("best", best).select("ck", "idx", *stats, F.col("best.cost").alias("cost"),
                                                       F.col("best.audit").alias("audit"), F.col("best.t").alias("t"))
    states = roots.select("ck", "idx", F.lit(0).alias("s"), "t")
    chosen = F.filter("matrix", lambda e: (e["s"] == F.col("s")) & (e["t"] == F.col("t")))[0]
    for level in reversed(levels[1:]):
        path = chosen["path"]
        below = level.select("ck", "idx", "matrix").join(states, ["ck", "idx"]).select("ck", "idx", F.posexplode(F.arrays_zip(
            F.slice(path, 1, F.size(path) - 1).alias("s"), F.slice(path, 2, F.size(path) - 1).alias("t"))).alias("j", "e"))
        states = written(below.select("ck", (F.col("idx") * FAN + F.col("j")).alias("idx"), "e.s", "e.t"), "states")
    leaves = levels[0].join(states, ["ck", "idx"]).select("ck", "part", "seq", "s", chosen["audit"].alias("audit"))
    texts = found.select("ck", "part", "seq", "whole", "roles", "texts")
    leaves = texts.where("NOT whole").drop("whole").join(leaves, ["ck", "part", "seq"])
    messages = _messages(leaves)
    sha = messages.repartition("ck").sortWithinPartitions("ck", "part", "seq").mapInPandas(_digests, "ck string, sha string")
    whole = found.where("whole").select("ck", *stats, F.col("matrix")[0]["cost"].alias("cost"), F.col("matrix")[0]["audit"].alias("audit"), "sha")
    result = whole.unionByName(roots.drop("idx", "t").join(sha, "ck"))
    kept = found.where("whole AND roles IS NOT NULL").select("ck", "part", "seq", F.lit(0).alias("s"),
                                                             F.col("matrix")[0]["audit"].alias("audit"), "roles", "texts")
    return result, kept.unionByName(leaves)


def _messages(leaves: DataFrame) -> DataFrame:
    return leaves.select("ck", "part", "seq", "s", "audit", "roles", "texts").mapInPandas(
        _written_rows, "ck string, part int, seq long, messages array<struct<role:string,text:string>>")


def _conv_id(rows: DataFrame) -> Column:
    return F.when(F.col("ck") != "n", F.expr("substr(ck, 2)")).cast(rows.schema["conv_id"].dataType).alias("conv_id")


def repair(rows: DataFrame, times: str | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): faults,
    cost, letters of the edits and the digest of the repaired rows. ``times``
    names a column that says how often a row stands there, once without; of a
    row that stands there 0 times only the conversation counts. ``gaps`` is null
    where it is no long."""
    found, _ = _solved(_read(rows, times), keep=False)
    gaps = F.expr("try_cast(cast(hi AS decimal(20)) - cast(lo AS decimal(20)) + 1 - turns AS bigint)")
    return found.select(_conv_id(rows), F.when(F.col("turns") > 0, gaps).otherwise(0).alias("gaps"), "blank", "duplicate", "truncated",
                        "illegal", "cost", "audit", F.col("sha").alias("repaired_sha256"))


def repaired_messages(rows: DataFrame, times: str | None = None) -> DataFrame:
    """(conv_id, part, seq, pos, role, text): the repaired rows, in the order of
    (part, seq, pos) within a conversation."""
    _, leaves = _solved(_read(rows, times), keep=True)
    return _messages(leaves).select(_conv_id(rows), "part", "seq", F.posexplode("messages").alias("pos", "m")).select(
        "conv_id", "part", "seq", "pos", "m.role", "m.text")


def _read(rows: DataFrame, times: str | None) -> DataFrame:
    return rows.select(*map(col, ("conv_id", "turn", "role", "text")), (col(times) if times else F.lit(1)).alias("times"))


def damaged(rows: DataFrame) -> DataFrame:
    """Test damage by crc32(`conv_id:turn`) % 20: 0 drops a row (``times`` 0), 1
    empties it, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(col("text"), space)
    return rows.select(
        col("conv_id"), col("turn"), F.when(kind == 4, "user").otherwise(F.coalesce(col("role"), space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")), times="times")
