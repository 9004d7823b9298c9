"""Repair of conversation structure (operator 13).

The rows of a conversation, by turn, are edited at the least cost until the
initials of their roles read ``(s?(ua)+)?``: Keep 0, Rerole to user or
assistant 1, Delete 2 (blank and duplicate rows must go), Insert an empty user
or assistant turn 5, and 5 more for a truncated row that stays.  Of equally
cheap audits (the edits' initials in order) the least in ASCII order counts.

What has been kept leaves one of four states: nothing yet, system, user,
assistant.  The state fixes the role that a Rerole or Insert writes, so the
audit names the whole repair.  It is found by Hirschberg's divide and conquer:
a forward vector of costs by state for the first half of the rows and a
backward one for the second meet in the middle, the cheapest crossing state is
taken, and both halves are solved alone, in linear space.  Forward vectors also
rank the states by their least audits.  An edit of a row is written as its
inserts and then one of D, K, R; so of two different audits of the same rows
none begins the other, and between equally cheap crossings the better rank
decides.

Rows are range-sorted by conversation and turn.  A task repairs the
conversations it holds whole, up to ``PIECE`` rows.  Longer ones, and those
that begin or end a task's range, are cut into pieces: each piece is reduced to
its 4 x 4 costs and ranks, the same search runs over these and gives each piece
its states at entry and exit, and the pieces are then solved apart.

Edge cases: null roles and texts count as one space; null turns come first,
equal turns in the order of role and digest, repeated rows are duplicates of
the first; rows with a null conv_id are one conversation; where the column
``present`` is false a row is absent, and a conversation of absent rows has an
empty repair; an empty table gives an empty result; other columns, whatever
their names, are not read."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitlab.llm.common import map_batches, written

#: rows of a conversation that a task repairs in one go
PIECE = 8192
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LEGAL = {"su", "ua", "au"}
_WHITE = " \t\n\x0b\f\r"

#: a step: for each state, (next state, cost, label) of its moves
Step = list[list[tuple[int, int, object]]]


def _next(state: int) -> int:
    """State after the one role that may be written now."""
    return ASSISTANT if state == USER else USER


@lru_cache(maxsize=None)
def row_step(initial: str, fault: str) -> Step:
    """Cheapest edits of a row from state to state; label: the audit."""
    step = []
    for state in range(4):
        best: dict[int, tuple[int, str]] = {}
        at, cost, audit = state, 0, ""
        for _ in range(3):  # inserts before the row; a third one only repeats a state
            edits = [(at, DELETE, "D")]
            if fault not in ("blank", "duplicate"):
                more = TRUNCATED if fault == "truncated" else 0
                edits.append((_next(at), REROLE + more, "R"))
                if initial == "s" and at == START:
                    edits.append((SYSTEM, KEEP + more, "K"))
                elif initial == "ua"[_next(at) - USER]:
                    edits.append((_next(at), KEEP + more, "K"))
            for to, price, edit in edits:
                best[to] = min(best.get(to, (1 << 60, "")), (cost + price, audit + edit))
            at, cost, audit = _next(at), cost + INSERT, audit + "I"
        step.append([(to, *v) for to, v in sorted(best.items())])
    return step


#: the end of a conversation: inserts until the roles may end
END: Step = [[(START, 0, "")], [(START, 2 * INSERT, "II")], [(START, INSERT, "I")], [(START, 0, "")]]


def forward(steps: list[Step], state: int) -> dict[int, tuple[int, int]]:
    """state -> (least cost, rank of its least audit) after the steps."""
    now = {state: (0, 0)}
    for step in steps:
        best: dict[int, tuple] = {}
        for s, (cost, rank) in now.items():
            for t, price, label in step[s]:
                found = (cost + price, rank, label)
                if t not in best or found < best[t]:
                    best[t] = found
        order = sorted((v[1], v[2], t) for t, v in best.items())
        now = {t: (best[t][0], i) for i, (_, _, t) in enumerate(order)}
    return now


def backward(steps: list[Step], state: int) -> dict[int, int]:
    """state -> least cost from it through the steps to ``state``."""
    after = {state: 0}
    for step in reversed(steps):
        after = {s: least for s in range(4) if (least := min((p + after[t] for t, p, _ in step[s] if t in after), default=None)) is not None}
    return after


def crossings(steps: list[Step], start: int, end: int) -> list[tuple[int, int, object]]:
    """(cost, state after, label) of every step on the cheapest way, of these
    the one with the least labels."""
    if not steps:
        return []
    if len(steps) == 1:
        return [min((p, t, label) for t, p, label in steps[0][start] if t == end)]
    half = len(steps) // 2
    near, far = forward(steps[:half], start), backward(steps[half:], end)
    middle = min((near[m][0] + far[m], near[m][1], m) for m in near if m in far)[2]
    return crossings(steps[:half], start, middle) + crossings(steps[half:], middle, end)


@lru_cache(maxsize=1 << 14)
def _short(rows: tuple[tuple[str, str], ...]) -> tuple[int, tuple[str, ...]]:
    return _solve(rows)


def _solve(rows) -> tuple[int, tuple[str, ...]]:
    way = crossings([row_step(*r) for r in rows] + [END], START, START)
    return sum(w[0] for w in way), tuple(w[2] for w in way)


def solve(rows: list[tuple[str, str]]) -> tuple[int, tuple[str, ...]]:
    """Cost and the audit by row (the last entry: inserts after all rows) of
    rows given as (initial of the role, fault)."""
    rows = tuple((i if i in ("s", "u", "a") else "", f) for i, f in rows)
    return _short(rows) if len(rows) <= 8 else _solve(rows)


def written_turns(state: int, audit: str, role: str, text: str) -> tuple[int, list[tuple[str, str]]]:
    """State and turns after the edits of one row."""
    out = []
    for edit in audit:
        if edit == "D":
            continue
        if edit == "K":
            state = SYSTEM if role[:1] == "s" else _next(state)
        else:
            state = _next(state)
            role = role if edit == "I" else "user" if state == USER else "assistant"
        out.append(("user" if state == USER else "assistant", "") if edit == "I" else (role, text))
    return state, out


class Tally:
    """Counts over the rows of a conversation, or of a piece of it."""

    def __init__(self):
        self.rows, self.turn, self.first, self.distinct, self.illegal, self.head, self.last = [], None, None, 0, 0, None, None

    def add(self, turn, role: str, fault: str) -> None:
        initial = role[:1]
        if self.rows:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.head = initial
        self.last = initial
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.distinct += turn != self.turn
            self.turn = turn
        self.rows.append((initial, fault))

    def count(self, fault: str) -> int:
        return sum(f == fault for _, f in self.rows)


FAULTS = ("blank", "duplicate", "truncated")
REPORT = ("gaps", *FAULTS, "illegal", "cost", "audit")
_TURNS = "array<struct<role:string,text:string>>"


def faulted(conversations: DataFrame, present: Column | None = None) -> DataFrame:
    """The rows with what one row alone shows: blank or truncated."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    bare = F.rtrim(text, F.lit(_WHITE))
    fault = F.when(bare == "", "blank").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    there = F.lit(True) if present is None else present
    return conversations.select(F.col("conv_id").alias("c"), "turn", role.alias("role"), text.alias("text"), fault.alias("fault"), digest.alias("dg"), there.alias("present"), F.monotonically_increasing_id().alias("u"))


def _first_pass(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Reports and turns of the conversations that a task holds whole; the
    rows of all others, with their piece (c, part, piece) and place."""
    own = ("c", "turn", "role", "text", "fault", "dg", "present")
    names = ("c", *REPORT, "turns", "part", "piece", "seq", *own[1:])

    def finish(held):
        tally, seen, texts = Tally(), set(), []
        for _, turn, role, text, fault, dg, present in held:
            if present:
                tally.add(turn, role, "duplicate" if fault != "blank" and dg in seen else fault)
                seen.add(dg)
                texts.append((role, text))
        cost, audit = solve(tally.rows)
        state, turns = START, []
        for edits, (role, text) in zip(audit, [*texts, ("", "")]):
            state, more = written_turns(state, edits, role, text)
            turns += more
        gaps = tally.turn - tally.first + 1 - tally.distinct if tally.turn is not None else 0
        return (held[0][0], gaps, *map(tally.count, FAULTS), tally.illegal, cost, "".join(audit), [{"role": r, "text": t} for r, t in turns], *[None] * (len(names) - 9))

    def work(batches):
        part, held, begun, piece, edge = TaskContext.get().partitionId(), [], False, 0, True

        def pieces():
            return [(held[0][0], *[None] * 8, part, piece, i, *row[1:]) for i, row in enumerate(held)]

        for cols in batches:
            out = []
            for row in zip(*(cols[n] for n in own)):
                if held and row[0] != held[0][0]:
                    out += pieces() if edge else [finish(held)]
                    held, edge, piece = [], False, 0
                elif len(held) >= PIECE:
                    out += pieces()
                    held, edge, piece = [], True, piece + 1
                held.append(row)
            yield {n: [r[i] for r in out] for i, n in enumerate(names)}
        rest = pieces() if held else []
        yield {n: [r[i] for r in rest] for i, n in enumerate(names)}

    schema = f"c {kinds['c']}, " + ", ".join(f"{n} long" for n in REPORT[:-1]) + f", audit string, turns {_TURNS}, part long, piece long, seq long, turn {kinds['turn']}, role string, text string, fault string, dg binary, present boolean"
    order = [F.asc_nulls_first("c"), F.asc_nulls_first("turn"), "role", "dg", "u"]
    return written(map_batches(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*own), work, schema), "repair")


PLACE = ("c", "part", "piece")


def _groups(rows, key):
    """Runs of equal key over dicts of columns, as lists of rows."""
    held, now = [], None
    for cols in rows:
        for row in zip(*cols.values()):
            k = tuple(row[:key])
            if held and k != now:
                yield held
                held = []
            now = k
            held.append(row)
    if held:
        yield held


def _tables(names, rows):
    """Dicts of columns of at most 512 rows each."""
    out = []
    for row in rows:
        out.append(row)
        if len(out) == 512:
            yield {n: [r[i] for r in out] for i, n in enumerate(names)}
            out = []
    yield {n: [r[i] for r in out] for i, n in enumerate(names)}


def _later_passes(rows: DataFrame, kinds: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Reports (c, ...) and turns (c, part, piece, seq, audit, turns) of the
    conversations in pieces."""
    at = F.struct("part", "piece", "seq")
    firsts = written(rows.where("present").groupBy("c", "dg").agg(F.min(at).alias("first")), "firsts")
    joined = rows.join(firsts.select(F.col("c").alias("fc"), F.col("dg").alias("fd"), "first"), F.col("c").eqNullSafe(F.col("fc")) & (F.col("dg") == F.col("fd")), "left")
    fault = F.when((F.col("fault") != "blank") & (at != F.col("first")), "duplicate").otherwise(F.col("fault"))
    marked = written(joined.select(*PLACE, "seq", "turn", "role", "text", fault.alias("fault"), "present"), "marked")
    summary = ("n", "distinct", "low", "high", *FAULTS, "illegal", "head", "last", "costs", "ranks")

    def reduce_(batches):
        def run():
            for held in _groups(batches, 3):
                tally = Tally()
                for *_, turn, role, fault, present in held:
                    if present:
                        tally.add(turn, role, fault)
                steps = [row_step(i if i in ("s", "u", "a") else "", f) for i, f in tally.rows]
                ends = [forward(steps, s) for s in range(4)]
                costs = [e[t][0] if t in e else -1 for e in ends for t in range(4)]
                ranks = [e[t][1] if t in e else -1 for e in ends for t in range(4)]
                yield (*held[0][:3], len(tally.rows), tally.distinct, tally.first, tally.turn, *map(tally.count, FAULTS), tally.illegal, tally.head, tally.last, costs, ranks)

        yield from _tables((*PLACE, *summary), run())

    def choose(batches):
        def run():
            for held in _groups(batches, 1):
                pieces = [dict(zip((*PLACE, *summary), r)) for r in held]
                steps = [[[(t, p["costs"][4 * s + t], p["ranks"][4 * s + t]) for t in range(4) if p["costs"][4 * s + t] >= 0] for s in range(4)] for p in pieces]
                way = crossings([*steps, END], START, START)
                total = {f: sum(p[f] for p in pieces) for f in ("distinct", *FAULTS, "illegal")}
                last, turn, low = None, None, None
                for p in pieces:
                    if p["n"]:
                        total["illegal"] += last is not None and last + p["head"] not in LEGAL
                        last = p["last"]
                    if p["low"] is not None:
                        total["distinct"] -= p["low"] == turn
                        turn, low = p["high"], p["low"] if low is None else low
                gaps = turn - low + 1 - total["distinct"] if turn is not None else 0
                report = (gaps, *[total[f] for f in FAULTS], total["illegal"], sum(w[0] for w in way))
                enter = START
                for p, (_, leave, _) in zip(pieces, way):
                    final = p is pieces[-1]
                    yield (p["c"], p["part"], p["piece"], enter, leave, final, *(report if final else [None] * 6))
                    enter = leave

        yield from _tables((*PLACE, "enter", "leave", "final", *REPORT[:-1]), run())

    def edit(batches):
        def run():
            for held in _groups(batches, 3):
                enter, leave, final = held[0][3:6]
                there = [(seq, role, text, fault) for *_, seq, role, text, fault, present in held if present]
                steps = [row_step(role[:1] if role[:1] in ("s", "u", "a") else "", fault) for _, role, _, fault in there]
                way = crossings(steps, enter, leave)
                state = enter
                for (_, _, audit), (seq, role, text, _) in zip(way, there):
                    state, turns = written_turns(state, audit, role, text)
                    yield (*held[0][:3], seq, audit, [{"role": r, "text": t} for r, t in turns])
                if final:
                    audit = END[state][0][2]
                    yield (*held[0][:3], PIECE, audit, [{"role": r, "text": t} for r, t in written_turns(state, audit, "", "")[1]])

        yield from _tables((*PLACE, "seq", "audit", "turns"), run())

    name = f"c {kinds['c']}, part long, piece long"
    turn = kinds["turn"]
    order = [F.asc_nulls_first("c"), "part", "piece"]
    dealt = marked.repartition(*PLACE).sortWithinPartitions(*order, "seq").select(*PLACE, "turn", "role", "fault", "present")
    schema = f"{name}, n long, distinct long, low {turn}, high {turn}, blank long, duplicate long, truncated long, illegal long, head string, last string, costs array<long>, ranks array<long>"
    reduced = written(map_batches(dealt, reduce_, schema), "pieces")
    schema = f"{name}, enter long, leave long, final boolean, " + ", ".join(f"{n} long" for n in REPORT[:-1])
    states = written(map_batches(reduced.repartition("c").sortWithinPartitions(*order), choose, schema), "states")
    key = [F.col(n).eqNullSafe(F.col(f"s_{n}")) for n in PLACE]
    both = marked.join(states.select(*[F.col(n).alias(f"s_{n}") for n in PLACE], "enter", "leave", "final"), key[0] & key[1] & key[2])
    edits = written(map_batches(both.repartition(*PLACE).sortWithinPartitions(*order, "seq").select(*PLACE, "enter", "leave", "final", "seq", "role", "text", "fault", "present"), edit, f"{name}, seq long, audit string, turns {_TURNS}"), "edits")
    return states.where("final").select("c", *REPORT[:-1]), edits


def _joined(edits: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(c, audit, repaired_sha256) from the edits of long conversations, whose
    rows pass in order through one incremental hash."""
    lines = F.concat_ws("\n", F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])))

    def work(batches):
        def run():
            conv, state, audit, empty = None, None, [], True
            for cols in batches:
                for c, a, n, text in zip(*cols.values()):
                    if state is None or c != conv:
                        if state is not None:
                            yield conv, "".join(audit), state.hexdigest()
                        conv, state, audit, empty = c, hashlib.sha256(), [], True
                    audit.append(a)
                    if n:
                        state.update((b"" if empty else b"\n") + text.encode())
                        empty = False
            if state is not None:
                yield conv, "".join(audit), state.hexdigest()

        yield from _tables(("c", "audit", "repaired_sha256"), run())

    ordered = edits.select("c", "part", "piece", "seq", "audit", F.size("turns").alias("n"), lines.alias("text")).repartition("c").sortWithinPartitions(F.asc_nulls_first("c"), "part", "piece", "seq")
    return map_batches(ordered.select("c", "audit", "n", "text"), work, f"c {kinds['c']}, audit string, repaired_sha256 string")


@dataclass
class Repaired:
    """``whole``: (c, report columns, turns) of conversations repaired in one
    go; ``reports`` and ``edits``: those in pieces."""

    whole: DataFrame
    reports: DataFrame
    edits: DataFrame
    kinds: dict[str, str]

    def turns(self) -> DataFrame:
        """(conv_id, part, piece, seq, place, role, text): the repaired turns;
        a conversation's order is that of part, piece, seq, place."""
        none = [F.lit(0).cast("long").alias(n) for n in ("part", "piece", "seq")]
        rows = self.whole.select("c", *none, "turns").unionByName(self.edits.select(*PLACE, "seq", "turns"))
        return rows.select(F.col("c").alias("conv_id"), "part", "piece", "seq", F.posexplode("turns").alias("place", "t")).select("conv_id", "part", "piece", "seq", "place", "t.role", "t.text")

    def digests(self) -> DataFrame:
        """One row per conversation: conv_id, the report, and the SHA-256 of
        its repaired ``role:text`` lines."""
        lines = F.concat_ws("\n", F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])))
        whole = self.whole.select(F.col("c").alias("conv_id"), *REPORT, F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))
        joined = _joined(self.edits, self.kinds).withColumnRenamed("c", "jc")
        long = self.reports.join(joined, F.col("c").eqNullSafe(F.col("jc")))
        return whole.unionByName(long.select(F.col("c").alias("conv_id"), *REPORT, "repaired_sha256"))


def repair(rows: DataFrame) -> Repaired:
    """Repair of ``faulted`` rows."""
    kinds = {n: rows.schema[n].dataType.simpleString() for n in ("c", "turn")}
    first = _first_pass(rows, kinds)
    cut = first.where("part is not null").select(*PLACE, "seq", "turn", "role", "text", "fault", "dg", "present")
    reports, edits = _later_passes(cut, kinds)
    return Repaired(first.where("part is null").select("c", *REPORT, "turns"), reports, edits, kinds)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with planted damage by crc32(``conv_id:turn``) mod 20: 0 makes
    a row absent, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4
    sets its role to user.  Nulls count as one space."""
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
