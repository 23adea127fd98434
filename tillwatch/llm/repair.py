"""Conversation structure repair by generalised LR parsing of the roles.

The grammar of a good conversation (``ROLES``: an optional system turn, then pairs of
user and assistant turns) gives a canonical LR(1) automaton.  A parse holds a
graph-structured stack: its nodes are a state on top of a shared node below.  Every row
may be kept (0), given another role (2) or deleted (3, forced for blank and repeated
rows), turns with an empty text may be inserted before it (2), and a truncated row that
stays adds 1.  Branches whose stacks have the same top are merged at once, the least
(cost, audit) stays; the audit is one letter for each edit, D I K R.  Branches of equal
cost over the same rows are never prefixes of each other, so the least audit of a part
is part of a least audit of the whole.

That makes a part of a conversation a map from entering to leaving stacks.  The narrow
rows (no texts) are range-partitioned by conversation and turn; a conversation inside
one range is parsed there, one that lies in several ranges is parsed in every range from
all entering stacks, and its few maps are put together in order.  A conversation of any
length is therefore spread over tasks.  Equal rows of a turn are one narrow row with a
count.  The audit then goes ahead of the conversation's rows as a tape, and the repaired
rows leave as a stream: no task holds a conversation, and only its SHA-256, which is
sequential by its nature, reads all rows of a conversation in one task.

Nulls in role and text are one space; a null conv_id is a conversation of its own, null
turns come first.  Rows of one turn are ordered by a hash of role and text.  Roles that
begin with another character are kept by no rule and must be deleted or given a role.
A conversation without rows has cost 0, an empty audit and no repaired rows; an empty
table gives an empty one.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .job import ship

#: C: a conversation, H: its optional system turn, P: pairs of turns.
ROLES = (("C", ""), ("C", "HP"), ("H", "s"), ("H", ""), ("P", "Pua"), ("P", "ua"))
NAMES = {"u": "user", "a": "assistant"}  # roles an edit may give
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
#: From the cheapest branch any other's future can be had for 7: two turns inserted (4), then one more (2) or a system turn deleted (3).
SLACK = 7
TRIM = 256      # rows between two cuts of the audits' common beginning
STACKS = 64     # a grammar with more different stacks is refused
ROWS = 1000     # rows of a batch that leaves

REPORT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")


class Parser:
    """Canonical LR(1) automaton of a grammar, and its stacks numbered from the empty one (0)."""

    def __init__(self, rules=ROLES):
        self.rules = [("^", rules[0][0]), *rules]
        self.heads = {head for head, _ in self.rules}
        symbols = {x for _, body in self.rules for x in body}
        first: dict[str, set] = {x: {x} if x not in self.heads else set() for x in symbols | self.heads}
        empty: set[str] = set()
        for _ in range(2 * len(self.rules)):
            for head, body in self.rules:
                for x in body:
                    first[head] |= first[x]
                    if x not in empty:
                        break
                else:
                    empty.add(head)
        self.first, self.empty = first, empty
        start = self._closure({(0, 0, "$")})
        self.states, self.goto = [start], [{}]
        for n, state in enumerate(self.states):  # grows while it is walked
            for x in sorted({self._next(i) for i in state} - {""}):
                moved = self._closure({(r, dot + 1, after) for r, dot, after in state if self._next((r, dot, after)) == x})
                if moved not in self.states:
                    self.states.append(moved)
                    self.goto.append({})
                self.goto[n][x] = self.states.index(moved)
        self.terminals = sorted(symbols - self.heads)
        self._number()

    def _next(self, item) -> str:
        rule, dot, _ = item
        return self.rules[rule][1][dot:dot + 1]

    def _closure(self, items: set) -> frozenset:
        todo = list(items)
        while todo:
            rule, dot, after = todo.pop()
            head = self._next((rule, dot, after))
            if head not in self.heads or not head:
                continue
            behind, ahead = self.rules[rule][1][dot + 1:], set()
            for x in behind:
                ahead |= self.first[x]
                if x not in self.empty:
                    break
            else:
                ahead.add(after)
            for r, (h, _) in enumerate(self.rules):
                for a in ahead if h == head else ():
                    if (r, 0, a) not in items:
                        items.add((r, 0, a))
                        todo.append((r, 0, a))
        return frozenset(items)

    def _reduce(self, state: int, ahead: str | None) -> int | None:
        """The rule to reduce by before ``ahead``; before anything (None), if there is nothing else to do."""
        done = {r for r, dot, after in self.states[state] if dot == len(self.rules[r][1]) and ahead in (None, after)}
        if ahead is None and (self.goto[state] or len(done) != 1 or done == {0}):
            return None
        if len(done) > 1 or done and ahead in self.goto[state]:
            raise ValueError("the grammar is not LR(1)")
        return done.pop() if done else None

    def _settle(self, stack: tuple, ahead: str | None) -> tuple:
        while (rule := self._reduce(stack[0], ahead)) not in (None, 0):
            head, body = self.rules[rule]
            for _ in body:
                stack = stack[1]
            stack = (self.goto[stack[0]][head], stack)
        return stack

    def _shift(self, stack: tuple, symbol: str) -> tuple | None:
        stack = self._settle(stack, symbol)
        to = self.goto[stack[0]].get(symbol)
        return None if to is None else self._settle((to, stack), None)

    def _number(self) -> None:
        """Follow the stacks from the empty one; all that ever stand on a graph-structured stack."""
        stacks, self.moves, self.accepts = [(0, None)], [], []
        for stack in stacks:
            self.moves.append({})
            self.accepts.append(self._reduce(self._settle(stack, "$")[0], "$") == 0)
            for x in self.terminals:
                to = self._shift(stack, x)
                if to is not None:
                    if to not in stacks:
                        stacks.append(to)
                    self.moves[-1][x] = stacks.index(to)
            if len(stacks) > STACKS:
                raise ValueError("the grammar's stacks are unbounded")

    # tops: {stack: (cost, audit)}

    def insert(self, tops: dict) -> None:
        todo = list(tops)
        while todo:
            at = todo.pop()
            cost, audit = tops[at]
            for x in NAMES:
                to = self.moves[at].get(x)
                if to is not None and (to not in tops or (cost + INSERT, audit + "I") < tops[to]):
                    tops[to] = (cost + INSERT, audit + "I")
                    todo.append(to)

    def row(self, tops: dict, symbol: str, must: bool, extra: int) -> dict:
        """The branches after one more row; ``must``: it has to be deleted, ``extra``: what staying adds."""
        self.insert(tops)
        most = min(tops.values())[0] + SLACK
        out: dict = {}
        for at, (cost, audit) in tops.items():
            if cost > most:
                continue
            offers = [(at, (cost + DELETE, audit + "D"))]
            if not must:
                for x, to in self.moves[at].items():
                    if x == symbol:
                        offers.append((to, (cost + extra, audit + "K")))
                    elif x in NAMES:
                        offers.append((to, (cost + REROLE + extra, audit + "R")))
            for to, offer in offers:
                if to not in out or offer < out[to]:
                    out[to] = offer
        return out

    def close(self, tops: dict) -> tuple[int, str]:
        self.insert(tops)
        return min(v for at, v in tops.items() if self.accepts[at])

    def given(self, at: int) -> str:
        """The role that an edit gives where the stack is ``at``."""
        return next(x for x in NAMES if x in self.moves[at])


_parsers: dict = {}


def parser(rules=ROLES) -> Parser:
    if rules not in _parsers:
        _parsers[rules] = Parser(rules)
    return _parsers[rules]


class Branches:
    """The parse of consecutive rows from one entering stack; what all audits begin with is kept apart."""

    def __init__(self, machine: Parser, entry: int):
        self.machine, self.tops, self.begun, self.rows = machine, {entry: (0, "")}, [], 0

    def row(self, symbol: str, must: bool, extra: int) -> None:
        self.tops = self.machine.row(self.tops, symbol, must, extra)
        self.rows += 1
        if self.rows % TRIM == 0:
            same = len(os.path.commonprefix([a for _, a in self.tops.values()]))
            if same:
                self.begun.append(next(iter(self.tops.values()))[1][:same])
                self.tops = {at: (c, a[same:]) for at, (c, a) in self.tops.items()}

    def leaving(self) -> dict:
        begun = "".join(self.begun)
        return {at: (c, begun + a) for at, (c, a) in self.tops.items()}


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of ``conv_id:turn`` deals out."""
    def text_of(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"),
                                (F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20).alias("dealt"))
    dealt = F.col("dealt")
    return rows.filter(dealt != 0).select(
        "conv_id", "turn", F.when(dealt == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(dealt == 1, F.lit("")).when(dealt == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(dealt == 3, 2).otherwise(1))).alias("__copy")).drop("__copy")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows of any table of conversations with the 16-byte key that stands for role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    both = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                       F.unhex(F.md5(both.cast("binary"))).alias("key"), role.alias("role"), text.alias("text"))


def _narrow(keyed: DataFrame) -> DataFrame:
    """One row for each distinct row of a turn: its initial, faults, number, and whether an earlier turn has it."""
    shown = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    rows = keyed.select("conv_id", "turn", "key", F.substring("role", 1, 1).alias("initial"), (shown == "").alias("blank"),
                        (~F.substring(shown, -1, 1).isin(".", "!", "?")).alias("cut"))
    rows = rows.groupBy("conv_id", "turn", "key", "initial", "blank", "cut").agg(F.count(F.lit(1)).alias("times"))
    again = (rows.groupBy(F.col("conv_id").alias("c"), F.col("key").alias("k"))
             .agg(F.count(F.lit(1)).alias("n"), F.max(F.col("turn").isNull()).alias("unplaced"), F.min("turn").alias("first"))
             .filter("n > 1").drop("n"))
    joined = rows.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")), "left")
    seen = F.col("turn").isNotNull() & (F.col("unplaced") | (F.col("turn") > F.col("first")))
    return joined.select("conv_id", "turn", "key", "initial", "blank", "cut", "times", F.coalesce(seen, F.lit(False)).alias("seen"))


class _Piece:
    """What one range knows of a conversation: counts, turns at the ends, a map of stacks."""

    def __init__(self, machine: Parser, conv, entries):
        self.conv, self.branches = conv, {e: Branches(machine, e) for e in entries}
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.head = self.tail = self.low = self.high = None

    def row(self, turn, initial, blank, cut, times, seen) -> None:
        for n in range(times):
            double = not blank and (seen or n > 0)
            truncated = not blank and not double and cut
            self.blank += blank
            self.duplicate += double
            self.truncated += truncated
            if self.head is None:
                self.head = initial
            else:
                self.illegal += self.tail + initial not in ("su", "ua", "au")
            self.tail = initial
            for branch in self.branches.values():
                branch.row(initial, blank or double, TRUNCATED * truncated)
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn

    def record(self) -> dict:
        paths = [{"entry": e, "leave": at, "cost": c, "audit": a}
                 for e, branch in self.branches.items() for at, (c, a) in branch.leaving().items()]
        return {"conv_id": self.conv, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "turns": self.turns, "head": self.head, "tail": self.tail, "low": self.low, "high": self.high, "paths": paths}


PATHS = pa.list_(pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", pa.int64()), ("audit", pa.large_string())]))
PIECES = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("whole", pa.bool_()), *((c, pa.int64()) for c in (
    "blank", "duplicate", "truncated", "illegal", "turns")), ("head", pa.string()), ("tail", pa.string()),
    ("low", pa.int64()), ("high", pa.int64()), ("paths", PATHS)])
PIECES_SQL = ("conv_id bigint, part int, whole boolean, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, "
              "head string, tail string, low bigint, high bigint, paths array<struct<entry int, leave int, cost bigint, audit string>>")
REPORTS = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                     ("audit", pa.string())])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a sorted range: the first and the last conversation may go on in a neighbour."""
    machine, part = parser(), TaskContext.get().partitionId()
    piece, first, out = None, True, []

    def ended(whole: bool) -> dict:
        return piece.record() | {"part": part, "whole": whole}

    for batch in batches:
        for conv, turn, initial, blank, cut, times, seen in zip(*(batch.column(c).to_pylist() for c in (
                "conv_id", "turn", "initial", "blank", "cut", "times", "seen"))):
            if piece is None or conv != piece.conv:
                if piece is not None:
                    out.append(ended(not first))
                    first = False
                # the range's last conversation may go on, but never begins before it: only the first needs all entries
                piece = _Piece(machine, conv, range(len(machine.moves)) if piece is None else [0])
            piece.row(turn, initial, blank, cut, times, seen)
        if len(out) >= ROWS:
            yield pa.RecordBatch.from_pylist(out, PIECES)
            out = []
    if piece is not None:
        out.append(ended(False))
    if out:
        yield pa.RecordBatch.from_pylist(out, PIECES)


def _joined(pieces: list[dict]) -> dict:
    """A conversation's report from its pieces in order."""
    machine, tops = parser(), {0: (0, "")}
    total = {c: sum(p[c] for p in pieces) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
    for a, b in zip(pieces, pieces[1:]):
        total["illegal"] += a["tail"] + b["head"] not in ("su", "ua", "au")
    placed = [p for p in pieces if p["high"] is not None]
    for a, b in zip(placed, placed[1:]):
        total["turns"] -= a["high"] == b["low"]
    for p in pieces:
        out: dict = {}
        for path in p["paths"]:
            if path["entry"] in tops:
                cost, audit = tops[path["entry"]]
                offer = (cost + path["cost"], audit + path["audit"])
                if path["leave"] not in out or offer < out[path["leave"]]:
                    out[path["leave"]] = offer
        tops = out
    cost, audit = machine.close(tops)
    turns = total.pop("turns")
    gaps = placed[-1]["high"] - placed[0]["low"] + 1 - turns if placed else 0
    return {"conv_id": pieces[0]["conv_id"], "gaps": gaps, **total, "cost": cost, "audit": audit}


def _close_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pylist([_joined([p]) for p in batch.to_pylist()], REPORTS)


def _close_split(table: pa.Table) -> pa.Table:
    """At most one piece for each range that the conversation lies in."""
    return pa.Table.from_pylist([_joined(sorted(table.to_pylist(), key=lambda p: p["part"]))], REPORTS)


def report(rows: DataFrame) -> DataFrame:
    """One row for each conversation with a row: faults, least cost and audit."""
    ship(rows.sparkSession)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("key")]
    narrow = _narrow(_keyed(rows))
    pieces = materialize(narrow.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_parse, PIECES_SQL), "dialogue-pieces")
    schema = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
    whole = pieces.filter("whole").mapInArrow(_close_whole, schema)
    return whole.unionByName(pieces.filter("NOT whole").groupBy("conv_id").applyInArrow(_close_split, schema))


def _tapes(reports: DataFrame, rows: DataFrame) -> DataFrame:
    """Every conversation's report ahead of its rows, in one sorted stream."""
    columns = [c.split()[0] for c in REPORT.split(", ")]
    heads = reports.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("binary").alias("key"),
                           F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), *columns)
    tail = _keyed(rows).select("conv_id", F.lit(1).alias("kind"), "turn", "key", "role", "text",
                               *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in REPORT.split(", ")])
    return heads.unionByName(tail).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "kind", F.col("turn").asc_nulls_first(), "key")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(head, None, None) at the beginning of a conversation, then (head, role, text) of every repaired row."""
    machine, head, at, place = parser(), None, 0, 0

    def inserted():
        nonlocal at, place
        while head["audit"][place:place + 1] == "I":
            symbol = machine.given(at)
            at, place = machine.moves[at][symbol], place + 1
            yield head, NAMES[symbol], ""

    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                if head is not None:
                    yield from inserted()
                head, at, place = row, 0, 0
                yield head, None, None
                continue
            yield from inserted()
            letter, role = head["audit"][place], row["role"]
            place += 1
            if letter != "D":
                symbol = role[:1] if letter == "K" else machine.given(at)
                at = machine.moves[at][symbol]
                yield head, role if letter == "K" else NAMES[symbol], row["text"]
    if head is not None:
        yield from inserted()


DIGESTS = pa.schema([*REPORTS, ("repaired_sha256", pa.string())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, last, lines, state = [], None, 0, None

    def done() -> dict:
        return {c: last[c] for c in REPORTS.names} | {"repaired_sha256": state.hexdigest()}

    for head, role, text in _edited(batches):
        if role is None:
            if last is not None:
                out.append(done())
            last, lines, state = head, 0, hashlib.sha256()
            if len(out) >= ROWS:
                yield pa.RecordBatch.from_pylist(out, DIGESTS)
                out = []
            continue
        state.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
        lines += 1
    if last is not None:
        out.append(done())
        yield pa.RecordBatch.from_pylist(out, DIGESTS)


ROWS_OUT = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, place, held = [], 0, 0
    for head, role, text in _edited(batches):
        if role is None:
            place = 0
            continue
        out.append({"conv_id": head["conv_id"], "place": place, "role": role, "text": text})
        place, held = place + 1, held + len(text)
        if len(out) >= ROWS or held > 1 << 22:
            yield pa.RecordBatch.from_pylist(out, ROWS_OUT)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, ROWS_OUT)


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the repaired conversations, rows numbered from 0."""
    return _tapes(report(rows), rows).mapInArrow(_rows, "conv_id bigint, place bigint, role string, text string")


def digest(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``report`` with the SHA-256 of the repaired ``role:text`` lines; ``ids`` (conv_id) names conversations that may have no row."""
    found = report(rows)
    if ids is not None:
        every = ids.select(F.col("conv_id").cast("bigint").alias("id")).distinct()
        found = every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").withColumnRenamed("id", "conv_id")
        found = found.na.fill(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]).na.fill("", ["audit"])
    return _tapes(found, rows).mapInArrow(
        _digests, "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
                  "repaired_sha256 string")
