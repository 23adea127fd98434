"""Best-fit packing of token pieces into sequences of bounded length.

Documents become ids with an end id; longer ones are cut into full pieces, the
first of which may be shorter.  Pieces are then packed in supersteps, longest
length first: all pieces of one length are matched at once to the sequences
whose gap is the tightest that holds them (the successor of the length among the
gaps), a gap as often as it holds the length; conflicts are settled by rank (the
k-th piece of the length goes to the k-th sequence of the gap), gaps are updated,
and the next length follows.

Pieces of one length are interchangeable, and so are sequences with one gap.  A
superstep's successor sweep therefore runs over runs ``(gap, first sequence,
count)`` and not over rows: at most one entry per length goes in, at most three
runs per length come out, whatever the number of documents.  The ranks inside a
length are the distributed part: each task numbers its own pieces of a length, the
counts of the earlier tasks are added, and pieces never move.  The result is that of
best-fit decreasing.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .job import narrow, ship
from .tokens import default_path, token_ids

LIMIT = 1024
SMALL = 2_000_000  # rows (length, task, count) that are surely small enough to be broadcast

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>, task int, turn bigint"


def _cut(path: str, limit: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64)
        for batch in batches:
            ids = token_ids(batch, "text", path)
            row, piece, start, length, crc, own = [], [], [], [], [], []
            for i, all_ids in enumerate(ids):
                n = len(all_ids)
                raw = all_ids.astype("<u4")
                to = (n - 1) % limit + 1
                at = k = 0
                while at < n:
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(to - at)
                    crc.append(zlib.crc32(raw[at:to].tobytes()))
                    own.append(raw[at:to].astype(np.int32) if with_ids else None)
                    at, to, k = to, to + limit, k + 1
            turn = _turns(np.array(length, np.int64), seen)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(own, pa.list_(pa.int32())),
                 pa.array(np.full(len(row), task, np.int32)), pa.array(turn)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "task", "turn"])
    return cut


def _turns(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """How many pieces of its length came before each; ``seen`` goes on."""
    by = np.argsort(length, kind="stable")
    ordered = length[by]
    first = np.searchsorted(ordered, ordered)
    out = np.empty(len(length), np.int64)
    out[by] = np.arange(len(length)) - first + seen[ordered]
    np.add.at(seen, length, 1)
    return out


def pieces(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, with_ids: bool = True) -> DataFrame:
    """Pieces of at most ``limit`` ids of every document: doc_id, piece, start, length, ids_crc32, ids.

    ``task`` and ``turn`` number the pieces of a length; write the table before it is packed.
    """
    ship(docs.sparkSession)
    texts = narrow(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return texts.mapInArrow(_cut(tokenizer or default_path(), limit, with_ids), PIECES)


class Runs:
    """Open sequences by gap: for each gap a list of (first sequence, count)."""

    def __init__(self, limit: int):
        self.limit, self.next = limit, 0
        self.gaps: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def put(self, gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in self.runs:
                insort(self.gaps, gap)
                self.runs[gap] = []
            self.runs[gap].append((first, count))

    def take(self, gap: int, most: int) -> tuple[int, int]:
        first, count = self.runs[gap].pop()
        if count > most:
            self.runs[gap].append((first + most, count - most))
            count = most
        if not self.runs[gap]:
            del self.runs[gap]
            self.gaps.remove(gap)
        return first, count

    def superstep(self, length: int, wanted: int) -> Iterator[tuple[int, int, int, int]]:
        """Place ``wanted`` pieces of one length: (first rank, count, first sequence, offset)."""
        rank = 0
        while rank < wanted:
            at = bisect_left(self.gaps, length)
            if at < len(self.gaps):
                gap = self.gaps[at]
            else:
                gap, fits = self.limit, self.limit // length
                count = max(1, (wanted - rank) // fits)
                self.put(gap, self.next, count)
                self.next += count
            left = wanted - rank
            turns = min(gap // length, left)
            first, count = self.take(gap, left // turns)
            for turn in range(turns):
                yield rank, count, first, self.limit - gap + turn * length
                rank += count
            self.put(gap - turns * length, first, count)


def plan(counts: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first rank, count, first sequence, offset)."""
    runs = Runs(limit)
    return [(length, *step) for length in sorted(counts, reverse=True) for step in runs.superstep(length, counts[length])]


def _place(steps: list[tuple[int, int, int, int, int]]):
    table = np.array(sorted(steps), np.int64).reshape(-1, 5)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("turn").to_numpy() + batch.column("before").to_numpy()
            at = np.searchsorted(key, (length << 48) + rank, "right") - 1
            sequence = table[at, 3] + rank - table[at, 1]
            names = [n for n in batch.schema.names if n not in ("task", "turn", "before", "rank")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(table[at, 4])],
                [*names, "sequence_id", "offset"])
    return place


def pack(cut: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Add sequence_id and offset to the written pieces of ``pieces``.

    Equal pieces, null ids and repeated rows are packed like others, each row once;
    an empty table gives an empty one.
    """
    ship(cut.sparkSession)
    counts = materialize(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= limit rows
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    before = materialize(counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "before")
    ranked = cut.join(F.broadcast(before) if before.count() <= SMALL else before, ["length", "task"])
    kept = [f for f in cut.schema if f.name not in ("task", "turn")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id bigint, offset bigint"
    names = [f.name for f in kept]
    return ranked.select(*names, "turn", "before").mapInArrow(_place(plan(by_length, limit)), schema)


def best_fit(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, with_ids: bool = True) -> DataFrame:
    """Pack all documents: one row per piece with its sequence and its place there.

    A null or empty text is the end id alone.  Columns: doc_id, piece, start,
    length, ids_crc32, ids (null without ``with_ids``), sequence_id, offset.
    """
    cut = materialize(pieces(docs, tokenizer, limit, with_ids), "pieces")
    return pack(cut, limit)
