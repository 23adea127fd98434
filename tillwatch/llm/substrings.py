"""Substring deduplication with suffix automata of reference shards.

A word goes if a run of ``span`` words around it also starts earlier: in a document
with a smaller doc_id, or earlier in the same document.

1. Every run of ``span`` words has an anchor, the 8-word gram in it with the least
   hash.  Equal runs have equal anchors, so a run whose anchor occurs once in the
   corpus occurs once.  Runs with the same anchor place lie side by side: one
   extent.  Repeated anchors are found by counting; all other extents are done.
2. Extents with equal words are one content, first held by its smallest place.
   Every later holder has earlier copies of all its runs.
3. Contents that share an anchor are a reference shard.  A shard's first holders
   stream in the order of their places through the shard's suffix automaton: the
   matching statistics tell which runs it holds already, that is which start
   earlier, and then the extent joins the reference.  Each task builds the
   automata of its own shards only, so nothing grows with the corpus on one
   machine.  A shard with more than ``SHARD`` contents is split by the runs
   themselves, whose first places are found by counting.
4. The maximal spans of marked runs are taken out of each text.

Each run is judged on the input, not on what is left.

Defined cases: a null text has no words; a null doc_id keeps its text and is no
reference; rows that repeat a doc_id are told apart by their texts, equal ones are
one document; texts shorter than ``span`` lose nothing; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .automaton import SuffixAutomaton
from .bitmap import bitmap, let_through
from .job import narrow, ship
from .words import Words, grams, mix, pieces, signed

SPAN = 20
GRAM = 8
SHARD = 48  # contents of one automaton; shards with more are split by runs

EXTENT = "anchor bigint, content bigint, doc_id bigint, tag bigint, lo int, hi int"


def _tags(text: Words) -> np.ndarray:
    """A hash of each whole text."""
    return text.range_hash(text.offsets[:-1], text.offsets[1:])


class Extents:
    """Extents of a few texts: anchor hash, text, first and last run (places in the text), content hash."""

    def __init__(self, text: Words, span: int):
        self.hashes = text.hashes()
        keys, at = grams(self.hashes, text.doc, GRAM)
        inside = span - GRAM + 1
        if len(keys) < inside:
            self.anchor = np.zeros(0, np.uint64)
            self.doc = self.lo = self.hi = np.zeros(0, np.int64)
            self.content = np.zeros(0, np.uint64)
            return
        views = np.lib.stride_tricks.sliding_window_view(keys, inside)
        whole = np.flatnonzero(at[inside - 1:] - at[:len(views)] == inside - 1)
        whole = whole[text.doc[at[whole]] == text.doc[at[whole + inside - 1]]]
        least = whole + views[whole].argmin(axis=1)
        run = at[whole]  # first word of each run, in the batch
        new = np.ones(len(run), bool)
        new[1:] = (least[1:] != least[:-1]) | (np.diff(run) != 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(run)) - 1 if len(run) else first
        self.anchor = keys[least[first]]
        self.doc = text.doc[run[first]]
        begin = text.bounds()[self.doc]
        self.from_word, self.to_word = run[first], run[last] + span
        self.lo, self.hi = run[first] - begin, run[last] - begin
        shift = at[least[first]] - run[first]
        self.content = mix(_sequence(self.hashes, self.from_word, self.to_word) + shift.astype(np.uint64))


def _sequence(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ranges of words, equal for equal words."""
    from .words import _power

    up, down = _power(len(hashes) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:len(hashes)], dtype=np.uint64)))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def _anchors(span: int):
    """Distinct anchors of a batch, with how often they occur (2 is enough)."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Extents(text, span).anchor for _, _, text in pieces(batch, "text")]
            keys, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, int))
            yield pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(np.minimum(n, 2).astype(np.int64))], ["key", "n"])
    return find


def _extents(span: int, shared):
    """Extents whose anchor the bitmap lets through."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for at, to, text in pieces(batch, "text"):
                e = Extents(text, span)
                keep = let_through(bits, e.anchor) if len(e.anchor) else np.zeros(0, bool)
                doc = e.doc[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(e.anchor[keep])), pa.array(signed(e.content[keep])), pa.array(ids[at:to][doc]),
                     pa.array(signed(_tags(text)[doc])), pa.array(e.lo[keep].astype(np.int32)), pa.array(e.hi[keep].astype(np.int32))],
                    [c.split()[0] for c in EXTENT.split(", ")])
    return find


def _through(shared):
    """Texts whose doc_id the bitmap lets through, with their tags."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            some = batch.filter(pa.array(let_through(bits, batch.column("doc_id").to_numpy())))
            for at, to, text in pieces(some, "text"):
                part = some.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(signed(_tags(text))), part.column("text")],
                                                 ["doc_id", "tag", "text"])
    return keep


def _fetch(span: int):
    """Word hashes of wanted extents of texts: rows (anchor, doc_id, tag, lo, words)."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted")
            ids, tags = batch.column("doc_id").to_numpy(), batch.column("tag").to_numpy()
            for at, to, text in pieces(batch, "text"):
                hashes, bounds = signed(text.hashes()), text.bounds()
                anchors, rows, los, words = [], [], [], []
                for i in range(at, to):
                    own = wanted[i].values
                    for a, lo, hi in zip(own.field("anchor").to_pylist(), own.field("lo").to_pylist(), own.field("hi").to_pylist()):
                        start = bounds[i - at] + lo
                        anchors.append(a)
                        rows.append(i)
                        los.append(lo)
                        words.append(hashes[start:start + hi - lo + span])
                sizes = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int32)
                flat = np.concatenate(words) if words else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors, pa.int64()), pa.array(ids[rows] if rows else ids[:0]), pa.array(tags[rows] if rows else tags[:0]),
                     pa.array(los, pa.int32()), pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))],
                    ["anchor", "doc_id", "tag", "lo", "words"])
    return fetch


def _stream(span: int):
    """Runs that start earlier in their shard; rows come sorted by anchor and place."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, automaton = None, SuffixAutomaton()
        for batch in batches:
            out = []
            for anchor, doc, tag, lo, words in zip(*(batch.column(c).to_pylist() for c in ("anchor", "doc_id", "tag", "lo", "words"))):
                if anchor != shard:
                    shard, automaton = anchor, SuffixAutomaton()
                found = automaton.matches(words)
                whole = True
                for end in range(span - 1, len(words)):
                    if found[end] >= span:
                        start = lo + end - span + 1
                        if out and out[-1][0] == doc and out[-1][1] == tag and out[-1][3] == start - 1:
                            out[-1][3] = start
                        else:
                            out.append([doc, tag, start, start])
                    else:
                        whole = False
                if not whole:
                    automaton.add(words)
            columns = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
                 pa.array(columns[3], pa.int32())], ["doc_id", "tag", "lo", "hi"])
    return stream


def _runs(span: int):
    """The runs of extents one by one: rows (run hash, doc_id, tag, lo)."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            flat, bounds = words.values.to_numpy().view(np.uint64), words.offsets.to_numpy()
            count = np.diff(bounds) - span + 1
            row = np.repeat(np.arange(len(count)), count)
            turn = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = bounds[:-1][row] - bounds[0] + turn
            flat = flat[bounds[0]:bounds[-1]] if len(flat) > bounds[-1] - bounds[0] else flat
            keys = _sequence(flat, start, start + span)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(keys)), batch.column("doc_id").take(pa.array(row)), batch.column("tag").take(pa.array(row)),
                 pa.array((batch.column("lo").to_numpy()[row] + turn).astype(np.int32))], ["run", "doc_id", "tag", "lo"])
    return split


KEPT = "doc_id bigint, n_words bigint, n_removed bigint, text string"


def _remove(span: int, marked: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, kept = [], [], []
            marks = batch.column("marks") if marked else None
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for i, raw in enumerate(texts):
                words = (raw or b"").split()
                drop = 0
                if marks is not None and marks[i].is_valid:
                    step = np.zeros(len(words) + 1, np.int32)
                    own = marks[i].values
                    np.add.at(step, own.field("lo").to_numpy(), 1)
                    np.add.at(step, np.minimum(own.field("hi").to_numpy() + span, len(words)), -1)
                    stay = np.cumsum(step[:-1]) == 0
                    drop = int(len(words) - stay.sum())
                    sizes.append(len(words))
                    words = [words[j] for j in np.flatnonzero(stay)]
                else:
                    sizes.append(len(words))
                gone.append(drop)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "text"])
    return remove


def repeated_runs(texts: DataFrame, span: int) -> DataFrame:
    """Runs that also start earlier: (doc_id, tag, lo, hi), all runs from the first to the last."""
    sc = texts.sparkSession.sparkContext
    counted = texts.mapInArrow(_anchors(span), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    repeated = counted.filter("n > 1").select("key")
    bits = sc.broadcast(bitmap(repeated))  # 4 MB
    extents = materialize(texts.mapInArrow(_extents(span, bits), EXTENT), "extents")
    # contents of an anchor and their first holders; hot anchors and contents are combined before the shuffle
    place = F.struct("doc_id", "lo", "tag", "hi")
    contents = materialize(extents.groupBy("anchor", "content").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")), "contents")
    again = contents.filter("n > 1").select("anchor", "content", F.col("first.doc_id").alias("d"), F.col("first.lo").alias("l"))
    later = (extents.join(again, ["anchor", "content"]).filter("doc_id <> d OR lo <> l")
             .select("doc_id", "tag", "lo", "hi"))
    shards = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1")
    holders = contents.join(shards, "anchor").select("anchor", "contents", "first.*")
    wanted = materialize(holders.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("anchor", "lo", "hi")).alias("wanted")), "wanted")
    some = sc.broadcast(bitmap(wanted, "doc_id"))
    few = texts.mapInArrow(_through(some), "doc_id bigint, tag bigint, text string").dropDuplicates(["doc_id", "tag"])
    words = "anchor bigint, doc_id bigint, tag bigint, lo int, words array<bigint>"
    held = few.join(wanted, ["doc_id", "tag"]).mapInArrow(_fetch(span), words)
    held = materialize(held.join(shards, "anchor"), "shards")
    runs = "doc_id bigint, tag bigint, lo int, hi int"
    small = (held.filter(F.col("contents") <= SHARD).drop("contents").repartition("anchor")
             .sortWithinPartitions("anchor", "doc_id", "lo").mapInArrow(_stream(span), runs))
    large = held.filter(F.col("contents") > SHARD).drop("contents").mapInArrow(_runs(span), "run bigint, doc_id bigint, tag bigint, lo int")
    least = large.groupBy("run").agg(F.min(F.struct("doc_id", "lo")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    split = (large.join(least.select("run", F.col("first.doc_id").alias("d"), F.col("first.lo").alias("l")), "run")
             .filter("doc_id <> d OR lo <> l").select("doc_id", "tag", "lo", F.col("lo").alias("hi")))
    return later.unionByName(small).unionByName(split)


def remove_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed and the text left (words joined by one blank)."""
    spark = docs.sparkSession
    ship(spark)
    texts = narrow(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    named = texts.filter("doc_id IS NOT NULL")
    marks = repeated_runs(named, span).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("marks"))
    marks = materialize(marks, "marks")
    shared = spark.sparkContext.broadcast(bitmap(marks, "doc_id"))
    touched = named.mapInArrow(_through(shared), "doc_id bigint, tag bigint, text string").join(marks, ["doc_id", "tag"], "left")

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            keep = ~let_through(shared.value, ids.fill_null(0).to_numpy()) | ids.is_null().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(keep))

    rest = texts.mapInArrow(untouched, "doc_id bigint, text string").mapInArrow(_remove(span, False), KEPT)
    return touched.mapInArrow(_remove(span, True), KEPT).unionByName(rest)
