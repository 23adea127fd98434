"""Phrase collocations counted in HAT-tries.

A task counts phrases in a HAT-trie: the top is a trie over word ids, below it hang hash
containers of the phrases' remaining ids; a container that grows beyond ``BURST`` entries
bursts into a trie node with a container for each next word.  When the trie holds more
than ``HELD`` entries, whole subtrees leave as sorted runs, the largest first, in blocks of
a prefix partition.  Spark's shuffle brings the blocks of a partition together in order,
and a sweep merges them; what a task has counted before is one entry, so a common word,
pair or passage is no hot key.

A phrase is at least as rare as its parts, so counting goes up in four rounds, and each
leaves out what the one before proves rare: words; pairs of frequent words; triples of
two frequent pairs; windows of four or five words that hold frequent triples only.
What a task may leave out it reads from a Bloom filter of the frequent words, pairs or
triples, sized by their number up to ``FILTER_BITS``; a filter lets all frequent ones
through, so beyond that size more rows travel and the counts stay what they are.  Windows
go to the partition of their first four words, so all that begin with a phrase pass there
one after another.

A word's id is a 64-bit hash of its language and its bytes; if two words of the
vocabulary share an id and one of them is frequent, ids are made anew with another salt.

A null language is ``und``.  Null and empty texts hold no phrase, a null doc_id and other
columns change nothing, repeated rows count again, an empty table gives an empty one.
Texts are read whole; a phrase never crosses a separator.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .job import ship
from .words import Words, mix, utf8

LONGEST = 5             # words of a phrase
LEAST = 100             # occurrences of a candidate
TOP = 2000              # phrases of a language
BURST = 4096            # entries of a container
HELD = 400_000          # entries of a task's trie
PIECE = 1 << 20         # bytes of texts read at once; a longer text is a piece of its own
ROWS = 4096             # rows of a block of a run
MERGED = 500_000        # rows that are merged at once
FILTER_BITS = 1 << 28   # 32 MB
PER_KEY = 16            # bits of a filter for each key
HASHES = 4
SALTS = 8

#: How bytes are read: capital letters lower, what separates pieces as a blank.
READ = np.arange(256, dtype=np.uint8)
READ[65:91] += 32
SEPARATES = np.zeros(256, bool)
SEPARATES[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
READ[SEPARATES] = 32


class HatTrie:
    """Counts of equally long rows of word ids."""

    def __init__(self, width: int, burst: int = BURST):
        self.width, self.burst, self.size = width, burst, 0
        self.root: dict = {}

    def add(self, rows: np.ndarray) -> None:
        """Count the rows of an array (n, width)."""
        if not len(rows):
            return
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        cuts = np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1
        first = rows[np.concatenate(([0], cuts)), 0].tolist()
        rest = _packed(rows[:, 1:])
        bounds = [0, *cuts.tolist(), len(rows)]
        for word, a, b in zip(first, bounds, bounds[1:]):
            self._into(self.root, word, rest[a:b], self.width - 1)

    def _into(self, node: dict, word, rest: list[bytes], left: int) -> None:
        """Count remainders of ``left`` ids below ``word``: in a container (Counter) or further down (dict)."""
        below = node.get(word)
        if below is None:
            below = node[word] = Counter()
        if type(below) is Counter:
            before = len(below)
            below.update(rest)
            self.size += len(below) - before
            if left > 1 and len(below) > self.burst:
                node[word] = self._burst(below, left)
            return
        parts: dict[bytes, list] = {}
        for r in rest:
            parts.setdefault(r[:8], []).append(r[8:])
        for key, tails in parts.items():
            self._into(below, key, tails, left - 1)

    def _burst(self, container: Counter, left: int) -> dict:
        node: dict = {}
        for r, n in container.items():
            node.setdefault(r[:8], Counter())[r[8:]] = n
        return {k: self._burst(c, left - 1) if left > 2 and len(c) > self.burst else c for k, c in node.items()}

    def _walk(self, node, prefix: bytes) -> Iterator[tuple[bytes, int]]:
        if type(node) is Counter:
            for r, n in node.items():
                yield prefix + r, n
        else:
            for key, below in node.items():
                yield from self._walk(below, prefix + key)

    def _entries(self, node) -> int:
        return len(node) if type(node) is Counter else sum(self._entries(x) for x in node.values())

    def spill(self, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Whole subtrees, the largest first, until ``share`` of the entries has left: sorted rows and their counts."""
        sizes = sorted(((self._entries(x), w) for w, x in self.root.items()), reverse=True)
        keys, counts, goal = [], [], share * self.size
        for entries, word in sizes:
            if len(keys) >= goal:
                break
            for key, n in self._walk(self.root.pop(word), int(word).to_bytes(8, "little")):
                keys.append(key)
                counts.append(n)
            self.size -= entries
        rows = np.frombuffer(b"".join(keys), "<u8").reshape(-1, self.width)
        order = np.lexsort(rows.T[::-1])
        return rows[order], np.array(counts, np.int64)[order]


def _packed(rows: np.ndarray) -> list[bytes]:
    """The ids of each row as bytes."""
    n, width = rows.shape
    if not width:
        return [b""] * n
    return np.ascontiguousarray(rows.astype("<u8")).view(f"V{8 * width}").ravel().tolist()


# a Bloom filter: places of a key are h, h + s, h + 2 s, ... for two halves of its hash

def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    h = mix(keys ^ np.uint64(0x6A09E667F3BCC908))
    step = (mix(h) | np.uint64(1))
    return ((h[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def bloom(phrases: DataFrame, count: int, most: int = FILTER_BITS) -> np.ndarray:
    """Filter of equally long ``ids``: its words are or-ed by Spark, and at most ``most`` bits come to the driver."""
    bits = 64
    while bits < min(most, max(1, count) * PER_KEY):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = batch.column("ids").flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)
                at = np.unique(_places(_joint(ids), bits))
                word, first = np.unique(at >> 6, return_index=True)
                value = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value.view(np.int64))], ["word", "value"])

    words = phrases.select("ids").mapInArrow(run, "word bigint, value bigint").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
    out = np.zeros(bits >> 6, np.int64)
    out[words["word"].to_numpy()] = words["value"].to_numpy()
    return out.view(np.uint64)


def lets_through(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _places(keys, len(words) * 64)
    return ((words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)


class _Texts:
    """Words of a few texts: ids and where the next word stands directly behind, in the same piece of the same text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, salt: int):
        self.words = Words(READ[data], offsets)
        start = self.words.start
        self.ids = mix(self.words.hashes() + langs[self.words.doc] + np.uint64(salt * 2 + 1) * np.uint64(0x9E3779B97F4A7C15))
        self.ids[self.ids == 0] = 1  # 0 stands for no word
        piece = np.concatenate(([0], np.cumsum(SEPARATES[data])))[start]
        self.joined = np.zeros(len(start), bool)
        self.joined[:-1] = (piece[1:] == piece[:-1]) & (self.words.doc[1:] == self.words.doc[:-1])


def _langs(names: list[str]) -> np.ndarray:
    """64-bit hashes of the languages' names."""
    data, offsets = utf8(pa.array(names, pa.string()))
    return Words(data, np.array([0, len(data)])).range_hash(offsets[:-1], offsets[1:]) if len(data) else mix(np.zeros(len(names), np.uint64))


def _read(batch: pa.RecordBatch, salt: int) -> Iterator[tuple[list[str], _Texts]]:
    data, offsets = utf8(batch.column("text"))
    names, at = batch.column("lang").to_pylist(), 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1)
        part = offsets[at:to + 1]
        if part[-1] > part[0]:
            yield names[at:to], _Texts(data[part[0]:part[-1]], part - part[0], mix(_langs(names[at:to])), salt)
        at = to
    pa.default_memory_pool().release_unused()


def _runs(texts: DataFrame, salt: int, width: int, prefix: int, rows_of) -> DataFrame:
    """The sorted runs of every task's trie over ``rows_of`` its texts, cut by prefix partition into blocks.

    A block (part, first, block) is some consecutive rows of a run, column after column, and
    its first row as bytes that sort like it.  Rows that agree in ``prefix`` ids are of one part.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = HatTrie(width)

        def left(share):
            rows, counts = trie.spill(share)
            part = (_joint(rows[:, :prefix]) % np.uint64(parts)).astype(np.int32)
            by = np.argsort(part, kind="stable")
            rows, counts, part = rows[by], counts[by], part[by]
            edges = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]))
            cuts = [c for a, b in zip(edges.tolist(), edges[1:].tolist()) for c in range(a, b, ROWS)]
            blocks = [_written(rows[a:b], counts[a:b]) for a, b in zip(cuts, [*cuts[1:], len(part)])]
            first = [r.astype(">u8").tobytes() for r in rows[cuts]]
            return pa.RecordBatch.from_arrays([pa.array(part[cuts]), pa.array(first, pa.binary()), pa.array(blocks, pa.binary())], ["part", "first", "block"])

        for batch in batches:
            for _, text in _read(batch, salt):
                trie.add(rows_of(text))
                while trie.size > HELD:
                    yield left(0.5)
        if trie.size:
            yield left(1.0)

    return texts.mapInArrow(run, "part int, first binary, block binary")


def _written(rows: np.ndarray, counts: np.ndarray) -> bytes:
    return np.concatenate((rows.T.reshape(-1), counts.view(np.uint64))).astype("<u8").tobytes()


def _blocks_read(blocks: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    columns = [np.frombuffer(b, "<u8").reshape(width + 1, -1) for b in blocks]
    whole = np.concatenate(columns, axis=1)
    return whole[:-1].T, whole[-1].view(np.int64)


def _in_order(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and counts of blocks that come by part and first row, merged: every part's rows in order.

    What lies before the first row of the next block is final, so no more is held than the
    blocks that overlap and about ``MERGED`` rows.
    """
    held, size, now = [], 0, None
    rows, counts = np.zeros((0, width), np.uint64), np.zeros(0, np.int64)

    def merged():
        more, times = _blocks_read(held, width)
        all_rows, all_counts = np.concatenate((rows, more)), np.concatenate((counts, times))
        by = np.lexsort(all_rows.T[::-1])
        return all_rows[by], all_counts[by]

    for batch in batches:
        for part, first, block in zip(*(batch.column(c).to_pylist() for c in ("part", "first", "block"))):
            if held and (part != now or size >= MERGED):
                rows, counts = merged()
                held, size = [], 0
                if part == now:
                    border = np.frombuffer(first, ">u8").astype(np.uint64)
                    below = np.zeros(len(rows), bool)
                    same = np.ones(len(rows), bool)
                    for k in range(width):
                        below |= same & (rows[:, k] < border[k])
                        same &= rows[:, k] == border[k]
                    final = int(below.sum())
                else:
                    final = len(rows)
                if final:
                    yield rows[:final], counts[:final]
                rows, counts = rows[final:], counts[final:]
            now = part
            held.append(block)
            size += len(block) // (8 * (width + 1))
    if held:
        yield merged()


def vocabulary(texts: DataFrame, salt: int) -> DataFrame:
    """(lang, word, id, n) of every word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        known: dict = {}

        def left():
            keys = list(held)
            rows = [known[k] for k in keys]
            out = pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array([held[k] for k in keys], pa.int64())], ["lang", "word", "id", "n"])
            held.clear()
            known.clear()
            return out

        for batch in batches:
            for names, text in _read(batch, salt):
                ids, first, counts = np.unique(text.ids, return_index=True, return_counts=True)
                raw = text.words.data
                for key, at, n in zip(ids.tolist(), first.tolist(), counts.tolist()):
                    if key not in known:
                        known[key] = (names[text.words.doc[at]], raw[text.words.start[at]:text.words.end[at]].tobytes().decode())
                    held[key] += n
                if len(held) > HELD // 4:
                    yield left()
        if held:
            yield left()

    found = texts.mapInArrow(run, "lang string, word string, id bigint, n bigint")
    return found.groupBy("lang", "word", "id").agg(F.sum("n").alias("n"))


def count_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): ``words`` (lang, word, id, n) of the whole vocabulary, ``phrases`` (ids, n) of one to five words found ``least`` times or more."""
    ship(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for salt in range(SALTS):
        words = materialize(vocabulary(texts, salt), "vocabulary")
        shared = words.groupBy("id").agg(F.count(F.lit(1)).alias("words"), F.max("n").alias("n")).filter((F.col("words") > 1) & (F.col("n") >= least))
        if shared.isEmpty():
            break
    else:
        raise RuntimeError("words share ids under every salt")
    phrases = words.filter(F.col("n") >= least).select(F.array("id").alias("ids"), "n")
    known = context.broadcast(bloom(phrases, phrases.count()))
    for shortest, longest in ((2, 2), (3, 3), (4, LONGEST)):
        runs = _runs(texts, salt, longest, shortest, _chains(known, shortest, longest))
        ordered = runs.repartition("part").sortWithinPartitions("part", "first")
        found = materialize(ordered.mapInArrow(_merge(shortest, longest, least), "ids array<bigint>, n bigint"), f"phrases-{shortest}")
        phrases = phrases.unionByName(found)
        if longest < LONGEST:
            known = context.broadcast(bloom(found, found.count()))
    return words, materialize(phrases, "phrases")


def _joint(ids: np.ndarray) -> np.ndarray:
    """One key for each row of ids."""
    out = mix(ids[:, 0])
    for column in ids.T[1:]:
        out = mix(out * np.uint64(3) + column)
    return out


def _chains(known, shortest: int, longest: int):
    """The windows of ``shortest`` to ``longest`` words whose runs of ``shortest - 1`` words are all let through by ``known``."""
    part = shortest - 1

    def windows(text: _Texts) -> np.ndarray:
        n = len(text.ids)
        ids = np.concatenate((text.ids, np.zeros(longest, np.uint64)))
        near = np.concatenate((text.joined, np.zeros(longest, bool)))  # the next word stands directly behind
        whole = np.ones(n, bool)
        for k in range(part - 1):
            whole &= near[k:k + n]
        at = np.flatnonzero(whole)
        good = np.zeros(n + longest, bool)  # a frequent run begins here
        if len(at):
            good[at] = lets_through(known.value, _joint(np.stack([ids[at + k] for k in range(part)], axis=1)))
        begin = np.flatnonzero(good[:n] & good[1:n + 1] & near[:n])
        out = np.zeros((len(begin), longest), np.uint64)
        whole = np.ones(len(begin), bool)
        for k in range(longest):
            if k >= shortest:
                whole &= good[begin + k - part + 1] & near[begin + k - 1]
            out[whole, k] = ids[begin[whole] + k]
        return out

    return windows


def _merge(shortest: int, longest: int, least: int):
    """Sums of the runs' rows in order for every prefix of ``shortest`` words or more, as each ends."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, tuple[np.ndarray, int]] = {}  # by length: the prefix that the last row has, and its sum so far

        def closed(phrases: list, counts: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(phrases, pa.list_(pa.int64())), pa.array(counts, pa.int64())], ["ids", "n"])

        for rows, n in _in_order(batches, longest):
            rows, phrases, counts = rows.view(np.int64) if rows.flags.c_contiguous else np.ascontiguousarray(rows).view(np.int64), [], []
            changed = np.zeros(len(rows) - 1, bool)
            for k in range(longest):
                changed |= rows[1:, k] != rows[:-1, k]
                if k + 1 < shortest:
                    continue
                starts = np.concatenate(([0], np.flatnonzero(changed) + 1))
                sums, keys = np.add.reduceat(n, starts), rows[starts, :k + 1]
                if k in open_:
                    key, before = open_[k]
                    if (key == keys[0]).all():
                        sums[0] += before
                    elif before >= least and key[-1]:
                        phrases.append(key)
                        counts.append(before)
                open_[k] = (keys[-1], int(sums[-1]))
                done = np.flatnonzero((sums[:-1] >= least) & (keys[:-1, -1] != 0))
                phrases += list(keys[done])
                counts += sums[done].tolist()
            if counts:
                yield closed(phrases, counts)
        last = [(key, n) for key, n in open_.values() if n >= least and key[-1]]
        if last:
            yield closed([key for key, _ in last], [n for _, n in last])

    return merge


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, scale: int = 1000) -> DataFrame:
    """The first ``top`` phrases of each language of ``docs`` (lang, text): lang, rank, phrase, a, l, r, n, score."""
    words, phrases = count_phrases(docs, least)
    length = F.size("ids")
    longer = phrases.filter(length > 1)
    # what a phrase that is one word longer and as frequent holds is left out; still longer ones imply such a one
    inner = phrases.filter(length > 2).select(
        F.explode(F.array(F.slice("ids", F.lit(1), length - 1), F.slice("ids", F.lit(2), length - 1))).alias("ids"), "n").distinct()
    kept = longer.join(inner, ["ids", "n"], "left_anti")
    cuts = kept.select("ids", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), length - 1)).alias("k")).select(
        "*", F.slice("ids", F.lit(1), F.col("k")).alias("left"), F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("right"))
    part = phrases.select(F.col("ids").alias("part"), F.col("n").alias("times"))
    scored = (cuts.join(part.withColumnsRenamed({"part": "left", "times": "l"}), "left")
              .join(part.withColumnsRenamed({"part": "right", "times": "r"}), "right"))
    names = words.filter(F.col("n") >= least).select("id", "lang", "word")
    totals = words.groupBy("lang").agg(F.sum("n").alias("all"))
    lang = names.select(F.col("id").alias("first"), "lang")
    scored = scored.withColumn("first", F.element_at("ids", 1)).join(lang, "first").join(totals, "lang")

    # a hundredth of a quintillion of occurrences fits; the products are exact
    score = F.expr(f"CAST({scale} AS DECIMAL(4,0)) * CAST(CAST(a AS DECIMAL(17,0)) * CAST(`all` AS DECIMAL(17,0)) AS DECIMAL(34,0)) div "
                   "CAST(CAST(l AS DECIMAL(17,0)) * CAST(r AS DECIMAL(17,0)) AS DECIMAL(34,0))")
    scored = scored.withColumn("score", score)
    best = scored.groupBy("lang", "ids", "a", "all").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "ids", "a", F.col("all").alias("n"), "cut.score", "cut.l", "cut.r")
    first = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    best = materialize(best.withColumn("place", F.rank().over(first)).filter(F.col("place") <= top).drop("place"), "collocations")
    spelled = best.select("*", F.posexplode("ids").alias("place", "id")).join(names.select("id", "word"), "id")
    spelled = spelled.groupBy("lang", "ids", "a", "n", "score", "l", "r").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return spelled.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
