"""Language-model scores from an Elias-Fano n-gram trie built and queried in shards.

Model: words of two, with a Dirichlet prior on the one-word model,

    p1(w)     = (c(w) + 1) / (N + V + 1)
    p(w | h)  = (c(h w) + mu * p1(w)) / (c(h) + mu)

which sums to one over the known words and one unknown word for every context h
(the word before, or the start of the text; the end of a text is a word).

1. Words are counted over the learning documents (summed within a batch, then by
   Spark) and written as the trie's first level: sorted hashes and counts, in files
   that tasks map into memory.
2. Each batch of texts looks its distinct words up there.  That gives the one-word
   score and the parts of log p(w | h) that need no pair; what is left is
   log(1 + c(h w) / (mu * p1(w))).  The batch's distinct pairs go to shards by the hash
   of the pair, as one compressed record for each batch and shard: pair, learning
   count, p1 in 256 steps, and the texts that hold it.
3. A shard merges its records into the trie's second level: contexts, monotone
   pointers to their successor lists (both Elias-Fano coded), and the counts in 256
   steps, with a list of those too large for a step.  The level is a file in the shared folder, mapped for the queries: a
   successor is searched within the range of its context.  The shard answers each
   record with a sum for each text.
4. The answers of a batch are added up.

A shard holds about ``SHARD`` pair occurrences whatever the corpus' size; what is
learnt and moved grows with the input.  Nothing is sampled or cut off.

Defined cases: a null or empty text is the end alone; a null doc_id is scored, not
learnt from and not held out; repeated rows count and score like others; with
nothing to learn from every word is unknown; other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path
from .elias_fano import decode, encode
from .job import filesystem, ship
from .words import Words, mix, pieces, signed

MU = 400.0
SHARD = 2_000_000   # pair occurrences of a shard, on average
BATCH = 8 << 20     # bytes of text of a record, about
FINEST = -14.0      # least log10 of p1 that the 256 steps reach
START = np.uint64(0x7AB1E5)
STOP = np.uint64(0x5709)
SPECIAL = np.array([START, np.uint64(0)]).view(np.int64)  # texts learnt from, and all tokens, among the counts
FILES = "name string, n bigint, least bigint, vocabulary bigint, tokens bigint, starts bigint, seen bigint"


def _tokens(text: Words) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts with the end after each, and each one's text."""
    n = text.texts
    out = np.empty(len(text.start) + n, np.uint64)
    doc = np.concatenate((text.doc, np.arange(n)))
    place = np.concatenate((np.arange(len(text.start)) + text.doc, np.cumsum(text.count) + np.arange(n)))
    out[place[:len(text.start)]] = text.hashes()
    out[place[len(text.start):]] = STOP
    order = np.empty_like(doc)
    order[place] = doc
    return out, order


def _gathered(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about BATCH bytes: (first row, next row, tokens, row of each token)."""
    first, size, tokens, rows, last = 0, 0, [], [], 0
    for at, to, text in pieces(batch, "text", lower=True):
        words, doc = _tokens(text)
        if to - first >= 1 << 16 or size and size + len(text.data) > BATCH:
            yield first, at, np.concatenate(tokens), np.concatenate(rows)
            first, size, tokens, rows = at, 0, [], []
        tokens.append(words)
        rows.append(doc + (at - first))
        size += len(text.data)
        last = to
    if tokens:
        yield first, last, np.concatenate(tokens), np.concatenate(rows)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the learning texts with their counts; START counts texts, and ``seen`` all tokens."""
    for batch in batches:
        learn = batch.column("learn").to_numpy(zero_copy_only=False)
        for at, to, tokens, rows in _gathered(batch):
            taken = learn[at:to]
            keys, n = np.unique(tokens[taken[rows]], return_counts=True)
            keys = np.append(keys, [START, np.uint64(0)])
            n = np.append(n, [taken.sum(), len(tokens)])
            yield pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(n.astype(np.int64))], ["word", "n"])


def _level_writer(folder: str):
    """The first level: one file of sorted hashes and counts for each range of hashes."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        context = TaskContext.get()
        table = pa.concat_tables(tables)
        words, counts = table["word"].to_numpy(), table["n"].to_numpy()
        fs, base = filesystem(folder)
        name = f"words-{context.partitionId():06d}.bin"
        draft = f"{base}/.{name}-{context.taskAttemptId()}"
        with fs.open_output_stream(draft) as out:
            out.write(words.tobytes())
            out.write(counts.tobytes())
        fs.move(draft, f"{base}/{name}")
        special = [int(counts[words == x].sum()) for x in SPECIAL]
        rest = int(counts.sum()) - sum(special)
        own = len(words) - int(np.isin(words, SPECIAL).sum())
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (name, len(words), int(words[0]), own, rest, *special)],
                                         [c.split()[0] for c in FILES.split(", ")])
    return write


def _mapped(folder: str, name: str, kind, count: int, at: int) -> np.ndarray:
    """A part of a shared file as an array: mapped where the file system is local, read elsewhere."""
    fs, base = filesystem(folder)
    if fs.type_name == "local":
        return np.memmap(f"{base}/{name}", kind, "r", at, (count,))
    with fs.open_input_file(f"{base}/{name}") as source:
        return np.frombuffer(source.read_at(count * np.dtype(kind).itemsize, at), kind)


class Level:
    """Counts of words, looked up in the mapped files."""

    def __init__(self, folder: str, files: list[tuple[str, int, int]]):
        self.files = sorted(files, key=lambda f: f[2])
        self.least = np.array([f[2] for f in self.files], np.int64)
        self.words = [_mapped(folder, name, np.int64, n, 0) for name, n, _ in self.files]
        self.counts = [_mapped(folder, name, np.int64, n, 8 * n) for name, n, _ in self.files]

    def look_up(self, sorted_words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(sorted_words), np.int64)
        cut = np.searchsorted(sorted_words, self.least)
        for i, (words, counts) in enumerate(zip(self.words, self.counts)):
            to = cut[i + 1] if i + 1 < len(cut) else len(sorted_words)
            own = sorted_words[cut[i]:to]
            at = np.searchsorted(words, own)
            at[at == len(words)] = 0
            out[cut[i]:to] = np.where(words[at] == own, counts[at], 0) if len(own) else 0
        return out


_levels: dict[str, Level] = {}


def _pack(*arrays: np.ndarray) -> bytes:
    import zstandard

    raw = b"".join(struct.pack("<Q", a.nbytes) + a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    import zstandard

    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind in kinds:
        size = struct.unpack_from("<Q", raw, at)[0]
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at + 8))
        at += 8 + size
    return out


#: Pairs, learning counts, p1 steps, numbers of texts, texts, times in the text (low and high half: the high one packs to nothing).
RECORD = ("<u8", "<u4", "u1", "<u4", "<u2", "<u2", "<u2")


def _records(folder: str, files, total: int, vocabulary: int, starts: int, shards: int, mu: float):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if folder not in _levels:
            _levels.clear()
            _levels[folder] = Level(folder, files)
        level = _levels[folder]
        turn = 0
        for batch in batches:
            learn = batch.column("learn").to_numpy(zero_copy_only=False)
            for at, to, tokens, rows in _gathered(batch):
                texts = to - at
                words, inverse = np.unique(signed(tokens), return_inverse=True)
                counts = level.look_up(words)
                logs = np.log10((counts + 1) / (total + vocabulary + 1))
                known = np.bincount(rows, counts[inverse] > 0, texts).astype(np.int64)
                base = np.bincount(rows, logs[inverse], texts)
                first = np.ones(len(rows), bool)
                first[1:] = rows[1:] != rows[:-1]
                before = np.where(first, START, np.roll(tokens, 1))
                context = np.where(first, starts, np.roll(counts[inverse], 1))
                fixed = base + np.bincount(rows, np.log10(mu) - np.log10(context + mu), texts)
                number = (TaskContext.get().partitionId() << 32) + turn  # the same if the task runs again
                turn += 1
                sizes = np.bincount(rows, minlength=texts).astype(np.int64)
                head = _pack(sizes, known, base, fixed)
                ids = batch.column("doc_id").slice(at, texts)
                held = batch.column("held").slice(at, texts)
                doc = pa.StructArray.from_arrays([ids, held], ["doc_id", "held"])
                # a pair is the hash of both words' halves: context above, successor below
                pair = (mix(before) & np.uint64(0xFFFFFFFF00000000)) | (mix(tokens) >> np.uint64(32))
                by = np.argsort(pair, kind="stable")  # then by text, as rows ascend
                pair, row = pair[by], rows[by]
                code = np.clip(np.rint((logs[inverse][by] / FINEST) * 255), 0, 255).astype(np.uint8)
                new = np.ones(len(pair), bool)
                new[1:] = (pair[1:] != pair[:-1]) | (row[1:] != row[:-1])
                place = np.flatnonzero(new)
                times = np.diff(np.append(place, len(pair)))
                pair, row, code = pair[place], row[place], code[place]
                taught = np.where(learn[at:to][row], times, 0)
                lead = np.ones(len(pair), bool)
                lead[1:] = pair[1:] != pair[:-1]
                lead = np.flatnonzero(lead)
                count = np.add.reduceat(taught, lead) if len(lead) else np.zeros(0, np.int64)
                own, steps = pair[lead], code[lead]
                ends = np.append(lead[1:], len(pair))
                shard = (mix(own) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                present, cut = np.unique(shard[order], return_index=True)
                cut = np.append(cut, len(order))
                out_shard, blobs = [int(number % shards)], [head]
                for j, s in enumerate(present.tolist()):
                    some = order[cut[j]:cut[j + 1]]
                    n = ends[some] - lead[some]
                    begin = np.concatenate(([0], np.cumsum(n)))
                    flat = np.repeat(lead[some] - begin[:-1], n) + np.arange(begin[-1])
                    out_shard.append(s)
                    blobs.append(_pack(own[some], count[some].astype("<u4"), steps[some], n.astype("<u4"),
                                       row[flat].astype("<u2"), (times[flat] & 0xFFFF).astype("<u2"), (times[flat] >> 16).astype("<u2")))
                many = len(blobs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_shard, pa.int32()), pa.array(np.full(many, number)), pa.array([True] + [False] * (many - 1)),
                     pa.array(np.full(many, texts, np.int32)),
                     pa.array([doc.to_pylist()] + [None] * (many - 1), pa.list_(pa.struct([("doc_id", pa.int64()), ("held", pa.bool_())]))),
                     pa.array(blobs, pa.binary())], ["shard", "batch", "head", "texts", "docs", "blob"])
    return make


ROWS = "shard int, batch bigint, head boolean, texts int, docs array<struct<doc_id:bigint,held:boolean>>, blob binary"


class Trie:
    """A shard's second level: contexts, pointers, successors and counts in 256 steps."""

    @staticmethod
    def build(pairs: np.ndarray, counts: np.ndarray) -> bytes:
        context, successor = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
        contexts, first = np.unique(context, return_index=True)
        pointers = np.append(first, len(pairs)).astype(np.uint64)
        rank = np.searchsorted(contexts, context).astype(np.uint64)
        steps = _steps(counts)
        large = np.flatnonzero(steps == 255)
        # successors made monotone by the rank of their context
        return b"".join((encode(contexts), encode(pointers), encode((rank << np.uint64(32)) | successor),
                         struct.pack("<QQ", len(steps), len(large)), steps.tobytes(),
                         large.astype("<i8").tobytes(), counts[large].astype("<i8").tobytes()))

    def __init__(self, raw):
        self.contexts, at = decode(raw)
        self.pointers, at = decode(raw, at)
        self.successors, at = decode(raw, at)
        n, large = struct.unpack_from("<QQ", raw, at)
        self.steps = np.frombuffer(raw, np.uint8, n, at + 16)
        self.large = np.frombuffer(raw, "<i8", large, at + 16 + n)
        self.large_counts = np.frombuffer(raw, "<i8", large, at + 16 + n + 8 * large)

    def count(self, pairs: np.ndarray) -> np.ndarray:
        """Counts of pairs: the successor is searched within its context's range."""
        if not len(self.contexts):
            return np.zeros(len(pairs))
        context, successor = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
        rank = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        known = self.contexts[rank] == context
        wanted = (rank.astype(np.uint64) << np.uint64(32)) | successor
        at = np.searchsorted(self.successors, wanted)
        inside = known & (at < self.pointers[rank + 1].astype(np.int64))
        at = np.where(inside, at, 0)
        return np.where(inside & (self.successors[at] == wanted), self._at(at), 0.0)

    def _at(self, places: np.ndarray) -> np.ndarray:
        """Counts at the places asked for; every batch of texts asks, so the whole level is never worked out."""
        steps = self.steps[places]
        values = _values(steps)
        listed = np.flatnonzero(steps == 255)
        values[listed] = self.large_counts[np.searchsorted(self.large, places[listed])]
        return values


def _steps(counts: np.ndarray) -> np.ndarray:
    """Counts to 64 exactly, larger ones in steps of 7 percent; 255 stands for those beyond, which a level lists."""
    large = 64 + np.rint(np.log(np.maximum(counts, 64) / 64) / np.log(1.07))
    return np.where(counts <= 64, counts, np.minimum(large, 255)).astype(np.uint8)


def _values(steps: np.ndarray) -> np.ndarray:
    s = steps.astype(np.float64)
    return np.where(s <= 64, s, 64 * 1.07 ** (s - 64))


def _answer(folder: str, mu: float):
    """Build each shard's level, write and map it, and answer the shard's records; rows come sorted by shard."""
    def solve(shard: int, blobs: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        pairs, counts = zip(*(_unpack(b, *RECORD)[:2] for _, _, b in blobs))
        pairs, counts = np.concatenate(pairs), np.concatenate(counts)
        taught = counts > 0
        pairs, counts = pairs[taught], counts[taught]
        by = np.argsort(pairs, kind="stable")
        pairs, counts = pairs[by], counts[by].astype(np.int64)
        lead = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1]))) if len(pairs) else np.zeros(0, np.int64)
        raw = Trie.build(pairs[lead], np.add.reduceat(counts, lead) if len(lead) else counts)
        fs, base = filesystem(folder)
        name = f"pairs-{shard:06d}.bin"
        draft = f"{base}/.{name}-{TaskContext.get().taskAttemptId()}"
        with fs.open_output_stream(draft) as out:
            out.write(raw)
        fs.move(draft, f"{base}/{name}")
        trie = Trie(memoryview(_mapped(folder, name, np.uint8, len(raw), 0)))
        for batch, texts, blob in blobs:
            own, _, code, n, row, low, high = _unpack(blob, *RECORD)
            gain = np.log10(1 + trie.count(own) / (mu * 10.0 ** (code / 255 * FINEST)))
            per = np.repeat(gain, n)
            sums = np.bincount(row, per * (low + high * 65536.0), texts)
            yield _row(batch, False, texts, None, sums.tobytes())

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                s, number, head, texts, docs, blob = (batch.column(c)[i] for c in ("shard", "batch", "head", "texts", "docs", "blob"))
                if head.as_py():
                    yield _row(number.as_py(), True, texts.as_py(), docs.as_py(), blob.as_py())
                    continue
                if s.as_py() != shard and held:
                    yield from solve(shard, held)
                    held = []
                shard = s.as_py()
                held.append((number.as_py(), texts.as_py(), blob.as_py()))
        if held:
            yield from solve(shard, held)
    return answer


DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("held", pa.bool_())]))


def _row(batch: int, head: bool, texts: int, docs, blob: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), pa.array([head]), pa.array([texts], pa.int32()),
                                       pa.array([docs], DOCS), pa.array([blob], pa.binary())], ["batch", "head", "texts", "docs", "blob"])


def _add_up(total: int):
    """Sum the answers of each batch of texts; rows come sorted by batch."""
    def finish(head, sums: np.ndarray) -> pa.RecordBatch:
        docs, blob = head
        sizes, known, base, fixed = _unpack(blob, np.int64, np.int64, np.float64, np.float64)
        return pa.RecordBatch.from_arrays(
            [pa.array([d["doc_id"] for d in docs], pa.int64()), pa.array([d["held"] for d in docs], pa.bool_()),
             pa.array(sizes), pa.array(known), pa.array(np.full(len(docs), total)), pa.array(base), pa.array(fixed + sums)],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, head, sums = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.column("batch")[i].as_py()
                if key != number and number is not None:
                    yield finish(head, sums)
                    sums = None
                number = key
                if sums is None:
                    sums = np.zeros(batch.column("texts")[i].as_py())
                if batch.column("head")[i].as_py():
                    head = (batch.column("docs")[i].as_py(), batch.column("blob")[i].as_py())
                else:
                    sums += np.frombuffer(batch.column("blob")[i].as_py())
        if number is not None:
            yield finish(head, sums)
    return add


def score(docs: DataFrame, learn, held, mu: float = MU, folder: str | None = None) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) by a model of the rows where ``learn`` holds.

    ``learn`` and ``held`` are boolean columns; ``held`` is passed on as held_out.
    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or scratch_path(spark, "trie")
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(learn, F.lit(False)).alias("learn"),
                        F.coalesce(held, F.lit(False)).alias("held"))
    counts = texts.select("text", "learn").mapInArrow(_counts, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    level = counts.repartitionByRange("word").sortWithinPartitions("word").mapInArrow(_level_writer(folder), FILES)
    found = level.collect()  # a row for each range of words
    files = [(r["name"], r["n"], r["least"]) for r in found]
    vocabulary, total, starts, seen = (sum(r[c] for r in found) for c in ("vocabulary", "tokens", "starts", "seen"))
    shards = max(1, -(-seen // SHARD))
    records = texts.mapInArrow(_records(folder, files, total, vocabulary, starts, shards, mu), ROWS)
    answers = (records.repartition(F.col("shard")).sortWithinPartitions("shard")
               .mapInArrow(_answer(folder, mu), "batch bigint, head boolean, texts int, docs array<struct<doc_id:bigint,held:boolean>>, blob binary"))
    return answers.repartition("batch").sortWithinPartitions("batch").mapInArrow(
        _add_up(total), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
