"""Toxicity of whole texts after noisy-channel deobfuscation.

Disguised words (digits and signs for letters in any place, letters set apart by
points, dashes or blanks, letters repeated) are read as the output of a noisy channel.
Each is a lattice of characters; the Viterbi path under a character language
model plus the channel's costs is the restored word, and takes its place in the
text.  The restored text is scored by the words and word beginnings it holds.

Learning.  From all labelled rows: the character model from the words of both
classes, the evidence from how many documents and how many different contexts of each
class a word or word beginning occurs in.  Contexts count so that copies of one text
count once.  The score is the posterior of the label under independent evidence.
Counting is done by Spark; what comes to the driver is the model, evidence that passes
all tests and character n-grams.

Nulls: a null or empty text has the score of no evidence; a null label or doc_id
is not learnt from; with several labels for a document the larger one holds; with
no label of one class every score is 0.5.  Repeated rows are scored alike.  Other
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .bitmap import bitmap, let_through
from .job import narrow, ship
from .words import LOWER, Words, mix, release, utf8

CONTEXTS = 4          # different contexts in toxic texts that evidence needs
WEIGHT = 2.5          # least log ratio of evidence
DISCOUNT = 2.0        # taken off each evidence's log ratio: a word and its beginnings are not independent
PREFIXES = (4, 5, 6)  # bytes of a word's beginning that are evidence besides the whole word
ORDER = 4             # characters of the character model
THRESHOLD = 0.7
PIECE = 1 << 20
PENDING = 1 << 20     # counted keys that a task holds before it passes them on
SCALE = 1 << 30       # log counts are added up as whole multiples of this one's inverse, in any order alike

# Which letters a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
SWAP, DROP, DOUBLE = -1.5, -0.7, -0.3  # log costs: a sign for a letter, a filler left out, a repeated letter
BREAK = -3.0                           # a blank of a spaced row that parts two words
MARK, KEEP = -0.3, -2.5                # punctuation, other signs left as they are at a word's ends
FILLERS, MARKS = " .-_*", "!.-_*|(¡"
SHORT = 64                             # longest words that are remembered

LETTERS = r"[^\W\d_]"
SIGNS = re.escape("".join(LEET))
#: Single letters and signs set apart, or a run that TRIGGER looks into.
DISGUISED = re.compile(
    rf"(?<!\w)(?:{LETTERS}|[{SIGNS}])(?:[\s.\-_*]+(?:{LETTERS}|[{SIGNS}])){{2,}}(?!\w)"
    rf"|[\w{SIGNS}.\-_*]{{3,}}")
#: A sign that can be a letter, letters set apart, or three equal letters.
TRIGGER = re.compile(rf"[{SIGNS}]|\s|{LETTERS}[.\-_*]+{LETTERS}|({LETTERS})\1\1", re.IGNORECASE)
_letter = re.compile(LETTERS)
_repeat = re.compile(r"(.)\1{3,}", re.DOTALL)
_gap = re.compile(r"\s+")
_sign, _filler = np.zeros(256, bool), np.zeros(256, bool)
_sign[list("".join(LEET).encode())] = True  # of the signs of several bytes, each byte
_filler[list(b".-_*")] = True


def _ngrams(word: str) -> Iterator[tuple[str, str]]:
    """Each character of a word, its end included, with its contexts of up to ``ORDER - 1`` characters."""
    text = "^" * (ORDER - 1) + word + "$"
    for i in range(ORDER - 1, len(text)):
        for k in range(ORDER):
            yield text[i - k:i], text[i]


class CharModel:
    """Smoothed n-gram model of the characters of words, ends included."""

    def __init__(self, words: dict[str, int]):
        counts: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
        for word, n in words.items():
            for context, char in _ngrams(word):
                counts[context][char] += math.log1p(n)
        self._set({c: dict(v) for c, v in counts.items()})

    @classmethod
    def counted(cls, ngrams: Iterator[tuple[str, str, float]]) -> "CharModel":
        """From the summed log counts of (context, character)."""
        counts: dict[str, dict[str, float]] = defaultdict(dict)
        for context, char, total in ngrams:
            counts[context][char] = total
        model = cls.__new__(cls)
        model._set(dict(counts))
        return model

    def _set(self, counts: dict[str, dict[str, float]]) -> None:
        self.counts = counts
        self.totals = {c: sum(v.values()) for c, v in counts.items()}

    def log(self, context: str, char: str) -> float:
        p = 1e-4
        for k in range(ORDER):
            own = self.counts.get(context[len(context) - k:] if k else "")
            if own is None:
                break
            kinds = len(own)
            total = self.totals[context[len(context) - k:] if k else ""]
            p = (own.get(char, 0.0) + kinds * p) / (total + kinds)
        return math.log(p)


class Restorer:
    """Viterbi decoding of disguised words; remembers what it has decoded."""

    def __init__(self, model: CharModel):
        self.model = model
        self.restore = lru_cache(maxsize=20_000)(self._restore)
        self.fix = lru_cache(maxsize=20_000)(self._fix)
        self.log = lru_cache(maxsize=100_000)(model.log)

    def _fix(self, raw: bytes) -> bytes:
        return restore_text(raw.decode("utf-8", "replace"), self).encode("utf-8", "replace")

    def _restore(self, token: str) -> str:
        start, ended = "^" * (ORDER - 1), "$"
        # state: last characters and the last letter read, which a repetition may share;
        # what was written is a chain (before, character), so a long word costs no copies
        best: dict[tuple[str, str], tuple[float, tuple | None]] = {(start, ""): (0.0, None)}
        for char in _repeat.sub(r"\1\1\1", _gap.sub(" ", token.lower())):
            after: dict[tuple[str, str], tuple[float, tuple | None]] = {}

            def move(key: tuple[str, str], value: float, out: tuple | None) -> None:
                if key not in after or after[key][0] < value:
                    after[key] = (value, out)

            letter = char.isalpha()
            options = [(char, 0.0)] if letter else [(c, SWAP) for c in LEET.get(char, "")]
            filler = char in FILLERS or not options
            keep = MARK if char in MARKS else KEEP
            for (context, last), (score, out) in best.items():
                if context == ended:  # only what is left as it is, to the next blank
                    if char == " ":
                        move((start, ""), score + BREAK, (out, char))
                    elif not letter:
                        move((ended, ""), score + keep, (out, char))
                    continue
                for c, cost in options:
                    move(((context + c)[1:], c), score + cost + self.log(context, c), (out, c))
                    if c == last:  # read again, written once
                        move((context, last), score + cost + DOUBLE, out)
                if filler:
                    move((context, last), score + DROP, out)
                if not letter:
                    if context == start:
                        if char != " ":
                            move((start, ""), score + keep, (out, char))
                        continue
                    end = score + self.log(context, "$")
                    if char == " ":
                        move((start, ""), end + BREAK, (out, char))
                    else:
                        move((ended, ""), end + keep, (out, char))
            best = after
            if not best:
                return token
        _, chain = max(((s + (0.0 if c == ended else self.log(c, "$")), o) for (c, _), (s, o) in best.items()), key=lambda x: x[0])
        chars = []
        while chain is not None:
            chain, c = chain
            chars.append(c)
        return "".join(reversed(chars))


def restore_text(text: str, restorer: Restorer) -> str:
    """The text with each disguised word replaced; signs at a word's ends stay where that is likelier than a letter."""
    def one(match: re.Match) -> str:
        word = match.group(0)
        if not _letter.search(word) or not TRIGGER.search(word):
            return word
        return restorer.restore(word) if len(word) <= SHORT else restorer._restore(word)

    return DISGUISED.sub(one, text)


_WORD_EDGE = np.ones(256, bool)
_WORD_EDGE[97:123] = False
_WORD_EDGE[128:] = False


class Letters(Words):
    """Words as runs of letters: ASCII's, lower-cased, and all bytes beyond ASCII."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = LOWER[data]
        data = np.where(_WORD_EDGE[data], np.uint8(32), data)
        super().__init__(data, offsets)

    def evidence(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, text, word) of every whole word and of its beginnings."""
        size = self.end - self.start
        keys, rows, at = [mix(self.hashes())], [self.doc], [np.arange(len(size))]
        for n in PREFIXES:
            long = np.flatnonzero(size >= n)
            own = self.range_hash(self.start[long], self.start[long] + n)
            keys.append(mix(own + np.uint64(n)))
            rows.append(self.doc[long])
            at.append(long)
        return np.concatenate(keys), np.concatenate(rows), np.concatenate(at)


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges that can hold a disguise: words with letters and a sign in any place, a filler
    before a letter or three equal letters, and rows of three or more words of one letter or sign."""
    low = LOWER[data]
    letter = ((low >= 97) & (low <= 122)) | (low >= 128)
    spot = _sign[data]
    spot[:-1] |= _filler[data[:-1]] & letter[1:]
    spot[2:] |= letter[2:] & (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2])
    text = Words(data, offsets)
    start, end = text.start, text.end
    letters, spots, chars, signs = (np.concatenate(([0], np.cumsum(x, dtype=np.int32))) for x in (
        letter, spot, (data & 0xC0) != 0x80, letter & ((data & 0xC0) != 0x80) | (data >= 48) & (data <= 57)))

    def held(sums: np.ndarray) -> np.ndarray:
        return sums[end] - sums[start]

    some = held(letters) > 0
    word = some & (held(spots) > 0) & (held(chars) >= 3)
    # a letter or sign alone, with up to two signs of punctuation
    alone = np.flatnonzero((held(signs) <= 1) & (held(chars) <= 3))
    words = np.stack((start[word], end[word]))
    if len(alone):
        edge = np.flatnonzero((np.diff(alone) != 1) | (np.diff(text.doc[alone]) != 0))
        first, last = alone[np.append(0, edge + 1)], alone[np.append(edge, len(alone) - 1)]
        row = (last - first >= 2) & (letters[end[last]] > letters[start[first]])
        words = np.concatenate((np.stack((start[first[row]], end[last[row]])), words), axis=1)
        words = words[:, np.argsort(words[0], kind="stable")]  # of two at one place the row first
    if words.shape[1]:
        clear = np.ones(words.shape[1], bool)
        clear[1:] = words[0, 1:] >= np.maximum.accumulate(words[1])[:-1]
        words = words[:, clear]
    return words[0], words[1]


def _restored(data: np.ndarray, offsets: np.ndarray, restorer: Restorer | None) -> tuple[np.ndarray, np.ndarray]:
    """The texts with their disguised words restored."""
    if restorer is None or len(offsets) < 2 or len(data) < 3:
        return data, offsets
    parts, last, moved, where = [], 0, [], []
    spans = [x + offsets[a] for a, b in _cuts(offsets)
             for x in [np.stack(_spans(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]))]]
    for start, end in np.concatenate(spans, axis=1).T.tolist():
        raw = data[start:end].tobytes()
        new = restorer.fix(raw) if len(raw) <= SHORT else restorer._fix(raw)
        if new != raw:
            parts += [data[last:start], np.frombuffer(new, np.uint8)]
            last = end
            where.append(start)
            moved.append(len(new) - len(raw))
    if not parts:
        return data, offsets
    parts.append(data[last:])
    shift = np.concatenate(([0], np.cumsum(moved)))
    return np.concatenate(parts), offsets + shift[np.searchsorted(where, offsets, "left")]


def _cuts(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1)
        yield at, to
        at = to


def _evidence(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, row, word before) of the evidence in a batch of texts, a piece at a time."""
    data, offsets = utf8(batch.column("text"))
    for at, to in _cuts(offsets):
        part = offsets[at:to + 1]
        text = Letters(data[part[0]:part[-1]], part - part[0])
        keys, rows, word = text.evidence()
        before = np.concatenate((np.zeros(1, np.uint64), text.hashes()[:-1])) if len(text.start) else np.zeros(0, np.uint64)
        yield keys, at + rows, before[word]
    release()


def _marked(shared):
    """Texts whose doc_id the bitmap lets through."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(let_through(shared.value, batch.column("doc_id").to_numpy())))
    return keep


def _documents(repeated, candidates):
    """Rows (key, doc, n): how many texts of a task hold a key; those of a doc_id that may occur again one by one, with it."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = repeated.value
        wanted = candidates.value if candidates is not None else None
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, n = (np.concatenate(x) for x in zip(*held))
            keys, at = np.unique(keys, return_inverse=True)
            return keys, np.bincount(at, weights=n, minlength=len(keys)).astype(np.int64)

        def rows(keys: np.ndarray, docs: pa.Array, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), docs, pa.array(n)], ["key", "doc", "n"])

        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            single = ~let_through(again, ids)
            for keys, at, _ in _evidence(batch):
                if wanted is not None:
                    keep = let_through(wanted, keys.view(np.int64))
                    keys, at = keys[keep], at[keep]
                _, first = np.unique(mix(keys + mix(at.astype(np.uint64))), return_index=True)
                keys, at = keys[first], at[first]
                own = single[at]
                if not own.all():
                    yield rows(keys[~own], pa.array(ids[at[~own]]), np.ones((~own).sum(), np.int64))
                found, n = np.unique(keys[own], return_counts=True)
                held.append((found, n))
            if sum(len(k) for k, _ in held) > 2 * PENDING:
                held = [merged()]
                if len(held[0][0]) > PENDING:
                    keys, n = held.pop()
                    yield rows(keys, pa.nulls(len(keys), pa.int64()), n)
        if held:
            keys, n = merged()
            yield rows(keys, pa.nulls(len(keys), pa.int64()), n)
    return count


def _contexts(candidates):
    """Rows (key, context) of the candidates, the different ones of each piece."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = candidates.value
        for batch in batches:
            for keys, _, context in _evidence(batch):
                keep = let_through(wanted, keys.view(np.int64))
                keys, context = keys[keep], context[keep]
                _, first = np.unique(mix(keys + mix(context)), return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[first].view(np.int64)), pa.array(context[first].view(np.int64))], ["key", "context"])
    return find


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Plain words of texts with counts, for the character model."""
    plain = re.compile(rf"{LETTERS}{{2,24}}")
    for batch in batches:
        counts: dict[str, int] = defaultdict(int)
        for text in batch.column("text").to_pylist():
            for word in plain.findall((text or "").lower()):
                counts[word] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def _characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Character n-grams of words with their whole-number log counts."""
    for batch in batches:
        sums: dict[tuple[str, str], int] = defaultdict(int)
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            weight = round(math.log1p(n) * SCALE)
            for pair in _ngrams(word):
                sums[pair] += weight
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in sums], pa.string()), pa.array([c for _, c in sums], pa.string()), pa.array(list(sums.values()), pa.int64())],
            ["context", "char", "total"])


class ToxicityModel:
    """What scoring needs: the evidence that passes all tests, and the character n-grams."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, prior: float, chars: CharModel | None):
        by = np.argsort(keys)
        self.keys, self.weights, self.prior = keys[by], weights[by], prior
        self.chars = chars

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.full(len(offsets) - 1, self.prior)
        if len(self.keys):
            for at, to in _cuts(offsets):
                part = offsets[at:to + 1]
                text = Letters(data[part[0]:part[-1]], part - part[0])
                keys, rows, _ = text.evidence()
                place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                hit = self.keys[place] == keys
                pair = np.unique(rows[hit] * len(self.keys) + place[hit])
                np.add.at(total, at + pair // len(self.keys), self.weights[pair % len(self.keys)])
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from all rows of ``labels`` (doc_id, toxic) and their texts."""
    spark = docs.sparkSession
    ship(spark)
    marks = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    texts = narrow(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    marks = materialize(marks, "marks")
    marked = spark.sparkContext.broadcast(bitmap(marks.select(F.col("doc_id").alias("key"))))  # 4 MB
    # marks grow with the corpus, so they are not broadcast; the bitmap keeps most other texts out of the shuffle
    known = texts.filter("doc_id IS NOT NULL").mapInArrow(_marked(marked), "doc_id bigint, text string")
    rows = materialize(known.join(marks.hint("merge"), "doc_id").select("doc_id", "text", "toxic"), "labelled")
    own = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
    own = materialize(own, "counted")
    counts = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 0.0, None)
    again = spark.sparkContext.broadcast(bitmap(own.filter("n > 1").select(F.col("doc_id").alias("key"))))  # 4 MB

    def documents(toxic: int, candidates=None) -> DataFrame:
        """Number of documents that hold a key: texts, but those of one doc_id once."""
        held = rows.filter(F.col("toxic") == toxic).mapInArrow(_documents(again, candidates), "key bigint, doc bigint, n bigint")
        once = held.groupBy("key", "doc").agg(F.sum("n").alias("n"))
        return once.groupBy("key").agg(F.sum(F.when(F.col("doc").isNull(), F.col("n")).otherwise(1)).alias("n"))

    toxic = materialize(documents(1).filter(F.col("n") >= CONTEXTS).withColumnRenamed("n", "docs"), "toxic-keys")
    some = spark.sparkContext.broadcast(bitmap(toxic))  # 4 MB
    # contexts can only lower a key's count, so what is too weak without them is out
    weight = F.log((F.col("docs") + 0.5) / (counts[1] + 1)) - F.log((F.col("clean") + 1) / (counts[0] + 1))
    clean = documents(0, some).withColumnRenamed("n", "clean")
    strong = toxic.join(clean, "key", "left").na.fill(0, ["clean"]).filter(weight >= WEIGHT - 1e-9)
    strong = materialize(strong, "candidates")
    some = spark.sparkContext.broadcast(bitmap(strong))
    contexts = (rows.filter("toxic = 1").mapInArrow(_contexts(some), "key bigint, context bigint")
                .groupBy("key").agg(F.count_distinct("context").alias("contexts")))
    found = (strong.join(contexts, "key").withColumn("docs", F.least("docs", "contexts"))
             .filter((F.col("docs") >= CONTEXTS) & (weight >= WEIGHT - 1e-9)).select("key", "docs", "clean").toArrow())
    keys = found["key"].to_numpy().astype(np.int64).view(np.uint64)
    weights = np.log((found["docs"].to_numpy() + 0.5) / (counts[1] + 1)) - np.log((found["clean"].to_numpy() + 1.0) / (counts[0] + 1))
    keep = weights >= WEIGHT
    words = rows.mapInArrow(_vocabulary, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter("n >= 3")
    ngrams = (words.mapInArrow(_characters, "context string, char string, total bigint")
              .groupBy("context", "char").agg(F.sum("total").alias("total")).orderBy("context", "char").toArrow().to_pydict())
    chars = CharModel.counted(zip(ngrams["context"], ngrams["char"], (t / SCALE for t in ngrams["total"])))
    return ToxicityModel(keys[keep], weights[keep] - DISCOUNT, math.log(counts[1] / counts[0]), chars if chars.counts else None)


def _scorer(shared, column: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ToxicityModel = shared.value
        # what it remembers is built anew by each task, so that a worker that goes on to other work does not keep it
        restorer = Restorer(model.chars) if model.chars else None
        for batch in batches:
            data, offsets = _restored(*utf8(batch.column(column)), restorer)
            scores = pa.array(model.score(data, offsets))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])
            release()
    return score


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # strong evidence and character n-grams
    texts = narrow(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return texts.mapInArrow(_scorer(shared, "text"), "doc_id bigint, score double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns kept whatever their names."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = []

        def seen():
            for batch in batches:
                whole.append(batch)
                yield batch

        for scored in _scorer(shared, "text")(seen()):
            yield whole.pop().filter(pa.array(scored.column("score").to_numpy() < threshold))

    return docs.mapInArrow(clean, docs.schema)


def in_fold(doc_id, parts: int, held: int):
    """Whether crc32 of the id's text leaves the held-out remainder."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts)) == held
