"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds to them.

The patterns give e-mail addresses, IPv4 addresses, payment cards and phone numbers,
leftmost and non-overlapping for each kind.  The random field reads the words around
digits, at-signs and the word at (alone or in brackets, in any case).  A segment of up to ``LONGEST`` words is scored as a whole (its
shape, digit counts, checksum, the word before it, ...) for each kind; dynamic
programming over all segmentations finds the best boundaries and kinds together,
and a segment is added if its probability under the model is ``SURE`` or more and
it overlaps nothing that the patterns found.

Training data are the patterns' own finds in all rows, together with rewritten forms of
them that the patterns miss (no plus sign, other separators, spelled-out at-signs) and
broken forms that are no finds (wrong check digit, a part above 255).  A table of more
than about ``SHARD`` rows is dealt by hash to shards of that size; each trains a model on
all of its examples, and the field's weights are the means over the shards (mixture
weights, Mann et al. 2009).  The deal depends on ids and texts only.

Places are code points, ends exclusive.  A null or empty text has no spans; rows are
read one by one, so repeated rows get equal spans and a null doc_id changes
nothing; an empty table gives an empty one and an untrained model adds nothing.
"""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .job import narrow, ship
from .words import LOWER, SPACE, Words, pieces, release, utf8

KINDS = ("email", "ip", "card", "phone")  # also the order of spans with one start
LONGEST = 6       # words of a segment, at most
SURE = 0.9
SHARD = 16_000    # rows whose examples one task trains on, about; all rows are in a shard
UPDATES = 24_000  # examples that training visits, at least: small shards are gone through more often
STEP = 0.5
SHRINK = 1e-3
SCALE = 1 << 30   # weights are added up as whole multiples of this one's inverse, in any order alike

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = "()[]{}<>\"'.,;:!?"
#: A word that a segment can begin from: with a digit or an at-sign, or with an at in brackets or alone.
BRACKETED = r"[\[({<]at[\])}>]"
MARKED = re.compile(rf"[0-9@]|{BRACKETED}|^[{re.escape(EDGES)}]*at[{re.escape(EDGES)}]*$", re.IGNORECASE)
DOT = re.compile(rf"^[{re.escape(EDGES)}]*dot[{re.escape(EDGES)}]*$", re.IGNORECASE)
SPELLED = re.compile(rf"{BRACKETED}| at .+ dot ", re.IGNORECASE)

Span = tuple[int, int, str]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """An address holds one at-sign, so at-signs are visited instead of all places."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end(), "email"
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """What the fixed patterns find, by start and then kind."""
    found = list(_emails(text))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _shape(text: str) -> str:
    out = []
    for c in text:
        kind = "9" if c.isdigit() else "a" if c.isalpha() else c
        if not out or out[-1] != kind or kind not in "9a":
            out.append(kind)
    return "".join(out[:24])


def features(words: list[str], i: int, j: int) -> list[str]:
    """Features of words[i:j] as one whole."""
    text = " ".join(words[i:j]).strip(EDGES.replace("(", "") if words[i].startswith("(") else EDGES)
    digits = NOT_DIGIT.sub("", text)
    letters = sum(c.isalpha() for c in text)
    n = len(digits)
    bucket = n if n in (0, 10, 11, 15, 16) else -7 if n < 7 else -10 if n < 10 else -14 if n < 15 else -19 if n < 20 else -99
    parts = text.split(".")
    ip = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    only = not text.strip("+0123456789 ().-/")
    at = "@" in text or bool(SPELLED.search(text))
    found = [
        f"shape:{_shape(text)}", f"digits:{bucket}", f"words:{j - i}", f"digits:{bucket}|words:{j - i}", f"letters:{min(letters, 4)}|only:{only}",
        f"ip:{ip}", f"luhn:{n >= 14 and luhn(digits)}|{bucket}|{letters == 0}", f"at:{at}|dot:{'.' in text or ' dot ' in text}|{text.count('@')}|{j - i}",
        f"first:{words[i][:1] if not words[i][:1].isalnum() else 'x'}|{any(c.isdigit() for c in words[i])}",
        f"last:{any(c.isdigit() for c in words[j - 1])}|{only}", f"before:{words[i - 1].strip(EDGES).lower() if i else '^'}",
    ]
    return found


class SemiMarkov:
    """Weights of (feature, kind); a word outside all segments scores 0."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}

    def scores(self, words: list[str]) -> dict[tuple[int, int], dict[str, float]]:
        """Scores of all segments, by kind."""
        get = self.weights.get
        return {place: {k: sum(get((x, k), 0.0) for x in f) for k in KINDS} for place, f in self.segments(words).items()}

    @staticmethod
    def segments(words: list[str]) -> dict[tuple[int, int], list[str]]:
        """Features of all segments that hold a digit, an at-sign or an at in brackets or alone."""
        out = {}
        marked = [bool(MARKED.search(w)) or any(c.isdigit() for c in w) for w in words]
        for i in range(len(words)):
            for j in range(i + 1, min(i + LONGEST, len(words)) + 1):
                if marked[i] and marked[j - 1] or j - i >= 3 and any(marked[i:j]):
                    out[i, j] = features(words, i, j)
        return out

    def _sums(self, n: int, scores) -> tuple[list[float], list[float]]:
        """Log sums over all segmentations of the words before and after each place."""
        ending, starting = defaultdict(list), defaultdict(list)
        for (i, j), by in scores.items():
            for s in by.values():
                ending[j].append((i, s))
                starting[i].append((j, s))
        before, after = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            before[j] = _logsum([before[j - 1], *(before[i] + s for i, s in ending[j])])
        for i in range(n - 1, -1, -1):
            after[i] = _logsum([after[i + 1], *(after[j] + s for j, s in starting[i])])
        return before, after

    def marginals(self, words: list[str], scores) -> Iterator[tuple[int, int, str, float]]:
        before, after = self._sums(len(words), scores)
        for (i, j), by in scores.items():
            for kind, s in by.items():
                yield i, j, kind, math.exp(min(0.0, before[i] + s + after[j] - before[-1]))

    def best(self, words: list[str]) -> list[tuple[int, int, str]]:
        """Sure segments of the best segmentation."""
        scores = self.scores(words)
        if not scores:
            return []
        ending = defaultdict(list)
        for (i, j), by in scores.items():
            kind = max(by, key=by.get)
            ending[j].append((i, kind, by[kind]))
        top, back = [0.0], [None]
        for j in range(1, len(words) + 1):
            choice = (top[j - 1], None)
            for i, kind, s in ending[j]:
                if top[i] + s > choice[0]:
                    choice = (top[i] + s, (i, kind))
            top.append(choice[0])
            back.append(choice[1])
        chosen, j = [], len(words)
        while j:
            if back[j]:
                chosen.append((back[j][0], j, back[j][1]))
                j = back[j][0]
            else:
                j -= 1
        if not chosen:
            return []
        sure = {(i, j, k): p for i, j, k, p in self.marginals(words, scores)}
        return [s for s in reversed(chosen) if sure[s] >= SURE]

    @classmethod
    def train(cls, stretches: list[tuple[list[str], list[tuple[int, int, str]]]]) -> "SemiMarkov":
        """Maximise the log likelihood of the marked segmentations by AdaGrad."""
        weights: dict[tuple[str, str], float] = defaultdict(float)
        squares: dict[tuple[str, str], float] = defaultdict(lambda: 1.0)
        model = cls(weights)
        rng = random.Random(3)
        order = list(range(len(stretches)))
        names: dict[str, str] = {}  # one string for each feature
        segments = [{place: [names.setdefault(x, x) for x in f] for place, f in cls.segments(words).items()} for words, _ in stretches]
        for _ in range(-(-UPDATES // max(len(stretches), 1))):
            rng.shuffle(order)
            for index in order:
                words, marked = stretches[index]
                known = segments[index]
                scores = {p: {k: sum(weights[x, k] for x in f) for k in KINDS} for p, f in known.items()}
                slope: dict[tuple[str, str], float] = defaultdict(float)
                for i, j, kind, p in model.marginals(words, scores):
                    if p > 1e-4:
                        for f in known[i, j]:
                            slope[f, kind] -= p
                for i, j, kind in marked:
                    for f in known.get((i, j), ()):
                        slope[f, kind] += 1.0
                for key, g in slope.items():
                    g -= SHRINK * weights[key]
                    squares[key] += g * g
                    weights[key] += STEP * g / math.sqrt(squares[key])
        return cls({k: w for k, w in weights.items() if abs(w) > 1e-3})


def _logsum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """Places of the words around digits, at-signs and the word at, two words more on each side; a dot in words goes on."""
    words = [(m.start(), m.end()) for m in WORD.finditer(text)]
    last, run = -1, []
    for k, (s, e) in enumerate(words):
        part = text[s:e]
        if MARKED.search(part) or run and k <= last and DOT.search(part):
            first = max(k - 2, last + 1)
            if run and first > last + 1:
                yield run
                run = []
            run += words[max(first, last + 1):min(k + 3, len(words))]
            last = min(k + 2, len(words) - 1)
        elif run and k > last:
            yield run
            run = []
    if run:
        yield run


def _rewritten(text: str, kind: str, rng: random.Random) -> str:
    """Another way to write a find, one that the patterns may miss."""
    digits = NOT_DIGIT.sub("", text)
    if kind == "phone":
        d = digits[-10:]
        return rng.choice([f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"{d[:3]} {d[3:6]} {d[6:]}", text])
    if kind == "card":
        sep = rng.choice([".", "-", " ", "/"])
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if kind == "email":
        name, _, host = text.partition("@")
        return rng.choice([f"{name}(at){host}", f"{name}[at]{host}", f"{name} (at) {host}", f"{name} at {host.replace('.', ' dot ')}", text])
    return text


def _broken(text: str, kind: str, rng: random.Random) -> str:
    """A find changed so that it is none: a wrong check digit, a part of an address above 255."""
    if kind == "card":
        at = max(i for i, c in enumerate(text) if c.isdigit())
        return text[:at] + str((int(text[at]) + rng.randint(1, 9)) % 10) + text[at + 1:]
    if kind == "ip":
        parts = text.split(".")
        parts[rng.randrange(4)] = str(rng.randint(256, 999))
        return ".".join(parts)
    return ""


def _examples(texts: list[str]) -> list[tuple[list[str], list[tuple[int, int, str]]]]:
    rng, out = random.Random(5), []
    for text in texts:
        spans = base_spans(text)
        for places in stretches(text):
            low, high = places[0][0], places[-1][1]
            own = [s for s in spans if s[0] >= low and s[1] <= high]
            for again in range(3 if own else 1):
                words, marked, at = [], [], low
                for s, e, kind in [*own, (high, high, "")]:
                    if s < at:
                        continue
                    words += text[at:s].split()
                    if kind and again == 2:
                        words += _broken(text[s:e], kind, rng).split()
                    elif kind:
                        new = (text[s:e] if not again else _rewritten(text[s:e], kind, rng)).split()
                        marked.append((len(words), len(words) + len(new), kind))
                        words += new
                    at = e
                if all(j - i <= LONGEST for i, j, _ in marked):
                    out.append((words, marked))
    rng.shuffle(out)
    return out


def _parts(words: Words) -> Iterator[tuple[int, int, int]]:
    """Text and byte range of each run of marked words with up to three words more on each side.

    Runs take turns from the left: a word is in one range at most, and of the marked words
    that three words can reach from a range's first word the last one begins its run.
    """
    data, start, end = words.data, words.start, words.end
    if not len(start):
        return
    signs = np.concatenate(([0], np.cumsum(_marks[data], dtype=np.int64)))
    marked = signs[end] > signs[start]
    at = np.flatnonzero((LOWER[data[:-1]] == 97) & (LOWER[data[1:]] == 116))
    word = np.searchsorted(start, at, "right") - 1
    inside = at + 2 <= end[word]
    at, word = at[inside], word[inside]
    free = np.concatenate(([0], np.cumsum(~_edges[data], dtype=np.int64)))  # words hold no white space
    alone = free[end[word]] - free[start[word]] == 2
    framed = (at > start[word]) & (at + 2 < end[word])
    framed &= _opening[data[at - 1]] & _closing[data[np.minimum(at + 2, len(data) - 1)]]
    marked[word[alone | framed]] = True
    bounds = words.bounds().tolist()
    places = np.flatnonzero(marked)
    texts, places = words.doc[places].tolist(), places.tolist()
    k, free_from = 0, 0
    while k < len(places):
        text = texts[k]
        first = max(places[k] - 3, free_from, bounds[text])
        high = bounds[text + 1]
        while k + 1 < len(places) and places[k + 1] < high and places[k + 1] <= first + 3:
            k += 1
        while k + 1 < len(places) and places[k + 1] < high and places[k + 1] == places[k] + 1:
            k += 1
        free_from = min(places[k] + 4, high)
        yield text, int(start[first]), int(start[free_from] if free_from < high else words.offsets[text + 1])
        while k < len(places) and places[k] < free_from:
            k += 1


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with marked words, and the words around these."""
    for batch in batches:
        some = batch.filter(pa.array(_suspect(batch)))
        for at, to, words in pieces(some, "text"):
            parts: list[list[str]] = [[] for _ in range(at, to)]
            for i, low, high in _parts(words):
                parts[i].append(words.data[low:high].tobytes().decode())
            rows = pa.array([i for i in range(at, to) if parts[i - at]], pa.int64())
            yield pa.RecordBatch.from_arrays([some.column("shard").take(rows), some.column("doc_id").take(rows), pa.array([p for p in parts if p], pa.list_(pa.string()))],
                                             ["shard", "doc_id", "parts"])


def _train(frame: pd.DataFrame) -> pd.DataFrame:
    """Weights of a shard's model."""
    rows = sorted((id_ if id_ == id_ else -math.inf, list(parts)) for id_, parts in zip(frame["doc_id"], frame["parts"]))
    examples = _examples([p for _, parts in rows for p in parts])
    weights = SemiMarkov.train(examples).weights if any(m for _, m in examples) else {}
    return pd.DataFrame([(f, k, round(w * SCALE)) for (f, k), w in weights.items()], columns=["feature", "kind", "weight"])


def fit(docs: DataFrame, shard: int = SHARD) -> SemiMarkov:
    """Train on the patterns' finds in all rows of ``docs`` (doc_id, text), about ``shard`` rows a task."""
    ship(docs.sparkSession)
    shards = max(1, -(-docs.count() // shard))
    texts = narrow(docs, "doc_id", "text").withColumn("shard", F.pmod(F.xxhash64(F.lit(11), "doc_id", "text"), F.lit(shards)).cast("int"))
    # only the words around digits, at-signs and the word at are shuffled
    short = texts.withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(_around, "shard int, doc_id bigint, parts array<string>")
    trained = short.repartition(shards, "shard").groupBy("shard").applyInPandas(_train, "feature string, kind string, weight bigint")
    summed = trained.groupBy("feature", "kind").agg(F.sum("weight").alias("weight"))
    found = summed.filter(F.abs("weight") > 1e-3 * SCALE * shards).orderBy("feature", "kind").toArrow().to_pydict()
    return SemiMarkov({(f, k): w / SCALE / shards for f, k, w in zip(found["feature"], found["kind"], found["weight"])})


def all_spans(text: str, model: SemiMarkov) -> tuple[list[Span], list[Span]]:
    """The patterns' spans, and these with what the model adds."""
    base = base_spans(text)
    added: list[Span] = []
    if model.weights:
        for places in stretches(text):
            for i, j, kind in model.best([text[s:e] for s, e in places]):
                start, end = places[i][0], places[j - 1][1]
                while end > start and text[end - 1] in EDGES:
                    end -= 1
                while start < end and text[start] in EDGES and text[start] != "(":
                    start += 1
                if start < end and not any(start < e and s < end for s, e, _ in base):
                    added.append((start, end, kind))
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_marks, _edges = np.zeros(256, bool), SPACE.copy()
_marks[list(b"0123456789@")] = True
_edges[list(EDGES.encode())] = True
_opening, _closing = np.zeros(256, bool), np.zeros(256, bool)
_opening[list(b"[({<")], _closing[list(b"])}>")] = True, True


def _suspect(batch: pa.RecordBatch) -> np.ndarray:
    """Rows with a digit, an at-sign or an at in brackets or alone; in all others neither method begins a span."""
    data, offsets = utf8(batch.column("text"))
    sums = np.concatenate(([0], np.cumsum(_marks[data], dtype=np.int64)))
    odd = np.array((sums[offsets[1:]] > sums[offsets[:-1]]).tolist(), bool)
    at = np.flatnonzero((LOWER[data[:-1]] == 97) & (LOWER[data[1:]] == 116))
    row = np.searchsorted(offsets, at, "right") - 1
    free = (at == offsets[row]) | _edges[data[at - 1]]
    free &= (at + 2 == offsets[row + 1]) | _edges[data[np.minimum(at + 2, len(data) - 1)]]
    odd[row[free & (at + 2 <= offsets[row + 1])]] = True
    return odd


def _find(shared):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SemiMarkov(shared.value)
        for batch in batches:
            base, every = [[]] * batch.num_rows, [[]] * batch.num_rows
            for i in np.flatnonzero(_suspect(batch)):
                text = batch.column("text")[int(i)].as_py()
                base[i], every[i] = ([{"kind": k, "start": s, "end": e} for s, e, k in x] for x in all_spans(text, model))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, SPANS), pa.array(every, SPANS)], ["doc_id", "base", "spans"])
            release()
    return find


def find(docs: DataFrame, model: SemiMarkov) -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model.weights)  # features of more than a trace of weight
    texts = narrow(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    return texts.mapInArrow(_find(shared), f"doc_id bigint, base {span}, spans {span}")


def redact(docs: DataFrame, model: SemiMarkov) -> DataFrame:
    """``docs`` with every span of its ``text`` replaced by its kind in brackets; other columns as they are."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model.weights)

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = SemiMarkov(shared.value)
        for batch in batches:
            rows = np.flatnonzero(_suspect(batch)).tolist()
            new = {}
            for i in rows:
                text = batch.column("text")[i].as_py()
                parts, at = [], 0
                for start, end, kind in all_spans(text, own)[1]:
                    if start >= at:
                        parts += [text[at:start], f"[{kind.upper()}]"]
                    at = max(at, end)
                if parts:
                    new[i] = "".join([*parts, text[at:]])
            if not new:
                yield batch
                continue
            place = batch.schema.get_field_index("text")
            texts = batch.column("text").to_pylist()
            for i, text in new.items():
                texts[i] = text
            columns = [pa.array(texts, batch.schema.field(place).type) if c == place else batch.column(c) for c in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)
            release()

    return docs.mapInArrow(cover, docs.schema)
