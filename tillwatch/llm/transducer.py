"""Token counts by compiled finite-state transducers.

Two deterministic transducers count a byte-level tokenizer's tokens.  The first reads
classes of characters and marks where the split pattern of the vocabulary begins a unit;
its table is small, so a text is cut into chunks of ``CHUNK`` characters, every chunk is
run from all states at once (its state map), the maps are composed by a parallel prefix
scan, and with the states that the scan gives every chunk marks its units alone.  The
second reads the bytes of a unit.  Its state holds, for every place where a token may
still be open, the place in the trie of the vocabulary, the last token of the encoding
up to that place, and the number of tokens there; a transition emits the tokens that no
later byte can change, the end of the unit emits the rest.  A token may follow another if
the merges give exactly these two for their joint text; then the encoding of a prefix has
one possible last token, which makes the states finite.  Transitions are compiled when
they are first taken and shared by all units.

Characters' classes and joint texts are asked of the ``tokenizers`` library once each;
no text is encoded by it.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .job import ship
from .tokens import default_path
from .words import Words, mix, utf8

CHUNK = 256           # characters of a chunk
PIECE = 1 << 20       # bytes of texts read at once; a longer text is a piece of its own
LIMIT = 512           # tokens that a text may have
KNOWN = 150_000       # compiled states of one worker; beyond it compiling starts anew
JOINT = 1_000_000     # remembered joint texts of one worker

# classes of characters: letters that can end a contraction have one each
OTHER, LETTER, NUMBER, BLANK, SPACE, QUOTE, STMD, R, V, L, E, BEGIN = range(12)
CLASSES = 12
# states: what the unit so far is
(AT_START, LETTERS, NUMBERS, OTHERS, BLANK_1, BLANK_N, SPACE_1, SPACE_N, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L, CLOSED) = range(13)
STATES = 13
HERE, BEFORE = 1, 2   # a unit begins at this character; one begins at the character before


def _fresh(kind: int, quote: bool = True) -> int:
    """The state after the first character of a unit."""
    if kind in (LETTER, STMD, R, V, L, E):
        return LETTERS
    return {NUMBER: NUMBERS, OTHER: OTHERS, BLANK: BLANK_1, SPACE: SPACE_1, QUOTE: QUOTED if quote else OTHERS}[kind]


def _move(state: int, kind: int) -> tuple[int, int]:
    """The next state and what begins, by the vocabulary's split pattern.

    A contraction, else letters, numbers or other signs with at most one blank ahead, else
    white space up to the last character before something else.
    """
    if kind == BEGIN:
        return AT_START, BEFORE * (state in (QUOTED_R, QUOTED_V, QUOTED_L))
    family, white = _fresh(kind, False), kind in (BLANK, SPACE)
    if state in (QUOTED_R, QUOTED_V, QUOTED_L):
        if kind == (L if state == QUOTED_L else E):
            return CLOSED, 0
        after, begins = _move(LETTERS, kind)  # the letter behind the quote begins a unit after all
        return after, begins | BEFORE
    if state == QUOTED:
        ends = {STMD: CLOSED, R: QUOTED_R, V: QUOTED_V, L: QUOTED_L}
        if kind in ends:
            return ends[kind], 0
        state = OTHERS
    if state in (AT_START, CLOSED):
        return _fresh(kind), HERE
    if state in (LETTERS, NUMBERS, OTHERS):
        return (state, 0) if family == state else (_fresh(kind), HERE)
    if white:
        return BLANK_N if kind == BLANK else SPACE_N, 0
    if state == BLANK_1:
        return family, 0
    if state == BLANK_N:
        return family, BEFORE
    return _fresh(kind), HERE | BEFORE * (state == SPACE_N)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Next states (times CLASSES, to be added to a class) and marks, by state times CLASSES plus class."""
    moves = [_move(s, c) for s in range(STATES) for c in range(CLASSES)]
    return np.array([m[0] * CLASSES for m in moves], np.uint8), np.array([m[1] for m in moves], np.uint8)


NEXT, MARKS = _tables()


def compose(maps: np.ndarray) -> np.ndarray:
    """Inclusive parallel prefix scan: row i becomes the map of rows 0 to i, one after another.

    A map is a row of STATES next states (times CLASSES).
    """
    out, step = maps.copy(), 1
    while step < len(out):
        later = np.take_along_axis(out[step:], (out[:-step] // CLASSES).astype(np.int64), axis=1)
        out = np.concatenate((out[:step], later))
        step *= 2
    return out


def marks(classes: np.ndarray) -> np.ndarray:
    """Which characters begin a unit; texts are set apart by BEGIN, which is no character."""
    n = -(-max(len(classes), 1) // CHUNK)
    padded = np.full((n, CHUNK), BEGIN, np.uint8)
    padded.reshape(-1)[:len(classes)] = classes
    columns = np.ascontiguousarray(padded.T)
    maps = np.tile(np.arange(STATES, dtype=np.uint8) * np.uint8(CLASSES), (n, 1))
    for column in columns:
        maps = NEXT[maps + column[:, None]]
    state = np.concatenate((np.zeros(1, np.uint8), compose(maps)[:-1, 0]))
    emitted = np.empty((CHUNK, n), np.uint8)
    for k, column in enumerate(columns):
        at = state + column
        emitted[k] = MARKS[at]
        state = NEXT[at]
    flat = np.ascontiguousarray(emitted.T).reshape(-1)
    begins = (flat & HERE) > 0
    begins[:-1] |= (flat[1:] & BEFORE) > 0
    return begins[:len(classes)]


class State(dict):
    """A state of the counting transducer: byte -> (next state, tokens emitted); ``rest`` is emitted at the unit's end."""

    __slots__ = ("made", "open", "rest")

    def __init__(self, made: "Counter", places: tuple):
        self.made, self.open, self.rest = made, places, places[-1][2]

    def __missing__(self, byte: int):
        self[byte] = move = self.made.compile(self, byte)
        return move


class Counter:
    """The compiled vocabulary: trie, joint texts and the lazily compiled states."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.shown = {}  # how the vocabulary writes a byte
        for b in range(256):
            printable = 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255
            self.shown[b] = chr(b) if printable else None
        spare = iter(range(256, 512))
        self.shown = {b: c or chr(next(spare)) for b, c in self.shown.items()}
        added = {t.content for t in self.library.get_added_tokens_decoder().values()}
        self.added = sorted(a.encode() for a in added)
        byte_of = {c: b for b, c in self.shown.items()}
        self.trie: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        self.text: dict[int, str] = {}
        for word, number in self.library.get_vocab(with_added_tokens=False).items():
            at = 0
            for c in word:
                b = byte_of[c]
                if b not in self.trie[at]:
                    self.trie[at][b] = len(self.trie)
                    self.trie.append({})
                    self.token.append(-1)
                at = self.trie[at][b]
            self.token[at] = number
            self.text[number] = word
        self.classes = np.full(0x110000, 255, np.uint8)
        for kind, characters in ((BLANK, " "), (QUOTE, "'"), (STMD, "stmd"), (R, "r"), (V, "v"), (L, "l"), (E, "e")):
            for c in characters:
                self.classes[ord(c)] = kind
        self.pairs: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        self.states: dict[tuple, State] = {}
        self.start = self._state(((0, -1, 0),))

    def _state(self, places: tuple) -> State:
        if places not in self.states:
            self.states[places] = State(self, places)
        return self.states[places]

    def follows(self, a: int, b: int) -> bool:
        """Whether the merges leave token ``a`` before token ``b`` as they are."""
        if a < 0:
            return True
        if (a, b) not in self.pairs:
            got = self.library.model.tokenize(self.text[a] + self.text[b])
            self.pairs[a, b] = [t.id for t in got] == [a, b]
        return self.pairs[a, b]

    def compile(self, state: State, byte: int) -> tuple[State, int]:
        """Places are (trie place, last token before it, tokens before it less those emitted), the unit's end last."""
        found, kept = None, []
        for node, last, number in state.open:
            to = self.trie[node].get(byte)
            if to is None:
                continue
            token = self.token[to]
            if found is None and token >= 0 and self.follows(last, token):
                found = (token, number + 1)
            if self.trie[to]:
                kept.append((to, last, number))
        if found is None:
            raise ValueError("no token ends here")
        kept.append((0, *found))
        sure = min(number for _, _, number in kept)
        return self._state(tuple((node, last, number - sure) for node, last, number in kept)), sure

    def count(self, unit: bytes) -> int:
        state, total = self.start, 0
        for byte in unit:
            state, emitted = state[byte]
            total += emitted
        return total + state.rest

    def classify(self, points: np.ndarray) -> np.ndarray:
        """Classes of code points; new ones are asked of the library's splitter."""
        got = self.classes[points]
        if (got == 255).any():
            for point in np.unique(points[got == 255]).tolist():
                c = chr(point)
                alone = [kind for kind, lead in ((LETTER, "x"), (NUMBER, "0"), (OTHER, "#"))
                         if len(self.split.pre_tokenize_str(lead + c)) == 1]
                self.classes[point] = alone[0] if alone else SPACE
            got = self.classes[points]
        return got

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of tokens of each of several UTF-8 texts that lie one after another."""
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(n, np.int64)
        # an added token is one token, and what lies before and behind it are texts of their own
        starts, ends, docs, counts = offsets[:-1], offsets[1:], np.arange(n), np.zeros(n, np.int64)
        cuts = self._added(data, offsets)
        if cuts:
            at = np.array([c[0] for c in cuts]), np.array([c[1] for c in cuts])
            inside = np.searchsorted(offsets, at[0], "right") - 1
            counts += np.bincount(inside, minlength=n)
            starts, ends = np.concatenate((starts, at[1])), np.concatenate((ends, at[0]))
            docs = np.concatenate((docs, inside))
            order = np.lexsort((starts, docs))
            starts, docs = starts[order], docs[order]
            # the k-th begin of a document goes with its k-th end
            ends = np.sort(ends)
        full = ends > starts
        starts, ends, docs = starts[full], ends[full], docs[full]
        if not len(starts):
            return counts
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # where each character's bytes begin
        covered = np.zeros(len(data) + 1, np.int8)
        covered[starts] += 1
        covered[ends] -= 1
        read = np.cumsum(covered[:-1])[lead] > 0
        lead, points = lead[read], points[read]
        first = np.searchsorted(lead, starts)
        stream = np.insert(self.classify(points), first, BEGIN)
        places = first + np.arange(len(first))
        begins = np.delete(marks(stream), places)
        begin = lead[begins]
        end = np.append(begin[1:], 0)
        of = np.searchsorted(starts, begin, "right") - 1
        last = np.append(of[1:] != of[:-1], True)
        end[last] = ends[of[last]]
        return counts + self._units(data, begin, end, docs[of], n)

    def _added(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        found = []
        raw = data.tobytes()
        for word in self.added:
            at = raw.find(word)
            while at >= 0:
                doc = np.searchsorted(offsets, at, "right") - 1
                if at + len(word) <= offsets[doc + 1] and not (found and any(a < at + len(word) and at < b for a, b in found[-1:])):
                    found.append((at, at + len(word)))
                    at = raw.find(word, at + len(word))
                else:
                    at = raw.find(word, at + 1)
        return sorted(found)

    def _units(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        if len(self.states) > KNOWN:
            self.forget()
        if len(self.pairs) > JOINT:
            self.pairs.clear()
        keys = Words(data, np.array([0, len(data)])).range_hash(begin, end)
        _, one, inverse = np.unique(mix(keys), return_index=True, return_inverse=True)
        raw = data.tobytes()
        counted = np.fromiter((self.count(raw[a:b]) for a, b in zip(begin[one].tolist(), end[one].tolist())), np.int64, len(one))
        return np.bincount(doc, counted[inverse], n).astype(np.int64)


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs`` (doc_id, text).

    A null or empty text has no bytes and no tokens.  Rows are counted one by one: repeated
    rows get equal counts, a null doc_id and other columns change nothing, an empty table
    gives an empty one.  A text is never cut; of a very long one a task holds its characters
    and their classes.
    """
    ship(docs.sparkSession)
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = counter(path)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            counts, at = [np.zeros(0, np.int64)], 0
            while at < len(offsets) - 1:
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE, "right")) - 1)
                part = offsets[at:to + 1]
                counts.append(made.texts(data[part[0]:part[-1]], part - part[0]))
                at = to
            pa.default_memory_pool().release_unused()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(np.concatenate(counts))], ["doc_id", "n_bytes", "n_tokens"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
