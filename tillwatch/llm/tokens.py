"""Token ids of whole texts with a public byte-level vocabulary, many texts at once.

The vocabulary's split pattern never lets a token cross the place before a word
(a blank directly before it goes with the word).  A text is therefore a row of
units: words with or without their blank, and what other white space lies
between.  Each distinct unit is encoded once by the ``tokenizers`` library and
remembered by its hash while it comes again; texts are put together from the units' ids with array
operations.  Texts with rarer white space than ASCII's, or with an added token of
the vocabulary such as ``<|endoftext|>``, go through the library whole: their ids
are those of ``encode(text, add_special_tokens=False)`` with the library's defaults.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from .words import SPACE, Words, mix, pieces

END = 2            # the id that ends every document
KNOWN = 2_000_000  # remembered units of one worker; beyond it those that came once are forgotten
IDS = 16_000_000   # their ids, which long units can make many; the same holds beyond it
PART = 1 << 19     # bytes of texts put together at once, about
CHUNK = 4_000      # units encoded by one call

_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        added = [re.escape(t.content.encode()) for t in self.model.get_added_tokens_decoder().values()]
        self.added = re.compile(b"(?=" + b"|".join(added) + b")") if added else None
        size = self.model.get_vocab_size()
        spaced = np.zeros(size, bool)
        for token, i in self.model.get_vocab().items():
            spaced[i] = token.startswith("Ġ")
        self.spaced = spaced
        self.width = 2 if size <= 1 << 16 else 4
        self.single = {c: self._plain(chr(c)) for c in np.flatnonzero(SPACE)}
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.uint32)
        self.pool = np.zeros(0, np.dtype(f"u{self.width}"))
        self.uses = np.zeros(0, np.uint8)  # by place: parts that held the unit since the last tidying, 2 for more

    def _tidy(self) -> None:
        """Keep the units that came again; all go if these are too many themselves."""
        again = np.flatnonzero(self.uses[self.place] > 1)
        start, end = self._span(self.place[again])
        if 2 * len(again) > KNOWN or 2 * (end - start).sum() > IDS:
            return self.forget()
        self.pool, counts = _gather(self.pool, start, end)
        self.keys, self.place = self.keys[again], np.arange(len(again), dtype=np.int32)
        self.starts = np.concatenate(([0], np.cumsum(counts))).astype(np.uint32)
        self.uses = np.zeros(len(again), np.uint8)

    def _span(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of units lie in the pool."""
        return self.starts[place].astype(np.int64), self.starts[place + 1].astype(np.int64)

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)  # fast: without places

    def _joined(self, units: list[bytes], lead: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units one after another and how many each has."""
        ids = self._plain((lead + lead.join(units)).decode("utf-8", "replace"))
        if lead == b" ":
            begin = self.spaced[ids]
        else:
            begin = ids == self.single[10][0]
        at = np.flatnonzero(begin)
        if len(at) != len(units):
            raise ValueError("units and ids do not match")
        counts = np.diff(np.append(at, len(ids)))
        return (ids, counts) if lead == b" " else (ids[~begin], counts - 1)

    def _learn(self, keys: np.ndarray, kind: np.ndarray, text: Words, start: np.ndarray, end: np.ndarray) -> None:
        """Encode new units: kind 0 with a blank before it, 1 without, 2 white space."""
        ids, counts, order = [], [], []
        raw = text.data
        for k, lead in ((0, b" "), (1, b"\n")):
            at = np.flatnonzero(kind == k)
            for a in range(0, len(at), CHUNK):
                some = at[a:a + CHUNK]
                got, n = self._joined([raw[s:e].tobytes() for s, e in zip(start[some], end[some])], lead)
                ids.append(got)
                counts.append(n)
                order.append(some)
        for i in np.flatnonzero(kind == 2):
            got = self._plain(raw[start[i]:end[i]].tobytes().decode("utf-8", "replace"))
            ids.append(got)
            counts.append(np.array([len(got)]))
            order.append(np.array([i]))
        made = np.concatenate(counts)
        place = np.arange(len(made), dtype=np.int32) + np.int32(len(self.starts) - 1)
        self.starts = np.concatenate((self.starts, (int(self.starts[-1]) + np.cumsum(made)).astype(np.uint32)))
        self.pool = np.concatenate((self.pool, *(x.astype(self.pool.dtype) for x in ids)))
        self.uses = np.concatenate((self.uses, np.zeros(len(made), np.uint8)))
        fresh = keys[np.concatenate(order)]
        by = np.argsort(fresh)
        at = np.searchsorted(self.keys, fresh[by])  # the known ones are not sorted again, and grow one array at a time
        self.keys = np.insert(self.keys, at, fresh[by])
        self.place = np.insert(self.place, at, place[by])

    @staticmethod
    def _units(text: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, end, kind (see _learn) and text of all units."""
        n, texts = len(text.start), text.texts
        # one row for each word and one for each text's tail; up to three units a row
        rows = n + texts
        row = np.arange(n) + text.doc
        tail = np.cumsum(text.count) + np.arange(texts)
        start = np.zeros((rows, 3), np.int64)
        end = np.zeros((rows, 3), np.int64)
        kind = np.full((rows, 3), 2, np.int8)
        begin = np.concatenate(([0], text.end[:-1])) if n else np.zeros(0, np.int64)
        begin = np.maximum(begin, text.offsets[:-1][text.doc])
        gap = text.start - begin
        blank = np.zeros(n, bool)
        some = gap > 0
        blank[some] = text.data[text.start[some] - 1] == 32
        start[row, 0], end[row, 0] = begin, text.start - some
        start[row, 1], end[row, 1] = text.start - (some & ~blank), text.start
        start[row, 2], end[row, 2] = text.start, text.end
        kind[row, 2] = np.where(blank, 0, 1)
        bounds = text.bounds()
        left = text.offsets[:-1].copy()
        full = text.count > 0
        left[full] = text.end[bounds[1:][full] - 1]
        start[tail, 0], end[tail, 0] = left, text.offsets[1:]
        doc = np.zeros(rows, np.int64)
        doc[row], doc[tail] = text.doc, np.arange(texts)
        used = (end > start).ravel()
        return start.ravel()[used], end.ravel()[used], kind.ravel()[used], np.repeat(doc, 3)[used]

    def encode(self, text: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin."""
        if len(self.keys) > KNOWN or len(self.pool) > IDS:
            self._tidy()
        start, end, kind, doc = self._units(text)
        keys = mix(text.range_hash(start, end) + kind.astype(np.uint64))
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, unique)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == unique[known]
        if not known.all():
            new = first[~known]
            self._learn(unique[~known], kind[new], text, start[new], end[new])
            at = np.searchsorted(self.keys, unique)
        place = self.place[at]
        self.uses[place] = np.minimum(self.uses[place] + 1, 2)
        ids, counts = _gather(self.pool, *self._span(place[inverse]))
        sizes = np.bincount(doc, counts, text.texts).astype(np.int64)
        return ids, np.concatenate(([0], np.cumsum(sizes)))


def _gather(pool: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """pool[start:end] for all pairs, one after another."""
    counts = end - start
    to = np.cumsum(counts)
    shift = np.repeat(start - (to - counts), counts)
    return pool[np.arange(len(shift)) + shift], counts


def _odd(text: Words) -> np.ndarray:
    """Rows that hold white space other than blank, tab, line feed, form feed and carriage return."""
    data = np.concatenate((text.data, np.zeros(2, np.uint8)))
    a = text.data
    low = (a == 11) | ((a >= 0x1C) & (a <= 0x1F))
    at = np.flatnonzero((a == 0xC2) | ((a >= 0xE1) & (a <= 0xE3)))
    one, two, three = data[at], data[at + 1], data[at + 2]
    wide = ((one == 0xC2) & ((two == 0x85) | (two == 0xA0))
            | (one == 0xE1) & ((two == 0x9A) & (three == 0x80) | (two == 0xA0) & (three == 0x8E))
            | (one == 0xE2) & ((two == 0x80) & ((three <= 0x8B) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF))
                               | (two == 0x81) & (three == 0x9F))
            | (one == 0xE3) & (two == 0x80) & (three == 0x80))
    places = np.concatenate((np.flatnonzero(low), at[wide]))
    return np.unique(np.searchsorted(text.offsets, places, "right") - 1)


def _with_added(text: Words, added: re.Pattern | None) -> np.ndarray:
    """Rows that hold the content of an added token."""
    if added is None:
        return np.zeros(0, np.int64)
    places = np.array([m.start() for m in added.finditer(text.data.tobytes())], np.int64)
    return np.unique(np.searchsorted(text.offsets, places, "right") - 1)


def token_ids(batch: pa.RecordBatch, column: str, path: str) -> list[np.ndarray]:
    """The ids of every whole text of a batch, each with the end id after it."""
    out: list[np.ndarray] = []
    model = encoder(path)
    for _, _, text in pieces(batch, column, size=PART):
        ids, at = model.encode(text)
        odd = {*_odd(text).tolist(), *_with_added(text, model.added).tolist()}
        for i in range(text.texts):
            if i in odd:
                raw = text.data[text.offsets[i]:text.offsets[i + 1]].tobytes()
                own = model._plain(raw.decode("utf-8", "replace"))
            else:
                own = ids[at[i]:at[i + 1]]
            out.append(np.append(own, np.uint32(END)).astype(np.uint32))
    return out


def default_path() -> str:
    """The installed 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
