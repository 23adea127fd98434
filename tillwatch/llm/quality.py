"""Quality rules on compression: zstandard ratios of whole texts and of fixed chunks.

Text that says the same again compresses far below prose of its length, random
or encoded text far above.  Prose compresses better the longer it is, so a text
is held against the band of its own length class; each full chunk, and the chunk that ends
where a longer text ends, is held against one band, so that a bad passage in a long text
shows.  A text is rejected if its whole ratio leaves its band, or if more than
``BAD_SHARE`` of its chunks do.  Below 64 bytes prose and random letters compress alike:
there is no limit.

A null or empty text has no words, fails the base rule and has null ratios.
Rows are judged one by one: repeated rows get equal verdicts, a null doc_id and
other columns change nothing, an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .job import ship
from .words import SPACE, Words, grams, mix, pieces

LEVEL = 3
CHUNK = 2048          # bytes
BAD_SHARE = 0.2
# (from this many bytes on, lowest, highest ratio): wider than prose in English, German, French and Spanish needs
BANDS = (
    (0, 0.00, 9.00),
    (64, 0.00, 1.15),
    (96, 0.00, 1.00),
    (128, 0.40, 0.92),
    (192, 0.40, 0.86),
    (256, 0.42, 0.81),
    (384, 0.42, 0.77),
    (512, 0.44, 0.73),
    (768, 0.44, 0.70),
    (1024, 0.43, 0.68),
    (2048, 0.41, 0.66),
    (4096, 0.39, 0.64),
    (8192, 0.38, 0.62),
    (16384, 0.37, 0.60),
    (65536, 0.33, 0.60),
)
CHUNK_BAND = (0.42, 0.66)
WINDOW = 5

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

COLUMNS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
           "base_failed boolean, ratio double, n_chunks bigint, n_bad_chunks bigint, kept boolean")


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key is there twice or more."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def repeat_words(text: Words, window: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in it."""
    keys, at = grams(text.hashes(), text.doc, window)
    if not len(at):
        return np.zeros(text.texts, np.int64)
    at = at[_repeated(mix(keys + text.doc[at].astype(np.uint64)))]
    step = np.zeros(len(text.start) + 1, np.int32)
    np.add.at(step, at, 1)
    np.add.at(step, at + window, -1)
    covered = np.cumsum(step[:-1]) > 0
    return _sums(covered, text.bounds())


def dup_lines(text: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    breaks = np.flatnonzero(text.data == 10)
    start = np.union1d(text.offsets[:-1], breaks + 1)
    start = start[start < len(text.data)]
    # a break that ends a text is followed by the next text's first line, which starts there anyway
    end = np.minimum(np.append(start[1:], len(text.data)), len(text.data))
    doc = np.searchsorted(text.offsets, start, "right") - 1
    closed = (end > start) & (text.data[end - 1] == 10)
    end = end - closed
    words = np.searchsorted(text.start, end) > np.searchsorted(text.start, start)
    start, end, doc = start[words], end[words], doc[words]
    if not len(start):
        return np.zeros(text.texts, np.int64)
    keys = mix(text.range_hash(start, end) + doc.astype(np.uint64))
    _, first = np.unique(keys, return_index=True)
    return np.bincount(doc, minlength=text.texts) - np.bincount(doc[first], minlength=text.texts)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    floors = np.array([b[0] for b in BANDS])
    for batch in batches:
        made = []
        for _, _, text in pieces(batch, "text"):
            sizes = np.diff(text.offsets)
            chars = _sums(~SPACE[text.data] & ((text.data & 0xC0) != 0x80), text.offsets)
            repeats = repeat_words(text)
            failed = (text.count < 10) | (100 * repeats > 20 * text.count)
            ratio = np.full(text.texts, np.nan)
            chunks, bad = sizes // CHUNK + ((sizes > CHUNK) & (sizes % CHUNK > 0)), np.zeros(text.texts, np.int64)
            for i in range(text.texts):
                raw = text.data[text.offsets[i]:text.offsets[i + 1]].tobytes()
                if raw:
                    ratio[i] = len(squeeze(raw)) / len(raw)
                for at in range(chunks[i]):
                    at = min(at * CHUNK, len(raw) - CHUNK)
                    part = len(squeeze(raw[at:at + CHUNK])) / CHUNK
                    bad[i] += not CHUNK_BAND[0] <= part <= CHUNK_BAND[1]
            band = np.searchsorted(floors, sizes, "right") - 1
            low, high = np.array([b[1] for b in BANDS])[band], np.array([b[2] for b in BANDS])[band]
            with np.errstate(invalid="ignore"):
                good = (ratio >= low) & (ratio <= high) & (bad <= BAD_SHARE * chunks)
            made.append((text.count.astype(np.int64), chars, _sums(SYMBOL[text.data], text.offsets), dup_lines(text), repeats,
                         failed, ratio, chunks, bad, good & ~failed))
        if made:
            columns = [np.concatenate(c) for c in zip(*made)]
            out = [pa.array(c, mask=np.isnan(c)) if c.dtype.kind == "f" else pa.array(c) for c in columns]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *out], ["doc_id", *(c.split()[0] for c in COLUMNS.split(", "))])


def judge(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): the base counts, the ratios and the verdict."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.mapInArrow(_judge, "doc_id bigint, " + COLUMNS)
