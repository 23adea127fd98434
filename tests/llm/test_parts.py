"""The parts: words as arrays, coding, automaton, perfect hashing, bitmaps, components."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import brute
from tillwatch.llm import elias_fano
from tillwatch.llm.automaton import SuffixAutomaton
from tillwatch.llm.bitmap import bitmap, let_through, xxhash_long
from tillwatch.llm.components import components
from tillwatch.llm.mph import Mph
from tillwatch.llm.words import Words, grams, pieces, utf8

TEXT = st.text(alphabet=st.sampled_from(list("ab \n\té \x0b\x1c")), max_size=30)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_are_those_of_the_pattern(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    found, marks = [], {}
    for at, to, w in pieces(batch, "text"):
        hashes = w.hashes()
        for i in range(at, to):
            mine = np.flatnonzero(w.doc == i - at)
            own = [w.data[w.start[j]:w.end[j]].tobytes().decode() for j in mine]
            found.append(own)
            for word, h in zip(own, hashes[mine].tolist()):
                assert marks.setdefault(word, h) == h
    assert found == [brute.words(t) for t in texts]
    assert len(set(marks.values())) == len(marks)


def test_grams_stay_inside_a_text():
    w = Words(*utf8(pa.array(["a b c d", "e", "a b c"])))
    keys, at = grams(w.hashes(), w.doc, 3)
    assert at.tolist() == [0, 1, 5] and keys[0] == keys[2] != keys[1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 62), max_size=60), st.integers(0, 40))
def test_elias_fano_round_trip(values, shift):
    values = np.sort(np.array([v >> shift for v in values], np.uint64))
    raw = elias_fano.encode(values) + b"rest"
    out, at = elias_fano.decode(raw)
    assert out.tolist() == values.tolist() and raw[at:] == b"rest"


def test_automaton_finds_the_longest_earlier_run():
    rng = random.Random(1)
    texts = [[rng.randrange(3) for _ in range(rng.randrange(1, 25))] for _ in range(30)]
    automaton, before = SuffixAutomaton(), []
    for text in texts:
        runs = {tuple(t[a:b]) for t in before for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
        want = [max([n for n in range(1, e + 2) if tuple(text[e + 1 - n:e + 1]) in runs], default=0) for e in range(len(text))]
        assert automaton.matches(text) == want
        automaton.add(text)
        before.append(text)


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(0, 2 ** 63, n, dtype=np.uint64)
    back, _ = Mph.from_bytes(Mph.build(keys).to_bytes())
    assert sorted(back.slots(keys).tolist()) == list(range(n))


def test_bitmap_agrees_with_spark(spark):
    keys = spark.range(-500, 500).select((F.col("id") * 7919).alias("key"))
    own = np.array([r["key"] for r in keys.collect()], np.int64)
    theirs = np.array([r[0] for r in keys.select(F.xxhash64("key")).collect()], np.int64)
    assert (xxhash_long(own).view(np.int64) == theirs).all()
    bits = bitmap(keys)
    assert let_through(bits, own).all()
    assert let_through(bits, np.arange(10 ** 6, 10 ** 6 + 1000, dtype=np.int64)).mean() < 0.01


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 150)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 150: 150, 200: 150}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
