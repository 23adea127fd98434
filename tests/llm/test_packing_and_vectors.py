"""Mixing, packing, token files, nearest neighbours and the pipeline."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from tillwatch.llm import mixing, neighbours, packing, pii, queries, token_files, tokens


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.awkward(), brute.SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def ids():
    model = Tokenizer.from_file(tokens.default_path())
    return lambda text: [*model.encode(text or "", add_special_tokens=False).ids, tokens.END]


def test_token_ids_of_added_tokens(ids):
    import pyarrow as pa

    texts = ["one <|endoftext|> two<|endoftext|>", "plain one two", "<|endoftext|>", "a\n <|endoftext|>  \n b", "<|endoftext", "|> end",
             "x  <|endoftext|><|endoftext|>\t<|ENDOFTEXT|>", "one <|endoftext|>two three", None]
    out = tokens.token_ids(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), "text", tokens.default_path())
    assert [x.tolist() for x in out] == [ids(t) for t in texts]
    assert out[0].tolist() == [505, 220, 50256, 734, 50256, tokens.END]


def test_token_ids_of_awkward_texts(ids):
    import pyarrow as pa

    texts = ["", None, " ", "\n\n a  b\n\n\nc \t d", "lead", "  lead", "trail  ", "a\x0bb", "it's we'll  don't", "　x　　 y",
             "日本 語\n é", "a\n \nb", "\ta\t\tb", "a\r\nb", "1234 56.7,8 !!", "x  y ", "a\x1cb \x1d"]
    out = tokens.token_ids(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), "text", tokens.default_path())
    assert [o.tolist() for o in out] == [ids(t) for t in texts]


def test_a_worker_keeps_only_units_that_come_again(ids, monkeypatch):
    import pyarrow as pa

    model, learnt = tokens.encoder(tokens.default_path()), []
    model.forget()
    monkeypatch.setattr(tokens, "KNOWN", 200_000)
    learn = model._learn
    monkeypatch.setattr(model, "_learn", lambda keys, *rest: (learnt.append(len(keys)), learn(keys, *rest)))
    texts = [" ".join(["the", *(f"x{text * 1000 + i:x} the\n" for i in range(1000))]) for text in range(320)]
    for at in range(0, len(texts), 40):
        out = tokens.token_ids(pa.RecordBatch.from_arrays([pa.array(texts[at:at + 40])], ["text"]), "text", tokens.default_path())
        assert out[-1].tolist() == ids(texts[at + 39])
    assert len(model.keys) < 260_000  # 320,000 words that come once
    assert sum(learnt) == 320_003  # and those that came again were never learnt anew
    held = model.keys, model.place, model.starts, model.pool, model.uses
    assert len({len(model.keys), len(model.place), len(model.uses), len(model.starts) - 1}) == 1 and sum(x.nbytes for x in held) < 16 << 20
    monkeypatch.setattr(tokens, "KNOWN", 100)  # also when nearly all come again
    for _ in range(3):
        out = tokens.token_ids(pa.RecordBatch.from_arrays([pa.array(texts[:2] * 2)], ["text"]), "text", tokens.default_path())
        assert [o.tolist() for o in out] == [ids(t) for t in texts[:2] * 2]
    model.forget()


def test_a_worker_needs_little_memory_besides_its_units(ids):
    import tracemalloc

    import pyarrow as pa

    model = tokens.encoder(tokens.default_path())
    model.forget()

    def encode(first, words):
        texts = [" ".join(f"x{text * 1000 + i:x}" for i in range(1000)) for text in range(first, first + words // 1000)]
        return texts[-1], tokens.token_ids(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), "text", tokens.default_path())[-1]

    for at in range(4):
        encode(100 * at, 100_000)
    assert sum(x.nbytes for x in (model.keys, model.place, model.starts, model.pool, model.uses)) < 32 * len(model.keys)
    tracemalloc.start()
    text, got = encode(400, 150_000)  # 1.1 MB
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert got.tolist() == ids(text) and peak < 55, peak  # MB, new units among them
    model.forget()


def test_a_worker_forgets_long_units_too(ids, monkeypatch):
    import pyarrow as pa

    model = tokens.encoder(tokens.default_path())
    model.forget()
    monkeypatch.setattr(tokens, "IDS", 20_000)  # few units, each of many ids
    for at in range(40):
        texts = [f"the {'qxz%d' % at * 500} the"] * (1 + at % 2)
        out = tokens.token_ids(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), "text", tokens.default_path())
        assert [o.tolist() for o in out] == [ids(t) for t in texts]
    assert len(model.keys) < 40 and len(model.pool) < 25_000
    model.forget()


def test_a_worker_gives_freed_memory_back():
    import os
    import subprocess
    import sys

    if not os.path.exists("/proc/self/smaps_rollup"):
        pytest.skip("needs Linux's account of memory")
    code = """
import re
import pyarrow as pa
from tillwatch.llm import tokens
def used():
    return int(re.search(r"Pss_Anon:\\s+([0-9]+)", open("/proc/self/smaps_rollup").read())[1]) / 1024
def encode(first, words):
    texts = [" ".join(f"x{text * 1000 + i:x}" for i in range(1000)) for text in range(first, first + words // 1000)]
    tokens.token_ids(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]), "text", tokens.default_path())
encode(0, 1000)
before = used()
for at in range(4):
    encode(1 + 100 * at, 100_000)
print(used() - before)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, check=True)
    assert float(out.stdout) < 40, out.stdout  # MB


def test_files_give_every_document_back(spark, docs, ids):
    files = token_files.write(docs)
    out = files.read(token_files.keys_of(docs)).collect()
    ordered = sorted(((r[0], r[1]) for r in brute.awkward()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, Counter()
    for i, t in ordered:
        own = ids(t)
        want[i, start, len(own), brute.crc(own), tuple(own)] += 1
        start += len(own)
    assert Counter((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], tuple(r["ids"])) for r in out) == want
    strange = spark.range(10_000, 10_200).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("copy"))
    assert files.read(strange).count() == 0


def test_empty_tables(spark):
    empty = spark.createDataFrame([], brute.SCHEMA)
    assert token_files.write(empty).read(token_files.keys_of(empty)).count() == 0
    assert packing.best_fit(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(vectors, F.lit(True)).count() == 0


def test_packing_is_gapless_and_tight(docs, ids):
    out = packing.best_fit(docs).collect()
    want = Counter()
    for i, t, *_ in brute.awkward():
        own = ids(t)
        to, at, k = (len(own) - 1) % 1024 + 1, 0, 0
        while at < len(own):
            want[i, k, at, to - at, brute.crc(own[at:to]), tuple(own[at:to])] += 1
            at, to, k = to, to + 1024, k + 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in out) == want
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by) == brute.best_fit_decreasing([r["length"] for r in out], 1024)


@pytest.mark.parametrize("seed", range(5))
def test_plan_equals_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    lengths = [int(x) for x in rng.choice([3, 5, 8, 13, 40, 64, 90, 100], 300)]
    steps = packing.plan(Counter(lengths), 100)
    used = {}
    for length, _, count, first, offset in steps:
        for s in range(first, first + count):
            used.setdefault(s, []).append((offset, length))
    assert sum(n for _, _, n, _, _ in steps) == 300 and len(used) == brute.best_fit_decreasing(lengths, 100)
    for parts in used.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))]


def test_mix_meets_its_targets(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = mixing.mix(docs, carry=False).withColumn("taken", F.col("size") * F.size("takes"))
    rows = out.collect()
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(brute.words(r["text"]))
    want = brute.targets(dict(sizes))
    taken, largest = Counter(), Counter()
    for r in rows:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in want)
    again = mixing.mix(docs.repartition(7), carry=False).collect()
    assert sorted(map(str, mixing.mix(docs, carry=False).collect())) == sorted(map(str, again))


def test_mix_of_awkward_rows(docs):
    mixed = mixing.mix(docs)
    assert mixed.count() == docs.count()
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns
    assert rows.count() == mixed.agg(F.sum(F.size("takes"))).first()[0]
    shards = Counter(t["shard"] for r in mixed.collect() for t in r["takes"])
    assert set(shards) <= set(range(2 ** mixing.DEPTH))


def vectors(n, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, 32))
    return (centers[rng.integers(0, 12, n)] + rng.normal(size=(n, 32))).astype(np.float32)


def test_neighbours_recall_and_scores(spark):
    points = vectors(3000)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(points)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6)
    out = neighbours.nearest(table, F.col("vec_id") % 20 == 0).collect()
    exact, found = points.astype(np.float64), {}
    for r in out:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q in range(0, 3000, 20):
        scores = exact @ exact[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(3000), -scores))[:20]
        mine = sorted(found[q])
        assert [r for r, _, _ in mine] == list(range(1, 21)) and q not in [v for _, v, _ in mine]
        assert all(abs(s - scores[v]) < 1e-9 for _, v, s in mine)
        hits += len(set(best.tolist()) & {v for _, v, _ in mine})
    assert hits / (150 * 20) >= 0.9


def test_neighbours_of_awkward_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 60)] + [(100, [2.0, 1.0]), (101, None), (102, [0.0, 0.0]), (103, [1.0, None]), (104, [float("nan"), 1.0]),
            (105, [float("inf"), 1.0]), (106, [1.0]), (107, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (120, [0.5, 0.5]), (120, [0.5, 0.5])]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, score int")
    out = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 20 == 0).orderBy("rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(out) == {0, 20, 40, 100, 120}
    assert out[20] == [(100, 2.0)] + [(i, 1.0) for i in range(20) if i != 20][:19]
    assert out[120][0] == (100, 1.5) and all(s == 0.5 for _, s in out[120][1:])


def test_pipeline_stages(spark, folder, tmp_path):
    import corpus_pipeline

    base = spark.read.parquet(f"{folder}/documents.parquet")
    docs, seen = base, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen[name] = (before, docs)
        if name != "best_fit_packing":
            assert docs.columns == base.columns
    before, after = seen["toxicity"]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    clean = before.join(labels.filter("toxic = 0"), "doc_id").count()
    assert after.join(labels.filter("toxic = 0"), "doc_id").count() >= 0.97 * clean
    before, after = seen["ngram_jaccard_join"]
    groups = brute.components([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(groups.values()))
    before, after = seen["personal_data"]
    assert after.count() == before.count()
    assert all(not pii.base_spans(r["text"] or "") for r in after.collect())
    before, after = seen["mixing"]
    assert set(r["doc_id"] for r in after.collect()) <= set(r["doc_id"] for r in before.collect())
    before, after = seen["best_fit_packing"]
    fill = after.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n"), F.count(F.lit(1)), F.sum("n")).first()
    assert fill[0] <= 1024 and fill[1] <= 1.05 * fill[2] / 1024 + 1
