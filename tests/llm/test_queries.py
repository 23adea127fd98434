"""Every registered query over the small tables, all contract columns against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import brute
import test_dialogue_tokens_phrases as new
from test_text_operators import kept_plainly
from tillwatch.llm import queries
from tillwatch.llm.tokens import default_path


@pytest.fixture(scope="module")
def docs(spark, folder):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def ids(docs):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(default_path())
    return {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in docs}


def run(spark, folder, number):
    name = next(k for k in queries.QUERIES if k.startswith(f"op{number}_"))
    return queries.QUERIES[name](spark, folder).collect()


def in_fold(i, parts, held):
    return zlib.crc32(str(i).encode()) % parts == held


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_one_query_each():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) == {"op13_phrase_mining"}


def test_op1(spark, folder, docs):
    want = brute.components(docs, 4, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, folder, 1)}
    assert got == {i: (len(brute.shingles(t, 4)), want[i]) for i, t in docs}


def test_op2(spark, folder, docs):
    want = brute.without_repeats(docs, 20)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in run(spark, folder, 2)}
    assert got == {i: (*want[i, t][:2], sha(want[i, t][2])) for i, t in docs}


def test_op3(spark, folder, docs):
    words = {i: [*brute.words(brute.lower(t)), None] for i, t in docs}
    counts = Counter(w for i, ws in words.items() if not in_fold(i, 7, 2) for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    out = run(spark, folder, 3)
    assert len(out) == len(docs)
    for r in out:
        mine = words[r["doc_id"]]
        base = sum(np.log10((counts[w] + 1) / (total + kinds + 1)) for w in mine)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            in_fold(r["doc_id"], 7, 2), len(mine), sum(counts[w] > 0 for w in mine), total)
        assert abs(r["base_score"] - base) <= 1e-6 * abs(base) and r["score"] <= 0
    held = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_op4(spark, folder, docs):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    got = {r["doc_id"]: tuple(r[c] for c in columns) for r in run(spark, folder, 4)}
    assert got == {i: (*brute.quality(t), kept_plainly(t)) for i, t in docs}


def test_op5(spark, folder, docs):
    for r in run(spark, folder, 5):
        base = brute.personal(dict(docs)[r["doc_id"]])
        kinds = Counter(k for _, _, k in base)
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(kinds[k] for k in ("email", "ip", "card", "phone"))
        listed = [f"{k}:{s}:{e}" for s, e, k in base]
        assert r["base_sha256"] == sha(",".join(listed))
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(listed) <= set(spans)
        places = [(int(x.split(":")[1]), ("email", "ip", "card", "phone").index(x.split(":")[0])) for x in spans]
        assert places == sorted(places)


def test_op6(spark, folder, docs):
    sources = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sizes = defaultdict(int)
    for i, t in docs:
        sizes[sources[i]] += len(brute.words(t))
    want, taken = brute.targets(sizes), Counter()
    first = run(spark, folder, 6)
    for r in first:
        size = len(brute.words(dict(docs)[r["doc_id"]]))
        source = sources[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size, sizes[source]) and abs(r["target"] - want[source]) < 1e-6 * max(want[source], 1)
        assert 0 <= r["taken"] <= 2 * size and (not size or r["taken"] % size == 0)
        taken[source] += r["taken"]
    largest = max(len(brute.words(t)) for _, t in docs)
    assert all(abs(taken[s] - want[s]) <= largest for s in sizes)
    assert sorted(map(str, first)) == sorted(map(str, run(spark, folder, 6)))


def test_op7(spark, folder, docs, ids):
    pieces, spaces = defaultdict(list), defaultdict(list)
    for r in run(spark, folder, 7):
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        spaces[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for i, found in pieces.items():
        at = 0
        for n, (piece, start, length, crc) in enumerate(sorted(found)):
            assert (piece, start) == (n, at) and 0 < length <= 1024 and (length == 1024 or n == 0)
            assert crc == brute.crc(ids[i][start:start + length])
            at += length
        assert at == len(ids[i])
    for found in spaces.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024
    lengths = [n for x in pieces.values() for _, _, n, _ in x]
    assert len(spaces) <= brute.best_fit_decreasing(lengths, 1024)


def test_op8(spark, folder, docs, ids):
    at, want = 0, {}
    for i, _ in sorted(docs):
        want[i] = (at, len(ids[i]), brute.crc(ids[i]))
        at += len(ids[i])
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in run(spark, folder, 8)} == want


def test_op9(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    names = np.array([r["vec_id"] for r in table])
    points = np.array([r["embedding"] for r in table], np.float64)
    found = defaultdict(list)
    for r in run(spark, folder, 9):
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q in names[names % 20 == 0]:
        own = points[names == q][0]
        best = sorted((-float(s), int(i)) for s, i in zip(points @ own, names) if i != q)[:20]
        mine = sorted(found[q])
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert all(abs(s - points[names == i][0] @ own) < 1e-9 for _, i, s in mine)
        hits += len({i for _, i in best} & {i for _, i, _ in mine})
    assert hits >= 0.9 * 20 * sum(names % 20 == 0)


def test_op10(spark, folder, docs):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    out = run(spark, folder, 10)
    assert sorted(r["doc_id"] for r in out) == sorted(i for i, _ in docs)
    assert all(r["held_out"] == in_fold(r["doc_id"], 3, 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out)
    known = [(labels[r["doc_id"]], r["predicted"]) for r in out if r["held_out"] and r["doc_id"] in labels]
    clean = [p for y, p in known if not y]
    assert sum(clean) <= 0.05 * len(clean)


def test_op11(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r["conv_id"]: tuple(r)[1:] for r in run(spark, folder, 11)} == new.expected(rows)


def test_op12(spark, folder, docs, ids):
    want = {i: (len((t or "").encode()), len(ids[i]) - 1, len(ids[i]) - 1 > 512) for i, t in docs}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in run(spark, folder, 12)} == want


def test_op13(spark, folder):
    """Every count is that of the texts; the whole result is held against SQL and, on other texts, a plain version."""
    texts = [(r["lang"], brute.lower(r["text"])) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    pieces = defaultdict(list)
    for lang, t in texts:
        pieces[lang or "und"] += [f" {' '.join(p.replace(chr(9), ' ').split(' '))} " for p in re.split(r"[.,;:!?\n-\r]", t)]
    for r in run(spark, folder, 13):
        phrase = " ".join(r["phrase"].split(" "))
        found = sum(len(re.findall(rf"(?=(?:^| ){re.escape(phrase)} )", re.sub(" +", " ", p))) for p in pieces[r["lang"]])
        assert found == r["a"] >= 100
