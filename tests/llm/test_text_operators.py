"""Jaccard join, substrings, quality, personal data, toxicity and language model against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from tillwatch.llm import jaccard, lm, pii, quality, substrings, toxicity

OPERATORS = {
    "jaccard": lambda d: jaccard.jaccard_join(d),
    "substrings": lambda d: substrings.remove_repeats(d),
    "quality": lambda d: quality.judge(d),
    "lm": lambda d: lm.score(d, F.lit(True), F.lit(False)),
    "pii": lambda d: pii.find(d, pii.SemiMarkov()),
}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    made = brute.awkward()
    vocabulary = [f"v{i}" for i in range(400)]
    for n in range(30):  # groups of near copies, and texts that share a passage
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 150))]
        for copy in range(rng.randrange(1, 5)):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            made.append((100 + 10 * n + copy, " ".join(text), "en", "s", 1, 1, "t", 1, "m"))
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    for n in range(60):
        own = " ".join(f"own{n}x{i}" for i in range(rng.randrange(0, 80)))
        made.append((1000 + n, f"{own} {passage} {own[::-1]}", "de", "s", 1, 1, "t", 1, "m"))
    return made


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, brute.SCHEMA).repartition(5)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], brute.SCHEMA)).count() == 0


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80)])
def test_jaccard_components(docs, rows, k, percent):
    want = brute.components([r[:2] for r in rows], k, percent)
    out = jaccard.jaccard_join(docs, k, percent).collect()
    assert Counter((r["doc_id"], r["n_shingles"]) for r in out) == Counter((r[0], len(brute.shingles(r[1], k))) for r in rows)
    assert all(r["component_id"] == (want[r["doc_id"]] if r["doc_id"] is not None else None) for r in out)


def test_one_of_each_group_stays(docs, rows):
    want = brute.components([r[:2] for r in rows], 4, 85)
    kept = [r["doc_id"] for r in jaccard.keep_one(docs).collect()]
    assert Counter(i for i in kept if i is not None) == Counter({i: 1 for i in want.values()})
    assert kept.count(None) == sum(r[0] is None for r in rows)


@pytest.fixture(scope="module")
def several(spark):
    """Forty ids with two or three texts each, the smallest of most groups among them."""
    rng = random.Random(8)
    made = []
    for n in range(120):
        text = [f"a{n}x{i}" for i in range(rng.randrange(3, 60))]
        for copy in range(rng.randrange(1, 4)):
            near = list(text)
            if len(near) > 30 and copy:
                near[-1] = f"other{copy}"
            made.append((rng.randrange(40) if copy == 0 or n % 3 else 100 + 10 * n + copy, " ".join(near), f"s{n % 5}", copy))
    made += [(3, made[0][1], "s9", 9), (3, made[0][1], "s8", 9), (3, made[0][1], "s8", 9), (77, None, None, None), (77, "", None, None)]
    return made


def test_repeated_smallest_ids(spark, several):
    table = spark.createDataFrame(several, "doc_id long, text string, source string, n int").repartition(6)
    want = brute.components([r[:2] for r in several], 4, 85)
    for _ in range(2):
        out = jaccard.jaccard_join(table).collect()
        assert len(out) == len(several) and {r["doc_id"]: r["component_id"] for r in out} == want
        assert Counter((r["doc_id"], r["n_shingles"]) for r in out) == Counter((r[0], len(brute.shingles(r[1], 4))) for r in several)


def test_kept_documents_keep_all_their_texts(spark, several):
    want = brute.components([r[:2] for r in several], 4, 85)
    expected = Counter({(i, t) for i, t, *_ in several if want[i] == i})
    for pieces in (2, 9):
        table = spark.createDataFrame(several, "doc_id long, text string, source string, n int").repartition(pieces)
        kept = jaccard.keep_one(table).collect()
        assert Counter((r["doc_id"], r["text"]) for r in kept) == expected
        seen = sorted(map(str, kept))
        assert pieces == 2 or seen == first
        first = seen


@pytest.mark.parametrize("shard", [48, 1])
def test_repeated_runs_go(docs, rows, shard, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD", shard)  # 1: every shard is split by runs
    want = brute.without_repeats([r[:2] for r in rows], 20)
    expected = Counter((r[0], *want[r[0], r[1]]) for r in rows)
    out = substrings.remove_repeats(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in out) == expected


def test_quality_counts(docs, rows):
    out = quality.judge(docs).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r["doc_id"], *(r[c] for c in columns)) for r in out) == Counter((r[0], *brute.quality(r[1])) for r in rows)
    assert all(not r["kept"] for r in out if r["base_failed"])


def test_quality_bands(spark):
    rng = random.Random(2)
    letters = "etaoinshrdlu"
    prose = " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(800))
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(12)) for _ in range(300))
    same = " ".join(f"the same thing number {i // 40} again" for i in range(400))
    table = spark.createDataFrame([(1, prose), (2, noise), (3, same)], "doc_id long, text string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(table).collect()}
    assert kept[1] and not kept[2] and not kept[3]


def kept_plainly(text):
    """The verdict by compressing the text and every stretch of 2048 bytes, the last one ending at its end."""
    import zstandard
    raw = (text or "").encode()
    if not raw or brute.quality(text)[-1]:
        return False
    ratio = lambda part: len(zstandard.ZstdCompressor(level=3).compress(part)) / len(part)
    _, low, high = [b for b in quality.BANDS if b[0] <= len(raw)][-1]
    chunks = [raw[i:i + 2048] for i in range(0, len(raw) - 2047, 2048)]
    if len(raw) > 2048 and len(raw) % 2048:
        chunks.append(raw[-2048:])
    bad = sum(not 0.42 <= ratio(c) <= 0.66 for c in chunks)
    return low <= ratio(raw) <= high and 5 * bad <= len(chunks)


def test_quality_verdicts_equal_the_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["kept"] for r in quality.judge(docs).collect()}
    assert got == {i: kept_plainly(t) for i, t in texts.items()}
    assert sum(got.values()) > 0.8 * len(got)


def test_noise_in_short_texts_and_at_the_end(spark, folder):
    """Random letters are rejected from 96 bytes on, and as the second half of a text that is prose before."""
    rng = random.Random(3)

    def noise(size):
        words = []
        while sum(map(len, words)) + len(words) < size:
            words.append("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(10)))
        return " ".join(words)

    prose = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if len(r["text"] or "") > 2200]
    halves = [t.encode()[:2048].decode("utf-8", "ignore") + " " + noise(1935) for t in prose]
    short = [noise(rng.randrange(115, 1900)) for _ in range(100)]
    table = spark.createDataFrame(list(enumerate(halves + short)), "doc_id long, text string")
    assert len(halves) > 10 and table.count() == len(halves) + 100
    assert quality.judge(table).filter("kept").count() == 0


PERSONAL = [
    "mail a.b+c@x-y.example.com, or a@b@c.de now", "10.0.0.1 999.1.1.1 1.2.3.4.5", "card 4111 1111 1111 1111 and 4111111111111112",
    "+1 (269) 555-3296 call +49.30.1234567 or +1", "@@ a@b a@.c " + "x" * 3000 + "@y", "1" * 5000, "é 日 b@c.de 5500-0000-0000-0004", None, "",
    "0" * 4400 + ".1.1.1", "4111 1111 1111 1111 4111 1111 1111 1111",
]


def test_fixed_patterns_of_personal_data():
    for text in PERSONAL[:-2]:
        assert pii.base_spans(text or "") == brute.personal(text)
    assert pii.base_spans(PERSONAL[-2]) == [(0, 4406, "ip")]


def test_random_field_adds_and_spares(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = pii.fit(docs)
    found = pii.find(docs, model).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in found:
        base = [(s["start"], s["end"], s["kind"]) for s in r["base"]]
        assert base == brute.personal(texts[r["doc_id"]])
        assert {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]}
        assert all(0 <= s["start"] < s["end"] <= len(texts[r["doc_id"]]) for s in r["spans"])
    for number in ("4111111111111112", "2123465659789240"):  # wrong check digit
        assert pii.all_spans(f"the number {number} here", model)[1] == []
    assert pii.all_spans("reach me at 269-555-3296 today", model)[1] == [(12, 24, "phone")]


def test_spelled_addresses_without_digits(spark):
    names = "anna ben carl dora emil fred gina hans ida jon".split()
    rows = [(i, f"please write to {names[i % 10]}.{names[i // 10 % 10]}@{names[i // 3 % 10]}{'.example' * (i % 2)}.com today or look at the house") for i in range(300)]
    model = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    forms = ["john.doe(at)mail.host.com", "john.doe[at]mail.host.com", "john.doe (at) mail.host.com", "john.doe at host dot com",
             "john.doe(AT)mail.host.com"]
    texts = [f"please write to {form} today" for form in forms] + ["look at the house", "that is late"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find(docs, model).collect()}
    for i, form in enumerate(forms):
        assert found[i] == [("email", 16, 16 + len(form))], form
    assert not found[5] and not found[6]


def test_redaction_keeps_the_rest(spark):
    rows = [(1, "write to a@b.example.com please", "x"), (2, None, "y"), (3, "nothing", None)]
    out = pii.redact(spark.createDataFrame(rows, "doc_id long, text string, other string"), pii.SemiMarkov())
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, "write to [EMAIL] please", "x"), (2, None, "y"), (3, "nothing", None)]


def test_language_model_equals_counting(docs, rows, monkeypatch):
    monkeypatch.setattr(lm, "SHARD", 3000)  # several shards
    fold = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(i, brute.words(brute.lower(t)) + ["</s>"]) for i, t, *_ in rows]
    single, pair, starts = Counter(), Counter(), 0
    for i, w in tokens:
        if i is not None and not fold(i):
            single.update(w)
            pair.update(zip(["<s>", *w], w))
            starts += 1
    total, kinds, mu = sum(single.values()), len(single), lm.MU
    p1 = lambda x: (single[x] + 1) / (total + kinds + 1)
    want = Counter()
    for i, w in tokens:
        base = sum(math.log10(p1(x)) for x in w)
        score = sum(math.log10((pair[h, x] + mu * p1(x)) / ((starts if h == "<s>" else single[h]) + mu)) for h, x in zip(["<s>", *w], w))
        want[i, fold(i), len(w), sum(x in single for x in w), total, round(base, 3)] += 1
    held = toxicity.in_fold("doc_id", 7, 2)
    out = lm.score(docs, ~held, held).collect()
    keys = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    assert Counter((*(r[k] for k in keys), round(r["base_score"], 3)) for r in out) == want
    near = {(i, len(w)): sum(math.log10((pair[h, x] + mu * p1(x)) / ((starts if h == "<s>" else single[h]) + mu))
                             for h, x in zip(["<s>", *w], w)) for i, w in tokens}
    assert all(abs(r["score"] - near[r["doc_id"], r["n_tokens"]]) < 0.03 * r["n_tokens"] for r in out)


def test_language_model_of_a_pair_many_times(spark):
    n = 70_000
    docs = spark.createDataFrame([(1, "word " * n), (2, "word word other")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in lm.score(docs, F.lit(True), F.lit(False)).collect()}
    pair = Counter({("<s>", "word"): 2, ("word", "word"): n, ("word", "</s>"): 1, ("word", "other"): 1, ("other", "</s>"): 1})
    single, total, mu = Counter({"word": n + 2, "other": 1, "</s>": 2}), n + 5, lm.MU
    step = lambda h, x: math.log10((pair[h, x] + mu * (single[x] + 1) / (total + 4)) / ((2 if h == "<s>" else single[h]) + mu))
    want = step("<s>", "word") + (n - 1) * step("word", "word") + step("word", "</s>")
    assert out[1]["n_tokens"] == n + 1 and abs(out[1]["score"] - want) < 0.03 * n
    counts = np.array([1, 64, 70_000, 26_000_000, 4_000_000_000])
    trie = lm.Trie(lm.Trie.build(np.arange(5, dtype=np.uint64), counts))
    assert (abs(trie.count(np.arange(5, dtype=np.uint64)) / counts - 1) < 0.04).all()


def test_language_model_works_out_only_the_counts_asked_for(monkeypatch):
    counts = np.append(np.arange(1, 50_000), [26_000_000, 4_000_000_000])
    trie, worked, values = lm.Trie(lm.Trie.build(np.arange(len(counts), dtype=np.uint64) << np.uint64(31), counts)), [], lm._values
    monkeypatch.setattr(lm, "_values", lambda steps: (worked.append(len(steps)), values(steps))[1])
    asked = np.array([3, 70, 40_000, 49_999, 50_000, 60_000], np.uint64) << np.uint64(31)
    for _ in range(10):  # each batch of texts asks its shards
        got = trie.count(asked)
        assert (abs(got[:5] / counts[[3, 70, 40_000, 49_999, 50_000]] - 1) < 0.04).all() and got[3] != got[4] and got[5] == 0
    assert sum(worked) <= 10 * len(asked)


def test_language_model_without_training(spark, docs):
    out = lm.score(docs, F.lit(False), F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0.0 and r["held_out"] for r in out)


def test_deobfuscation():
    words = "idiot stupid loser the and with moron pathetic worthless scum trash clown you are very person today".split()
    restorer = toxicity.Restorer(toxicity.CharModel({w: 50 for w in words}))
    cases = {"an 1d10t and a l0ser": "an idiot and a loser", "i d i o t today": "idiot today", "p.a.t.h.e.t.i.c": "pathetic",
             "a looooser, worthlesssss": "a loser, worthless", "$cum and tr@sh!!": "scum and trash!!",
             "Plain text. Nothing to see, 12 of 30.": "Plain text. Nothing to see, 12 of 30.", "": ""}
    from tillwatch.llm.words import utf8
    import pyarrow as pa

    data, at = toxicity._restored(*utf8(pa.array(list(cases))), restorer)
    assert [data[at[i]:at[i + 1]].tobytes().decode() for i in range(len(cases))] == list(cases.values())


def test_deobfuscation_of_each_form():
    words = ("idiot stupid loser the and with moron pathetic worthless scum trash clown you are very person today "
             "kill ass dumbass hello see this bad covid user well").split()
    restorer = toxicity.Restorer(toxicity.CharModel({w: 50 for w in words}))
    cases = {
        "a dumba$$ here": "a dumbass here", "idio7": "idiot", "a55": "ass", "1d10t": "idiot",  # signs at the end
        "i d 1 o t": "idiot", "k i l l today": "kill today", "a s s": "ass", "a 5 5": "ass", "k  i   l l": "kill",  # rows
        "stop k i l l!": "stop kill!", "(i d 1 o t)": "(idiot)",
        "s€€": "see", "k¡ll": "kill", "we££": "well", "k¡££ you": "kill you",  # signs of several bytes
        "l" + "o" * 60 + "ser": "loser", "l" + "0" * 500 + "ser": "loser",  # long repeats
        "hello! (see this) covid19 @user bad.": "hello! (see this) covid19 @user bad.", "12 30 1 2 3 4": "12 30 1 2 3 4",
    }
    from tillwatch.llm.words import utf8
    import pyarrow as pa

    data, at = toxicity._restored(*utf8(pa.array(list(cases))), restorer)
    got = [data[at[i]:at[i + 1]].tobytes().decode() for i in range(len(cases))]
    assert dict(zip(cases, got)) == cases
    long = "x1y2" * 20_000  # a word of any length is read whole
    assert len(toxicity.restore_text(long, restorer)) >= 70_000


@pytest.fixture(scope="module")
def toxic(spark):
    rng = random.Random(6)
    plain = ["".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randrange(3, 9))) for _ in range(2000)]
    bad = ["loser", "stupid", "moron", "clown"]
    rows = []
    for i in range(600):
        text = [rng.choice(plain) for _ in range(60)]
        label = i % 6 == 0
        if label:
            for place in rng.sample(range(60), 3):
                text[place] = rng.choice(bad) if i % 12 else rng.choice(["l0ser", "s t u p i d", "m0r0n", "cl0wn"])
        rows.append((i, " ".join(text), int(label)))
    return rows


def test_toxicity_on_held_out_rows(spark, toxic):
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t, _ in toxic] + [(None, None, "a", None), (900, "", None, None)],
                                 "doc_id long, text string, toxic string, score string")
    held = toxicity.in_fold("doc_id", 3, 1)
    labels = spark.createDataFrame([(i, y) for i, _, y in toxic] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.filter(~held))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    known = [(y, scores[i] >= toxicity.THRESHOLD) for i, _, y in toxic if zlib.crc32(str(i).encode()) % 3 == 1]
    caught = sum(p for y, p in known if y) / sum(y for y, _ in known)
    false = sum(p for y, p in known if not y) / sum(not y for y, _ in known)
    assert caught >= 0.9 and false <= 0.02 and 0 <= scores[900] < 0.5
    table = docs.withColumn("toxicity_score", F.lit("mine")).withColumn("doc", F.lit(1))  # clashing names
    left = toxicity.drop_toxic(table, model)
    assert left.columns == table.columns
    stays = Counter(i for i, x in scores.items() if x < toxicity.THRESHOLD)
    assert Counter(r["doc_id"] for r in left.collect()) == stays and 900 in stays


def test_toxicity_without_labels(spark, docs):
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.5}


def test_toxicity_counts_all_labelled_rows(spark):
    """More rows than any sample held; a doc_id with several texts is one document, copies are one context."""
    rows, labels = [], []
    for i in range(13_000):
        toxic = i % 100 == 0
        rows.append((i, f"w{'abcdefgh'[i % 8]}{'klmnopqr'[i // 8 % 8]} {'zorkling' if toxic else 'plain'} text" if i % 200 else "same zorkling copied brabble"))
        labels.append((i, int(toxic)))
    rows += [(100, "other zorkling words"), (100, "other zorkling words")]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model.prior == math.log(130 / 12_870)
    contexts = {t.split()[0] for i, t in rows if i % 100 == 0}
    # the whole word and its beginnings of 4, 5, 6 letters; the copied text's other words have one context
    assert len(model.keys) == 4 and 4 <= len(contexts) < 130
    assert np.allclose(model.weights, math.log((len(contexts) + 0.5) / 131) - math.log(1 / 12_871) - toxicity.DISCOUNT)


def test_random_field_learns_from_all_rows(spark):
    """Finds that come after thousands of stretches without any, and in shards of their own."""
    names = "anna ben carl dora emil fred gina hans ida jon".split()
    rows = [(i, f"there were {i} of them") for i in range(5_000)]
    rows += [(10_000 + i, f"please write to {names[i % 10]}.{names[i // 10 % 10]}@{names[i // 3 % 10]}{'.example' * (i % 2)}.com today") for i in range(300)]
    docs = spark.createDataFrame(rows + [(None, None), (None, "call 12")], "doc_id long, text string")
    for shard in (pii.SHARD, 2_000):
        model = pii.fit(docs.repartition(5), shard)
        assert pii.all_spans("please write to john.doe(at)mail.host.com today", model)[1] == [(16, 41, "email")]
        assert model.weights == pii.fit(docs.repartition(3), shard).weights


def test_only_points_of_pairs_are_measured(spark):
    classes = spark.range(20_000).select(F.col("id").alias("doc"), F.array(F.lit(1).cast("bigint")).alias("sketch"), F.lit(0).cast("bigint").alias("d1"), "id")
    pairs = spark.createDataFrame([(5, 6), (5, 7)], "doc long, pivot long")
    assert {5, 6, 7} <= (left := {r["doc"] for r in jaccard._paired(pairs, classes).collect()}) and len(left) < 10


def test_words_around_marks(spark):
    """The parts that the field learns from are those of one pattern; very long texts and words are read as well."""
    edge = r"[()\[\]{}<>\"'.,;:!?]"
    mark = rf"(?:[^ \t-\r]*(?:[0-9@]|[\[({{<]at[\])}}>])[^ \t-\r]*|(?<![^ \t-\r]){edge}*at{edge}*(?![^ \t-\r]))"
    part = re.compile(rf"(?i)(?:[^ \t-\r]+[ \t-\r]+){{0,3}}(?:{mark}[ \t-\r]*)+(?:[^ \t-\r]+[ \t-\r]*){{0,3}}")
    rng = random.Random(6)
    words = ["a", "at", "(AT)", "x(at)y", "[at", "at]", "9", "b@c", "at.", "cat", "é", "日", "dot", "at\x1c", *"uvwxyz" * 3]
    texts = [None, "", "at", " a", "1"] + ["".join(rng.choice(words) + rng.choice([" ", "  ", "\n"]) for _ in range(rng.randrange(30))) + rng.choice(["", "at"]) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(texts), pa.int32()), pa.array(range(len(texts))), pa.array(texts)], ["shard", "doc_id", "text"])
    found = {i: parts for b in pii._around(iter([batch, batch.slice(0, 0)])) for i, parts in zip(b.column("doc_id").to_pylist(), b.column("parts").to_pylist())}
    want = {i: part.findall(t or "") for i, t in enumerate(texts)}
    assert found == {i: p for i, p in want.items() if p}
    long = spark.createDataFrame([(1, "12 " * 60_000), (2, "x" * 400_000 + " at")], "doc_id long, text string")
    assert pii.fit(long).weights == {}  # a pattern over the whole text ran out of stack here


def test_long_sets_are_moved_once(spark, monkeypatch):
    """Texts of 8,000 words that share a third are told apart by their sketches; sets of linked ones go by point once."""
    rng = random.Random(12)
    shared = [f"s{i}" for i in range(2_700)]
    rows = [(n, " ".join(shared + [f"w{n}x{i}" for i in range(5_400)])) for n in range(10)]
    rows += [(19 + n, f"{text} {' '.join(f'more{n}x{i}' for i in range(150 * n))}") for n, text in rows[1:4]]  # sketches of two lengths
    for n in range(4):
        words = rows[n][1].split()
        for _ in range(60):
            words[rng.randrange(len(words))] = "other"
        rows.append((30 + n, " ".join(words)))
    asked, plans = [], []

    def seen(df, label="stage"):
        if label == "measured":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        out = materialize(df, label)
        if label == "asked":
            asked.append(out.count())
        assert label != "sets"
        return out

    materialize = jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r["doc_id"]: r["component_id"] for r in out} == brute.components(rows, 4, 85)
    assert asked[0] == 7 and "ReusedExchange" in plans[0].split("== Initial Plan ==")[0]
