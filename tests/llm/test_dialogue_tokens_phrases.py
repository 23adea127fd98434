"""Conversation repair, token counts and phrase mining against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import brute
from tillwatch.llm import phrases, repair, transducer
from tillwatch.llm.tokens import default_path
from tillwatch.llm.words import utf8

GOOD = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, kind int, cost string, audit long"


# conversations

def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        dealt = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if dealt == 0:
            continue
        text = "" if dealt == 1 else re.sub("[.!?]", "", text) if dealt == 2 else text
        out += [(conv, turn, "user" if dealt == 4 else role, text)] * (2 if dealt == 3 else 1)
    return out


def faults(rows):
    """(fault or None) of each (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by a plain table over rows and four hand-made states.

    States: 0 nothing yet, 1 system turn or whole pairs last and a user turn due, 2 an assistant
    turn due, 3 as 1 with at least one pair.
    """
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    names = {"u": "user", "a": "assistant"}
    best = {0: (0, "", ())}

    def offer(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value
            return True

    def inserts(table):
        while any([offer(table, after[s, x], (c + 2, a + "I", r + ((names[x], ""),)))
                   for s, (c, a, r) in list(table.items()) for x in "ua" if (s, x) in after]):
            pass

    for (role, text), fault in zip(rows, faults(rows)):
        inserts(best)
        new = {}
        for s, (c, a, r) in best.items():
            offer(new, s, (c + 3, a + "D", r))
            if fault not in ("blank", "duplicate"):
                extra = int(fault == "truncated")
                if (s, role[:1]) in after:
                    offer(new, after[s, role[:1]], (c + extra, a + "K", r + ((role, text),)))
                for x in "ua":
                    if (s, x) in after:
                        offer(new, after[s, x], (c + 2 + extra, a + "R", r + ((names[x], text),)))
        best = new
    inserts(best)
    return min((v for s, v in best.items() if s in (0, 3)), key=lambda v: v[:2])


def expected(rows):
    """conv_id -> the whole row of the query."""
    kept = defaultdict(list)
    for row in damaged(rows):
        kept[row[0]].append(row)
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(kept[conv], key=lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        turns = [r[1] for r in mine if r[1] is not None]
        found = Counter(faults([r[2:] for r in mine]))
        initials = [r[2][:1] for r in mine]
        cost, audit, repaired = cheapest([r[2:] for r in mine])
        assert GOOD.match("".join(r[0][:1] for r in repaired))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found["blank"], found["duplicate"], found["truncated"],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(7)
    texts = ["Yes.", "No!", "cut off", "", " \t\n", "Why?", "Good. \r\n", None, "Ünd é", "a.b", "same text."]
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system", "system", None, "", "tool", "sys", "User"]
    rows = []
    for conv in [*range(300), None]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, None if rng.random() < 0.03 else turn * rng.choice([1, 1, 1, 2]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {conv} {turn}."))
    for turn in range(3000):  # lies in several ranges, alternates with faults
        rows.append((1000, turn, ("user", "assistant")[(turn + (turn > 1500)) % 2] if turn else "system", f"line {turn % 900}" + "." * (turn % 5 > 0)))
    rows += [(1001, 5, "user", "again.")] * 400 + [(1001, 6, "assistant", "again.")] * 3
    return rows


@pytest.fixture(scope="module")
def talk_table(spark, talks):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in talks], SCHEMA).repartition(7)


def test_conversations_equal_the_plain_version(talk_table, talks):
    out = repair.digest(repair.damage(talk_table), talk_table).collect()
    want = expected(talks)
    assert len(out) == len(want)
    assert {r["conv_id"]: tuple(r)[1:] for r in out} == want


def test_repaired_rows(talk_table, talks):
    rows = repair.repaired(repair.damage(talk_table)).collect()
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["place"]):
        assert r["place"] == len(found[r["conv_id"]])
        found[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for conv, row in expected(talks).items():
        assert hashlib.sha256("\n".join(found[conv]).encode()).hexdigest() == row[-1]


def test_a_conversation_in_many_ranges(spark, talks):
    """The same answers when every range holds a few rows."""
    rows = [r for r in talks if r[0] in (1000, 1001, 3)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        out = repair.digest(repair.damage(table), table).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert {r["conv_id"]: tuple(r)[1:] for r in out} == expected(rows)


def test_plain_version_against_all_edits():
    """Every edit of up to three rows with up to two inserted turns in each gap."""
    names = {"u": "user", "a": "assistant"}
    gaps = [""] + ["".join(p) for n in (1, 2) for p in itertools.product("ua", repeat=n)]
    rows = [("user", "x."), ("assistant", "y"), ("system", "z."), ("user", ""), ("tool", "w.")]
    for n in range(4):
        for pick in itertools.product(rows, repeat=n):
            bad, options = faults(pick), []
            for (role, text), fault in zip(pick, bad):
                stay = int(fault == "truncated")
                one = [(3, "D", None)]
                if fault not in ("blank", "duplicate"):
                    one += [(stay, "K", (role, text))] + [(2 + stay, "R", (names[x], text)) for x in "ua"]
                options.append(one)
            found = []
            for edits in itertools.product(*options):
                for filled in itertools.product(gaps, repeat=n + 1) if n < 3 else itertools.product(gaps[:3], repeat=n + 1):
                    parts, audit, cost = [], "", 0
                    for k in range(n + 1):
                        parts += [(names[x], "") for x in filled[k]]
                        audit += "I" * len(filled[k])
                        cost += 2 * len(filled[k])
                        if k < n:
                            cost, audit = cost + edits[k][0], audit + edits[k][1]
                            parts += [edits[k][2]] if edits[k][2] else []
                    if GOOD.match("".join(r[:1] for r, _ in parts)):
                        found.append((cost, audit, tuple(parts)))
            assert cheapest(pick) == min(found, key=lambda v: v[:2])


def test_parser_of_other_grammars():
    with pytest.raises(ValueError):
        repair.Parser((("A", "uAa"), ("A", "")))  # its stacks grow without bound
    with pytest.raises(ValueError):
        repair.Parser((("A", "u"), ("A", "B"), ("B", "u")))  # two reductions
    pairs = repair.Parser((("P", "Pua"), ("P", "ua")))
    assert pairs.accepts[0] is False and pairs.close({0: (0, "")}) == (4, "II")


def test_pruning_and_trimming_change_nothing(monkeypatch):
    rng = random.Random(3)
    for n in (5, 40, 700):
        rows = [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]
        results = []
        for slack, trim in ((repair.SLACK, 16), (10 ** 9, 10 ** 9)):
            monkeypatch.setattr(repair, "SLACK", slack)
            monkeypatch.setattr(repair, "TRIM", trim)
            branches = repair.Branches(repair.parser(), 0)
            for symbol, must, extra in rows:
                branches.row(symbol, must, int(extra))
            results.append(repair.parser().close(branches.leaving()))
        assert results[0] == results[1]


# tokens

def sample_texts():
    rng = random.Random(1)
    signs = "ab'strevldm  \t\n.,!1２²é日本　 'LlREVE_-ß\U0001F600́‍\r\x0b\x1c\x85"
    made = ["".join(rng.choice(signs) for _ in range(rng.randrange(0, 70))) for _ in range(1500)]
    made += ["one <|endoftext|> two<|endoftext|>", "<|endoftext|>" * 3, "<|endoftext|", " <|endoftext|>\n\n<|endoftext|> x", "x" * 5000, "ab" * 3000,
             " " * 700, "\n" * 300 + "a", "", None, "'re'", "'r", "'ve 'v 'll 'l", "we'll've  'd", "a" + "'" * 900 + "s",
             "".join(chr(rng.randrange(33, 127)) for _ in range(20_000)),
             "".join(chr(rng.choice([rng.randrange(0x100, 0xD7FF), rng.randrange(0xE000, 0x1FFFF)])) for _ in range(8_000)),
             " ".join(f"w{i * 7919 % 5003}" for i in range(150_000))]
    return made


def test_token_counts_are_the_librarys(spark):
    texts = sample_texts()
    rows = [(i if i % 50 else None, t, i, "n") for i, t in enumerate(texts)]
    rows += rows[:3]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int, over_limit string").repartition(5)
    out = transducer.count_tokens(table).collect()
    library = transducer.counter(default_path()).library
    sizes = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    want = Counter((r[0], len((r[1] or "").encode()), sizes[r[2]], sizes[r[2]] > 512) for r in rows)
    assert Counter(tuple(r) for r in out) == want
    assert transducer.count_tokens(table.filter("false")).count() == 0


def test_chunk_maps_equal_one_run():
    rng = np.random.default_rng(2)
    for n in (0, 1, 255, 256, 257, 5000):
        classes = rng.integers(0, transducer.CLASSES, n).astype(np.uint8)
        state, begins = 0, np.zeros(n + 1, bool)
        for i, c in enumerate(classes.tolist()):
            state, mark = transducer._move(state, c)
            begins[i] |= bool(mark & transducer.HERE)
            begins[i - 1] |= bool(mark & transducer.BEFORE) and i > 0
        end = transducer._move(state, transducer.BEGIN)[1]
        begins[n - 1] |= bool(end & transducer.BEFORE) and n > 0
        got = transducer.marks(classes)
        if n % transducer.CHUNK:  # a full last chunk has nothing after it that could end the text
            assert got.tolist() == begins[:n].tolist()
    maps = rng.integers(0, transducer.STATES, (37, transducer.STATES)).astype(np.uint8)
    got, one = transducer.compose(maps * transducer.CLASSES), np.arange(transducer.STATES)
    for i in range(37):
        one = maps[i][one]
        assert (got[i] == one * transducer.CLASSES).all()


def test_states_that_start_anew(monkeypatch):
    """Counts are the same when compiled states are forgotten all the time."""
    monkeypatch.setattr(transducer, "KNOWN", 10)
    made = transducer.Counter(default_path())
    texts = [t or "" for t in sample_texts()[:200]]
    for t in texts:
        data, offsets = utf8(pa.array([t]))
        assert made.texts(data, offsets).tolist() == [len(made.library.encode(t, add_special_tokens=False).ids)]


# phrases

def mined(rows, least, top):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    out, around = defaultdict(list), Counter()  # the most frequent longer candidate that holds a phrase
    for (lang, q), n in counts.items():
        if n >= least:
            for k in range(1, len(q)):
                for i in range(len(q) - k + 1):
                    around[lang, q[i:i + k]] = max(around[lang, q[i:i + k]], n)
    for (lang, phrase), a in counts.items():
        if len(phrase) < 2 or a < least or around[lang, phrase] >= a:
            continue
        cuts = [(1000 * a * total[lang] // (counts[lang, phrase[:k]] * counts[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(phrase).encode(), counts[lang, phrase[:k]], counts[lang, phrase[k:]]))
    return {(lang, i + 1): (phrase.decode(), -a, left, right, total[lang], -score)
            for lang, found in out.items() for i, (score, a, phrase, left, right) in enumerate(sorted(found)[:top])}


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)] + ["the", "of", "Of", "é", "日本", "\xa0", " x"]
    rows = [(r[2], r[1]) for r in brute.awkward()]
    for n in range(250):
        text = " ".join(rng.choice(words) + rng.choice(["", "", "", "", ",", ".", "\n", "\x0b", "\t", ":"]) for _ in range(rng.randrange(0, 60)))
        rows.append((rng.choice(["en", "en", "en", "de", None, "", "und"]), text + (" new york city hall annex. " if n % 3 else " NEW YORK, city") * 2))
    rows += [("en", "spam spam spam " * 200)] * 2 + [("fr", None), (None, None)]
    return rows


@pytest.mark.parametrize("least, top, held", [(10, 2000, None), (4, 25, 300)])
def test_phrases_equal_the_plain_version(spark, monkeypatch, prose, least, top, held):
    if held:  # tries that spill and burst all the time
        monkeypatch.setattr(phrases, "HELD", held)
    table = spark.createDataFrame([(lang, text, 1, "p") for lang, text in prose], "lang string, text string, n int, phrase string").repartition(6)
    out = phrases.collocations(table, least=least, top=top).collect()
    got = {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in out}
    assert len(got) == len(out) and got == mined(prose, least, top)


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(empty).count() == 0
    rare = spark.createDataFrame([("en", "a b c"), (None, None), ("en", "")], "lang string, text string")
    assert phrases.collocations(rare).count() == 0


@pytest.mark.parametrize("width", [1, 2, 5])
def test_trie_counts_and_sorted_runs(width):
    rng = np.random.default_rng(width)
    trie, want, got = phrases.HatTrie(width, burst=20), Counter(), Counter()
    for _ in range(30):
        rows = rng.integers(0, 9, (200, width)).astype(np.uint64)
        trie.add(rows)
        want.update(map(tuple, rows.tolist()))
        if trie.size > 500:
            keys, counts = trie.spill(0.5)
            assert keys.tolist() == sorted(keys.tolist()) and len(set(map(tuple, keys.tolist()))) == len(keys)
            assert trie.size == sum(trie._entries(x) for x in trie.root.values()) <= 500
            got.update(dict(zip(map(tuple, keys.tolist()), counts.tolist())))
    keys, counts = trie.spill(1.0)
    got.update(dict(zip(map(tuple, keys.tolist()), counts.tolist())))
    assert got == want and trie.size == 0 and not trie.root


def test_filters_let_all_their_keys_through(spark):
    keys = np.stack((np.arange(5000) * 7919, np.arange(5000) % 13), axis=1)
    table = spark.createDataFrame([(k,) for k in keys.tolist()], "ids array<long>")
    for most in (1 << 10, 1 << 20):  # also one that is far too small
        made = phrases.bloom(table, len(keys), most)
        assert phrases.lets_through(made, phrases._joint(keys.astype(np.uint64))).all()
    others = phrases._joint(np.stack((np.arange(10 ** 9, 10 ** 9 + 10_000), np.zeros(10_000)), axis=1).astype(np.uint64))
    assert phrases.lets_through(phrases.bloom(table, len(keys)), others).mean() < 0.02


@pytest.mark.parametrize("merged", [1, 150, 10 ** 9])
def test_runs_merge_block_by_block(monkeypatch, merged):
    """Overlapping sorted runs of several parts, cut into blocks that come by part and first row."""
    monkeypatch.setattr(phrases, "MERGED", merged)
    rng = np.random.default_rng(1)
    want, blocks = Counter(), []
    for part in range(3):
        for _ in range(8):
            rows = rng.integers(0, 3, (300, 5)).astype(np.uint64)
            rows[:, 0] += np.uint64(10 * part + 2 ** 63 * (part == 2))  # ids use all 64 bits
            rows[:, 1:3] += np.uint64(1)
            rows[rows[:, 3] == 0, 4] = 0
            rows = rows[np.lexsort(rows.T[::-1])]
            n = rng.integers(1, 5, 300)
            for r, c in zip(rows.tolist(), n.tolist()):
                for k in (4, 5):
                    if r[k - 1]:
                        want[tuple(r[:k])] += c
            blocks += [(part, rows[i].astype(">u8").tobytes(), phrases._written(rows[i:i + 37], n[i:i + 37])) for i in range(0, 300, 37)]
    blocks.sort(key=lambda b: b[:2])
    for size in (1, 7, 4000):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*blocks[i:i + size])], ["part", "first", "block"]) for i in range(0, len(blocks), size)]
        got = [(tuple(x % 2 ** 64 for x in p), c) for b in phrases._merge(4, 5, 60)(iter(batches))
               for p, c in zip(b.column("ids").to_pylist(), b.column("n").to_pylist())]
        assert len(dict(got)) == len(got) and dict(got) == {p: c for p, c in want.items() if c >= 60}
