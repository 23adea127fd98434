"""Plain versions of the operators for small tables, and awkward tables to run them on."""

import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, target string, block int, marks string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(text or "")


def awkward():
    """Nulls in every column, blanks, a very long text, repeated rows, copies, clashing column names."""
    base = " ".join(f"word{i % 97}x{i % 13}" for i in range(120))
    edited = base.replace("word5x5", "other")
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(20_000))
    texts = [
        (1, base), (2, base), (3, edited), (4, None), (5, ""), (6, " \n\t "), (7, "one two"), (8, "One two"), (9, long),
        (10, long + " end"), (11, "a b c\na b c\n\nx"), (11, "a b c\na b c\n\nx"), (12, base), (12, "quite another text of five words"),
        (None, base), (None, None), (13, "Ünïcode — ß 日本 語 é x"), (14, base + " " + base), (15, "x" * 5000),
        (16, " ".join(["same"] * 100)),
    ]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", None if k % 7 == 0 else len(t or ""), k, "t", None, "m")
            for k, (i, t) in enumerate(texts)]


def shingles(text, k):
    w = words(lower(text))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(rows, k, percent):
    """Smallest linked doc_id of each doc_id; rows (doc_id, text)."""
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if i == j or s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def without_repeats(rows, span):
    """(n_words, n_removed, text left) of each distinct row, by doc_id and text."""
    first = {}
    for i, t in sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], r[1] or "")):
        w = words(t)
        for p in range(len(w) - span + 1):
            key = tuple(w[p:p + span])
            if key not in first or (i, p) < first[key]:
                first[key] = (i, p)
    out = {}
    for i, t in set(rows):
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - span + 1 if i is not None else 0):
            if first[tuple(w[p:p + span])] < (i, p):
                gone[p:p + span] = [True] * span
        out[i, t] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def quality(text):
    t = text or ""
    w = words(t)
    seen, lines = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    runs = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    marks = [False] * len(w)
    for i in range(len(w) - 4):
        if runs[tuple(w[i:i + 5])] > 1:
            marks[i:i + 5] = [True] * 5
    repeats = sum(marks)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), lines, repeats, len(w) < 10 or 100 * repeats > 20 * len(w))


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    """The fixed patterns as written, by start and then kind."""
    t = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
              if all(int(p) <= 255 for p in m.group().split("."))]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m)) <= 15]
    return [(s, e, ("email", "ip", "card", "phone")[k]) for s, k, e in sorted(found)]


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Reshare what is above the caps until none is."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, full = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in full]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not over:
            return {s: full.get(s, level * weight[s]) for s in order}
        for s in over:
            full[s] = float(most * sizes[s])
            left -= full[s]


def best_fit_decreasing(lengths, limit):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(limit - n)
    return len(gaps)


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))
