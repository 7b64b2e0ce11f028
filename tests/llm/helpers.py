"""Small inputs and brute-force versions shared by the tests of the training-data operators."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

#: names that operators use inside or return
CLASHING = ("id", "tk", "rk", "at", "h", "d", "t", "w", "kept", "key", "line", "node", "n_words", "ids", "host", "low", "score", "bucket")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = "abcdefghij é"


def words(rng, n, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


def awkward(rng=None):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rng = rng or random.Random(5)
    long = "\n".join(words(rng, 40, 5000) + "." for _ in range(700))
    some = words(rng, 60)
    rows = [(1, None), (2, ""), (3, "  \n\t "), (None, words(rng, 30)), (None, None), (4, long), (5, some), (5, some),
            (5, words(rng, 50)), (6, some), (7, "One line here that is long.\n\nOne line here that is long."), (8, "é" * 300)]
    return [(i, t, None if n % 2 else "en", None if n % 3 else "src", None if n % 5 else 1) for n, (i, t) in enumerate(rows)]


def frame(spark, rows, schema=SCHEMA, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def with_clashes(df):
    return df.withColumns({c: F.lit("clash") for c in CLASHING if c not in df.columns})


def shingles(text, size=5):
    w = (text or "").encode().split()
    if len(w) >= size:
        return frozenset(tuple(w[a:a + size]) for a in range(len(w) - size + 1))
    return frozenset([tuple(w)] if w else [])


def near_classes(docs, least=0.8):
    """(class id, links) of each row of (id, text), by comparing all that share a shingle."""
    sets = [shingles(t) for _, t in docs]
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    links = defaultdict(set)
    for k, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for m in holders[x]:
                shared[m] += 1
        links[k] = {m for m, v in shared.items() if m != k and v >= least * (len(s) + len(sets[m]) - v) - 1e-9}
    out, seen = [None] * len(docs), set()
    for k in range(len(docs)):
        if k in seen:
            continue
        todo, group = [k], []
        seen.add(k)
        while todo:
            x = todo.pop()
            group.append(x)
            fresh = links[x] - seen
            seen |= fresh
            todo += fresh
        ids = [docs[x][0] for x in group]
        first = None if None in ids else min(ids)
        for x in group:
            out[x] = (docs[x][0], first, len(links[x]))
    return out


def within_one(a, b):
    """At most one character put in, taken out or replaced."""
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + 1:] == b[k + 1:] or a[k:] == b[k + 1:] or a[k + 1:] == b[k:]


def left_lines(docs, least=20):
    """What line dedup leaves of each text; ids must differ."""
    white = " \t\x0b\x0c\r"
    spots = sorted((i, n, x.strip(white)) for i, t in docs if t is not None for n, x in enumerate(t.split("\n")))
    first = {}
    for i, n, x in spots:
        if x:
            first.setdefault(x, (i, n))
    gone = set()
    fuzzy = [x for x in first if len(x) >= least]
    for x in fuzzy:
        if any(first[y] < first[x] and within_one(x, y) for y in fuzzy if y != x):
            gone.add(x)
    out = {}
    for i, t in docs:
        if t is None:
            out[i] = None
        else:
            out[i] = "\n".join(raw for n, raw in enumerate(t.split("\n"))
                               if not (x := raw.strip(white)) or first[x] == (i, n) and x not in gone)
    return out


def kept_bytes(docs, length=100):
    """(bytes, removed, runs, what is left) by marking every window that started earlier; ids must differ."""
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for a in range(len(raw) - length + 1):
            if raw[a:a + length] in seen:
                gone[a:a + length] = b"\1" * length
            seen.add(raw[a:a + length])
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(raw), sum(gone), runs, bytes(b for b, g in zip(raw, gone) if not g))
    return out
