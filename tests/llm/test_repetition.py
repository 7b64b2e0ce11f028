import random

import numpy as np

from rowtide.llm import repetition as R

from .helpers import awkward, frame, with_clashes, words


def brute(text, longest=100):
    t = text or ""
    w = [x.decode() for x in t.encode().split()]
    lines = [x for x in t.split("\n") if x.strip(R.WHITE)]

    def covered(size):
        at = {}
        for i in range(len(w) - size + 1):
            at.setdefault(tuple(w[i:i + size]), []).append(i)
        return {i + k for v in at.values() if len(v) > 1 for i in v for k in range(size)}

    five = covered(5)
    base = len(w) < 10 or 100 * len(five) > 20 * len(w)
    chars = sum(len(w[i]) for i in five)
    total = sum(map(len, w))
    return (len(w), total, sum(map(t.count, R.SYMBOLS)), len(lines) - len(set(lines)), len(five), chars, base,
            not (base or chars > 0.25 * total or bool(covered(longest + 1))))


def test_suffix_order_against_sorting():
    rng = np.random.default_rng(2)
    for _ in range(300):
        x = rng.integers(0, rng.integers(1, 5), rng.integers(0, 60))
        sa, lcp = R.suffix_order(x)
        suffixes = [x[i:].tolist() for i in sa]
        assert suffixes == sorted(suffixes)
        for k in range(1, len(x)):
            a, b = suffixes[k - 1], suffixes[k]
            n = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
            assert lcp[k] == n


def test_measures_against_brute_force(spark):
    rng = random.Random(1)
    texts = [r[1] for r in awkward()]
    for _ in range(40):
        p = words(rng, rng.randrange(1, 30), 20)
        texts.append("\n".join(rng.choice([p, words(rng, rng.randrange(0, 40), 30) + " #*é"]) for _ in range(rng.randrange(1, 8))))
    texts.append("\n".join([words(rng, 120, 10_000)] * 2 + [words(rng, 3000, 10_000)]))
    df = frame(spark, [(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.covered_chars, r.base_failed, r.kept)
           for r in R.quality(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert got[len(texts) - 1][6:] == (False, False)  # a repeat of 120 words


def test_rows_keep_their_columns(spark):
    df = with_clashes(frame(spark, awkward()))
    kept = R.keep_good(df)
    assert kept.columns == df.columns
    assert kept.count() == sum(brute(r[1])[-1] for r in awkward())
    assert R.quality(df).count() == len(awkward())
    assert R.keep_good(df.limit(0)).count() == 0
