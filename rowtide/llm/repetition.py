"""Quality rules from repeated substrings, found in a suffix array of each text's words.

A text's words are the runs of characters other than ASCII white space.  The
words of many texts are sorted as one suffix array (prefix doubling that goes on
only inside groups still equal; words of different texts never compare equal).
The longest common prefixes of neighbours give the maximal repeated substrings:
the longest one that starts at a word is the larger of the two prefixes beside
it.  Their spans are united.  A text is rejected if the spans of repeats of
``min_words`` words or more cover over ``max_covered`` of its word characters, or
if one repeat is longer than ``max_longest`` words.

Null text counts as a text without words.  Rows are judged one by one, so ties,
repeated rows and further columns (of whatever name) don't matter; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\f\r"
BLOCK_WORDS = 200_000  # words sorted at once; a longer text is a block of its own

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "covered_chars long, longest_repeat long")


def suffix_order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and neighbours' longest common prefixes of a sequence of integers.

    ``lcp[k]`` belongs to the suffixes at ranks k-1 and k; ``lcp[0]`` is 0.
    """
    n = len(keys)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sa = np.argsort(keys, kind="stable")
    head = np.empty(n, bool)
    head[0] = True
    head[1:] = keys[sa[1:]] != keys[sa[:-1]]
    rank = np.full(n + 1, -1, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels, h = [rank.copy()], 1
    while True:
        same = ~head
        in_group = same.copy()
        in_group[:-1] |= same[1:]
        at = np.flatnonzero(in_group)
        if not len(at):
            break
        pos = sa[at]
        first, second = rank[pos], rank[np.minimum(pos + h, n)]
        order = np.lexsort((second, first))
        pos, first, second = pos[order], first[order], second[order]
        sa[at] = pos
        new = np.ones(len(at), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        head[at] = new
        rank[pos] = np.maximum.accumulate(np.where(new, at, 0))
        levels.append(rank.copy())
        h *= 2
    lcp = np.zeros(n, np.int64)
    for j in range(len(levels) - 1, -1, -1):
        r, step = levels[j], 1 << j
        a, b = sa[:-1] + lcp[1:], sa[1:] + lcp[1:]
        inside = (a < n) & (b < n)
        a, b = np.minimum(a, n), np.minimum(b, n)
        lcp[1:] += np.where(inside & (r[a] == r[b]), step, 0)
    return sa, lcp


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions inside the union of the spans."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + lengths, -1)
    return np.cumsum(d[:n]) > 0


def _block(texts: list[str], min_words: int) -> np.ndarray:
    """The measures of some texts, one row each."""
    out = np.zeros((len(texts), 7), np.int64)
    words: list[bytes] = []
    sizes = []
    for i, t in enumerate(texts):
        w = t.encode("utf-8", "surrogatepass").split()
        words += w
        sizes.append(len(w))
        lines = [x for x in t.split("\n") if x.strip(WHITE)]
        out[i, 1] = len(t) - sum(map(t.count, WHITE))
        out[i, 2] = sum(map(t.count, SYMBOLS))
        out[i, 3] = len(lines) - len(set(lines))
    out[:, 0] = sizes
    if not words:
        return out
    doc = np.repeat(np.arange(len(texts)), sizes)
    ids, _ = pd.factorize(np.array(words, dtype=object))
    sa, lcp = suffix_order(doc * (ids.max() + 1) + ids)
    repeat = np.zeros(len(words), np.int64)
    repeat[sa] = np.maximum(lcp, np.append(lcp[1:], 0))
    chars = np.fromiter((len(w) if w.isascii() else len(w.decode("utf-8", "surrogatepass")) for w in words),
                        np.int64, len(words))
    for column, least in ((4, 5), (5, min_words)):
        starts = np.flatnonzero(repeat >= least)
        mask = covered(starts, repeat[starts], len(words))
        out[:, column] = np.bincount(doc[mask], None if column == 4 else chars[mask], len(texts)).astype(np.int64)
    np.maximum.at(out[:, 6], doc, repeat)
    return out


def measure(text: Column, min_words: int = 5) -> Column:
    """Struct of the word counts and repetition measures of a text column."""
    ship()

    @F.pandas_udf(MEASURES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in MEASURES.split(", ")]
        for batch in batches:
            texts = batch.fillna("").tolist()
            rows, part, size = [], [], 0
            for t in texts:
                part.append(t)
                size += len(t) // 4
                if size >= BLOCK_WORDS:
                    rows.append(_block(part, min_words))
                    part, size = [], 0
            rows.append(_block(part, min_words))
            yield pd.DataFrame(np.concatenate(rows), columns=names)

    return run(text)


def judge(text: Column, min_words: int = 5, max_covered: float = 0.25, max_longest: int = 100) -> Column:
    """Struct: the measures, ``base_failed`` and ``kept`` (false if either rule set rejects the text)."""
    names = [x.split()[0] for x in MEASURES.split(", ")]

    def verdict(m: Column) -> Column:
        base_failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
        rejected = (m["covered_chars"] > max_covered * m["word_chars"]) | (m["longest_repeat"] > max_longest)
        return F.struct(*[m[x].alias(x) for x in names], base_failed.alias("base_failed"),
                        (~(base_failed | rejected)).alias("kept"))

    # a one-element array names the measures once, so a text is sorted once
    return F.transform(F.array(measure(text, min_words)), verdict)[0]


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rules) -> DataFrame:
    """One row per document: its id, the measures and the verdict."""
    judged = docs.select(F.col(id_col), judge(F.col(text_col), **rules).alias("q"))
    return judged.select(id_col, "q.*")


def keep_good(docs: DataFrame, text_col: str = "text", **rules) -> DataFrame:
    """The rows whose text passes the rules, with their own columns."""
    return docs.where(judge(F.col(text_col), **rules)["kept"])
