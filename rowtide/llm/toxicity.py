"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length.

Folding: compatibility forms (NFKC), lower case, look-alike Greek and Cyrillic
letters to Latin ones, digits and signs that stand for letters inside words to
those letters, everything else that is no word character to one space.  A lexicon
entry is a whole word or the beginning of words; at each word only its heaviest
entry counts.  A hit inside an exception phrase doesn't count.

Entries and weights come from the labelled rows: the log of how much more often a
word (or beginning) occurs in toxic texts than in others, for those with support.
A small seed list counts where labels say nothing about its words.  The summed
weights, as such and per length, go through a logistic function fitted on the same
rows.  At most about ``per_label`` rows of each label are used (a hash-based sample, the
stated bound) and at most ``max_entries`` entries are kept.

Null and empty texts have no hits and get the score of a text without hits.  A
document with several label rows counts as toxic if one of them says so; null
labels are not learned from.  Rows are scored one by one, so ties, repeated rows
and further columns don't matter; empty tables give an empty result, and without
labels the seed list alone decides.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .lang_id import held_out

SEEDS = ("bastard", "clown", "disgusting", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "scumbag", "stupid",
         "trash", "worthless")
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "recycle the trash", "pathetic fallacy", "sore loser rule")
#: look-alike letters
HOMOGLYPHS = str.maketrans({
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i"})
#: digits and signs used as letters
LEET = str.maketrans("0134578@$", "oieastbas")
FOREIGN = re.compile("[ıͰ-ԯ]")
LEET_RUN = re.compile(r"[0134578@$]+(?=[^\W\d_])")
OTHER = re.compile(r"[\W_]+")


def fold(text: str | None) -> str:
    """Folded words, each between single spaces."""
    t = text or ""
    if not t.isascii():
        t = unicodedata.normalize("NFKC", t)
    t = t.lower()
    if FOREIGN.search(t):
        t = t.translate(HOMOGLYPHS)
    t = LEET_RUN.sub(lambda m: m[0].translate(LEET), t)
    return f" {OTHER.sub(' ', t).strip()} "


def entries_of(folded: str, shortest: int = 4, longest: int = 7) -> set[str]:
    """The entries a text speaks for: its words, and their beginnings."""
    found = set()
    for w in set(folded.split()):
        if not w.isdigit():
            found.add(f" {w} ")
            found.update(f" {w[:k]}" for k in range(shortest, min(longest, len(w) - 1) + 1))
    return found


@dataclass
class Model:
    weights: dict[str, float]
    coef: np.ndarray  # intercept, log sum, log sum per 100 words, largest
    exceptions: tuple[str, ...] = EXCEPTIONS
    machine: object = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"machine": None}

    def _machine(self):
        if self.machine is None:
            self.machine = ahocorasick.Automaton()
            for e, w in self.weights.items():
                self.machine.add_word(e, (len(e), w))
            for e in self.exceptions:
                self.machine.add_word(fold(e), (len(fold(e)), None))
            if len(self.machine):
                self.machine.make_automaton()
        return self.machine

    def features(self, text: str | None) -> tuple[float, float, float, int]:
        folded, machine = fold(text), self._machine()
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in machine.iter(folded) if len(machine) else ():
            start = end - size + 1
            if weight is None:
                spared.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if spared:
            best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in spared)}
        total = sum(best.values())
        words = folded.count(" ") - 1
        return np.log1p(total), np.log1p(100 * total / max(words, 1)), max(best.values(), default=0.0), len(best)

    def score(self, text: str | None) -> tuple[float, int]:
        a, b, c, n = self.features(text)
        return float(1 / (1 + np.exp(-(self.coef @ np.array([1.0, a, b, c]))))), n


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Ridge-regularised logistic regression by Newton's method."""
    a = np.column_stack([np.ones(len(x)), x])
    w, eye = np.zeros(a.shape[1]), np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        move = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + eye, a.T @ (y - p) - eye @ w)
        w = w + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return w


def most_specific(learned: list) -> list:
    """Without the beginnings nearly all of whose toxic texts a longer entry explains."""
    by_start: dict[str, int] = {}
    for r in learned:
        e = r["e"].rstrip()
        for k in range(2, len(e) + (r["e"][-1] == " ")):
            by_start[e[:k]] = max(by_start.get(e[:k], 0), r["n1"])
    return [r for r in learned if r["e"][-1] == " " or by_start.get(r["e"], 0) < 0.95 * r["n1"]]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          per_label: int = 4_000, max_entries: int = 3_000, least_weight: float = 1.5) -> Model:
    ship()
    marks = (labels.where(~held_out(id_col) & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("k")).agg(F.max(F.col(label_col).cast("int")).alias("y")))
    sizes = {r["y"]: r["count"] for r in marks.groupBy("y").count().collect()}
    seeds = {f" {w} ": 3.0 for w in SEEDS}
    fixed = Model(seeds, np.array([-4.0, 1.0, 1.0, 0.5]))
    if not sizes.get(0) or not sizes.get(1):
        return fixed
    share = F.when(F.col("y") == 1, per_label / sizes[1]).otherwise(per_label / sizes[0])
    drawn = marks.where(F.pmod(F.xxhash64(F.lit("sample"), "k"), F.lit(1 << 20)) / float(1 << 20) < share)
    # drawn has about 2 * per_label rows of two numbers at most, whatever the size of the tables
    rows = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).join(F.broadcast(drawn), "k").select("t", "y")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = {0: Counter(), 1: Counter()}
        n = Counter()
        for batch in batches:
            for t, y in zip(batch["t"], batch["y"]):
                seen[int(y == 1)].update(entries_of(fold(t)))
                n[int(y == 1)] += 1
        terms = ["", *(seen[0].keys() | seen[1].keys())]  # the empty entry carries the number of texts
        seen[0][""], seen[1][""] = n[0], n[1]
        yield pd.DataFrame({"e": terms, "n1": [seen[1][e] for e in terms], "n0": [seen[0][e] for e in terms]})

    counts = rows.mapInPandas(count, "e string, n1 long, n0 long").groupBy("e").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    counts = counts.where((F.col("e") == "") | (F.col("n1") >= 3) | F.col("e").isin(list(seeds)))
    all_rows = counts.where("e = ''").collect()
    n1, n0 = (all_rows[0]["n1"], all_rows[0]["n0"]) if all_rows else (0, 0)
    if not n1 or not n0:
        return fixed
    # lower bound of the log ratio, so that a few chance occurrences make no entry
    weight = (F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
              - 1.64 * F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5)))
    learned = (counts.withColumn("w", weight)
               .where((F.col("e") != "") & (F.col("w") >= least_weight) & (F.col("n1") >= max(3, 0.01 * n1)))
               .orderBy(F.desc(F.col("w") * F.col("n1")), "e").limit(max_entries).collect())
    known = {r["e"] for r in counts.where(F.col("e").isin(list(seeds)) & (F.col("n1") + F.col("n0") >= 5)).collect()}
    weights = {e: w for e, w in seeds.items() if e not in known} | {r["e"]: float(r["w"]) for r in most_specific(learned)}
    model = Model(weights, fixed.coef)

    @F.pandas_udf("a double, b double, c double, n int")
    def feature(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([model.features(t) for t in batch], columns=["a", "b", "c", "n"])

    fit = rows.select("y", feature("t").alias("f")).select("y", "f.a", "f.b", "f.c").collect()
    x = np.array([(r["a"], r["b"], r["c"]) for r in fit], float)
    y = np.array([float(r["y"] == 1) for r in fit])
    order = np.lexsort((*x.T, y))
    model.coef = _logistic(x[order], y[order])
    # classes are drawn apart: back to the share that the labels have
    model.coef[0] += np.log(sizes[1] / sizes[0]) - np.log(n1 / n0)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per row: id, ``held_out``, ``score``, ``predicted`` and the number of hits."""
    ship()

    @F.pandas_udf("score double, n_hits long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([model.score(t) for t in batch], columns=["score", "n_hits"])

    return (docs.select(F.col(id_col), held_out(id_col).alias("held_out"), run(F.col(text_col)).alias("p"))
            .select(id_col, "held_out", "p.score", (F.col("p.score") >= threshold).cast("int").alias("predicted"), "p.n_hits"))
