"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is lower-cased, what is no letter becomes a space, and every run of 2, 3 and
4 bytes inside it is a subword.  Subwords are hashed to ``2**bits`` embedding rows;
the mean row of the whole text goes through a linear softmax.  Embeddings and
softmax are trained together by stochastic gradient descent in numpy, on at most
about ``per_lang`` labelled texts a language (a hash-based sample; the stated bound
of what is collected, as subword frequencies).  A fifth of the sample is held back
to calibrate: a temperature for the probabilities, and the lowest probability at
which accepted predictions reach the wanted precision; rarer ones are ``rejected``.

Null text and text without letters give ``und`` with score 0.  Null labels are not
learned from; without any label every text is ``und``.  Rows are judged one by one,
so ties, repeated rows and further columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

ORDERS = (2, 3, 4)
BLOCK = 1_000_000  # bytes worked on at once; a longer text is summed over blocks
LETTER = re.compile(r"[^\W\d_]")
SPACED = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _text_bytes(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "replace") + b" "


def subwords(raw: bytes, bits: int) -> Iterator[np.ndarray]:
    """Hashed subwords of one text's bytes, block by block."""
    longest = max(ORDERS)
    for at in range(0, max(len(raw) - 1, 1), BLOCK):
        x = SPACED[np.frombuffer(raw, np.uint8, min(BLOCK + longest - 1, len(raw) - at), at)].astype(np.uint32)
        for n in ORDERS:
            stop = min(BLOCK, len(x) - n + 1)
            if stop > 0:
                h = np.full(stop, n, np.uint32)
                for j in range(n):
                    h = (h ^ x[j:j + stop]) * np.uint32(16777619)
                    h ^= h >> np.uint32(15)
                yield ((h * np.uint32(2654435761)) >> np.uint32(32 - bits)).astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # logits of each subword: embeddings @ softmax weights
    bias: np.ndarray
    bits: int
    temperature: float = 1.0
    reject_below: float = 0.0

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.langs or not LETTER.search(text):
            return "und", 0.0, True
        total, n = np.zeros(len(self.langs)), 0
        for idx in subwords(_text_bytes(text), self.bits):
            total += self.table.take(idx, axis=0).sum(axis=0, dtype=np.float64)
            n += len(idx)
        p = softmax((total / max(n, 1) + self.bias)[None] * self.temperature)[0]
        k = int(p.argmax())
        return self.langs[k], float(p[k]), bool(p[k] < self.reject_below)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _frequencies(text: Column, bits: int) -> Column:
    ship()

    @F.pandas_udf("idx array<int>, freq array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch:
                counts = np.zeros(1 << bits, np.int64)
                for idx in subwords(_text_bytes(t), bits):
                    counts += np.bincount(idx, minlength=1 << bits)
                at = np.flatnonzero(counts)
                rows.append((at.astype(np.int32), (counts[at] / counts.sum()).astype(np.float32)))
            yield pd.DataFrame(rows, columns=["idx", "freq"])

    return run(text)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", bits: int = 15,
          dim: int = 16, per_lang: int = 400, epochs: int = 12, rate: float = 20.0, precision: float = 0.99) -> Model:
    """Fit on a sample of the labelled, not held-out rows."""
    rows = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in rows.groupBy(F.col(lang_col).cast("string")).count().collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((1 << bits, 0), np.float32), np.zeros(0), bits)
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col(lang_col) == lang, min(1.0, per_lang / n)).otherwise(share)
    # the draw depends on text and id alone, so it is the same however the table is partitioned
    draw = F.pmod(F.xxhash64(F.lit("sample"), id_col, text_col), F.lit(1 << 20)) / float(1 << 20)
    sample = (rows.where(draw < share)
              .select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col, text_col).alias("order"),
                      _frequencies(F.col(text_col), bits).alias("f")).select("lang", "order", "f.idx", "f.freq").collect())
    sample.sort(key=lambda r: (r["order"], r["lang"]))
    x = [(np.array(r["idx"], np.int64), np.array(r["freq"], np.float32)) for r in sample]
    y = np.array([langs.index(r["lang"]) for r in sample], np.int64)
    rng = np.random.default_rng(7)
    emb = rng.normal(0, 0.1, (1 << bits, dim)).astype(np.float32)
    out = rng.normal(0, 0.1, (dim, len(langs))).astype(np.float32)
    bias = np.zeros(len(langs), np.float32)
    held = np.arange(len(x)) % 5 == 4
    fit = np.flatnonzero(~held)
    weight = len(fit) / (len(langs) * np.maximum(np.bincount(y[fit], minlength=len(langs)), 1))

    def hidden(batch: np.ndarray, table: np.ndarray) -> np.ndarray:
        return np.stack([x[i][1] @ table[x[i][0]] for i in batch])

    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(fit)
        for at in range(0, len(order), 16):
            batch = order[at:at + 16]
            h = hidden(batch, emb)
            d = softmax(h @ out + bias)
            d[np.arange(len(batch)), y[batch]] -= 1
            d *= (weight[y[batch]] / len(batch))[:, None].astype(np.float32)
            back = d @ out.T
            out -= 0.1 * step * (h.T @ d)
            bias -= 0.02 * step * d.sum(axis=0)
            for k, i in enumerate(batch):
                emb[x[i][0]] -= step * x[i][1][:, None] * back[k]
    model = Model(langs, emb @ out, bias.astype(np.float64), bits)
    test = np.flatnonzero(held)
    if len(test):
        z, want = hidden(test, model.table) + model.bias, y[test]
        # smoothed, so that a sample without errors doesn't ask for boundless confidence
        loss = {t: -np.log(0.999 * softmax(z * t)[np.arange(len(test)), want] + 5e-4).mean() for t in np.geomspace(0.25, 16, 25)}
        model.temperature = float(min(loss, key=loss.get))
        p = softmax(z * model.temperature)
        top, right = p.max(axis=1), p.argmax(axis=1) == want
        order = np.argsort(-top)
        good = np.cumsum(right[order]) >= precision * np.arange(1, len(order) + 1)
        model.reject_below = float(top[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``lang_pred``, ``score`` and ``rejected``."""
    ship()

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([model.predict(t) for t in batch], columns=["lang_pred", "score", "rejected"])

    return (docs.select(F.col(id_col), held_out(id_col).alias("held_out"), run(F.col(text_col)).alias("p"))
            .select(id_col, "held_out", "p.*"))
