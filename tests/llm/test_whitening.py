"""Whitening against dense eigenvectors and exact arithmetic."""

from fractions import Fraction

import numpy as np
import pytest

from rowtide.llm import feast, queries, whitening
from rowtide.llm.common import table

from ..conftest import SF_SMALL
from .helpers import frame, with_clashes

SCHEMA = "vec_id long, embedding array<float>, label int"


def matrix(kind, d=40):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    falling = {"clusters": [7.0] * 15 + [3.0] * 10 + [3.0 - 1e-9] * 5 + [1.0] * (d - 30), "geometric": 10.0 ** -np.linspace(0, 8, d),
               "equal": [2.0] * d, "rank": [5.0, 4.0, 4.0] + [0.0] * (d - 3)}[kind]
    a = (q * np.array(falling)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("kind", ["clusters", "geometric", "equal", "rank"])
def test_contour_pairs(kind):
    a = matrix(kind)
    want = np.linalg.eigvalsh(a)[::-1]
    values, vectors = feast.top_pairs(a, 32, 1e-11 * np.trace(a))
    assert len(values) == min(32, (want > 1e-11 * np.trace(a)).sum())
    assert np.abs(values - want[:len(values)]).max() < 1e-13 * want[0]
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def test_inertia_counts():
    rng = np.random.default_rng(5)
    for d in (1, 2, 7, 30):
        a = rng.normal(size=(d, d))
        a += a.T
        for m in (-1.0, 0.0, 0.5, 2.0):
            assert feast.above(a, m) == (np.linalg.eigvalsh(a) > m).sum()
    assert feast.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def exact(rows):
    """n, sums and covariance (fractions) of integer vectors."""
    n = len(rows)
    s = [sum(r[i] for r in rows) for i in range(len(rows[0]))]
    c = [[n * x - t for x, t in zip(r, s)] for r in rows]
    cov = [[Fraction(sum(r[i] * r[j] for r in c), n ** 3) for j in range(len(s))] for i in range(len(s))]
    return n, s, cov, [sum(x * x for x in r) for r in c]


def check(out, rows, wanted=32):
    """``rows``: (id, integer vector), ids distinct."""
    n, s, cov, deviation = exact([v for _, v in rows])
    a = np.array([[float(x) for x in r] for r in cov])
    values, vectors = np.linalg.eigh(a)
    order = np.argsort(-values)[:wanted]
    values, vectors = values[order], vectors[:, order]
    keep = values > 1e-11 * np.trace(a)
    trace = float(sum(cov[i][i] for i in range(len(s))))
    got = {}
    for r in out:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(got) == sorted(i for i, _ in rows)
    x = np.array([[float(Fraction(n * v - t, n)) for v, t in zip(vec, s)] for _, vec in rows])
    z = x @ vectors[:, keep] / np.sqrt(values[keep])
    mine = np.array([[got[i][k + 1].whitened for k in range(int(keep.sum()))] for i, _ in rows])
    for (i, _), dev in zip(rows, deviation):
        assert sorted(got[i]) == list(range(1, int(keep.sum()) + 1))
        assert {r.deviation for r in got[i].values()} == {dev} and {r.n for r in got[i].values()} == {n}
    for k in range(int(keep.sum())):
        assert abs(got[rows[0][0]][k + 1].explained - values[k] / trace) < 1e-10 * values[k] / trace
        gap = min([abs(values[k] - v) for j, v in enumerate(np.linalg.eigvalsh(a)[::-1]) if j != k], default=1.0)
        if gap > 1e-6 * values[0]:
            sign = np.sign(mine[:, k] @ z[:, k])
            assert np.abs(mine[:, k] * sign - z[:, k]).max() < 1e-6
    assert {r.identity_error for r in out}.pop() < 1e-8
    c = np.cov(mine.T, bias=True) if mine.shape[1] > 1 else np.array([[mine.var()]])
    assert np.abs(c - np.eye(len(c))).max() < 1e-8


def integers(v):
    return [int(np.floor(np.float64(64) * np.float64(np.float32(c)))) + 1_000_000 for c in v]


def test_query(spark):
    given = [(r.vec_id, integers(r.embedding)) for r in table(spark, SF_SMALL, "embeddings").collect()]
    check(queries.QUERIES["op12_embedding_whitening"](spark, SF_SMALL).collect(), given)


def test_few_dimensions_and_unusable_vectors(spark):
    rng = np.random.default_rng(8)
    good = [(i, [float(x) for x in rng.normal(size=3) * 9]) for i in range(50)]
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [1.0, float("nan"), 2.0]), (93, [1.0, float("inf"), 0.0]), (94, []), (95, [1.0]),
           (96, [1e30, 0.0, 0.0])]
    df = with_clashes(frame(spark, [(i, v, None) for i, v in good + bad], SCHEMA))
    check(whitening.whitened(df).collect(), [(i, integers(v)) for i, v in good])


def test_dependent_constant_and_large_entries(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(40):
        a, b = rng.integers(-5, 5, 2)
        rows.append((i, [float(a), float(2 * a), 7.0, float(b) * 2.0 ** 34]))  # rank 2, products over 2^53
    df = frame(spark, [(i, v, 1) for i, v in rows], SCHEMA)
    model = whitening.fit(df)
    assert len(model.values) <= 2
    n, s, cov, deviation = exact([integers(v) for _, v in rows])
    assert model.n == n and model.sums == s
    got = {r.vec_id: int(r.deviation) for r in whitening.transform(df, model).collect()}
    assert got == {i: d for (i, _), d in zip(rows, deviation)}


def test_repeats_nulls_and_nothing_to_scale(spark):
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [3.0, 1.0], 0), (2, [0.0, 0.5], 0)]
    out = whitening.whitened(frame(spark, rows, SCHEMA)).collect()
    assert sorted((str(r.vec_id), r.component) for r in out) == sorted([("1", 1), ("1", 2)] * 2 + [("None", 1), ("None", 2), ("2", 1), ("2", 2)])
    for rows in ([], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], [(1, None, 0)]):
        out = whitening.whitened(frame(spark, rows, SCHEMA))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.count() == 0
