"""Whitening of embeddings along the principal components of their covariance.

Every entry ``c`` is read as the integer ``x = floor(scale * c) + offset``, so sums, the
covariance and its trace are exact whatever the order in which tasks are added up.  A first
pass counts the vectors and sums each dimension; a second subtracts the rounded means and adds
up the products; what rounding the means left over is taken off exactly.  The covariance, a
matrix of dimensions by dimensions, is the only thing that reaches the driver.  Its largest
eigenpairs come from contour integration (``feast``).  A third pass projects every vector and
measures how far the covariance of the result is from the identity.

Vectors that are null or hold null or non-finite entries are dropped; so are empty ones,
vectors of another length than the commonest (ties: the longest), and those with an entry of
``2^50 / scale`` or more, whose ``x`` would leave the exact range.  Components whose eigenvalue is
not over ``1e-11`` of the trace (a constant or dependent dimension) can't be scaled to one and
are left out: one vector, or only equal ones, give no rows.  Repeated rows, ids that are null or
repeated count as often as they come.  Further columns are ignored.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, StructField, StructType

from .common import ship
from .feast import top_pairs

EXACT = 1 << 50   # entries stay under this
LEAST = 1e-11     # of the trace: the smallest eigenvalue that counts as one


def vectors(batch: pa.RecordBatch, column: str, scale: int, offset: int, dim: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integer vectors) of the usable rows of a batch, one pair for each length."""
    col = batch.column(column)
    flat = col.flatten()
    sizes = np.array(col.value_lengths().fill_null(0))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    null = np.array(flat.is_null()) if flat.null_count else np.zeros(len(flat), bool)
    values = flat.fill_null(0.0).to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(invalid="ignore", over="ignore"):
        bad = null | ~(np.abs(values * scale) < EXACT)
    has_null = np.concatenate([[0], np.cumsum(bad)])
    good = (has_null[ends[1:]] == has_null[ends[:-1]]) & (sizes > 0)
    for size in np.unique(sizes[good]) if dim is None else [dim]:
        rows = np.flatnonzero(good & (sizes == size))
        if len(rows):
            at = ends[rows][:, None] + np.arange(size)
            yield rows, np.floor(values[at] * scale).astype(np.int64) + offset


def _sums(x: np.ndarray) -> list[int]:
    """Exact column sums."""
    return [int(v) for v in (x >> 20).sum(axis=0).astype(object) * (1 << 20) + (x & 0xFFFFF).sum(axis=0).astype(object)]


def _products(x: np.ndarray) -> np.ndarray:
    """Exact ``x' x``: in floating point while every sum of products is an exact integer there."""
    most = int(np.abs(x).max(initial=0))
    if most * most * len(x) < 1 << 53:
        f = x.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    o = x.astype(object)
    return o.T @ o


@dataclass
class Whitening:
    """What a fit learns: count, sums and eigenpairs (components as columns)."""
    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    explained: list[float]
    scale: int
    offset: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n x - sums``, exact."""
        wide = (int(np.abs(x).max(initial=0)) + 1) * self.n + max(map(abs, self.sums), default=0) >= 1 << 62
        return x.astype(object) * self.n - np.array(self.sums, object) if wide else x * self.n - np.array(self.sums, np.int64)

    def project(self, c: np.ndarray) -> np.ndarray:
        return (c.astype(np.float64) / self.n) @ self.components / np.sqrt(self.values)


def fit(rows: DataFrame, wanted: int = 32, vector_col: str = "embedding", scale: int = 64, offset: int = 1_000_000) -> Whitening:
    """Count, sums, covariance and the ``wanted`` largest components over all usable vectors."""
    ship()
    given = rows.select(F.col(vector_col).cast("array<double>").alias("v"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for _, x in vectors(batch, "v", scale, offset):
                n, s = total.get(x.shape[1], (0, [0] * x.shape[1]))
                total[x.shape[1]] = n + len(x), [a + b for a, b in zip(s, _sums(x))]
        for size, (n, s) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()),
                 pa.array(s, pa.decimal128(38, 0))], ["size", "i", "n", "s"])

    by_size = given.mapInArrow(sums, "size int, i int, n long, s decimal(38,0)").groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    # one row: the sums of the commonest length
    best = (by_size.groupBy("size").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "s"))).alias("s"))
            .agg(F.max_by(F.struct("size", "n", "s"), F.struct("n", "size")).alias("b")).first()["b"])
    if best is None:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), [], scale, offset)
    dim, n, total = best["size"], best["n"], [int(r["s"]) for r in best["s"]]
    centre = np.array([round(Fraction(t, n)) for t in total], np.int64)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = None
        for batch in batches:
            for _, x in vectors(batch, "v", scale, offset, dim):
                g = _products(x - centre) + (0 if g is None else g)
        if g is not None:
            i, j = np.triu_indices(dim)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(list(g[i, j]), pa.decimal128(38, 0))],
                                             ["i", "j", "g"])

    # a cell is shuffled once for each task, dimensions x dimensions numbers in all reach the driver
    cells = given.mapInArrow(products, "i int, j int, g decimal(38,0)").groupBy("i", "j").agg(F.sum("g").alias("g")).toArrow()
    left = [t - n * int(c) for t, c in zip(total, centre)]
    cov = np.zeros((dim, dim))
    trace = Fraction(0)
    for i, j, g in zip(*(cells.column(c).to_pylist() for c in ("i", "j", "g"))):
        exact = Fraction(int(g) * n - left[i] * left[j], n * n)
        cov[i, j] = cov[j, i] = float(exact)
        trace += exact if i == j else 0
    if not trace:
        return Whitening(n, total, np.zeros(0), np.zeros((dim, 0)), [], scale, offset)
    values, components = top_pairs(cov, min(wanted, dim), LEAST * float(trace))
    # one sign for all rows: the largest entry of a component is positive
    components = components * np.sign(components[np.abs(components).argmax(axis=0), np.arange(len(values))])
    return Whitening(n, total, values, components, [float(Fraction(float(v)) / trace) for v in values], scale, offset)


def identity_error(rows: DataFrame, model: Whitening, vector_col: str = "embedding") -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, over all rows."""
    ship()
    k, dim = len(model.values), len(model.sums)
    if not k:
        return None

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, s = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            for _, x in vectors(batch, "v", model.scale, model.offset, dim):
                z = model.project(model.centred(x))
                g += z.T @ z
                s += z.sum(axis=0)
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i, np.full(k, -1)), pa.int32()), pa.array(np.append(j, np.arange(k)), pa.int32()),
                                          pa.array(np.append(g[i, j], s))], ["i", "j", "g"])

    cells = (rows.select(F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(products, "i int, j int, g double")
             .groupBy("i", "j").agg((F.sum("g") / model.n).alias("g")).collect())
    mean = {r["j"]: r["g"] for r in cells if r["i"] < 0}
    return max(abs(r["g"] - mean[r["i"]] * mean[r["j"]] - (r["i"] == r["j"])) for r in cells if r["i"] >= 0)


def transform(rows: DataFrame, model: Whitening, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """Per usable row: id, ``whitened`` (array<double>, by falling eigenvalue) and ``deviation`` (decimal, exact).

    ``deviation`` is the sum over dimensions of the squares of ``n x - sums``.
    """
    ship()
    given = rows.select(F.col(id_col), F.col(vector_col).cast("array<double>").alias("v"))
    schema = StructType([given.schema[id_col], StructField("whitened", ArrayType(DoubleType())), StructField("deviation", DecimalType(38, 0))])
    k, dim = len(model.values), len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in vectors(batch, "v", model.scale, model.offset, dim) if k else ():
                c = model.centred(x)
                wide = c.dtype == object or int(np.abs(c).max()) ** 2 * dim >= 1 << 62
                deviation = [int(v) for v in ((c.astype(object) ** 2) if wide else c * c).sum(axis=1)]
                z = model.project(c)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.ListArray.from_arrays(np.arange(0, z.size + 1, k, dtype=np.int32), pa.array(z.ravel())),
                     pa.array(deviation, pa.decimal128(38, 0))], schema.fieldNames())

    return given.mapInArrow(run, schema)


def whitened(rows: DataFrame, wanted: int = 32, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """Per usable row and component: id, ``component`` (from 1), ``n``, ``deviation`` (null beyond 64 bits),
    ``whitened``, ``explained`` and ``identity_error``."""
    model = fit(rows, wanted, vector_col)
    error = identity_error(rows, model, vector_col)
    out = transform(rows, model, vector_col, id_col).select(
        F.col(id_col), F.posexplode("whitened").alias("at", "whitened"), F.col("deviation").try_cast("long").alias("deviation"))
    share = F.array(*[F.lit(x) for x in model.explained]) if model.explained else F.array().cast("array<double>")
    return out.select(id_col, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(share, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
