"""Whitening of embeddings by a two-pass covariance.

Entries become integers first: x = floor(``scale`` * c) + ``shift``. The first pass adds them up exactly, which gives n and the sum
S of every dimension. The second pass centres each vector as (n * x - S) / n, whose numerator is an exact integer, multiplies
the centred vectors of a batch with themselves (a NumPy matrix product) and adds the d x d matrices up in a tree of tasks.
A symmetric eigenproblem (LAPACK) of the covariance gives the components. The projection on ``components`` of
them, d x ``components`` doubles, goes to all tasks. A third pass measures the covariance of the whitened vectors, and the
last one returns them. Every pass is a scan of the input and keeps nothing, so a lost executor costs the tasks it had.

Through the driver, or in one task at once, go a matrix for each of at most ``FAN_IN`` branches of the tree: 8 * d^2 bytes
each, and nothing that grows with the rows.

Defined cases: rows whose vector is null, empty, or holds a null or non-finite entry, or one whose integer would not stay below
2^62, are left out. Vectors of each length have a fit list, a mean and components of their own (a row per length in ``n``), so
that none are lost; the matrices of all lengths are held together. Components whose eigenvalue is zero up to rounding (constant
dimensions, fewer rows than dimensions) have a null ``whitened`` and do not count in ``identity_error``. Repeated rows and
repeated or null ids all count. Equal eigenvalues have some orthonormal basis; the sign is that for which the largest entry of a
component is positive. A deviation beyond 38 digits is null. An empty table gives an empty one. Only key and vector are read,
so other columns may have any name.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE = 1024.0
SHIFT = 100_000
#: Branches of the tree that meet in one task.
FAN_IN = 8
#: Vectors of one matrix product.
ROWS = 4096
_LIMIT = float(1 << 62)

Sums = dict[int, tuple[int, list[int]]]  #: by length: n and exact sums
Matrices = dict[int, np.ndarray]


def integers(column: pa.Array, scale: float = SCALE, shift: int = SHIFT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, integer vectors) of a list column, one pair for every length that its usable vectors have."""
    lists = column.cast(pa.list_(pa.float64()))
    at = np.asarray(lists.offsets)
    flat = lists.values.to_numpy(zero_copy_only=False)  # null entries become NaN
    lengths = np.where(np.asarray(lists.is_valid()), np.diff(at), 0)
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.floor(flat * scale)
    for d in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == d)
        x = flat[at[rows][:, None] + np.arange(d)]
        ok = (np.abs(x) < _LIMIT).all(1)  # false for NaN
        if ok.any():
            yield rows[ok], x[ok].astype(np.int64) + shift


def _vectors(batches: Iterator[pa.RecordBatch], at: int, scale: float, shift: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            for rows, x in integers(pa.concat_arrays([part.column(at)]), scale, shift):
                yield part, rows, x


def _exact_sums(x: np.ndarray) -> list[int]:
    """Sums of columns, exact whatever their size: in two halves of 32 bits."""
    return [(int(h) << 32) + int(low) for h, low in zip((x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0), strict=True)]


def numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S as integers: of 64 bits where they fit, else Python's."""
    s = np.array(sums, dtype=object)
    if n * max(1, int(np.abs(x).max(initial=0))) < 1 << 61 and max(map(abs, sums)) < 1 << 61:
        return n * x - s.astype(np.int64)
    return n * x.astype(object) - s


def deviations(y: np.ndarray) -> list[int]:
    """Exact sums of squares of rows of integers."""
    if y.dtype != object:
        most = int(np.abs(y).max(initial=0))
        if most * most * y.shape[1] < 1 << 62:
            return (y * y).sum(1).tolist()
        if most < 1 << 47 and y.shape[1] < 1 << 14:  # halves of 24 bits: every sum of products fits
            a, b = y >> 24, y & 0xFFFFFF
            return [(int(p) << 48) + (int(q) << 25) + int(r) for p, q, r in zip((a * a).sum(1), (a * b).sum(1), (b * b).sum(1), strict=True)]
        y = y.astype(object)
    return (y * y).sum(1).tolist()


def _merged(left: Matrices, right: Matrices) -> Matrices:
    return {d: left[d] + right[d] if d in left and d in right else left.get(d, right.get(d)) for d in left.keys() | right.keys()}


def _summed(left: Sums, right: Sums) -> Sums:
    out = dict(left)
    for d, (n, s) in right.items():
        m, t = out.get(d, (0, [0] * d))
        out[d] = m + n, [a + b for a, b in zip(t, s, strict=True)]
    return out


class Whitening:
    """Mean, components and their eigenvalues of all vectors of a table."""

    def __init__(self, spark: SparkSession, vectors: DataFrame, *, key: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS, scale: float = SCALE, shift: int = SHIFT):
        self.spark, self.key, self.components, self.scale, self.shift = spark, key, components, scale, shift
        self.vectors = vectors.select(F.col(key).alias("key"), F.col(embedding).cast("array<double>").alias("v"))
        self.sums: Sums = self._tree(_add, _summed)
        covariance: Matrices = self._tree(self._outer, _merged)
        self.covariance = {d: covariance[d] / n for d, (n, _) in self.sums.items()}
        self.values: dict[int, np.ndarray] = {}
        self.project: Matrices = {}
        self.explained: dict[int, np.ndarray] = {}
        for d, v in self.covariance.items():
            e, w = np.linalg.eigh(v)
            e, w = e[::-1][:components], w[:, ::-1][:, :components]
            w = w * np.where(w[np.abs(w).argmax(0), np.arange(w.shape[1])] < 0, -1.0, 1.0)
            good = e > e[0] * d * np.finfo(float).eps * 8
            self.values[d], self.explained[d] = e, np.where(good, e, 0.0) / max(np.trace(v), np.finfo(float).tiny)
            self.project[d] = np.divide(w, np.sqrt(e, where=good, out=np.ones_like(e)), where=good[None, :], out=np.full_like(w, np.nan))
        again: Matrices = self._tree(self._whitened_outer, _merged)
        self.identity_error = {d: float(np.nanmax(np.abs(m / self.sums[d][0] - np.eye(len(m))), initial=0.0)) for d, m in again.items()}

    def _tree(self, add, merge):
        """``add`` over the batches of every task, ``merge`` over what tasks hand on, in a tree."""
        scale, shift = self.scale, self.shift

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc: dict = {}
            for _, _, x in _vectors(batches, 0, scale, shift):
                acc = add(acc, x)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(acc)], pa.binary())], ["part"])

        rows = self.vectors.select("v").mapInArrow(run, "part binary").rdd.map(lambda r: pickle.loads(r[0]))
        depth = max(2, math.ceil(math.log(max(2, rows.getNumPartitions())) / math.log(FAN_IN)))
        return rows.treeAggregate({}, merge, merge, depth)

    @property
    def _outer(self):
        sums = self.sums

        def add(acc: Matrices, x: np.ndarray) -> Matrices:
            d = x.shape[1]
            n, s = sums[d]
            y = numerators(x, n, s).astype(np.float64) / n
            acc[d] = acc[d] + y.T @ y if d in acc else y.T @ y
            return acc

        return add

    @property
    def _whitened_outer(self):
        sums, project = self.sums, self.project

        def add(acc: Matrices, x: np.ndarray) -> Matrices:
            d = x.shape[1]
            n, s = sums[d]
            y = numerators(x, n, s).astype(np.float64) / n @ project[d]
            acc[d] = acc[d] + y.T @ y if d in acc else y.T @ y
            return acc

        return add

    def transform(self) -> DataFrame:
        """key, component, n, deviation (decimal), whitened, explained, identity_error: a row for every vector and component."""
        model = self.spark.sparkContext.broadcast((self.sums, self.project, self.explained, self.identity_error))
        scale, shift = self.scale, self.shift
        wide = pa.decimal128(38, 0)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, project, explained, error = model.value
            for part, rows, x in _vectors(batches, 1, scale, shift):
                d = x.shape[1]
                n, s = sums[d]
                y = numerators(x, n, s)
                w = y.astype(np.float64) / n @ project[d]
                k = w.shape[1]
                far = pa.array([v if v < 10**38 else None for v in deviations(y)], wide)
                row = pa.array(np.repeat(np.arange(len(rows)), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)).take(row),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(rows) * k, n, np.int64)),
                        far.take(row),
                        pa.array(w.ravel(), from_pandas=True),
                        pa.array(np.tile(explained[d], len(rows))),
                        pa.array(np.full(len(rows) * k, error[d])),
                    ],
                    ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

        kind = self.vectors.schema["key"].dataType.simpleString()
        out = self.vectors.mapInArrow(run, f"key {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
        return out.withColumnRenamed("key", self.key)


def _add(acc: Sums, x: np.ndarray) -> Sums:
    return _summed(acc, {x.shape[1]: (len(x), _exact_sums(x))})
