"""Near-duplicate embeddings by randomised-rotation binary codes.

A unit vector is turned by a seeded random rotation, once, and stored with its code: the signs (a bit an entry), a
correction factor (the inner product of the vector with its signs), and the turned entries, rounded to ``PLANES`` bits with a fixed
random dither and kept as planes of bits. From the signs and factor of one vector and the planes of another the inner product is
estimated without bias, by counting bits, with a bound on the error that holds with the confidence asked for: pairs
whose upper bound misses the threshold are dropped, all others are recomputed exactly in double precision.

Which pairs are looked at comes from runs of code bits: vectors that agree in one of ``tables`` runs meet. The length of
a run follows the number of vectors (about one random vector per bucket), the number of tables follows from the length
so that a pair at the threshold meets with probability ``recall``; pairs above it meet more often. A bucket of more
than ``cell`` vectors is split into cells and worked off as pairs of cells, so every bucket is compared in full and no
task holds more than two cells of one bucket at a time. A pair counts in the first table in which it meets.

Equal vectors are one before the search and weigh as many as they are, so copies cost nothing. The number of links of each
vector is exact among the pairs found, so a group of n near copies that are not equal is compared in all its pairs, each
in the first table in which it meets: n^2 / 2 products, in blocks of ``cell`` by ``cell``,
and n^2 / cell vectors dealt.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with
nothing and are their own component. Vectors of different lengths do not link; those of each length are compared with each other.
Rows are vectors: rows with one id and different vectors have links and components of their own, rows with equal vectors
count as copies, whatever their ids. Rows with a null id link like others, but name no component: theirs is null if no other row
is within reach, and only then they are kept. Ties need no rule: links depend on the vectors only. Only key and vector are read, so other columns may have any name.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, connected_components, forest, groups

THRESHOLD = 0.95
RECALL = 0.998
CELL = 128
SEED = 17
#: Standard errors of the estimate that the bound spans.
SPAN = 4.0
#: Bits of a turned entry.
PLANES = 6


def rotations(dim: int, n: int, seed: int = SEED) -> np.ndarray:
    """n random orthogonal matrices (n x dim x dim)."""
    rng = np.random.default_rng(seed)
    out = np.empty((n, dim, dim))
    for k in range(n):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        out[k] = q * np.sign(np.diag(r))
    return out


def plan(n: int, dim: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits of a run, number of tables) for n vectors."""
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    bits = min(dim, 48, max(6, math.ceil(math.log2(max(2, n)))))
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log1p(-(agree**bits))))


def _unit(column: pa.Array | pa.ChunkedArray, dim: int, kind: str) -> np.ndarray:
    """Unit vectors in double precision from stored bytes."""
    x = np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, dim).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _stored(kind: str):
    """(key, vector as bytes or null, dim) from (key, list)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, dims = [], []
            for v in batch.column(1).to_pylist():
                x = np.array(v, dtype=kind) if v is not None and len(v) and all(c is not None for c in v) else None
                if x is not None and not (np.isfinite(x).all() and x.any()):
                    x = None
                out.append(None if x is None else (x + 0).tobytes())  # -0 becomes 0
                dims.append(0 if x is None else len(v))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), pa.array(dims, pa.int32())], ["key", "vec", "dim"])

    return run


def codes(x: np.ndarray, turns: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The runs of code bits of unit vectors: vectors x tables."""
    per = x.shape[1] // bits
    out = np.empty((len(x), tables), dtype=np.int64)
    power = 1 << np.arange(bits, dtype=np.int64)
    for t in range(tables):
        y = x @ turns[t // per].T[:, (t % per) * bits : (t % per + 1) * bits]
        out[:, t] = (y > 0) @ power
    return out


class Codes(NamedTuple):
    """Of unit vectors: signs (vectors x words of 64 bits), factors, planes (vectors x PLANES x words), lowest entry and step of the planes."""

    signs: np.ndarray
    factor: np.ndarray
    planes: np.ndarray
    low: np.ndarray
    step: np.ndarray

    def at(self, rows: np.ndarray) -> Codes:
        return Codes(*(c[rows] for c in self))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as words of 64."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    pad = -packed.shape[-1] % 8
    return np.pad(packed, [(0, 0)] * (bits.ndim - 1) + [(0, pad)]).view("<u8")


def encode(x: np.ndarray, turn: np.ndarray) -> Codes:
    """Codes of unit vectors after a rotation."""
    y = x @ turn.T
    dim = x.shape[1]
    low = y.min(1)
    step = np.maximum((y.max(1) - low) / ((1 << PLANES) - 2), np.finfo(float).tiny)
    dither = np.random.default_rng(SEED).random(dim)
    u = np.floor((y - low[:, None]) / step[:, None] + dither).astype(np.uint8)
    return Codes(_words(y > 0), np.abs(y).sum(1) / math.sqrt(dim), _words(np.stack([u >> p & 1 for p in range(PLANES)], 1)), low, step)


@functools.lru_cache(maxsize=4)
def _turn(dim: int) -> np.ndarray:
    return rotations(dim, 1, SEED + 1)[0]


@functools.lru_cache(maxsize=4)
def _turns(dim: int, n: int) -> np.ndarray:
    return rotations(dim, n)


def compare(left: np.ndarray, right: np.ndarray, query: Codes, code: Codes, threshold: float, span: float = SPAN) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs (i of left, j of right) with cosine >= threshold, and how many were recomputed exactly.

    The estimate counts bits of the planes of ``query`` (left) where ``code`` (right) is positive: <signs, turned left> / factor.
    """
    dim = left.shape[1]
    both = np.zeros((len(left), len(right)))
    for p in range(PLANES):
        for w in range(code.signs.shape[1]):
            both += np.bitwise_count(query.planes[:, p, w, None] & code.signs[None, :, w]) * float(1 << p)
    ones = np.bitwise_count(code.signs).sum(1)
    total = (np.bitwise_count(query.planes).sum(2) * (1 << np.arange(PLANES))).sum(1)
    product = query.low[:, None] * (2.0 * ones - dim)[None, :] + query.step[:, None] * (2 * both - total[:, None])
    estimate = product / math.sqrt(dim) / code.factor[None, :]
    # a vector at cosine t to the coded one has only a part sqrt(1 - t^2) of its length across it
    across = (1 - np.minimum(1, code.factor) ** 2) / max(1, dim - 1) * max(0.0, 1 - threshold**2)
    margin = span * np.sqrt(across[None, :] + (query.step[:, None] / 2) ** 2) / code.factor[None, :] + 1e-9
    i, j = np.nonzero(estimate >= threshold - margin)
    exact = np.einsum("ij,ij->i", left[i], right[j])
    ok = exact >= threshold
    return i[ok], j[ok], len(i)


_CODED = "id long, weight long, dim int, vec binary, signs binary, factor double, planes binary, low double, step double, codes array<long>"


def _coder(kind: str, n: int, threshold: float, recall: float):
    """Vectors with their codes, of signs and of all tables, from (id, weight, dim, vec)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                bits, tables = plan(n, dim, threshold, recall)
                x = _unit(part.column(3), dim, kind)
                keys = codes(x, _turns(dim, -(-tables // (dim // bits))), bits, tables)
                c = encode(x, _turn(dim))
                raw = lambda rows: pa.array([v.tobytes() for v in rows], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, raw(c.signs), pa.array(c.factor), raw(c.planes), pa.array(c.low), pa.array(c.step), pa.array(list(keys), pa.list_(pa.int64()))],
                    ["id", "weight", "dim", "vec", "signs", "factor", "planes", "low", "step", "codes"],
                )

    return run


def _codes_of(t: pa.Table) -> Codes:
    """Stored codes."""
    words = lambda c: np.frombuffer(b"".join(t.column(c).to_pylist()), "<u8").reshape(t.num_rows, -1)
    return Codes(words("signs"), t.column("factor").to_numpy(), words("planes").reshape(t.num_rows, PLANES, -1), t.column("low").to_numpy(), t.column("step").to_numpy())


def _links(kind: str, n: int, threshold: float, recall: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: tuple[list, list, list] = ([], [], [])
        for t in groups(batches, ["dim", "table", "code", "ci", "cj"]):
            dim, table, ci, cj = (t.column(c)[0].as_py() for c in ("dim", "table", "ci", "cj"))
            ids, weight, cell = (t.column(c).to_numpy() for c in ("id", "weight", "cell"))
            a, b = (np.flatnonzero(cell == ci), np.flatnonzero(cell == cj))
            if len(a) == 0 or len(b) == 0:
                continue
            x, code = _unit(t.column("vec"), dim, kind), _codes_of(t)
            i, j, _ = compare(x[a], x[b], code.at(a), code.at(b), threshold)
            i, j = a[i], b[j]
            if ci == cj:
                keep = i < j
                i, j = i[keep], j[keep]
            if table and len(i):  # pairs that met in an earlier table counted there
                bits, tables = plan(n, dim, threshold, recall)
                own, at = np.unique(np.concatenate([i, j]), return_inverse=True)
                keys = codes(x[own], _turns(dim, -(-tables // (dim // bits))), bits, tables)[:, :table]
                new = ~(keys[at[: len(i)]] == keys[at[len(i) :]]).any(1)
                i, j = i[new], j[new]
            if not len(i):
                continue
            links = np.bincount(i, weight[j], len(x)) + np.bincount(j, weight[i], len(x))
            root = forest(len(x), i, j)
            at = np.flatnonzero(links)
            rows[0].append(ids[at])
            rows[1].append(links[at].astype(np.int64))
            rows[2].append(ids[root[at]])
            if sum(map(len, rows[0])) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in rows], ["id", "n", "other"])
                rows = ([], [], [])
        if rows[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in rows], ["id", "n", "other"])

    return run


def near_duplicates(spark: SparkSession, vectors: DataFrame, *, key: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL, cell: int = CELL) -> DataFrame:
    """key, n_links, component_id, kept for every row of ``vectors``."""
    scratch = Scratch(spark)
    kind = "<f4" if dict(vectors.dtypes)[embedding] == "array<float>" else "<f8"
    listed = F.col(embedding) if kind == "<f4" else F.col(embedding).cast("array<double>")
    unit = vectors.select(F.col(key).cast("long").alias("key"), listed.alias("e")).mapInArrow(_stored(kind), "key long, vec binary, dim int")
    unit = scratch.cut(unit.withColumn("rid", F.monotonically_increasing_id()))
    good = unit.where("dim > 0").withColumn("d1", F.xxhash64("vec")).withColumn("d2", F.xxhash64(F.lit(SEED), "vec"))
    reps = scratch.cut(good.groupBy("dim", "d1", "d2").agg(F.min("rid").alias("id"), F.min("key").alias("low"), F.count(F.lit(1)).alias("weight")))
    n = reps.count()
    # one row of each group of copies brings its vector along; its number stands for the group
    own = reps.select("id", "weight").join(unit.select("rid", "vec", "dim"), F.col("id") == F.col("rid")).select("id", "weight", "dim", "vec")
    one = scratch.cut(own.mapInArrow(_coder(kind, n, threshold, recall), _CODED))
    coded = one.select("id", "dim", F.posexplode("codes").alias("table", "code"))
    full = scratch.cut(coded.groupBy("dim", "table", "code").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("dim", "table", "code", F.expr(f"CAST((m + {cell - 1}) DIV {cell} AS INT)").alias("nc")))
    met = coded.join(full, ["dim", "table", "code"]).withColumn("cell", F.pmod(F.xxhash64(F.lit(SEED), "id"), F.col("nc")).cast("int")).join(one.drop("codes", "dim"), "id")
    other = F.explode(F.sequence(F.lit(0), F.col("nc") - 1)).alias("o")
    dealt = met.select("*", other).withColumn("ci", F.least("cell", "o")).withColumn("cj", F.greatest("cell", "o")).drop("o", "nc")
    at = ["dim", "table", "code", "ci", "cj"]
    found = scratch.cut(dealt.repartition(*at).sortWithinPartitions(*at, "id").mapInArrow(_links(kind, n, threshold, recall), "id long, n long, other long"))
    scratch.drop(full)
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    comp = scratch.cut(connected_components(spark, found.select(F.col("id").alias("u"), F.col("other").alias("v")), scratch))
    names = comp.join(reps.select("id", "low"), F.col("node") == F.col("id")).groupBy("component").agg(F.min("low").alias("name"))
    rep = reps.join(counts, "id", "left").join(comp, F.col("id") == F.col("node"), "left").join(scratch.cut(names), "component", "left")
    info = scratch.cut(rep.select("dim", "d1", "d2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("name", "low").alias("component")))
    known = good.join(info, ["dim", "d1", "d2"]).select("key", F.col("n").cast("long").alias("n_links"), F.col("component").alias("component_id"))
    rest = unit.where("dim = 0").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    out = known.unionByName(rest)
    return out.select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
