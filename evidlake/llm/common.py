"""Shared helpers of the training-data operators.

Intermediate tables go to the library's scratch folder (``sources.writers.scratch``), which all executors see. They are
ordinary Parquet tables, so a lost executor costs a re-read and not a recomputation.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidlake.sources.writers import scratch

#: A word everywhere in this subpackage: a run of anything but ASCII white space. In Python ``bytes.split()`` gives it.
WORD = r"[^\x20\x09-\x0D]+"

#: Links that one task labels at most.
LINKS_AT_ONCE = 1 << 20

Made = TypeVar("Made")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables below ``sf_dir``, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Writes intermediate tables and removes those that are no longer needed."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.paths = spark, scratch(spark), {}

    def cut(self, df: DataFrame) -> DataFrame:
        """``df`` written as Parquet and read again: its lineage ends here and its size is known to the planner."""
        path = f"{self.root}/{uuid.uuid4().hex}"
        schema = df.schema
        df.write.parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *dfs: DataFrame) -> None:
        """Deletes tables that ``cut`` wrote and nothing reads any more."""
        jvm = self.spark._jvm
        for df in dfs:
            _, path = self.paths.pop(id(df), (None, None))
            if path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def per_process(name: str, make: Callable[[], Made]) -> Made:
    """``make()``, once in each Python process; the last name asked for is kept and all others are let go.

    Functions travel by value here, so their globals last one task only. Workers are used for one operator after
    another, and their caches must not add up.
    """
    kept = sys.__dict__.setdefault("_evidlake", {})
    if name not in kept:
        kept.clear()
        kept[name] = make()
    return kept[name]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Record batches cut into smaller ones, so that few texts at a time become Python strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width, which a cluster sets to suit its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all links that come."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held)
    nodes, at = np.unique(np.concatenate([t.column("u").to_numpy(), t.column("v").to_numpy()]), return_inverse=True)
    root = nodes[forest(len(nodes), at[: t.num_rows], at[t.num_rows :])]
    for lo in range(0, len(nodes), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[lo : lo + (1 << 16)]), pa.array(root[lo : lo + (1 << 16)])], ["node", "component"])


def connected_components(spark: SparkSession, edges: DataFrame, scratch: Scratch | None = None, *, at_once: int = LINKS_AT_ONCE) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v long); component is the smallest node that links reach.

    Up to ``at_once`` links (16 bytes each) are labelled in one task: that bound is checked before. More go through
    alternating large-star and small-star steps: each maps every edge towards the smallest neighbour, so rows never
    exceed the edges given, and nothing is gathered outside the cluster. The minima are written before they are joined
    back, which leaves two plain exchanges that adaptive execution can split when a node is a hub. Both ways give the same.
    Self-links, repeated links and nulls are ignored; no edges give no rows.
    """
    scratch = scratch or Scratch(spark)
    a, b = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = scratch.cut(edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select(a, b))
    if now.count() <= at_once:
        return now.coalesce(1).mapInArrow(_labelled, "node long, component long")
    old, now = now, scratch.cut(now.distinct())
    scratch.drop(old)
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = scratch.cut(both.join(low, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low2 = scratch.cut(large.groupBy("u").agg(F.min("v").alias("m")))
        joined = large.join(low2, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low2.select("u", F.col("m").alias("v")))
        nxt = scratch.cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
        after = _state(nxt)
        scratch.drop(now, low, large, low2)
        now = nxt
        if after == state:
            break
        state = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def groups(batches: Iterable[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """The runs of equal ``key`` in record batches sorted by it; a run may span batches. One run is held at a time."""
    held: list[pa.Table] = []
    last = None

    def ident(t: pa.Table, i: int) -> tuple:
        return tuple(t.column(k)[i].as_py() for k in key)

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        change = np.zeros(t.num_rows, dtype=bool)
        for k in key:
            v = t.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), t.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            me = ident(t, lo)
            if held and me != last:
                yield pa.concat_tables(held)
                held = []
            held.append(t.slice(lo, hi - lo))
            last = me
    if held:
        yield pa.concat_tables(held)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links left-right: each node's smallest connected node (minimum-label propagation)."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label
