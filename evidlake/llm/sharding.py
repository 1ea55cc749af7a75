"""Sharding by proportional stratified interleaving, in DataFrame operations only.

Rows of each source are put in a seeded random order; a row's fractional rank is its place in its source over the
source's size. Sorted by fractional rank, every stretch of rows holds the sources in their overall proportions, so
cutting that order into equal stretches gives shards that all match the mixture.

Places are found without sorting a source in one task: rows are cut by their sort key into fine buckets, whose counts
are added up beforehand, and only places within a bucket come from a window. A source with a third of all rows is spread over
all buckets alike.

Defined cases: a null source is a source of its own, a null text has size 1 and the checksum 0. The seeded order is that of
a hash of the id and of the columns handed in beside it (text checksum and size), so null and repeated ids are spread like
others; rows equal in all of these are interchangeable. Equal texts are not kept together: the ``rows`` law spreads them.
Texts of any length count as one row. Other columns pass through; shard and slot are replaced. An empty table gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hexadecimal digits of the sort key that name a bucket, at least; more are taken so that a bucket has about ROWS rows.
DIGITS, ROWS = 3, 1 << 16
SEED = "evidlake-17"


def place(rows: DataFrame, group: list[str], bucket: Column, order: list[Column], name: str, total: str | None = None) -> DataFrame:
    """Adds ``name``, a row's place (from 0) within ``group`` by (bucket, order), and ``total``, the group's rows."""
    rows = rows.withColumn("__bucket", bucket)
    counts = rows.groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    offsets = counts.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__bucket").alias("__b"), (F.sum("__n").over(w.orderBy("__bucket")) - F.col("__n")).alias("__off"), F.sum("__n").over(w).alias("__total"))
    on = F.col("__bucket") == F.col("__b")
    for i, g in enumerate(group):
        on &= F.col(g).eqNullSafe(F.col(f"__g{i}"))
    within = F.row_number().over(Window.partitionBy(*group, "__bucket").orderBy(*order)) - 1
    out = rows.withColumn("__in", within).join(offsets, on).withColumn(name, F.col("__in") + F.col("__off"))
    if total:
        out = out.withColumn(total, F.col("__total"))
    return out.drop("__bucket", "__b", "__in", "__off", "__total", *[f"__g{i}" for i in range(len(group))])


def interleave(docs: DataFrame, shards: int = 8, *, key: str = "doc_id", source: str = "source", seed: str = SEED, extra: tuple[Column, ...] = ()) -> DataFrame:
    """``docs`` with shard (0 to shards-1) and slot (gapless from 0 in each shard) added."""
    ident = F.coalesce(F.col(key).cast("string"), F.lit(""))
    count = docs.count()
    digits = max(DIGITS, math.ceil(math.log(max(1, count) / ROWS, 16)))
    buckets = 16**digits
    ident = F.concat_ws(":", F.lit(seed), ident, *[F.coalesce(x.cast("string"), F.lit("")) for x in extra])
    rows = docs.drop("shard", "slot").withColumn("__src", F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("-"))).withColumn("__h", F.md5(ident.cast("binary")))
    order = [F.col("__h"), F.col(key), *extra]
    ranked = place(rows, ["__src"], F.conv(F.substring("__h", 1, digits), 16, 10).cast("int"), order, "__rank", "__size")
    frac = (2 * F.col("__rank") + 1) / (2 * F.col("__size"))
    ranked = ranked.withColumn("__frac", frac)
    at = place(ranked, [], F.least(F.floor(F.col("__frac") * buckets), F.lit(buckets - 1)).cast("int"), [F.col("__frac"), F.col("__src"), *order], "__pos", "__all")
    shard = F.expr(f"CAST((__pos * {shards}) DIV __all AS INT)")
    first = F.expr(f"((__pos * {shards}) DIV __all * __all + {shards - 1}) DIV {shards}")  # the first place of that shard
    return at.withColumn("shard", shard).withColumn("slot", (F.col("__pos") - first).cast("long")).drop("__src", "__h", "__rank", "__size", "__frac", "__pos", "__all")
