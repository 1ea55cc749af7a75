"""Mixing sources to target weights, in DataFrame operations only.

The words of a source, its documents put in a seeded order, are cut into blocks of one length: BLOCK, or a small share
(1 / STEPS) of its target where that is less, one word at least, so that small sources meet their targets as well. A
source's target gives its number of output slots. How many slots of each source an output shard gets is a multinomial
draw: every slot picks a shard at random. That is the draw of source counts per shard under the condition that every source
meets its target, so the sources' totals are fixed and shard sizes vary a little instead (by the root of their slots). Slot k of a source is
mapped to a block by a pseudorandom permutation of the source's blocks (a Feistel network on block numbers, a new one
for each pass over the source), so no block is taken a second time before all are taken once. Slots and blocks are then
joined by block number.

Nothing is sorted or numbered in one task per source: documents are placed by hash buckets whose sizes are added up
first, and slots are made from counts in runs of RUN. The only table that goes through one task has a row per source.

Defined cases: a null source is one more source, last in order; null and blank texts have size 0 and nothing is taken of
them; repeated rows are documents of their own. Documents are ordered by a hash of id and text, so null and repeated ids
are spread like others, and reruns agree whatever the splits of the input (rows equal in both are interchangeable).
Very long texts are cut into blocks like all others. Without words all targets are 0. Columns named size, source_size,
target or taken are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, Scratch, partitions

BLOCK = 32
#: A source's target is this many blocks at least, or blocks are single words.
STEPS = 50
SHARDS = 64
BUCKETS = 1024
#: Slots that one row makes at most.
RUN = 4096
WEIGHTS = (5, 2, 1)
SEED = 17


def words(text: str) -> Column:
    """The number of words of a text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sizes`` (src nullable, source_size) with sid (place by code point, null last), weight and target.

    Targets share ``share`` of all sizes by weight; none exceeds ``most`` times its size. What is cut off there is
    shared among the others again: the level that fits is found from prefix sums over the sources by size per weight.
    """
    by_name = Window.orderBy(F.col("src").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("sid", F.row_number().over(by_name) - 1).withColumn("weight", w)
    all_ = Window.partitionBy(F.lit(0))
    up = all_.orderBy("__fill", "sid")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__fill", most * F.col("source_size") / F.col("weight"))
    left = F.lit(share) * F.sum("source_size").over(all_) - F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0.0))
    heavy = F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("__level", left / heavy)
    # the first source, by size per weight, that the level leaves below its limit
    open_ = F.min(F.when(F.col("__fill") >= F.col("__level"), F.struct("__fill", "sid", "__level"))).over(all_)
    level = F.coalesce(open_["__level"], F.max("__fill").over(all_))
    return rows.withColumn("__final", level).withColumn("target", F.least(most * F.col("source_size"), F.col("weight") * F.col("__final"))).drop("__fill", "__level", "__final")


def permute(rows: DataFrame, at: str, n: str, keys: list[str], name: str, *, seed: int = SEED, rounds: int = 4, walk: int = 16) -> DataFrame:
    """Adds ``name``: the number in [0, n) that ``at`` in [0, n) is mapped to; one permutation for each value of ``keys``.

    Numbers are cells of a grid of a x b cells, a * b < n + a; a round shifts the row by a hash of the column, then the
    column by a hash of the row. Results outside [0, n), about one in sqrt(n), go through the rounds again.
    """
    a, b = F.col("__a"), F.col("__b")
    rows = rows.withColumn("__a", F.ceil(F.sqrt(F.col(n).cast("double"))).cast("long")).withColumn("__b", F.expr(f"({n} + __a - 1) DIV __a"))

    def shift(r: Column | int, other: Column, side: int, size: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys], F.lit(side), r if isinstance(r, Column) else F.lit(r), other), size)

    rows = rows.withColumn("__l", F.expr(f"{at} DIV __b")).withColumn("__r", F.col(at) % b)
    for r in range(rounds):
        rows = rows.withColumn("__l", (F.col("__l") + shift(r, F.col("__r"), 0, a)) % a)
        rows = rows.withColumn("__r", (F.col("__r") + shift(r, F.col("__l"), 1, b)) % b)
    rows = rows.withColumn("__x", F.col("__l") * b + F.col("__r"))

    def once(x: Column) -> Column:
        start = F.struct(F.floor(x / b).cast("long").alias("l"), (x % b).alias("r"))

        def step(acc: Column, r: Column) -> Column:
            low = (acc["l"] + shift(r, acc["r"], 0, a)) % a
            return F.struct(low.alias("l"), ((acc["r"] + shift(r, low, 1, b)) % b).alias("r"))

        end = F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, step)
        return F.aggregate(F.array(end), F.lit(0).cast("long"), lambda _, e: e["l"] * b + e["r"])

    more = F.aggregate(F.sequence(F.lit(1), F.lit(walk)), F.col("__x"), lambda x, _: F.when(x < F.col(n), x).otherwise(once(x)))
    return rows.withColumn(name, F.when(F.col("__x") < F.col(n), F.col("__x")).otherwise(more)).drop("__a", "__b", "__l", "__r", "__x")


def _runs(rows: DataFrame, n: str) -> DataFrame:
    """``rows`` with one row for each number __i from 0 to ``n`` - 1, made in runs that are dealt to all tasks.

    The number of tasks is given: runs are tiny and their rows many, so they must not be gathered by their size.
    """
    runs = rows.where(F.col(n) > 0).withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({n} - 1) DIV {RUN}"))))
    runs = runs.repartition(partitions(rows.sparkSession), *[F.col(c) for c in runs.columns if c in ("sid", "shard", "__run")])
    last = F.least(F.col(n), (F.col("__run") + 1) * RUN) - 1
    return runs.withColumn("__i", F.explode(F.sequence(F.col("__run") * RUN, last))).drop("__run")


def slots(plan: DataFrame, *, shards: int = SHARDS, seed: int = SEED, scratch: Scratch) -> DataFrame:
    """(sid, shard, slot, block, pass): the block of every output slot. ``plan``: sid, n_blocks, n_slots."""
    draws = _runs(plan.select("sid", "n_slots"), "n_slots").withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), F.lit("draw"), "sid", "__i"), F.lit(shards)).cast("int"))
    counts = scratch.cut(draws.groupBy("sid", "shard").agg(F.count(F.lit(1)).alias("n")))
    first = F.sum("n").over(Window.partitionBy("sid").orderBy("shard")) - F.col("n")
    laid = counts.withColumn("first", first).join(plan.select("sid", "n_blocks"), "sid")
    each = _runs(laid, "n").withColumn("__k", F.col("first") + F.col("__i"))
    each = each.select("sid", "shard", F.col("__i").alias("slot"), "n_blocks", F.expr("__k DIV n_blocks").alias("pass"), (F.col("__k") % F.col("n_blocks")).alias("__j"))
    return permute(each, "__j", "n_blocks", ["sid", "pass"], "block", seed=seed).select("sid", "shard", "slot", "block", "pass")


class Mix:
    """A mix of ``docs``: ``docs`` stored with __rid, __size; sources with targets; slots; pieces of blocks."""

    def __init__(self, spark: SparkSession, docs: DataFrame, *, source: str = "source", text: str = "text", key: str = "doc_id", block: int = BLOCK, shards: int = SHARDS, seed: int = SEED, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, keep: tuple[str, ...] | None = None):
        scratch = Scratch(spark)
        keep = tuple(c for c in keep or (key,) if c not in ("size", "source_size", "target", "taken"))
        self.docs = scratch.cut(docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, key, source])], words(text).alias("__size"), F.xxhash64(text).alias("__text"), F.monotonically_increasing_id().alias("__rid")))
        slim = self.docs.select("__rid", F.col(source).alias("src"), F.col(key).alias("__key"), "__size", "__text")
        self.sources = scratch.cut(targets(slim.groupBy("src").agg(F.sum("__size").alias("source_size")), weights=weights, share=share, most=most))
        sized = self.sources.withColumn("__block", F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.col("target") / STEPS))).cast("long"))
        blocks = F.expr("(source_size + __block - 1) DIV __block")
        wanted = F.least(F.round(F.col("target") / F.col("__block")).cast("long"), F.floor(F.lit(most) * blocks).cast("long"))
        plan = sized.select("sid", blocks.alias("n_blocks"), wanted.alias("n_slots"))
        self.slots = slots(plan, shards=shards, seed=seed, scratch=scratch)
        own = sized.select(F.col("src").alias("__src"), "sid", "__block")
        rows = slim.join(own, F.col("src").eqNullSafe(F.col("__src"))).select("__rid", "__key", "__text", "__size", "sid", "__block").where("__size > 0")
        rows = rows.withColumn("__h", F.xxhash64(F.lit(seed), F.lit("order"), "__key", "__text")).withColumn("__bucket", F.pmod("__h", F.lit(BUCKETS)).cast("int"))
        sums = rows.groupBy("sid", "__bucket").agg(F.sum("__size").alias("__n"))
        offs = sums.select("sid", "__bucket", (F.sum("__n").over(Window.partitionBy("sid").orderBy("__bucket")) - F.col("__n")).alias("__off"))
        within = F.sum("__size").over(Window.partitionBy("sid", "__bucket").orderBy("__h", "__key", "__text", "__rid")) - F.col("__size")
        placed = rows.withColumn("__in", within).join(offs, ["sid", "__bucket"]).withColumn("__start", F.col("__in") + F.col("__off"))
        spans = placed.withColumn("block", F.explode(F.sequence(F.expr("__start DIV __block"), F.expr("(__start + __size - 1) DIV __block"))))
        lo = F.greatest(F.col("__start"), F.col("block") * F.col("__block")) - F.col("__start")
        hi = F.least(F.col("__start") + F.col("__size"), (F.col("block") + 1) * F.col("__block")) - F.col("__start")
        self.pieces = spans.select("sid", "block", "__rid", lo.alias("lo"), hi.alias("hi"))
        self.source, self.key = source, key

    def takes(self) -> DataFrame:
        """(__rid, lo, hi, times): the words lo to hi of a document that are taken, and how often."""
        times = self.slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))
        # slots are made from a tiny table of counts, which the planner would take for their size and broadcast
        return self.pieces.join(times.hint("merge"), ["sid", "block"]).select("__rid", "lo", "hi", "times")

    def taken(self) -> DataFrame:
        """The stored documents with size, source_size, target and taken added."""
        got = self.takes().groupBy("__rid").agg(F.sum((F.col("hi") - F.col("lo")) * F.col("times")).alias("taken"))
        info = self.sources.select(F.col("src").alias("__src"), "source_size", "target")
        out = self.docs.join(got, "__rid", "left").join(info, F.col(self.source).eqNullSafe(F.col("__src")), "left")
        return out.withColumnRenamed("__size", "size").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long")).drop("__rid", "__src", "__text")

    def texts(self, text: str = "text") -> DataFrame:
        """The mixed documents: the taken words of each, in order, once per pass that takes any of them.

        A document whose words are all taken in a pass keeps its text as it is; else white space becomes one blank.
        """
        got = self.takes().withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        spans = got.groupBy("__rid", "pass").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("__spans"), F.sum(F.col("hi") - F.col("lo")).alias("__n"))
        rows = self.docs.join(spans, "__rid")
        ws = F.regexp_extract_all(F.col(text), F.lit(WORD), 0)

        def part(w: Column) -> Column:
            return F.array_join(F.flatten(F.transform(F.col("__spans"), lambda s: F.slice(w, (s["lo"] + 1).cast("int"), (s["hi"] - s["lo"]).cast("int")))), " ")

        # the words are a lambda's argument: as a column they would be cut anew for every span
        part_ = F.element_at(F.transform(F.array(ws), part), 1)
        return rows.withColumn(text, F.when(F.col("__n") >= F.col("__size"), F.col(text)).otherwise(part_)).drop("__rid", "pass", "__spans", "__n", "__size", "__text")
