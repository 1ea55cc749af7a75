"""An incremental release: arriving files become accepted rows once, whatever restarts happen between.

A file stream with the trigger ``availableNow`` hands over what has arrived since the last run as batches with numbers that
its checkpoint keeps. A batch drops repeated keys (the first in source order wins), then the keys that earlier batches
released, and writes what is left to a folder named by its number. A batch that is run again after a failure reads the keys
of lower numbers only and overwrites its own folder, so every row is released exactly once; only folders up to the last number
that the checkpoint has committed are read.

Keys are kept beside the rows in ``buckets`` folders by hash: a batch reads the folders of the buckets that its own keys fall into.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evidlake.operators.relational import pick
from evidlake.sources.readers import exists, names
from evidlake.sources.writers import stored


class Release:
    """The release below ``path`` of rows with distinct ``keys``; ``order``: which of several rows of a batch with one key stays."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[Column | str], *, buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.order = [F.col(c) if isinstance(c, str) else c for c in order]

    def _hash(self) -> Column:
        return F.xxhash64(*[F.col(k) for k in self.keys])

    def committed(self) -> int:
        """The number of the last batch that the checkpoint knows to be done, -1 for none."""
        return max((int(n) for n in names(self.spark, f"{self.path}/checkpoint/commits") if n.isdigit()), default=-1)

    def accept(self, batch: DataFrame, number: int) -> None:
        """Writes the rows of one batch that are new; the same batch may come again."""
        new = stored(pick(batch, self.keys, self.order).withColumn("bucket", F.pmod(self._hash(), F.lit(self.buckets)).cast("int")))
        mine = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # buckets without a key of this batch are not read
        if number and mine and exists(self.spark, f"{self.path}/keys"):
            schema = new.select(*self.keys).schema.add("bucket", "integer").add("batch", "integer")
            old = self.spark.read.schema(schema).parquet(f"{self.path}/keys").where((F.col("batch") < number) & F.col("bucket").isin(mine))
            same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in ["bucket", *self.keys]]
            new = stored(new.alias("n").join(old.alias("o"), same, "left_anti"))
        new.drop("bucket").write.mode("overwrite").parquet(f"{self.path}/rows/batch={number}")
        new.select("bucket", *self.keys).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/keys/batch={number}")

    def run(self, source: str, schema: StructType | str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df, *, files: int | None = None) -> int:
        """Takes in what has arrived at ``source`` (Parquet, ``files`` a batch at most); returns how many batches that were."""
        stream = self.spark.readStream.schema(schema).option("recursiveFileLookup", True)
        stream = (stream.option("maxFilesPerTrigger", files) if files else stream).parquet(source)
        query = prepare(stream).writeStream.foreachBatch(self.accept).option("checkpointLocation", f"{self.path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        return sum(p["numInputRows"] > 0 for p in query.recentProgress)

    def rows(self) -> DataFrame:
        """All released rows with the number of their batch."""
        return self.spark.read.parquet(f"{self.path}/rows").where(F.col("batch") <= self.committed())
