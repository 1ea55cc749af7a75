"""Sinks: fixed-column CSV, JSON lines, tables, summaries and upserts. Inputs are never changed in place."""

from __future__ import annotations

import atexit
import contextlib
import json
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OWN: dict[str, str] = {}
_REMOVED: set[str] = set()


def _remove_at_exit(spark: SparkSession, root: str) -> None:
    """What an application has stored goes when its driver ends, as far as the JVM is still there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def remove() -> None:
        with contextlib.suppress(Exception):
            p = jvm.org.apache.hadoop.fs.Path(root)
            p.getFileSystem(conf).delete(p, True)

    atexit.register(remove)
    _REMOVED.add(root)


def scratch(spark: SparkSession) -> str:
    """The application's folder below the one in ``spark.checkpoint.dir``, else below the warehouse; a local session has a temporary one.

    A folder of one machine is refused where executors are on others: set ``spark.checkpoint.dir`` there. The folder goes when the driver ends.
    """
    app, root, local = spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master.startswith("local[")
    if not root and local:
        root = _OWN.setdefault(app, tempfile.mkdtemp(prefix="evidlake-"))
    elif not root:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark.conf.get("spark.sql.warehouse.dir"))
        root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
        if root.startswith("file:"):
            raise RuntimeError(f"{root} is a folder of one machine: set spark.checkpoint.dir to one that all executors share")
    out = f"{root.rstrip('/')}/evidlake/{app}"
    if out not in _REMOVED:
        _remove_at_exit(spark, out)
    return out


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the session's shared checkpoint folder, read again: its lineage ends there."""
    spark = df.sparkSession
    path, schema = f"{scratch(spark)}/{uuid.uuid4().hex}", df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def csv(df: DataFrame, path: str, fields: Sequence[str], *, bom: bool = False, single: bool = False) -> None:
    """Columns ``fields`` in order as text, missing ones empty, others dropped."""
    have = set(df.columns)
    out = df.select(*[(F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")) if f in have else F.lit("")).alias(f) for f in fields])
    if bom and fields:
        out = out.withColumnRenamed(fields[0], "﻿" + fields[0])
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).option("quoteAll", False).option("escape", '"').csv(path)


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def summary(df: DataFrame) -> str:
    """A one-row aggregate as an indented JSON document."""
    row = df.first()
    return json.dumps(row.asDict(recursive=True) if row else {}, indent=2, ensure_ascii=False, default=str)


def excel_text(c: Column | str, most: int = 32000) -> Column:
    """Text that fits a workbook's cell."""
    t = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    return F.when(F.length(t) > most, F.concat(F.left(t, F.lit(most - 3)), F.lit("..."))).otherwise(t)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], replace: bool = True) -> DataFrame:
    """Rows by key: with ``replace`` new rows win, else old ones. The result is a new table."""
    both = old.withColumn("__o", F.lit(0)).unionByName(new.withColumn("__o", F.lit(1)), allowMissingColumns=True)
    names = [c for c in both.columns if c != "__o"]
    best = (F.max_by if replace else F.min_by)(F.struct(*names), F.col("__o"))
    return both.groupBy(*keys).agg(best.alias("__b")).select("__b.*")


def typed(df: DataFrame, ddl: str) -> DataFrame:
    """Columns of a schema in its order, cast; what does not fit, or is missing, is null."""
    have = {c.lower() for c in df.columns}
    fields = T.StructType.fromDDL(ddl).fields
    return df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields])


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text, null as empty."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def side_files(df: DataFrame, key: str, text: str, path: str) -> None:
    """One folder of text for each document, named by its key."""
    df.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("value")).repartition(key).write.mode("overwrite").partitionBy(key).text(path)


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """One small file, in whatever file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(content))
    out.close()


def release(df: DataFrame, path: str, version: int) -> str:
    """A new version of a table beside those that are there; no version is ever changed."""
    out = f"{path}/v{version:06d}"
    df.write.mode("error").parquet(out)
    return out


def split(df: DataFrame, parts: dict[str, Column], path: str) -> None:
    """One output per predicate from one stored pass."""
    kept = stored(df)
    for name, cond in parts.items():
        kept.where(cond).write.mode("overwrite").parquet(f"{path}/{name}")


def table(df: DataFrame, path: str, sort: Sequence[str] = ()) -> None:
    """A Parquet table, sorted within its files so that readers can skip row groups."""
    (df.sortWithinPartitions(*sort) if sort else df).write.mode("overwrite").parquet(path)


def views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
