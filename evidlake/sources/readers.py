"""Scans: CSV, tab exports, JSON, XML, HTML and binary files as DataFrames with declared schemas.

Missing inputs are empty tables where the pipeline treats them as optional. Network fetches and OCR stay outside: they
land files, and these scans read what landed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidlake.functions import text as X
from evidlake.operators.relational import conform
from evidlake.sources import archives


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names directly below a folder, none if it is not there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []


def csv(spark: SparkSession, path: str, fields: Sequence[str] | None = None, *, sep: str = ",", cleaned: bool = False, aliases: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Text columns of a CSV with a header, a byte-order mark gone; ``fields`` are looked up by name or alias.

    A missing file gives an empty table with ``fields``.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], _strings(fields or ["value"]))
    df = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("sep", sep).csv(path)
    df = df.toDF(*[c.replace("﻿", "").strip() for c in df.columns])
    if fields is not None:
        df = conform(df, fields, aliases)
    return df.select(*[(X.clean(f"`{c}`") if cleaned else X.blank(f"`{c}`")).alias(X_name(c) if cleaned else c) for c in df.columns])


def X_name(name: str) -> str:
    """A column name of letters, digits and underscores."""
    return "".join(ch if ch.isascii() and (ch.isalnum() or ch == "_") else "_" for ch in name.strip()) or "column"


def catalogue(spark: SparkSession, path: str, fields: Sequence[str] | None = None, required: Sequence[str] = (), *, sheet: str = "", keys: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """CSV, TSV or a workbook by its ending; missing values are empty text; missing required columns are an error.

    A workbook (at most 1,048,576 rows a sheet, by its format) is read on the driver: from the sheet named, where it is there,
    else from the first one.
    """
    low = path.lower()
    if low.endswith((".xlsx", ".xls")):
        book = pd.ExcelFile(path)
        df = spark.createDataFrame(book.parse(sheet if sheet in book.sheet_names else 0, dtype=str).fillna(""))
    else:
        df = csv(spark, path, sep="\t" if low.endswith((".tsv", ".txt")) else ",")
    lost = [c for c in required if c.lower() not in {x.lower() for x in df.columns}]
    if lost:
        raise ValueError(f"missing columns: {', '.join(lost)}")
    df = conform(df, fields) if fields else df
    return df.withColumns({name: X.composite(*parts) for name, parts in (keys or {}).items()})


def tab_export(spark: SparkSession, path: str, fields: Sequence[str], encoding: str = "ISO-8859-1") -> DataFrame:
    """Headerless tab-separated export; short rows are filled up with empty text."""
    if not exists(spark, path):
        return spark.createDataFrame([], _strings(fields))
    df = spark.read.option("sep", "\t").option("encoding", encoding).option("mode", "PERMISSIVE").option("quote", "").schema(_strings(fields)).csv(path)
    return df.select(*[X.blank(f).alias(f) for f in fields])


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, value, parsed): whole JSON files, ``parsed`` null where they are empty or broken."""
    df = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return df.withColumn("parsed", F.try_parse_json("value"))


def class_map(spark: SparkSession, path: str) -> DataFrame:
    """Subclass rows with their class, from a JSON dimension."""
    schema = "classes array<struct<CLASS_CODE string, CLASS_NAME string>>, subclasses array<struct<CLASS_CODE string, CLASS_NAME string, SUBCLASS_CODE string, SUBCLASS_NAME string>>"
    return spark.read.option("multiLine", True).schema(schema).json(path).select(F.inline("subclasses"))


def _xml_prefix(spark: SparkSession, path: str, tag: str) -> str | None:
    """The prefix, colon included, that a tag has in these files; None if it is nowhere."""
    starts = spark.read.option("lineSep", ">").text(path).select(F.regexp_extract("value", rf"<((?:[\w.\-]+:)?{tag})(?:\s[^<]*)?/?$", 1).alias("name")).where("name <> ''")
    found = [r["name"] for r in starts.distinct().limit(2).collect()]
    if len(found) > 1:
        raise ValueError(f"{tag} has several prefixes below {path}: read such files apart")
    return found[0].removesuffix(tag) if found else None


def xml_records(spark: SparkSession, path: str, tag: str, needles: Sequence[str] = (), *, plain: bool = False) -> DataFrame:
    """(value): the text of each record of large XML files; only those that hold a needle are passed on to a parser.

    Files are cut at the records' end tags by the text source, which splits them and finds records across the ends of splits, so a task
    holds one record at a time. The tag may have a prefix, the same in all files. ``plain``: prefixes of elements and declarations
    of namespaces are dropped. Records do not hold records of their own kind; end tags have no blanks.
    """
    prefix = _xml_prefix(spark, path, tag)
    if prefix is None:
        return spark.createDataFrame([], "value string")
    end = f"</{prefix}{tag}>"
    df = spark.read.option("lineSep", end).text(path)
    df = df.select(F.regexp_extract("value", rf"(?s)<{prefix}{tag}(?:\s[^>]*)?>.*$", 0).alias("value")).where("value <> ''")
    df = df.select(F.concat("value", F.lit(end)).alias("value"))
    if needles:
        df = df.where(reduce(lambda a, b: a | b, [F.contains(F.lower("value"), F.lit(n.lower())) for n in needles]))
    if plain:
        df = df.select(F.regexp_replace(F.regexp_replace("value", r"<(/?)[\w.\-]+:", "<$1"), r"""\sxmlns(?::[\w.\-]+)?\s*=\s*(?:"[^"]*"|'[^']*')""", "").alias("value"))
    return df


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    """Records of large XML files under a schema, whatever prefix their elements have; attributes are columns that begin with ``_``."""
    records = xml_records(spark, path, row_tag, plain=True)
    return records.select(F.from_xml("value", schema, {"rowTag": row_tag}).alias("r")).where("r IS NOT NULL").select("r.*")


def files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, length, modificationTime) of files; contents are not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", pattern).load(path)
    return df.select("path", "length", "modificationTime")


def contents(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, content, kind, sha256) of files; zip archives are replaced by their members, one row each.

    Members larger than ``archives.CHUNK`` bytes come in several rows, ``#part`` behind their names.
    """
    loose = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "content").where(~F.lower("path").endswith(".zip"))
    within = archives.zip_members(spark, path)
    name = F.concat(F.col("archive"), F.lit("!"), F.col("member"), F.when(F.col("last") & (F.col("part") == 0), F.lit("")).otherwise(F.concat(F.lit("#"), F.col("part").cast("string"))))
    both = loose.unionByName(within.select(name.alias("path"), "content"))
    return both.withColumn("kind", X.magic("content")).withColumn("sha256", F.sha2("content", 256))


def _prose(text: str, least: float = 0.55) -> bool:
    """Whether text looks like prose: enough letters among its visible characters, few marks of a raw PDF."""
    visible = [c for c in text if not c.isspace()]
    letters = sum(c.isalpha() for c in visible)
    return bool(visible) and letters >= least * len(visible) and sum(text.count(m) for m in ("endobj", "endstream", "/Type", "xref")) < 3


def document_text(df: DataFrame, parse_pdf=None, ocr=None, *, parsers: Sequence[tuple[str, Callable[[bytes], str]]] = (), readable: bool = False) -> DataFrame:
    """Adds text, parser and status to (path, content, kind).

    ``parsers`` are (name, function bytes -> text) that the caller brings along, tried in order (``parse_pdf`` and ``ocr`` are
    short for those two); without any PDFs get the status no_parser. With ``readable`` a text that is no prose does not
    count, and unreadable is the status if no parser gives one. Markup is stripped, plain text is decoded here.
    """
    tries = [*parsers, *((n, f) for n, f in (("pdf", parse_pdf), ("ocr", ocr)) if f is not None)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for kind, c in zip(b["kind"], b["content"], strict=True):
                if kind != "pdf":
                    got.append((c.decode("utf-8", "replace"), "markup" if kind == "markup" else "decode", "ok" if c.strip() else "no_text_extracted"))
                    continue
                text, parser, status = "", "", "no_parser"
                for name, f in tries:
                    try:
                        said = f(c)
                    except Exception:  # a parser may fail in any way; the row says so
                        status = "extract_failed" if status == "no_parser" else status
                        continue
                    if said.strip() and (not readable or _prose(said)):
                        text, parser, status = said, name, "ok"
                        break
                    status = "unreadable" if said.strip() else "no_text_extracted"
                got.append((text, parser, status))
            out = b.drop(columns=["content"]).copy()
            out["text"], out["parser"], out["status"] = zip(*got, strict=True) if got else ((), (), ())
            yield out

    schema = T.StructType([*[f for f in df.schema.fields if f.name != "content"], *_strings(["text", "parser", "status"]).fields])
    out = df.mapInPandas(run, schema)
    return out.withColumn("text", F.when(F.col("parser") == "markup", X.strip_html("text")).otherwise(F.col("text")))


def landed(spark: SparkSession, path: str, keys: DataFrame, key: str) -> DataFrame:
    """(key, body, hit): what a fetcher has landed as one JSON line {"key", "body"} per request; a miss has a null body.

    The fetching itself stays outside; rows without a hit are what is left to fetch. Of several answers the longest counts.
    """
    got = spark.read.schema("key string, body string").json(path) if exists(spark, path) else spark.createDataFrame([], "key string, body string")
    best = got.groupBy("key").agg(F.max_by("body", F.struct(F.length("body"), F.col("body"))).alias("body"))
    out = keys.select(F.col(key).cast("string").alias(key)).distinct().join(best.withColumnRenamed("key", key), key, "left")
    return out.withColumn("hit", F.col("body").isNotNull())


def discover(spark: SparkSession, root: str, keys: Sequence[str] = ("row_id", "amm"), skip: Sequence[str] = ()) -> DataFrame:
    """(path, key, value): the key values of every CSV below a root that has one of ``keys``, the first of them; ``skip``: names of folders.

    All files are lines of one text scan with their file's name. The first line of a file is its header; the place of its key
    column, a row per file, is joined to the file's other lines, which are split by the rules of CSV. Values do not span lines; lines equal to the header are headers.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"), F.regexp_replace("value", "^\ufeff|\r$", "").alias("value"))
    below = F.split(F.substring_index("file", root.rstrip("/").rsplit("/", 1)[-1] + "/", -1), "/")
    for name in skip:
        lines = lines.where(~F.array_contains(below, name))
    header = lines.groupBy("file").agg(F.min_by("value", F.struct("at", "n")).alias("header"))
    fields = lambda c: F.transform(F.regexp_extract_all(F.concat(F.lit(","), c), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), 1), lambda x: F.when(x.startswith('"'), F.replace(F.regexp_replace(x, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(x))
    named = header.withColumn("names", F.transform(fields(F.col("header")), lambda x: F.lower(F.trim(x))))
    key = F.coalesce(*[F.when(F.array_contains("names", k), F.lit(k)) for k in keys])
    named = named.select("file", "header", key.alias("key"), F.array_position("names", key).cast("int").alias("place")).where("key IS NOT NULL")
    rows = lines.join(named, "file").where((F.col("value") != "") & (F.col("value") != F.col("header")))
    return rows.select(F.element_at(F.split("file", "/"), -1).alias("path"), "key", X.clean(F.get(fields(F.col("value")), F.col("place") - 1)).alias("value"))


def resolve(paths: DataFrame, path: str, available: DataFrame, roots: Sequence[str]) -> DataFrame:
    """``paths`` with resolved: the first of ``roots`` below which a relative path is available (``available``: path); null if none."""
    have = available.select(F.col("path").alias("__have")).distinct()
    options = paths.select("*", F.posexplode(F.array(*[F.concat(F.lit(r.rstrip("/") + "/"), F.col(path)) for r in roots])).alias("__n", "__full"))
    best = options.join(have, F.col("__full") == F.col("__have")).groupBy(path).agg(F.min_by("__full", "__n").alias("resolved"))
    return paths.join(best, path, "left")


def jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def multiplex(frames: Sequence[tuple[DataFrame, dict[str, object]]]) -> DataFrame:
    """Several sources in order as one: each with its configuration as columns and its place as src_ord."""
    parts = [df.withColumns({k: F.lit(v) for k, v in cfg.items()}).withColumn("src_ord", F.lit(n)) for n, (df, cfg) in enumerate(frames, 1)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
