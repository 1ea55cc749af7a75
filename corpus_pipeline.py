"""Corpus pipeline: from raw documents to packed training sequences, in five stages.

Every stage reads what its predecessor stored and decides for all of it. All but the last return the columns of
``documents``; the last returns the place of every piece in the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidlake.llm import jaccard, langid, linededup, mixing, packing
from evidlake.llm.common import Scratch, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Below this posterior, the language of a document counts as unknown.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language; fills in ``lang`` where it is null."""
    model = langid.fit(docs.where(langid.fold("doc_id", 5) != 0))
    out = langid.predict(spark, docs.select(*COLUMNS), model, prefix="__id").where((F.col("__id_pred") != "und") & (F.col("__id_score") >= LEAST_SCORE))
    return out.withColumn("lang", F.coalesce("lang", "__id_pred")).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes blocks of lines that an earlier document has; documents of which nothing is left go."""
    out = linededup.dedup(spark, docs.select(*COLUMNS)).where((F.col("n_lines_left") > 0) | (F.col("n_lines_removed") == 0))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the one with the smallest id; of rows with equal id and text the first by the other columns."""
    docs = docs.select(*COLUMNS)
    scratch = Scratch(spark)
    found = scratch.cut(jaccard.join(spark, docs, words=5, percent=80))
    named = found.where(F.col("class").isNotNull() & (F.col("doc_id") == F.col("component_id")))
    first = named.groupBy("component").agg(F.min(F.struct("doc_id", "h")).alias("x")).select(F.col("x.doc_id").alias("__k"), F.col("x.h").alias("__h"))
    alone = found.where(F.col("class").isNull() | F.col("component_id").isNull()).select(F.col("doc_id").alias("__k"), F.col("h").alias("__h"))
    keep = scratch.cut(first.unionByName(alone).distinct())
    on = F.col("doc_id").eqNullSafe(F.col("__k")) & F.xxhash64("text").eqNullSafe(F.col("__h"))
    kept = docs.join(keep, on, "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("x"))
    return kept.select("doc_id", "text", "x.*").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to weights 5, 2, 1, ...: documents as far as taken, once more where taken twice."""
    out = mixing.Mix(spark, docs, keep=COLUMNS).texts()
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: every piece and its place."""
    import public_tokenizers

    cut = Scratch(spark).cut(packing.pieces(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json")).drop("ids"))
    return packing.pack(spark, cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: Hashing, alignment and tokenisation have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is stored and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.cut(docs)
    return docs
