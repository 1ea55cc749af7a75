"""Additive scores, gates and the sequence ratio for matching foreign records to a registry."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from evidlake.functions import text as T

# Registry weights by field.
REGISTRY = {"amm": 100, "nom": 40, "dosage": 20, "forme": 15, "presentation": 10, "nom_generique": 10, "labo": 5}
# Confidence of exact term matches, (generic, brand), by kind of record.
TERM_CONFIDENCE = {"label": (0.72, 0.62), "class": (0.68, 0.58), "approximate": (0.66, 0.55), "properties": (0.64, 0.54), "spl": (0.70, 0.60)}
# Fixed values: (score, shared tokens) that suffice.
ACCEPT = {
    "nom": ((0.97, 0), (0.90, 1), (0.84, 2)),
    "nom_aggressive": ((0.95, 0), (0.84, 1), (0.78, 2), (0.74, 3)),
    "generic": ((0.96, 0), (0.89, 2)),
    "generic_aggressive": ((0.92, 0), (0.84, 1), (0.80, 2)),
}


def registry_keys(df: DataFrame, fields: dict[str, Column], prefix: str) -> DataFrame:
    """``df`` with a comparison key for each registry field (columns <prefix><field>): once a row, before any join."""
    return df.withColumns({f"{prefix}{f}": T.key_text(x) for f, x in fields.items()})


def registry_score(left: str, right: str, fields: Sequence[str]) -> Column:
    """The sum of the weights of the fields whose keys (columns <left><field>, <right><field>) agree and are not empty."""
    terms = [F.when((F.col(left + f) != "") & (F.col(left + f) == F.col(right + f)), w).otherwise(0) for f, w in REGISTRY.items() if f in fields]
    return sum(terms[1:], terms[0])


def resolve_ties(scored: DataFrame, key: str, candidate: str, score: str, tie: Column) -> DataFrame:
    """The single best candidate of each key; of several the only one for which ``tie`` holds; else none.

    Returns key, candidate (null if ambiguous), score and outcome.
    """
    levels = scored.where(F.col(score) > 0).groupBy(key, score).agg(F.count(F.lit(1)).alias("__n"), F.min(candidate).alias("__one"), F.sum(tie.cast("int")).alias("__t"), F.min(F.when(tie, F.col(candidate))).alias("__tied"))
    got = levels.groupBy(key).agg(F.max_by(F.struct(score, "__n", "__one", "__t", "__tied"), score).alias("__x")).select(key, "__x.*")
    outcome = F.when(F.col("__n") == 1, "unique").when(F.col("__t") == 1, "tie_broken").otherwise("ambiguous")
    return got.select(key, F.when(F.col("__n") == 1, F.col("__one")).when(F.col("__t") == 1, F.col("__tied")).alias(candidate), score, outcome.alias("outcome"))


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(DoubleType())
def sequence_ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Ratcliff-Obershelp similarity; run it on blocked candidates only."""
    for a, b in pairs:
        yield pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)], dtype=float)


def letters(c: Column) -> Column:
    """The letters of a text, each with how often it came before: common ones of two texts are the elements that both arrays hold."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    return F.transform(chars, lambda x, i: F.concat(x, F.size(F.filter(F.slice(chars, 1, i), lambda y: y == x)).cast("string")))


def name_pairs(pairs: DataFrame, mode: str, line: str = "line", key: str = "key", line_tokens: str = "lt", key_tokens: str = "kt", line_letters: str = "ll", key_letters: str = "kl") -> DataFrame:
    """``pairs`` with shared (tokens), known (the score where one holds the other) and most: the score that common letters allow.

    Pairs that cannot be acceptable are left out: the matching blocks of two texts hold at most their common letters.
    """
    a, b, ta, tb = F.col(line), F.col(key), F.col(line_tokens), F.col(key_tokens)
    rows = pairs.withColumn("shared", F.size(F.array_intersect(ta, tb)))
    known = F.when((b != "") & F.contains(a, b), 1.0).when((F.length(a) >= 8) & F.contains(b, a), 0.95)
    common = F.size(F.array_intersect(line_letters, key_letters))
    most = _mixed(2.0 * common / F.greatest(F.lit(1), F.length(a) + F.length(b)), ta, tb)
    return rows.withColumn("known", known).withColumn("most", F.coalesce("known", most)).where(acceptable(F.col("most") + 1e-9, F.col("shared"), mode))


def _mixed(r: Column, ta: Column, tb: Column) -> Column:
    return 0.58 * r + 0.27 * F.col("shared") / F.greatest(F.lit(1), F.size(tb)) + 0.15 * F.col("shared") / F.greatest(F.lit(1), F.size(ta))


def name_matches(pairs: DataFrame, mode: str, line: str = "line", key: str = "key", line_tokens: str = "lt", key_tokens: str = "kt", line_letters: str = "ll", key_letters: str = "kl") -> DataFrame:
    """``pairs`` of lines and catalogue names that are acceptable, with score and shared (tokens).

    The sequence ratio runs only where it decides: not where one holds the other, and not where even all common letters would
    not do. ``pairs`` have the letters of both sides (``letters``), made once a name.
    """
    rows = name_pairs(pairs, mode, line, key, line_tokens, key_tokens, line_letters, key_letters)
    direct = rows.where("known IS NOT NULL").withColumn("score", F.col("known"))
    rest = rows.where("known IS NULL").withColumn("score", _mixed(sequence_ratio(F.col(line), F.col(key)), F.col(line_tokens), F.col(key_tokens)))
    return direct.unionByName(rest).where(acceptable(F.col("score"), F.col("shared"), mode)).drop("known", "most")


def acceptable(score: Column, shared: Column, mode: str) -> Column:
    out = F.lit(False)
    for least, need in ACCEPT[mode]:
        out = out | ((score >= least) & (shared >= need))
    return out


def index_lookup(names: DataFrame, index: DataFrame, name_id: str, name: str, key: str) -> DataFrame:
    """(name id, hit): the key that equals a name, else the first key by order that holds all its words of three letters or more.

    Words may be parts of a key's words. A key that holds a word holds the word's first three letters, so keys are looked up
    by triples of letters, of each name those that begin its longest word; no name is compared with all keys.
    """
    words = F.array_distinct(F.filter(F.split(name, " "), lambda w: F.length(w) > 2))
    rows = names.select(name_id, F.col(name).alias("__name"), words.alias("__w")).withColumn("__t", F.left(F.array_max(F.transform("__w", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"], F.lit(3)))
    keys = index.select(F.col(key).alias("__key")).distinct()
    triples = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("__key") - 2)), lambda i: F.substr("__key", i, F.lit(3))))
    met = rows.join(keys.select("__key", F.explode(triples).alias("__t")), "__t").where(F.forall("__w", lambda w: F.contains("__key", w)))
    same = rows.join(keys, F.col("__name") == F.col("__key"))
    both = met.select(name_id, F.lit(1).alias("o"), "__key").unionByName(same.select(name_id, F.lit(0).alias("o"), "__key"))
    hit = both.groupBy(name_id).agg(F.min(F.struct("o", "__key")).alias("__x"))
    return names.select(name_id).join(hit, name_id, "left").select(name_id, F.col("__x.__key").alias("hit"))
