"""Quality rules with risk-controlled thresholds.

Base features come from whole texts. Rule scores (larger is worse) are put on a fixed grid. Labelled documents are split
in two by a hash of their id. The first half proposes, per stratum, a sequence of threshold vectors, one cutoff per rule,
from lax to strict: at each level a rule has the cutoff that rejects the most bad documents net of ``price`` times the good
ones, while it loses at most that level's share of good documents; cutoffs only tighten along the sequence. The second
half, held out, tests the vectors in that order. A vector passes if an exact (Clopper-Pearson) upper bound on the share
of good documents that it rejects, by any of its rules, is at most ``risk``; the first one that fails ends the sequence, so the tests
within a stratum need no further correction, and the error is shared among strata (Bonferroni). So with probability
``confidence`` no stratum loses more than ``risk`` of its good documents to all learned rules together. Of the vectors
that pass, the one with the best net catch is taken. Where the labels do not suffice, or nothing is gained, no learned
rule is on in that stratum.

What is learned from is one row per stratum, rule and cell, or per stratum and level, whatever the input's size; a
document's own features never leave its row. Defined cases: a null or blank text has features 0 and fails the base rules; a
null stratum is a stratum of its own, apart from an empty one; labels other than 0 and 1, null ids and ids without a document
are ignored; of repeated labels the worst counts; repeated rows are judged alike. Without labels no learned rule is on. Very
long texts are measured whole. Only key, text and stratum are read of the input, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

RISK = 0.03
PRICE = 2
CONFIDENCE = 0.95
#: Cells of the grid on which rule scores, shares from 0 to 1, are rounded down.
GRID = 200
#: Levels of the sequence of threshold vectors: shares of ``risk`` that one rule may lose.
LEVELS = 40
WINDOW = 8
_SYMBOLS = b"#*$%&|<>"


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that occur twice or more in the text, the first included.

    Windows are numbered exactly, by doubling: equal pairs of numbers get one number.
    """
    n = len(words)
    if n <= window:
        return 0
    ids = np.fromiter(map(_Ids().__getitem__, words), np.int64, n)
    have, at = 1, ids
    while have < window:
        step = min(have, window - have)
        pair = at[: len(at) - step] * (int(at.max()) + 1) + at[step:]
        at = np.unique(pair, return_inverse=True)[1]
        have += step
    hit = np.bincount(at)[at] > 1
    if not hit.any():
        return 0
    cover = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover[:n]) > 0).sum())


def _measure(text: str | None) -> tuple[int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper."""
    if not text:
        return (0,) * 7
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    # continuation bytes (0x80-0xBF) are no code points of their own
    joined = b"".join(words)
    chars = len(joined) - len(joined.translate(None, _LEADS)) if not joined.isascii() else len(joined)
    symbols = len(joined) - len(joined.translate(None, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split()]
    dup = len(lines) - len(set(lines))
    upper = len(joined) - len(joined.translate(None, _UPPER))
    return len(words), chars, symbols, dup, repeated_words(words), len(lines), upper


_LEADS = bytes(b for b in range(256) if not 0x80 <= b < 0xC0)
_UPPER = bytes(range(65, 91))
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def features(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and FEATURES (long) of every row."""
    slim = docs.select(F.col(text).cast("string").alias("__text"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = np.array([_measure(x) for x in batch.column(0).to_pylist()], dtype=np.int64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(got[:, i]) for i in range(len(FEATURES)))], [*keep, *FEATURES])

    return slim.mapInArrow(run, T.StructType([*slim.schema.fields[1:], *(T.StructField(f, T.LongType()) for f in FEATURES)]))


def share(part: str, whole: str) -> Column:
    """part / whole from 0 to 1, 0 where whole is 0."""
    return F.least(F.lit(1.0), F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0))


def rules() -> dict[str, Column]:
    """The learned rules: each a share from 0 to 1, larger is worse."""
    return {
        "symbols": share("n_symbols", "word_chars"),
        "upper": share("n_upper", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "short_words": F.greatest(F.lit(0.0), 1.0 - F.coalesce(F.try_divide(F.col("word_chars"), 20.0 * F.col("n_words")), F.lit(1.0))),
        "long_words": F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("word_chars"), 40.0 * F.col("n_words")), F.lit(0.0))),
    }


def most_rejects(n: int, risk: float, delta: float, step: int = 1 << 20) -> int:
    """The largest k with P(X <= k) <= ``delta`` for a binomial of n trials at ``risk``; -1 if there is none."""
    if n <= 0 or not 0 < risk < 1:
        return -1
    odds, goal = math.log(risk) - math.log1p(-risk), math.log(delta)
    term, total, k = n * math.log1p(-risk), -math.inf, -1
    while k < n:
        i = np.arange(k + 1, min(k + 1 + step, n + 1), dtype=np.float64)
        ratio = np.log(n - i + 1, where=i > 0, out=np.zeros_like(i)) - np.log(i, where=i > 0, out=np.zeros_like(i)) + odds * (i > 0)
        terms = term + np.cumsum(ratio)
        sums = np.logaddexp(total, np.logaddexp.accumulate(terms))
        over = np.flatnonzero(sums > goal)
        if len(over):
            return k + int(over[0])
        term, total, k = float(terms[-1]), float(sums[-1]), int(i[-1])
    return n


def rejects_at_most(k: int, n: int, risk: float, delta: float) -> bool:
    """Whether, with k of n good documents rejected, the exact upper bound at level ``delta`` is at most ``risk``.

    The Clopper-Pearson bound is at most ``risk`` just when P(X <= k | risk) is at most ``delta``.
    """
    return k <= most_rejects(n, risk, delta)


def cutoffs(good: np.ndarray, bad: np.ndarray, levels: np.ndarray, price: float = PRICE) -> np.ndarray:
    """For each level, the cell from which on a rule rejects, ``len(good)`` if it is off; ``good``, ``bad``: documents by cell."""
    n = len(good)
    lost, caught = np.cumsum(good[::-1])[::-1], np.cumsum(bad[::-1])[::-1]
    out = np.full(len(levels), n, dtype=np.int64)
    best, most, cell = n, 0.0, n
    for k, level in enumerate(levels):
        while cell > 1 and lost[cell - 1] <= level * good.sum():
            cell -= 1
            if caught[cell] - price * lost[cell] > most:
                best, most = cell, caught[cell] - price * lost[cell]
        out[k] = best
    return out


def choose(good: np.ndarray, bad: np.ndarray, risk: float, delta: float, price: float = PRICE) -> int | None:
    """The level to use, from held-out documents by the first level that rejects them (the last entry: none does)."""
    limit, best, most = most_rejects(int(good.sum()), risk, delta), None, 0.0
    for level, (lost, caught) in enumerate(zip(np.cumsum(good[:-1]), np.cumsum(bad[:-1]), strict=True)):
        if lost > limit:
            break
        if caught - price * lost > most:
            best, most = level, caught - price * lost
    return best


def _stratum(column: str) -> Column:
    """The stratum's name; null has one that no text has."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def calibrate(scored: DataFrame, labels: DataFrame, names: list[str], *, stratum: str, key: str = "doc_id", quality: str = "quality", risk: float = RISK, confidence: float = CONFIDENCE, grid: int = GRID, scratch=None) -> DataFrame:
    """(stratum, cuts): the cutoff cells, in the order of ``names``, of strata in which they are on. ``scored`` has cells named as the rules."""
    cut = scratch.cut if scratch else lambda df: df
    lab = labels.where(F.col(quality).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.min(quality).alias("__q"))
    rows = scored.join(lab, key).select(_stratum(stratum).alias("stratum"), F.col("__q").cast("long").alias("good"), F.pmod(F.xxhash64(F.lit("half"), key), F.lit(2)).alias("half"), F.array(*names).alias("cells"))
    rows = cut(rows)
    levels = risk * np.arange(LEVELS + 1) / LEVELS
    n_rules = len(names)
    hist = rows.where("half = 0").select("stratum", "good", F.posexplode("cells").alias("rule", "cell")).groupBy("stratum", "rule", "cell").agg(F.sum("good").alias("good"), F.count(F.lit(1)).alias("n"))

    def propose(t: pd.DataFrame) -> pd.DataFrame:
        good, n = np.zeros((2, n_rules, grid + 1), np.int64)
        at = (t["rule"].to_numpy(), t["cell"].to_numpy())
        np.add.at(good, at, t["good"].to_numpy())
        np.add.at(n, at, t["n"].to_numpy())
        return pd.DataFrame({"stratum": [t["stratum"].iloc[0]], "path": [[cutoffs(good[r], n[r] - good[r], levels).tolist() for r in range(n_rules)]]})

    paths = cut(hist.groupBy("stratum").applyInPandas(propose, "stratum string, path array<array<int>>"))
    delta = (1 - confidence) / max(1, paths.count())  # the tests share the error among all strata

    def first(r: int) -> Column:
        """The first level at which rule r rejects: cutoffs only fall along the path."""
        return F.size(F.filter(F.col("path")[r], lambda c: c > F.col("cells")[r]))

    held = rows.where("half = 1").join(paths, "stratum").select("stratum", "good", F.least(*map(first, range(n_rules)), F.lit(LEVELS + 1)).alias("level"))
    held = held.groupBy("stratum", "level").agg(F.sum("good").alias("good"), F.count(F.lit(1)).alias("n"))

    def test(t: pd.DataFrame) -> pd.DataFrame:
        good, n = np.zeros((2, LEVELS + 2), np.int64)
        np.add.at(good, t["level"].to_numpy(), t["good"].to_numpy())
        np.add.at(n, t["level"].to_numpy(), t["n"].to_numpy())
        level = choose(good, n - good, risk, delta)
        return pd.DataFrame({"stratum": [t["stratum"].iloc[0]], "level": [level]}).dropna().astype({"level": "int32"})

    taken = held.groupBy("stratum").applyInPandas(test, "stratum string, level int")
    return paths.join(taken, "stratum").select("stratum", F.transform("path", lambda c: c[F.col("level")]).alias("cuts"))


def assess(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", stratum: str = "lang", risk: float = RISK, confidence: float = CONFIDENCE, scratch=None) -> DataFrame:
    """key, FEATURES, base_failed, rejected_by (array of rule names), kept for every row of ``docs``."""
    all_rules = rules()
    rows = features(docs, text, (key, stratum))
    rows = rows.select("*", *[F.floor(F.least(F.lit(1.0), v) * GRID).cast("int").alias(f"r_{k}") for k, v in all_rules.items()])
    rows = scratch.cut(rows) if scratch else rows
    names = [f"r_{k}" for k in all_rules]
    cuts = calibrate(rows, labels, names, stratum=stratum, key=key, risk=risk, confidence=confidence, scratch=scratch)
    cuts = cuts.select(F.col("stratum").alias("__s"), F.col("cuts").alias("__cuts"))
    cuts = scratch.cut(cuts) if scratch else cuts  # its size is known then: small tables are broadcast, large ones not
    joined = rows.join(cuts, _stratum(stratum) == F.col("__s"), "left")
    by = F.filter(F.array(*[F.when(F.col(n) >= F.col("__cuts")[i], F.lit(n[2:])) for i, n in enumerate(names)]), lambda x: x.isNotNull())
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return joined.select(key, *FEATURES, failed.alias("base_failed"), by.alias("rejected_by"), (~failed & (F.size(by) == 0)).alias("kept"))
