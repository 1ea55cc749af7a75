"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in parallel (each task adds up one row of fixed size per language and emits its cells
that are not 0). The matrix of log probabilities, ``buckets`` by languages, is broadcast in blocks of LANGS_AT_ONCE
languages, so its size has a bound whatever number of languages the labels name; with more than one block, documents
pass through one after another and keep the best so far. Scoring looks up all n-grams of a batch of texts at once and
adds the rows up per text in numpy; a long text is counted in parts first.

Training reads at most about ``sample`` labelled rows of each language (a documented bound): beyond it, rows are drawn by
a hash of their id, the same ones in every run. Scoring reads every row and whole texts. Functions and models travel by
value or as broadcasts, but their classes do not: executors need this package.

Defined cases: a null text, or one without a letter, gives ``und`` with score 0. Without labelled rows everything is
``und``; a language whose labelled texts are all empty is not learned. Other columns, whatever their names, pass through
untouched. Repeated rows are scored alike; a null id is never held out. Ties between languages go to the first by name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, slices

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
#: Labelled rows of a language that training reads, about.
SAMPLE = 5_000
#: Languages in one broadcast (128 KB each).
LANGS_AT_ONCE = 256
#: Posteriors of long texts are 0 or 1 almost always; the evidence of at most so many n-grams is counted in full.
EVIDENCE = 200.0
#: Cells of looked-up rows, and characters of a text, that are worked on at once.
CELLS, PART = 1 << 22, 1 << 20
_BLANK = re.compile(r"\s")
_MULT = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def _bucket_ids(codes: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Buckets of the n-grams that start at each place of ``codes`` (uint32 code points)."""
    n = len(codes) - order + 1
    h = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
    for k in range(order):
        h ^= codes[k : k + n] * _MULT[k % 3]
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
    return (h & np.uint32(buckets - 1)).astype(np.int32)


def _points(text: str, orders: tuple[int, ...], part: int = PART) -> Iterator[tuple[np.ndarray, int]]:
    """(code points, how many of them the part before ends with) of a text's parts, lower-cased between two spaces; white space is one space."""
    keep, pos, gap, said = max(orders) - 1, 0, True, False
    before = np.zeros(0, np.uint32)
    while True:
        end = len(text)
        if pos + part < end:
            blank = _BLANK.search(text, pos + part, pos + 2 * part)
            end = blank.start() if blank else pos + part
        piece = text[pos:end]
        words = " ".join(piece.lower().split())
        if words:
            own = (" " if gap or piece[0].isspace() else "") + words
            gap, said = piece[-1].isspace(), True
        else:
            own, gap = "", gap or bool(piece)
        if end == len(text):
            own += " " if said else "  "
        codes = np.concatenate([before, np.frombuffer(own.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)])
        yield codes, len(before)
        before, pos = codes[len(codes) - min(keep, len(codes)) :], end
        if end == len(text):
            return


def _counts(text: str, orders: tuple[int, ...], buckets: int) -> np.ndarray:
    """How often each bucket's n-grams are in a text."""
    out = np.zeros(buckets, dtype=np.int64)
    for codes, old in _points(text, orders):
        for order in orders:
            own = codes[max(0, old - order + 1) :]
            if len(own) >= order:
                out += np.bincount(_bucket_ids(own, order, buckets), minlength=buckets)
    return out


def _train(buckets: int, orders: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for lang, own in sums.items():
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])], ["lang", "bucket", "n"])
            sums.clear()

        for batch in slices(batches):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in sums and len(sums) >= LANGS_AT_ONCE:
                    yield from emit()
                own = _counts(text, orders, buckets)
                sums[lang] = sums[lang] + own if lang in sums else own
        yield from emit()

    return run


class Model:
    """langs in order of name, weights (buckets x langs float32), prior (float64)."""

    def __init__(self, langs: list[str], weights: np.ndarray, prior: np.ndarray, orders: tuple[int, ...]):
        self.langs, self.weights, self.prior, self.orders = langs, weights, prior, orders

    def long(self, text: str) -> tuple[np.ndarray, int]:
        """Log likelihoods of one text, and its n-grams, from counts."""
        counts = _counts(text, self.orders, len(self.weights))
        out = np.zeros(len(self.langs))
        for lo in range(0, len(counts), 4096):
            out += counts[lo : lo + 4096] @ self.weights[lo : lo + 4096].astype(np.float64)
        return out, int(counts.sum())

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log joint probabilities (texts x langs) and the number of n-grams of each text."""
        buckets = len(self.weights)
        out, count = np.tile(self.prior, (len(texts), 1)), np.zeros(len(texts))
        held: list[np.ndarray] = []
        owner: list[int] = []
        most = max(1, CELLS // max(1, len(self.langs)))

        def flush() -> None:
            codes = np.concatenate(held)
            sizes = np.array([len(x) for x in held])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            for order in self.orders:
                ids = _bucket_ids(codes, order, buckets)
                # n-grams that reach into the next text belong to none
                owner_end = starts + np.maximum(sizes - order + 1, 0)
                rows = self.weights[ids]
                edges = np.minimum(np.stack([starts, owner_end], 1).ravel(), len(ids))
                padded = np.concatenate([rows, np.zeros((1, rows.shape[1]), rows.dtype)])
                part = np.add.reduceat(padded, edges, axis=0)[::2].astype(np.float64)
                part[owner_end == starts] = 0
                out[owner] += part
                count[owner] += owner_end - starts
            held.clear()
            owner.clear()

        size = 0
        for i, text in enumerate(texts):
            if len(text) >= min(buckets, most):
                got, count[i] = self.long(text)
                out[i] += got
                continue
            codes = next(_points(text, self.orders))[0]
            held.append(codes)
            owner.append(i)
            size += len(codes)
            if size >= most:
                flush()
                size = 0
        if held:
            flush()
        return out, count

    def predict(self, texts: list[str | None], best: list[str | None], top: list[float | None], mass: list[float | None]) -> tuple[list, list, list]:
        """(language, its log joint, the sum of all languages' weights against it) per text, after those of other languages."""
        best, top, mass = list(best), list(top), list(mass)
        at = [i for i, x in enumerate(texts) if x and any(map(str.isalpha, x))]
        if not at or not self.langs:
            return best, top, mass
        joint, count = self.scores([texts[i] for i in at])
        first = joint.argmax(1)
        for i, b, row, n in zip(at, first, joint, count, strict=True):
            scale, high = min(1.0, EVIDENCE / max(n, 1)), float(row[b])
            own = float(np.exp((row - high) * scale).sum())
            if best[i] is None or high > top[i]:
                old = 0.0 if best[i] is None else mass[i] * float(np.exp((top[i] - high) * scale))
                best[i], top[i], mass[i] = self.langs[b], high, own + old
            else:
                mass[i] += own * float(np.exp((high - top[i]) * scale))
        return best, top, mass


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", *, sample: int = SAMPLE, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS, alpha: float = 0.5, at_once: int = LANGS_AT_ONCE) -> Iterator[Model]:
    """Learns from the rows of ``labelled`` whose text and language are not null: a model of each block of languages, one at a time."""
    scratch = Scratch(labelled.sparkSession)
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("l"), F.pmod(F.xxhash64(F.lit("langid"), F.col(key)), F.lit(1 << 20)).alias("draw"))
    per = scratch.cut(rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")))
    drawn = rows.join(per, "l").where(F.col("draw") < F.lit(sample) / F.col("n") * (1 << 20)).select("t", "l")
    cells = scratch.cut(drawn.mapInArrow(_train(buckets, orders), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    known = per.join(cells.select("lang").distinct(), F.col("l") == F.col("lang"))
    total = known.agg(F.sum("n")).first()[0] or 0
    last = None
    while total:
        block = known.select("lang", per["n"]).where(F.lit(True) if last is None else F.col("lang") > F.lit(last)).orderBy("lang").limit(at_once).collect()
        if not block:
            break
        langs, last = [r["lang"] for r in block], block[-1]["lang"]
        own = cells.where(F.col("lang").between(langs[0], last)).toPandas()
        counts = np.zeros((buckets, len(langs)))
        counts[own["bucket"].to_numpy(), own["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=int)] = own["n"].to_numpy()
        weights = np.log((counts + alpha) / (counts.sum(0) + alpha * buckets)).astype(np.float32)
        yield Model(langs, weights, np.log(np.array([r["n"] for r in block], dtype=float) / total), orders)


def predict(spark: SparkSession, docs: DataFrame, models: Iterable[Model], text: str = "text", *, prefix: str = "lang") -> DataFrame:
    """``docs`` with columns <prefix>_pred and <prefix>_score added (replacing columns of those names)."""
    names = (f"{prefix}_pred", f"{prefix}_score")
    rest = [c for c in docs.columns if c not in names]
    at = rest.index(text)
    state = ("__best", "__top", "__mass")
    kinds = (T.StringType(), T.DoubleType(), T.DoubleType())
    rows = docs.select(*[F.col(f"`{c}`") for c in rest], *[F.lit(None).cast(k).alias(c) for c, k in zip(state, kinds, strict=True)])
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in rest]).schema.fields, *(T.StructField(c, k) for c, k in zip(state, kinds, strict=True))])

    def step(shared) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for batch in slices(batches):
                got = m.predict(batch.column(at).to_pylist(), *(batch.column(len(rest) + i).to_pylist() for i in range(3)))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], *(pa.array(v, t) for v, t in zip(got, (pa.string(), pa.float64(), pa.float64()), strict=True))], [*rest, *state])

        return run

    models = iter(models)
    now = next(models, None)
    while now is not None:
        rows = rows.mapInArrow(step(spark.sparkContext.broadcast(now)), schema)
        now = next(models, None)
        if now is not None:  # a worker holds one block of languages at a time
            rows = Scratch(spark).cut(rows)
    return rows.select(*[F.col(f"`{c}`") for c in rest], F.coalesce("__best", F.lit("und")).alias(names[0]), F.coalesce(1 / F.col("__mass"), F.lit(0.0)).alias(names[1]))


def fold(key: str, n: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo n."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(n))


def identify(spark: SparkSession, docs: DataFrame, *, folds: int = 5, held: int = 0, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learns from all folds but ``held`` and predicts every row: doc_id, held_out, lang_pred, score."""
    docs = docs.select(key, text, lang)
    model = fit(docs.where(fold(key, folds) != held), text, lang, key)
    slim = docs.select(key, F.coalesce(fold(key, folds) == held, F.lit(False)).alias("held_out"), text)
    return predict(spark, slim, model, text).select(key, "held_out", "lang_pred", F.col("lang_score").alias("score"))
