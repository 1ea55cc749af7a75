"""Language-model scores from a probabilistic suffix tree, with a unigram base score beside them.

A text is its words, lower-cased in A-Z, joined by single blanks and closed by an end symbol; the tree's symbols are the
bytes of that. Training counts every run of ``depth`` + 1 symbols of the whole training texts. A context of up to
``depth`` symbols becomes a candidate when it occurs at least ``root`` times the square root of all positions: the more
text, the rarer (as a share) and the more numerous are the contexts that are tested, and the tree grows with the corpus,
about as its square root. A candidate stays in the tree if its next-symbol distribution diverges from that of its longest
proper suffix: its count times the Kullback-Leibler divergence exceeds ``gain``, the cost of one more state. Suffixes of
states are states. Distributions are smoothed by interpolation with the suffix (Witten-Bell), the root with the uniform
one, so every text has a probability. Scoring uses the longest suffix that is a state.

The tree is grown level by level in joins and stored as a table. In the order of their reversed contexts, states below
one state stand together, so the tree is cut into ranges of about AT_ONCE states (a shard: at most 2 KiB a state, 0.7 KiB
for a common alphabet) that each hold, with the states above their first one, all that a position in the range needs.
Shards are broadcast one after another and score the positions in their range; a document's score is the sum. So neither
the driver nor a worker ever holds more than one shard, however large the tree; up to AT_ONCE states there is one pass.

The unigram base needs the counts of all training words. The ``common`` most frequent ones (a bound on what is
broadcast: 16 bytes a word) are looked up in place; all others go through a join on the word's 64-bit hash, so every
count is exact up to hash collisions, at about one in 10^6 for ten million words. Classes of this module do not travel by
value: executors need this package.

Defined cases: a null, empty or blank text is only the end token; without training rows all counts are 0; repeated rows
are scored alike and count in training as often as they are there; a null id is never held out. Very long texts are
worked on in parts. Other columns pass through, but for those that are added, which are replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, per_process, slices
from .langid import fold

DEPTH = 5
ROOT = 0.25
GAIN = 6.0
#: States that are broadcast at once, about.
AT_ONCE = 1 << 16
COMMON = 1 << 19
END, START = 0x0A, 0x09  # bytes that no word holds
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: The end token's place among word hashes.
END_HASH = -(2**63)
#: Symbols that are worked on at once; runs that a task counts before it hands its counts on (words: a quarter of that).
CHUNK, FLUSH = 1 << 20, 1 << 20


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, lower-cased in A-Z."""
    return text.encode("utf-8", "surrogatepass").translate(_UPPER).split() if text else []


def _hash(word: bytes) -> int:
    import xxhash

    return max(xxhash.xxh64_intdigest(word) - 2**63, END_HASH + 1)


def runs(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The runs of depth + 1 symbols that end at each place from ``depth`` on, as numbers."""
    code = np.zeros(len(symbols) - depth, dtype=np.int64)
    for k in range(depth + 1):
        code <<= 8
        code |= symbols[k : len(symbols) - depth + k]
    return code


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


def _count(depth: int):
    """(kind, key, n): counts of word hashes (kind 0) and of symbol runs (kind 1) of a task's texts."""
    pad = bytes([START] * depth)

    def out(kind: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(keys), 1 << 16):
            k = keys[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(n[i : i + (1 << 16)])], ["kind", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        docs, held, size = 0, [], 0
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def take() -> None:
            nonlocal size
            symbols = np.frombuffer(b"".join(held), dtype=np.uint8)
            for lo in range(0, len(symbols) - depth, 4 * CHUNK):
                code = runs(symbols[lo : lo + 4 * CHUNK + depth], depth)
                code = code[(code & 0xFF) != START]  # runs that end in padding
                parts.append(np.unique(code, return_counts=True))
            held.clear()
            size = 0

        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                own = tokens(text)
                words.update(own)
                docs += 1
                held += [pad, b" ".join(own), b"\n"]
                size += sum(map(len, held[-2:]))
                if size >= CHUNK:
                    take()
                    if sum(len(p[0]) for p in parts) > 3 * FLUSH:
                        parts[:] = [_merge(parts)]
                        if len(parts[0][0]) > 1.5 * FLUSH:
                            yield from out(1, *parts.pop())
            if len(words) > FLUSH // 4:
                yield from out(0, np.fromiter(map(_hash, words), np.int64, len(words)), np.fromiter(words.values(), np.int64, len(words)))
                words.clear()
        if held:
            take()
        if parts:
            yield from out(1, *_merge(parts))
        if words:
            yield from out(0, np.fromiter(map(_hash, words), np.int64, len(words)), np.fromiter(words.values(), np.int64, len(words)))
        if docs:
            yield from out(0, np.array([END_HASH]), np.array([docs]))

    return run


class SuffixTree:
    """A range of the tree. child[node, symbol]: the state whose context has one symbol more on the left (0: none); logp[node, symbol].

    Node 1 is the root, node 0 stands for no state. ``code`` maps bytes to symbols; the last one stands for all bytes that
    training has not seen. ``lo`` and ``hi`` bound the reversed contexts of the positions in the range.
    """

    def __init__(self, depth: int, code: np.ndarray, child: np.ndarray, logp: np.ndarray, lo: int = 0, hi: int = 1 << 62):
        self.depth, self.code, self.child, self.logp, self.lo, self.hi = depth, code, child, logp, lo, hi
        self.whole = lo <= 0 and hi >= 1 << 8 * depth

    def score(self, symbols: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol from place ``depth`` on, given those before; 0 outside the range."""
        d, n = self.depth, len(symbols) - self.depth
        flat, wide, a = self.child.ravel(), self.code[symbols], self.child.shape[1]
        at = None
        if not self.whole:
            key = np.zeros(n, dtype=np.int64)
            for k in range(1, d + 1):
                key = key << 8 | symbols[d - k : d - k + n]
            at = np.flatnonzero((key >= self.lo) & (key < self.hi)) + d
        node = np.full(n if at is None else len(at), 1, dtype=np.int32)
        best = node.copy()
        for k in range(1, d + 1):
            node = flat[node * a + (wide[d - k : d - k + n] if at is None else wide[at - k])]
            np.copyto(best, node, where=node > 0)
        if at is None:
            return self.logp.ravel()[best * a + wide[d:]]
        out = np.zeros(n, dtype=np.float32)
        out[at - d] = self.logp.ravel()[best * a + wide[at]]
        return out

    def texts(self, texts: list[list[bytes]], most: int = CHUNK) -> np.ndarray:
        """log10 probability of whole texts, given as words, as far as the range goes."""
        out = np.zeros(len(texts))
        pad = bytes([START] * self.depth)
        held: list[bytes] = []
        owner: list[int] = []
        size = 0

        def flush() -> None:
            symbols = np.frombuffer(b"".join(held), dtype=np.uint8)
            p = np.concatenate([np.zeros(self.depth), self.score(symbols)])
            starts = np.concatenate([[0], np.cumsum([len(x) for x in held])[:-1]])
            for k in range(self.depth):  # the symbols before a part belong to the part before it, or are padding
                p[starts + k] = 0
            np.add.at(out, owner, np.add.reduceat(p, starts))
            held.clear()
            owner.clear()

        for i, own in enumerate(texts):
            text = pad + b" ".join(own) + b"\n"
            for lo in range(0, len(text) - self.depth, most):
                held.append(text[lo : lo + most + self.depth])
                owner.append(i)
                size += len(held[-1])
                if size >= most:
                    flush()
                    size = 0
        if held:
            flush()
        return out


def build(states: list[tuple[int, int, float, list[int], list[float]]], depth: int, lo: int = 0, hi: int = 1 << 62) -> SuffixTree:
    """A range of the tree from its states: (length of the context, reversed context, weight of the suffix, next symbols, their probabilities).

    States above others come with them.
    """
    states = sorted(states, key=lambda s: s[:2])
    used = sorted({START}.union(*(s[3] for s in states)))
    code = np.full(256, len(used), dtype=np.int32)
    code[used] = np.arange(len(used))
    a = len(used) + 1
    child, p = np.zeros((len(states) + 2, a), dtype=np.int32), np.full((len(states) + 2, a), 1 / 256, dtype=np.float32)
    node_of: dict[tuple[int, int], int] = {}
    for node, (d, key, weight, nexts, probs) in enumerate(states, 1):
        if d:
            low = 8 * (depth - d)
            above = node_of[d - 1, key >> low + 8 << low + 8]
            symbol = code[key >> low & 255]
            if symbol < len(used):
                child[above, symbol] = node
            p[node] = p[above]
        node_of[d, key] = node
        p[node] *= weight
        p[node, code[nexts]] = probs
    return SuffixTree(depth, code, child, np.log10(p), lo, hi)


def grow(grams: DataFrame, depth: int, least: float, gain: float, scratch: Scratch) -> DataFrame:
    """(d, key, weight, next, p): the states of the tree. ``grams``: runs of depth + 1 symbols (key) and their counts (n)."""
    levels = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * d) - 1)).alias("ctx")) for d in range(depth + 1)])).alias("x")
    counts = scratch.cut(grams.select(levels, F.col("key").bitwiseAND(F.lit(255)).cast("int").alias("next"), "n").groupBy(F.col("x.d").alias("d"), F.col("x.ctx").alias("ctx"), "next").agg(F.sum("n").alias("n")))
    often = counts.groupBy("d", "ctx").agg(F.sum("n").alias("m"), F.count(F.lit(1)).alias("t")).where(F.col("m") >= F.lit(float(least)))
    cand = scratch.cut(counts.join(often, ["d", "ctx"]))
    scratch.drop(counts)
    made: list[DataFrame] = []
    stays = None
    for d in range(depth + 1):
        rows = cand.where(F.col("d") == d)
        if d:
            above = made[-1].select(F.col("ctx").alias("up"), "next", F.col("p").alias("above"))
            rows = rows.withColumn("up", F.col("ctx").bitwiseAND(F.lit((1 << 8 * (d - 1)) - 1))).join(above, ["up", "next"])
        else:
            rows = rows.withColumn("above", F.lit(1 / 256))
        rows = rows.withColumn("p", (F.col("n") + F.col("t") * F.col("above")) / (F.col("m") + F.col("t")))
        made.append(scratch.cut(rows.select("d", "ctx", "next", "p", "above", "n", "m", "t")))
        gains = made[-1].groupBy("d", "ctx").agg(F.sum(F.col("n") * F.log(F.col("n") / F.col("m") / F.col("above"))).alias("g"))
        kept = gains.where(F.col("g") > gain) if d else gains
        stays = kept.select("d", "ctx") if stays is None else stays.unionByName(kept.select("d", "ctx"))
    suffixes = F.transform(F.sequence(F.lit(0), F.col("d")), lambda k: F.struct(k.alias("d"), F.col("ctx").bitwiseAND(F.pow(F.lit(256.0), k).cast("long") - 1).alias("ctx")))
    states = stays.select(F.explode(suffixes).alias("x")).select("x.d", "x.ctx").distinct()
    all_rows = made[0]
    for m in made[1:]:
        all_rows = all_rows.unionByName(m)
    byte = lambda k: F.shiftleft(F.shiftright("ctx", 8 * k).bitwiseAND(F.lit(255)), 8 * (depth - 1 - k))
    key = sum((F.when(F.col("d") > k, byte(k)).otherwise(F.lit(0)).cast("long") for k in range(1, depth)), F.when(F.col("d") > 0, byte(0)).otherwise(F.lit(0)).cast("long"))
    out = all_rows.join(states, ["d", "ctx"]).groupBy("d", "ctx").agg(F.first(F.col("t") / (F.col("m") + F.col("t"))).alias("weight"), F.collect_list(F.struct("next", "p")).alias("x"))
    out = scratch.cut(out.select("d", key.alias("key"), "weight", F.col("x.next").alias("next"), F.col("x.p").alias("p")))
    scratch.drop(cand, *made)
    return out


def shards(states: DataFrame, depth: int, at_once: int = AT_ONCE) -> Iterator[SuffixTree]:
    """The ranges of a stored tree, one at a time, of about ``at_once`` states (one in 10,000 of all more or less)."""
    count = states.count()
    parts = -(-count // at_once)
    cuts = states.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else []
    edges = [0, *sorted(set(cuts) - {0}), 1 << 62]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        above = [(d, lo >> 8 * (depth - d) << 8 * (depth - d)) for d in range(depth)]
        own = F.col("key").between(lo, hi - 1)
        for d, key in above:
            own = own | ((F.col("d") == d) & (F.col("key") == key))
        rows = states.where(own).toArrow()
        yield build(list(zip(*(rows.column(c).to_pylist() for c in ("d", "key", "weight", "next", "p")), strict=True)), depth, lo, hi)


class Model:
    """A suffix tree as a stored table, and word counts: the common ones as sorted arrays, the others as a stored table (key, n)."""

    def __init__(self, depth: int, states: DataFrame, keys: np.ndarray, n: np.ndarray, rest: DataFrame | None, total: int, distinct: int):
        self.depth, self.states, self.keys, self.n, self.rest, self.total, self.distinct = depth, states, keys, n, rest, total, distinct
        self.log_all = math.log10(total + distinct + 1)


def fit(spark: SparkSession, texts: DataFrame, text: str = "text", *, depth: int = DEPTH, root: float = ROOT, gain: float = GAIN, common: int = COMMON, scratch: Scratch | None = None) -> Model:
    """Learns from all rows of ``texts``."""
    scratch = scratch or Scratch(spark)
    counts = texts.select(F.col(text).cast("string")).mapInArrow(_count(depth), "kind int, key long, n long")
    counts = scratch.cut(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")))
    words, grams = counts.where("kind = 0").select("key", "n"), counts.where("kind = 1")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # the least count that at most ``common`` words reach
    steps = words.where("n > 1").groupBy("n").count().orderBy(F.desc("n"))
    ranked, least_n, seen = steps.toArrow(), 2**62, 0
    for n, k in zip(ranked["n"].to_pylist(), ranked["count"].to_pylist(), strict=True):
        if seen + k > common:
            break
        seen, least_n = seen + k, n
    if distinct <= common:
        least_n = 0
    top = words.where(F.col("n") >= F.lit(int(least_n))).toArrow().sort_by("key")
    rest = words.where(F.col("n") < F.lit(int(least_n)))
    places = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    states = grow(grams.select("key", "n"), depth, root * math.sqrt(places), gain, scratch)
    return Model(depth, states, top["key"].to_numpy(), top["n"].to_numpy(), rest, int(total), int(distinct))


class _Logs(dict):
    """word -> log10(c + 1) of a common word, NaN of another one."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys_, self.logs = keys, np.log10(n + 1.0)

    def __missing__(self, word: bytes) -> float:
        h = _hash(word)
        at = int(np.searchsorted(self.keys_, h))
        value = float(self.logs[at]) if at < len(self.keys_) and self.keys_[at] == h else math.nan
        if len(self) < 200_000:
            self[word] = value
        return value


def score(spark: SparkSession, docs: DataFrame, model: Model, text: str = "text", *, at_once: int = AT_ONCE, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` without ``text``, with n_tokens, n_known, train_tokens, base_score and score added (replacing columns of those names)."""
    scratch = scratch or Scratch(spark)
    rest = [c for c in docs.columns if c not in (text, "n_tokens", "n_known", "train_tokens", "base_score", "score")]
    ranges = shards(model.states, model.depth, at_once)
    first, ahead = next(ranges), next(ranges, None)
    shared = spark.sparkContext.broadcast((first, model.keys, model.n))
    name = f"logs {spark.sparkContext.applicationId} {shared._jbroadcast.id()}" if shared._jbroadcast is not None else "logs"
    slim = docs.select(*[F.col(f"`{c}`") for c in rest], F.monotonically_increasing_id().alias("__row"), F.col(text).cast("string").alias("__text"))
    if ahead is not None:  # several passes need the same row numbers
        slim = scratch.cut(slim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, keys, n = shared.value
        logs = per_process(name, lambda: _Logs(keys, n))
        at = int(np.searchsorted(keys, END_HASH))
        end = float(np.log10(n[at] + 1.0)) if at < len(keys) and keys[at] == END_HASH else math.nan
        for batch in slices(batches):
            texts = [tokens(x) for x in batch.column(len(rest) + 1).to_pylist()]
            size, known, base, tails = [], [], [], []
            for own in texts:
                v = np.fromiter(map(logs.__getitem__, own), np.float64, len(own))
                miss = np.isnan(v)
                lost = np.flatnonzero(miss)
                tail = [_hash(own[i]) for i in lost]
                if math.isnan(end):
                    tail.append(END_HASH)
                size.append(len(own) + 1)
                known.append(len(own) + 1 - len(tail))
                base.append(float(v[~miss].sum()) + (0.0 if math.isnan(end) else end))
                tails.append(tail)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(size, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(tree.texts(texts), pa.float64()), pa.array(tails, pa.list_(pa.int64()))], [*rest, "__row", "n_tokens", "__known", "__base", "__tree", "__tail"])

    schema = T.StructType([*slim.schema.fields[:-1], *T.StructType.fromDDL("n_tokens long, __known long, __base double, __tree double, __tail array<long>").fields])
    rows = scratch.cut(slim.mapInArrow(run, schema))
    more = None if ahead is None else rows.select("__row", F.col("__tree").alias("score"))
    while ahead is not None:
        now = spark.sparkContext.broadcast(ahead)

        def part(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                got = now.value.texts([tokens(x) for x in batch.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], ["__row", "score"])

        more = more.unionByName(scratch.cut(slim.select("__row", "__text").mapInArrow(part, "__row long, score double")))
        now.unpersist()
        ahead = next(ranges, None)
    if more is not None:
        rows = rows.join(more.groupBy("__row").agg(F.sum("score").alias("score")), "__row")
    else:
        rows = rows.withColumnRenamed("__tree", "score")
    tail = rows.where(F.size("__tail") > 0).select("__row", F.explode("__tail").alias("key"))
    found = tail.join(model.rest, "key").groupBy("__row").agg(F.sum(F.log10(F.col("n") + 1)).alias("__more"), F.count(F.lit(1)).alias("__got"))
    out = rows.drop("__tail").join(found, "__row", "left")
    return out.select(
        *[F.col(f"`{c}`") for c in rest],
        "n_tokens",
        (F.col("__known") + F.coalesce("__got", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("__base") + F.coalesce("__more", F.lit(0.0)) - F.col("n_tokens") * F.lit(model.log_all)).alias("base_score"),
        "score",
    )


def score_all(spark: SparkSession, docs: DataFrame, *, key: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2, at_once: int = AT_ONCE, **how) -> DataFrame:
    """Learns from all folds but ``held`` and scores every row."""
    scratch = Scratch(spark)
    docs = docs.select(key, F.coalesce(fold(key, folds) == held, F.lit(False)).alias("held_out"), text)
    model = fit(spark, docs.where("NOT held_out"), text, scratch=scratch, **how)
    return score(spark, docs, model, text, at_once=at_once, scratch=scratch)
