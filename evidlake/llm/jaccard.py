"""Exact n-gram Jaccard join by token-combination prefixes.

A document's tokens are the 64-bit hashes of its distinct word n-grams, in the order of the hashes, which is the same for
all documents and as good as random. A pair that reaches the threshold shares at least ``L`` tokens within extended
prefixes (windows); ``L`` follows from the two sizes. Tokens of windows fall into two classes by the number of windows
that hold them:

* Rare tokens (up to RARE windows) are indexed singly. Pairs that meet are counted, and kept only if the rare tokens
  they share could make up ``L`` together with all frequent tokens of the poorer of the two.
* Frequent tokens are indexed as combinations of two that follow each other among the frequent tokens of a window, in
  documents of every length. Windows are so long that this misses no pair: of two similar documents without a shared rare
  token, the shared tokens of the windows outnumber the places where one of the two has a token of its own in between, so
  two shared tokens follow each other in both. A document has fewer combinations than tokens in its window (0.2 of its
  set at 90 %, 0.4 at 80 %). Only documents whose windows hold ``L`` frequent tokens need them. (Below about 60 %, sets of a
  few tokens are too small for the argument; they and what may be similar to them are indexed by single tokens as well.)

Candidates are verified exactly on the full sets. The documents of a combination are not compared in pairs: first all with
its smallest one, then, while that makes headway, all that are not yet connected with another one of theirs, drawn at
random. In a group of near copies nearly all are connected by then, at a cost in proportion to the group. What is left of
a combination that still holds several components is compared in full, in cells of bounded size, but within no component
and not within the largest at all. Of the links found there only a spanning forest leaves a cell. Components of all
verified links are the result.

Documents with equal token sets are one from the start. No pair of different texts is dropped: every bound is exact
(but for collisions of 64-bit hashes, about n^2 / 2^64 for a pair).

Defined cases: a text with fewer words than an n-gram has its whole word sequence as one token; null and blank texts have
none and link with nothing; rows are nodes, so rows with one id but different texts are apart unless they link; a null id takes
part in links but is never a component's name; rows without any id in reach have a null component. Very long texts are
taken whole. Only the key and the text are read, so other columns may have any name; they are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, connected_components, forest, groups, per_process, slices

#: Windows that hold a rare token at most. It bounds the pairs that a token makes, so it does not follow the table.
RARE = 24
#: Rounds in which the documents of a combination are compared with one of them; further ones are left out when a round
#: leaves more than half of the open ones open.
ROUNDS = 4
CELL, CELL_TOKENS = 256, 400_000
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_M = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh64_intdigest(word)
        if len(self) < 200_000:
            self[word] = h
        return h


def shingles(text: str | None, words: int, cache: dict) -> np.ndarray:
    """The distinct hashes of a text's word n-grams, sorted."""
    own = text.encode("utf-8", "surrogatepass").translate(_UPPER).split() if text else []
    if not own:
        return np.zeros(0, dtype=np.int64)
    h = np.fromiter(map(cache.__getitem__, own), np.uint64, len(own))
    k = min(words, len(own))
    code = np.full(len(own) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        code = (code ^ h[i : len(h) - k + 1 + i]) * _M[0]
        code ^= code >> np.uint64(29)
        code *= _M[1]
        code ^= code >> np.uint64(32)
    return np.unique(code.view(np.int64))


def overlap(a: int | np.ndarray, b: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Shared tokens that sets of a and b tokens need at least."""
    return -(-percent * (a + b) // (100 + percent))


def _partners(n: int, percent: int) -> np.ndarray:
    """The sizes of sets that can be similar to one of n tokens."""
    return np.arange(-(-percent * n // 100), 100 * n // percent + 1)


def window(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Tokens in the window of a set of n: two, and as many as it may have of its own, twice, and its partner once."""

    def own(other: int | np.ndarray) -> int | np.ndarray:
        return 2 * n + other - 3 * percent * (n + other) // (100 + percent)

    return np.minimum(n, 2 + np.maximum(own(-(-percent * n // 100)), own(100 * n // percent)))


def least_shared(n: int, percent: int) -> int:
    """The least ``L`` of a set of n tokens with any set that can be similar to it."""
    other = _partners(n, percent)
    return int((np.minimum(window(n, percent) - n, window(other, percent) - other) + overlap(n, other, percent)).min())


def adjacent(n: int, other: int | np.ndarray, percent: int) -> int | np.ndarray:
    """Pairs of shared tokens that follow each other in both windows, at least, if sets of these sizes are similar."""
    o = overlap(n, other, percent)
    return np.minimum(window(n, percent) - n, window(other, percent) - other) + o - 1 - (n - o) - (other - o)


def needs_single(n: int, percent: int) -> bool:
    """Whether a similar but different set may share no combination with one of n tokens."""
    other = _partners(n, percent)
    return bool(((adjacent(n, other, percent) < 1) & ((other != n) | (overlap(n, other, percent) < n))).any())


def _signatures(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        cache = per_process("shingle words", _Hashes)
        least: dict[int, int] = {0: 0}
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        for batch in slices(batches):
            cols: tuple[list, ...] = ([], [], [], [], [])
            for text in batch.column(2).to_pylist():
                s = shingles(text, words, cache)
                n = len(s)
                if n not in least:
                    least[n] = least_shared(n, percent)
                d = xxhash.xxh128_intdigest(s.tobytes())
                for c, v in zip(cols, (n, least[n], (d >> 64) - 2**63, (d & (2**64 - 1)) - 2**63, s[: window(n, percent)]), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], ["doc", "h", "n", "least", "d1", "d2", "win"])

    return run


def combination_keys(tokens: np.ndarray, least: int, single: bool) -> np.ndarray:
    """Index keys of a document's frequent window tokens (sorted)."""
    t = tokens.view(np.uint64)
    out = [((t[:-1] * _M[0] ^ t[1:]) * _M[2]).view(np.int64)]
    if single:
        out.append(tokens[: len(tokens) - least + 1])
    return np.unique(np.concatenate(out))


def _combine(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single: dict[int, bool] = {}
        for batch in slices(batches):
            for cid, n, least, toks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if n not in single:
                    single[n] = needs_single(n, percent)
                keys = combination_keys(np.array(sorted(toks), dtype=np.int64), least, single[n])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), cid, np.int64)), pa.array(np.full(len(keys), n, np.int32))], ["key", "cid", "n"])

    return run


def similar(sets: list[np.ndarray], percent: int, left: np.ndarray, right: np.ndarray, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i in ``left`` and j in ``right``, of sets that reach the threshold."""
    sizes = np.array([len(s) for s in sets])
    if not len(left) or not len(right):
        return np.zeros(0, int), np.zeros(0, int)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.r_[True, flat[1:] != flat[:-1]]
    token = np.cumsum(first) - 1
    often = np.bincount(token)[token] > 1
    token, owner = token[often], owner[often]
    token = np.cumsum(np.r_[False, token[1:] != token[:-1]]) if len(token) else token
    vocab = int(token[-1]) + 1 if len(token) else 0
    place = np.full(len(sets), -1)
    place[left] = np.arange(len(left))
    place_r = np.full(len(sets), -1)
    place_r[right] = np.arange(len(right))
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    for lo in range(0, vocab, step):  # tokens are sorted, so a slice of the vocabulary is a slice of the rows
        a, b = np.searchsorted(token, [lo, lo + step])
        t, o = token[a:b] - lo, owner[a:b]
        x = np.zeros((len(left), step), dtype=np.float32)
        y = np.zeros((len(right), step), dtype=np.float32)
        m = place[o] >= 0
        x[place[o[m]], t[m]] = 1
        m = place_r[o] >= 0
        y[place_r[o[m]], t[m]] = 1
        shared += x @ y.T
    shared = np.rint(shared).astype(np.int64)
    union = sizes[left][:, None] + sizes[right][None, :] - shared
    i, j = np.nonzero((100 * shared >= percent * union) & (shared > 0))
    i, j = left[i], right[j]
    keep = i != j
    return i[keep], j[keep]


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["bundle", "band", "ci", "cj"]):
            ci, cj = t.column("ci")[0].as_py(), t.column("cj")[0].as_py()
            sets = [np.array(x, dtype=np.int64) for x in t.column("set").to_pylist()]
            cid, comp, cell, high = (t.column(c).to_numpy(zero_copy_only=False) for c in ("cid", "comp", "cell", "high"))
            i, j = similar(sets, percent, np.flatnonzero(cell == ci), np.flatnonzero(cell == cj))
            keep = ~(high[i] & high[j]) & (comp[i] != comp[j])  # two of the higher band meet in their own group
            i, j = i[keep], j[keep]
            if len(i):
                root = forest(len(sets), i, j)
                at = np.flatnonzero(root != np.arange(len(sets)))
                yield pa.RecordBatch.from_arrays([pa.array(cid[at]), pa.array(cid[root[at]])], ["u", "v"])

    return run


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = per_process("shingle words", _Hashes)
        for batch in slices(batches):
            sets = [shingles(x, words, cache) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(sets, pa.list_(pa.int64()))], ["cid", "n", "set"])

    return run


def _may(percent: int, a: Column, b: Column) -> Column:
    """Whether sets of these sizes can be similar."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


class _Links:
    """Verified links and the components they make so far."""

    def __init__(self, spark: SparkSession, scratch: Scratch, sets: DataFrame, percent: int):
        self.spark, self.scratch, self.sets, self.percent = spark, scratch, sets, percent
        self.label = sets.select("cid", F.col("cid").alias("comp"))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (u, v) that reach the threshold."""
        one, two = (self.sets.select(F.col("cid").alias(c), F.col("n").alias(f"n{c}"), F.col("set").alias(f"s{c}")) for c in "uv")
        both = pairs.join(one, "u").join(two, "v").withColumn("shared", F.size(F.array_intersect("su", "sv")))
        return both.where(100 * F.col("shared") >= self.percent * (F.col("nu") + F.col("nv") - F.col("shared"))).select("u", "v")

    def add(self, links: DataFrame) -> None:
        """Joins the components of linked documents."""
        u, v = (self.label.select(F.col("cid").alias(c), F.col("comp").alias(f"c{c}")) for c in "uv")
        between = self.scratch.cut(links.join(u, "u").join(v, "v").where("cu <> cv").select(F.col("cu").alias("u"), F.col("cv").alias("v")).distinct())
        joined = connected_components(self.spark, between, self.scratch)
        old, self.label = self.label, self.scratch.cut(self.label.join(joined, F.col("comp") == F.col("node"), "left").select("cid", F.coalesce("component", "comp").alias("comp")))
        self.scratch.drop(old, between)

    def open(self, posts: DataFrame) -> DataFrame:
        """(key, cid, n, comp) of the keys whose documents are in several components."""
        now = posts.join(self.label, "cid")
        several = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
        return self.scratch.cut(now.join(several, "key").select("key", "cid", "n", "comp"))


def _rest(links: _Links, posts: DataFrame) -> DataFrame:
    """Links between components among the documents of open keys: all compared but within components."""
    spark, scratch, percent = links.spark, links.scratch, links.percent
    heads = posts.groupBy("key").agg(F.min("cid").alias("v"))
    stars = posts.join(heads, "key").where("cid <> v").select(F.col("cid").alias("u"), "v").distinct()
    bundles = scratch.cut(connected_components(spark, stars, scratch).select(F.col("node").alias("cid"), F.col("component").alias("bundle")))
    docs = bundles.join(posts.select("cid", "comp", "n").distinct(), "cid")
    large = docs.groupBy("bundle", "comp").agg(F.count(F.lit(1)).alias("m")).groupBy("bundle").agg(F.max(F.struct("m", "comp")).alias("x")).select("bundle", F.col("x.comp").alias("most"))
    docs = docs.join(large, "bundle").withColumn("big", F.col("comp") == F.col("most"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")
    flat = docs.select("cid", "bundle", "comp", "big", "n", F.explode(F.array(F.struct(band.alias("band"), F.lit(False).alias("high")), F.struct((band - 1).alias("band"), F.lit(True).alias("high")))).alias("b")).select("cid", "bundle", "comp", "big", "n", "b.*")
    flat = scratch.cut(flat)
    cells = lambda kind: F.greatest(F.ceil(F.sum(F.when(kind, 1).otherwise(0)) / CELL), F.ceil(F.sum(F.when(kind, F.col("n")).otherwise(0)) / CELL_TOKENS)).cast("int")
    size = flat.groupBy("bundle", "band").agg(cells(~F.col("big")).alias("small"), cells(F.col("big")).alias("large"), F.count(F.lit(1)).alias("m"), F.min("high").alias("no_low"))
    size = scratch.cut(size.where("m > 1 AND NOT no_low AND small > 0").select("bundle", "band", "small", "large"))
    place = F.xxhash64(F.lit("cell"), "cid")
    dealt = flat.join(size, ["bundle", "band"]).withColumn("cell", F.when(F.col("big"), F.col("small") + F.pmod(place, F.greatest("large", F.lit(1)))).otherwise(F.pmod(place, F.greatest("small", F.lit(1)))).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.when(F.col("big"), F.col("small")).otherwise(F.col("small") + F.col("large")) - 1)))
    dealt = dealt.select("cid", "bundle", "band", "high", "comp", "cell", F.least("cell", "o").alias("ci"), F.greatest("cell", "o").alias("cj")).join(links.sets.select("cid", "set"), "cid")
    at = ["bundle", "band", "ci", "cj"]
    return dealt.repartition(*at).sortWithinPartitions(*at, "cid").mapInArrow(_verify(percent), "u long, v long")


def join(spark: SparkSession, docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, rare: int = RARE, rounds: int = ROUNDS) -> DataFrame:
    """key, h (a hash of the text), n_shingles, class (one per token set, null if empty), component (a number of its own), component_id."""
    scratch = Scratch(spark)
    slim = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("h"), F.col(text).cast("string").alias("t"))
    sig = scratch.cut(slim.mapInArrow(_signatures(words, percent), "doc long, h long, n int, least int, d1 long, d2 long, win array<long>").withColumn("rid", F.monotonically_increasing_id()))
    classes = scratch.cut(sig.where("n > 0").groupBy("d1", "d2").agg(F.min("rid").alias("cid"), F.min("doc").alias("low")))
    rows = scratch.cut(sig.select("doc", "h", "n", "d1", "d2", "rid").join(classes.select("d1", "d2", "cid"), ["d1", "d2"], "left").select("doc", "h", "n", "rid", "cid"))
    own = scratch.cut(sig.join(classes.select("cid"), sig["rid"] == classes["cid"], "left_semi").select(F.col("rid").alias("cid"), "n", "least", "win"))
    scratch.drop(sig)
    posts = own.select("cid", F.explode("win").alias("tok"))
    often = scratch.cut(posts.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    met = scratch.cut(posts.join(often, "tok").select("tok", "cid", "df"))
    scratch.drop(often)

    # rare tokens, one by one
    lists = met.where(F.col("df") <= rare).join(own.select("cid", "n", F.size("win").alias("w")), "cid").groupBy("tok").agg(F.collect_list(F.struct("cid", "n", "w")).alias("all"))
    close = lambda x, y: (x["cid"] < y["cid"]) & _may(percent, x["n"], y["n"])
    pairs = lists.select(F.explode("all").alias("x"), "all").select("x", F.explode(F.filter("all", lambda y: close(F.col("x"), y))).alias("y"))
    pairs = pairs.groupBy(F.col("x.cid").alias("u"), F.col("y.cid").alias("v")).agg(F.count(F.lit(1)).alias("c"), *[F.min(f"{a}.{b}").alias(f"{b}{c}") for a, c in (("x", "u"), ("y", "v")) for b in "nw"])
    busy = scratch.cut(met.where(F.col("df") > rare).groupBy("cid").agg(F.count(F.lit(1)).alias("f")))
    need = F.least(F.col("wu") - F.col("nu"), F.col("wv") - F.col("nv")) + F.expr(f"({percent} * (nu + nv) + {99 + percent}) DIV {100 + percent}")
    fu, fv = (busy.select(F.col("cid").alias(c), F.col("f").alias(f"f{c}")) for c in "uv")
    ties = scratch.cut(pairs.join(fu, "u", "left").join(fv, "v", "left").where(F.col("c") >= need - F.least(F.coalesce("fu", F.lit(0)), F.coalesce("fv", F.lit(0)))).select("u", "v"))

    # frequent tokens, in combinations
    ruled = scratch.cut(busy.join(own.select("cid", "n", "least"), "cid").where("f >= least").select("cid", "n", "least"))
    ruled = met.where(F.col("df") > rare).select("cid", "tok").join(ruled, "cid").groupBy("cid").agg(F.first("n").alias("n"), F.first("least").alias("least"), F.collect_list("tok").alias("toks"))
    keys = scratch.cut(ruled.mapInArrow(_combine(percent), "key long, cid long, n int"))
    heads = scratch.cut(keys.groupBy("key").agg(F.min(F.struct("cid", "n")).alias("x"), F.count(F.lit(1)).alias("m")).where("m > 1").select("key", F.col("x.cid").alias("head"), F.col("x.n").alias("hn")))
    posts = scratch.cut(keys.join(heads, "key").select("key", "cid", "n", "head", "hn"))
    scratch.drop(met, busy, keys, heads, own)

    # the full sets of all candidates
    wanted = posts.select("cid").unionByName(ties.select(F.explode(F.array("u", "v")).alias("cid"))).distinct()
    wanted = wanted.join(rows.select("doc", "h", "n", "rid"), F.col("rid") == F.col("cid")).select("doc", "h", "n", "cid")
    texts = slim.withColumnRenamed("h", "h2").withColumnRenamed("doc", "doc2")
    found = wanted.join(texts, F.col("doc").eqNullSafe(F.col("doc2")) & (F.col("h") == F.col("h2"))).select("cid", "n", "t")
    sets = scratch.cut(found.mapInArrow(_full_sets(words), "cid long, n int, set array<long>").dropDuplicates(["cid"]))

    # exact verification
    links = _Links(spark, scratch, sets, percent)
    first = posts.where((F.col("cid") != F.col("head")) & _may(percent, F.col("n"), F.col("hn"))).select(F.col("head").alias("u"), F.col("cid").alias("v"))
    links.add(links.verified(ties.unionByName(first).distinct()))
    left = links.open(posts.select("key", "cid", "n"))
    scratch.drop(posts)
    before = left.count()
    for r in range(1, rounds):
        if not before:
            break
        drawn = left.groupBy("key").agg(F.min(F.struct(F.xxhash64(F.lit(r), "key", "cid").alias("o"), "cid", "n", "comp")).alias("x")).select("key", F.col("x.cid").alias("u"), F.col("x.n").alias("nu"), F.col("x.comp").alias("cu"))
        near = left.join(drawn, "key").where((F.col("comp") != F.col("cu")) & _may(percent, F.col("n"), F.col("nu"))).select("u", F.col("cid").alias("v")).distinct()
        links.add(links.verified(near))
        old, left = left, links.open(left.select("key", "cid", "n"))
        scratch.drop(old)
        now = left.count()
        if 2 * now > before:
            before = now
            break
        before = now
    if before:
        links.add(_rest(links, left))
    comp = links.label

    named = comp.join(classes.select(F.col("cid").alias("cid2"), "low"), F.col("cid") == F.col("cid2"))
    names = scratch.cut(named.groupBy("comp").agg(F.min("low").alias("name")))
    label = scratch.cut(classes.select("cid", "low").join(comp, "cid", "left").join(names, "comp", "left").select(F.col("cid").alias("cid2"), F.coalesce("comp", "cid").alias("component"), F.when(F.col("comp").isNull(), F.col("low")).otherwise(F.col("name")).alias("name")))
    scratch.drop(sets, left, ties)
    out = rows.join(label, F.col("cid") == F.col("cid2"), "left")
    return out.select(F.col("doc").alias(key), "h", F.col("n").cast("long").alias("n_shingles"), F.col("cid").alias("class"), "component", F.when(F.col("cid").isNull(), F.col("doc")).otherwise(F.col("name")).alias("component_id"))
