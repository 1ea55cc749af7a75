"""Benchmark decontamination: exact occurrences of item windows in documents, by a prefix-filtered set join.

Texts are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII characters. A window is ``window`` consecutive
words of an item, or the whole item where it has fewer. A window is the set of its shingles of ``shingle`` words (of the whole
window where that is shorter). A document that contains a window contains all of its shingles, so by the prefix rule for
containment 1 it is enough to join one of them: the rarest, as counted over all documents.

1. Items become windows, distinct windows become shingles.
2. All documents are scanned for these shingles and their occurrences counted. A shingle that no document has rules out its
   windows; of all others each window keeps the rarest (ties: the first), with its place in the window.
3. All documents are scanned again for the kept shingles. Each occurrence goes on with the words around it, as many as a window
   can reach from there.
4. Occurrences are joined with the kept places. The place in the window and the window's length bound where it would start and end
   in the document; what lies within is compared, word by word, with the windows.
5. Verified windows are marked in their documents, and their items listed.

Scans work on whole columns of bytes (words and shingles are hashed by array operations; equality is decided by words, never
by hashes). A bitmap of the wanted shingles, of ``MOST_BITS`` bits at most (32 MB), is sent to all tasks, whatever the size of the benchmark: beyond that,
more occurrences pass it and are dropped by the join. A shingle that most documents have gives an occurrence each, not pairs:
occurrences meet places in a window (at most ``window`` * (``window`` + 1) / 2 a shingle), never windows, before the words are
compared. Windows of a document are made distinct before they meet their items.

Defined cases: null or wordless texts have no words and no hits, a null or wordless item has no windows. Repeated documents count
one by one, null and repeated document ids included; repeated item ids are one item, a null item id is an empty one. Very long texts and items are read whole,
in blocks. No documents give no rows, no items give documents without hits. Only ids and texts are read, so other columns may
have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

WINDOW = 10
SHINGLE = 3
#: Bits of the bitmap for each shingle in it, and its size at most.
BITS_EACH, MOST_BITS = 64, 1 << 28
#: Bits of one cell of ``bitmap_construct_agg``.
_CELL = 1 << 15
#: Bytes of text that are worked on at once.
BLOCK = 1 << 20
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

#: Bytes of words stay (A-Z as a-z), all others become blanks.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M2
    return h ^ (h >> np.uint64(29))


def _powers(n: int) -> np.ndarray:
    """Odd factors for the bytes of a word by their place."""
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _M1, np.uint64))


@dataclass
class Words:
    """The words of several texts: where they start and end in the folded bytes, their hashes, and each text's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def text(self, lo: int, hi: int) -> str:
        """Words lo to hi - 1, one blank between."""
        raw = self.data[self.starts[lo] : self.ends[hi - 1]].tobytes() if hi > lo else b""
        return b" ".join(raw.split(b" ")).decode("utf-8", "replace") if b"  " not in raw else b" ".join(x for x in raw.split(b" ") if x).decode("utf-8", "replace")


def words_of(column: pa.Array) -> Words:
    """The words of a column of texts; nulls have none."""
    raw = column.cast(pa.large_binary())
    at = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8) if len(raw) else np.zeros(1, np.int64)
    size = np.where(np.asarray(raw.is_valid()), np.diff(at), 0) if len(raw) else np.zeros(0, np.int64)
    source = np.frombuffer(raw.buffers()[2] or b"", np.uint8) if len(raw) else np.zeros(0, np.uint8)
    # a blank after each text keeps texts apart
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    data = np.full(begin[-1], 32, np.uint8)
    for i in np.flatnonzero(size).tolist():
        data[begin[i] : begin[i] + size[i]] = source[at[i] : at[i] + size[i]]
    starts, ends, hashes = [], [], []
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + BLOCK)
        part = data[lo:hi]
        np.take(_FOLD, part, out=part)
        while hi < n and data[hi - 1] != 32:  # no word is cut
            more = _FOLD[data[hi : hi + BLOCK]]
            k = int(np.argmax(np.append(more, 32) == 32))
            data[hi : hi + k] = more[:k]
            hi += k
            if k < len(more):
                break
        part = data[lo:hi]
        inside = np.concatenate([[False], part != 32, [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        s, e = edge[::2], edge[1::2]
        if len(s):
            length = e - s
            place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
            value = part[np.repeat(s, length) + place].astype(np.uint64)
            with np.errstate(over="ignore"):
                value = (value + np.uint64(1)) * _powers(int(length.max()))[place]
                hashes.append(_mixed(np.add.reduceat(value, np.cumsum(length) - length)))
            starts.append(s + lo)
            ends.append(e + lo)
        lo = hi
    none = np.zeros(0, np.int64)
    starts, ends = (np.concatenate(x) if x else none for x in (starts, ends))
    return Words(data, starts, ends, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.searchsorted(starts, begin))


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words, at the place of the first."""
    out = np.full(max(0, len(hashes) - n + 1), n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = out * _M1 + hashes[i : len(hashes) - n + 1 + i]
        return _mixed(out)


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Slices of record batches with the words of their second column."""
    for batch in batches:
        lo = 0
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0))
        while lo < batch.num_rows:
            hi = lo + max(1, min(rows, int(np.searchsorted(np.cumsum(size[lo : lo + rows]), 4 * BLOCK))))
            part = batch.slice(lo, hi - lo)
            yield part, words_of(part.column(1))
            lo = hi


def windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """item, words (of a window, one blank between), length, shingles (hashes, by place) of all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["item", "words", "length", "shingles"]
        for part, w in _parts(batches):
            for i, item in enumerate(part.column(0).to_pylist()):
                lo, hi = int(w.first[i]), int(w.first[i + 1])
                if hi == lo:
                    continue
                n = min(window, hi - lo)
                size = min(shingle, n)
                own = shingles(w.hashes[lo:hi], size).view(np.int64)
                for a in range(lo, hi - n + 1, 4096):
                    at = range(a, min(a + 4096, hi - n + 1))
                    sets = [own[k - lo : k - lo + n - size + 1] for k in at]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(at), pa.string()), pa.array([w.text(k, k + n) for k in at]), pa.array([n] * len(at), pa.int32()), pa.array(sets, pa.list_(pa.int64()))], names)

    slim = items.select(F.coalesce(F.col(items.columns[0]).cast("string"), F.lit("")).alias("item"), F.col(items.columns[1]).cast("string").alias("text"))
    return slim.mapInArrow(run, "item string, words string, length int, shingles array<long>")


def bitmap(spark: SparkSession, hashes: DataFrame, n: int) -> Broadcast:
    """(bits, bitmap) of the values of column h, of which there are n: bit h mod bits. At most MOST_BITS bits."""
    bits = _CELL
    while bits < min(MOST_BITS, n * BITS_EACH):
        bits *= 2
    bit = F.pmod("h", F.lit(bits))
    cells = hashes.groupBy(F.floor(bit / _CELL).alias("cell")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit + 1)).alias("b"))
    out = np.zeros(bits // 8, np.uint8)
    for cell, b in cells.collect():
        out[cell * (_CELL // 8) : cell * (_CELL // 8) + len(b)] = np.frombuffer(b, np.uint8)
    return spark.sparkContext.broadcast((bits, out))


def _wanted(hashes: np.ndarray, filter_: tuple[int, np.ndarray]) -> np.ndarray:
    bits, held = filter_
    at = hashes & np.uint64(bits - 1)
    return np.flatnonzero(held[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1)


def _found(w: Words, sizes: list[int], filter_: tuple[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """By size of shingles: texts, places and hashes of those that the bitmap knows."""
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    for n in sizes:
        h = shingles(w.hashes, n)
        at = _wanted(h, filter_)
        at = at[text[at] == text[at + n - 1]]
        yield n, text[at], at, h[at]


def occurrences(spark: SparkSession, docs: DataFrame, hashes: DataFrame, sizes: list[int]) -> DataFrame:
    """h, n: how often the given shingles occur in all documents (and some others, that share a bit with one of them)."""
    held = bitmap(spark, hashes, hashes.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = held.value
        for _, w in _parts(batches):
            h = np.concatenate([np.zeros(0, np.uint64), *(f[3] for f in _found(w, sizes, filter_))])
            if len(h):
                u, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], ["h", "n"])

    return docs.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def candidates(spark: SparkSession, docs: DataFrame, hashes: DataFrame, sizes: list[int], window: int, shingle: int) -> DataFrame:
    """(key, n_words, found: h, size, at, before, words) for every document: kept shingles in it and the words around each."""
    held = bitmap(spark, hashes, hashes.count())
    kind = pa.struct([("h", pa.int64()), ("size", pa.int32()), ("at", pa.int32()), ("before", pa.int32()), ("words", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = held.value
        for part, w in _parts(batches):
            rows: list[list[dict]] = [[] for _ in range(part.num_rows)]
            for n, text, at, h in _found(w, sizes, filter_):
                reach = window - n if n == shingle else 0  # a shorter shingle is a whole window
                for t, a, x in zip(text.tolist(), at.tolist(), h.view(np.int64).tolist(), strict=True):
                    lo, hi = int(w.first[t]), int(w.first[t + 1])
                    begin = max(lo, a - reach)
                    rows[t].append({"h": x, "size": n, "at": a - lo, "before": a - begin, "words": w.text(begin, min(hi, a + n + reach))})
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(w.first)), pa.array(rows, pa.list_(kind))], ["key", "n_words", "found"])

    return docs.mapInArrow(run, "key long, n_words long, found array<struct<h:long,size:int,at:int,before:int,words:string>>")


class Decontamination:
    """Occurrences of the windows of ``items`` (id, text) in ``docs`` (id, text)."""

    def __init__(self, spark: SparkSession, docs: DataFrame, items: DataFrame, *, window: int = WINDOW, shingle: int = SHINGLE):
        self.window, self.scratch = window, Scratch(spark)
        slim = docs.select(F.col(docs.columns[0]).cast("long").alias("key"), F.col(docs.columns[1]).cast("string").alias("text"))
        self.windows = self.scratch.cut(windows(items, window, shingle).dropDuplicates(["item", "words"]))
        sets = self.scratch.cut(self.windows.dropDuplicates(["words"]).select("words", "length", F.posexplode("shingles").alias("place", "h")))
        sizes = sorted(r[0] for r in sets.select(F.least(F.lit(shingle), "length")).distinct().collect())
        count = self.scratch.cut(occurrences(spark, slim, sets.select("h").distinct(), sizes))
        ranked = sets.join(count, "h", "left").groupBy("words", "length").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "h")).alias("x"))
        rarest = ranked.where("x.n > 0")
        self.places = self.scratch.cut(rarest.select("x.h", "x.place", "length").distinct())
        kept = self.places.select("h").distinct()
        found = candidates(spark, slim, kept, sizes, window, shingle).withColumn("rid", F.monotonically_increasing_id())
        self.documents = self.scratch.cut(found)
        start = F.col("at") - F.col("place")
        seen = self.documents.where(F.size("found") > 0).select("rid", "n_words", F.explode("found").alias("f")).select("rid", "n_words", "f.*")
        at = seen.join(self.places, "h").where((start >= 0) & (start + F.col("length") <= F.col("n_words")) & (F.col("place") <= F.col("before")))
        inside = F.array_join(F.slice(F.split("words", " "), F.greatest(F.lit(1), F.col("before") - F.col("place") + 1), F.col("length")), " ")
        known = self.windows.select("words").distinct()
        self.hits = self.scratch.cut(at.select("rid", start.alias("start"), (start + F.col("length")).alias("stop"), inside.alias("words")).distinct().join(known, "words", "left_semi"))

    def spans(self) -> DataFrame:
        """key, start, stop, words: every occurrence of a window, by word numbers of the document."""
        return self.hits.join(self.documents.select("rid", "key"), "rid").select("key", "start", "stop", "words")

    def report(self) -> DataFrame:
        """key, n_words, n_hit, items (sorted as strings) of every document."""
        before = F.max("stop").over(Window.partitionBy("rid").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
        covered = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce("before", F.lit(0))))
        ends = self.hits.groupBy("rid", "start").agg(F.max("stop").alias("stop"))
        hit = ends.withColumn("before", before).groupBy("rid").agg(F.sum(covered).alias("n_hit"))
        pairs = self.hits.select("rid", "words").distinct().join(self.windows.select("words", "item"), "words").select("rid", "item").distinct()
        items = pairs.groupBy("rid").agg(F.array_sort(F.collect_list("item")).alias("items"))
        out = self.documents.select("rid", "key", "n_words").join(hit.join(items, "rid"), "rid", "left")
        return out.select("key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
