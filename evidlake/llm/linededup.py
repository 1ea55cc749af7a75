"""Line deduplication by pairwise alignment.

The result is that of aligning every document with every earlier one: aligned common blocks of at least ``min_words``
words are deleted from the later document, comparisons always being with whole original texts, so the first occurrence
of a block stays. Each pair is aligned with a patience diff (lines that are unique in both anchor the alignment,
recursively; a longest common subsequence where there are none) over the hashes of lines (white space made even).

Not all pairs are aligned to get there. A block of ``min_words`` words holds a passage: adjacent lines that have as many
words and would not without their first or their last line. Pairs without a common passage delete nothing. A line that
one document holds matches nothing, so documents with the same sequence of shared lines (gaps between them made even)
have the same alignments with all others: the first of them stands for all, and the others are aligned with it alone,
which deletes all that any earlier document could. Of the rest, the holders of a passage are tried in order, the first
one to begin with and more at once in every round, by those later documents in which a line of the passage is still
left; the rounds end when every passage is deleted or was compared with all its earlier holders.

Pairs and alignments carry line hashes only; texts move once, to the rows that say what to delete.

Defined cases: documents are ordered by id (null last), then by a hash of their text; rows with equal id and text count
as one document and get the same result; a null text stays null, a blank one stays as it is; blank lines neither
match nor break a block; very long texts are aligned as a whole. Other columns pass through, but for n_lines_removed and
n_lines_left, which are replaced.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, slices

#: After a passage's first holder, so many are tried at once, and that many times more in each further round ...
RARE = 8
#: ... up to this many.
MOST = 1000
#: Bits of an alignment table of which all rows are held at once.
MOST_BITS = 1 << 27
MIN_WORDS = 10
_LAST = 2**63 - 1


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in slices(batches):
        hashes, sizes = [], []
        for text in batch.column(2).to_pylist():
            words = [x.split() for x in (text or "").encode("utf-8", "surrogatepass").split(b"\n")]
            hashes.append([xxhash.xxh64_intdigest(b" ".join(w)) - 2**63 if w else None for w in words])
            sizes.append([len(w) for w in words])
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))], ["k", "h", "lines", "sizes"])


def _rows(a: list[int], where: dict[int, int], full: int, row: int) -> Iterator[int]:
    """For each start of a, the bits of b at which the longest common subsequence does not grow, from the bits ``row`` on."""
    for x in a:
        u = row & where.get(x, 0)
        row = ((row + u) | (row - u)) & full
        yield row


def _places(b: list[int]) -> dict[int, int]:
    at: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        at.setdefault(x, []).append(j)
    out = {}
    for x, places in at.items():
        bits = bytearray(places[-1] // 8 + 1)
        for j in places:
            bits[j >> 3] |= 1 << (j & 7)
        out[x] = int.from_bytes(bits, "little")
    return out


def longest(a: list[int], b: list[int], most: int = MOST_BITS) -> list[tuple[int, int]]:
    """A longest common subsequence as pairs (i, j), by bit vectors; neighbours of one side are kept together where possible.

    Lines that only one side holds are set aside first. Of tables of more than ``most`` bits only some rows are kept, and those
    between are made again, from the last backwards: the pairs are the same.
    """
    ia, ib = set(a), set(b)
    ia, ib = [i for i, x in enumerate(a) if x in ib], [j for j, x in enumerate(b) if x in ia]
    out: list[tuple[int, int]] = []
    left, right = [a[i] for i in ia], [b[j] for j in ib]
    m, n = len(left), len(right)
    full, where = (1 << n) - 1, _places(right)
    step = max(1, m if m * n <= most else math.isqrt(m))
    starts, row = [full], full
    for at in range(0, m - step, step):
        for row in _rows(left[at : at + step], where, full, row):
            pass
        starts.append(row)
    i, j, low = m, n, m
    rows: list[int] = []
    while i and j:
        if i <= low:  # rows[k] is the row after line low + k
            low = (i - 1) // step * step
            rows = list(_rows(left[low : min(low + step, m)], where, full, starts[low // step]))
        if rows[i - 1 - low] >> (j - 1) & 1:
            j = (~rows[i - 1 - low] & ((1 << j) - 1)).bit_length()
            continue
        i -= 1
        before = full if i == 0 else starts[i // step] if i == low else rows[i - 1 - low]
        if before >> (j - 1) & 1:
            j -= 1
            out.append((ia[i], ib[j]))
    out.sort()
    for n in range(len(out) - 2, -1, -1):  # towards the next pair
        (i, j), (i2, j2) = out[n], out[n + 1]
        if a[i2 - 1] == b[j2 - 1] == a[i]:
            out[n] = (i2 - 1, j2 - 1)
    for n in range(1, len(out)):  # towards the pair before
        (i, j), (i2, j2) = out[n - 1], out[n]
        if a[i + 1] == b[j + 1] == a[i2]:
            out[n] = (i + 1, j + 1)
    return out


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs (i, j) with a[i] == b[j], rising in both: a patience diff.

    Where no line is unique in both, the n-th occurrences of lines that both hold equally often are anchors; where there
    are none of these either, a longest common subsequence is taken.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 >= i1 or j0 >= j1:
            continue
        ca, cb = Counter(a[i0:i1]), Counter(b[j0:j1])
        anchors = {x for x, n in ca.items() if n == 1 and cb.get(x) == 1}
        if not anchors:
            anchors = {x for x, n in ca.items() if cb.get(x) == n}
        if not anchors:
            out += [(i0 + i, j0 + j) for i, j in longest(a[i0:i1], b[j0:j1])]
            continue
        where: dict[int, list[int]] = {}
        for i in range(i1 - 1, i0 - 1, -1):
            if a[i] in anchors:
                where.setdefault(a[i], []).append(i)
        pairs = [(where[b[j]].pop(), j) for j in range(j0, j1) if b[j] in anchors]
        tops: list[int] = []
        ends: list[int] = []
        back = [-1] * len(pairs)
        for n, (i, _) in enumerate(pairs):  # longest rising run, by patience piles
            at = bisect_left(tops, i)
            back[n] = ends[at - 1] if at else -1
            if at == len(tops):
                tops.append(i)
                ends.append(n)
            else:
                tops[at], ends[at] = i, n
        chain, n = [], ends[-1]
        while n >= 0:
            chain.append(pairs[n])
            n = back[n]
        pi, pj = i0, j0
        for i, j in reversed(chain):
            out.append((i, j))
            todo.append((pi, i, pj, j))
            pi, pj = i + 1, j + 1
        todo.append((pi, i1, pj, j1))
    return sorted(out)


def common_blocks(a: list[int | None], b: list[int | None], sizes: list[int], min_words: int) -> list[int]:
    """Lines of b (their numbers) in aligned blocks with a that have ``min_words`` words or more."""
    ia, ib = [i for i, x in enumerate(a) if x is not None], [j for j, x in enumerate(b) if x is not None]
    at = blocks([a[i] for i in ia], [b[j] for j in ib], [sizes[j] for j in ib], min_words)
    return [ib[j] for j in at]


def blocks(a: list[int], b: list[int], sizes: list[int], min_words: int) -> list[int]:
    """The same for documents without blank lines."""
    out: list[int] = []
    run: list[int] = []
    last = (-2, -2)
    for i, j in [*align(a, b), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if run and sum(sizes[x] for x in run) >= min_words:
                out += run
            run = []
        if j >= 0:
            run.append(j)
        last = (i, j)
    return out


def outline(lines: list[int | None], sizes: list[int], shared: set[int]) -> tuple[list[int | None], list[int], list[int]]:
    """(lines, their numbers, their words) without blank lines; each run of lines that are not shared is one null."""
    seq: list[int | None] = []
    at, words = [], []
    for i, x in enumerate(lines):
        if x is None or x not in shared and seq and seq[-1] is None:
            continue
        seq.append(x if x in shared else None)
        at.append(i)
        words.append(sizes[i])
    return seq, at, words


def passages(seq: list[int | None], sizes: list[int], min_words: int) -> list[tuple[int, int]]:
    """(first, last) of all runs of shared lines with ``min_words`` words that end, or start, as early, or late, as they can."""
    out: set[tuple[int, int]] = set()
    lo, n = 0, 0
    for hi, x in enumerate(seq):
        if x is None:
            lo, n = hi + 1, 0
            continue
        n += sizes[hi]
        if n < min_words:
            continue
        while n >= min_words:  # runs that are complete with this line
            if n - sizes[hi] < min_words:
                out.add((lo, hi))
            lo, n = lo + 1, n - sizes[lo]
        lo, n = lo - 1, n + sizes[lo - 1]
        out.add((lo, hi))
    return sorted(out)


def _name(lines: list[int | None]) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(",".join(map(str, lines))) - 2**63


def _identity(key: str, text: str) -> tuple[Column, Column]:
    """(order key, hash of the text) of a document; those without an id come last and meet no document with one."""
    k = F.col(key).cast("long")
    return F.coalesce(k, F.lit(_LAST)), F.when(k.isNull(), F.xxhash64(F.lit("no id"), text)).otherwise(F.xxhash64(text))


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of lines as one flag a line, up to the last one, which can be looked up by place."""
    for batch in slices(batches):
        masks = []
        for gone in batch.column(2).to_pylist():
            mask = np.zeros(max(gone) + 1, dtype=bool)
            mask[gone] = True
            masks.append(mask)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(masks, pa.list_(pa.bool_()))], ["__k", "__h", "__gone"])


def find(spark: SparkSession, docs: DataFrame, *, key: str = "doc_id", text: str = "text", rare: int = RARE, min_words: int = MIN_WORDS) -> DataFrame:
    """(k, h, gone): the numbers of the lines to delete from the document with order key k and text hash h."""
    scratch = Scratch(spark)
    keyed = docs.where(F.col(text).isNotNull()).select(_identity(key, text)[0].alias("k"), _identity(key, text)[1].alias("h"), F.col(text).cast("string").alias("t"))
    lines = scratch.cut(keyed.mapInArrow(_lines, "k long, h long, lines array<long>, sizes array<int>").dropDuplicates(["k", "h"]))
    posts = lines.select("k", "h", F.explode(F.array_distinct(F.filter("lines", lambda x: x.isNotNull()))).alias("line"))
    # stored, so that the join below is one of two plain exchanges, which can be split where a line is very common
    often = scratch.cut(posts.groupBy("line").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("line"))
    shared = posts.join(often, "line").groupBy("k", "h").agg(F.collect_list("line").alias("shared"))

    def outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for k, h, x, s, c in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                seq, at, words = outline(x, s, set(c))
                held = passages(seq, words, min_words)
                if held:
                    rows.append((k, h, _name(seq), seq, at, words, sorted({_name(seq[lo : hi + 1]) for lo, hi in held})))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["k", "h", "kind", "seq", "at", "sizes", "held"])

    seqs = scratch.cut(lines.join(shared, ["k", "h"]).mapInArrow(outlines, "k long, h long, kind long, seq array<long>, at array<int>, sizes array<int>, held array<long>"))
    scratch.drop(lines, often)
    me = F.struct("k", "h")
    heads = seqs.groupBy("kind").agg(F.min(me).alias("a"))
    kinds = scratch.cut(seqs.select("k", "h", "kind").join(heads, "kind").select("k", "h", "a"))
    alike = kinds.where(me != F.col("a")).select(F.col("a.k").alias("ak"), F.col("a.h").alias("ah"), "k", "h")
    posts = scratch.cut(seqs.join(kinds.where(me == F.col("a")).select("k", "h"), ["k", "h"], "left_semi").select("k", "h", F.explode("held").alias("passage")))
    firsts = posts.groupBy("passage").agg(F.count(F.lit(1)).alias("df"), F.min(me).alias("first")).where("df > 1")
    left = scratch.cut(posts.join(firsts, "passage").where(me != F.col("first")).select("k", "h", "passage"))
    one = seqs.select(F.col("k").alias("ak"), F.col("h").alias("ah"), F.col("seq").alias("other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            gone = []
            for a, b, at, s in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
                here = blocks([("a",) if x is None else x for x in a], [("b",) if x is None else x for x in b], s, min_words)
                gone.append([at[j] for j in here])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(gone, pa.list_(pa.int32()))], ["k", "h", "gone"])

    def still(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for k, h, seq, at, s, gone in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                lost = set(gone or ())
                rows += [(k, h, x) for x in {_name(seq[lo : hi + 1]) for lo, hi in passages(seq, s, min_words) if any(at[i] not in lost for i in range(lo, hi + 1))}]
            columns = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["k", "h", "passage"])

    def compare(pairs: DataFrame) -> DataFrame:
        both = scratch.cut(pairs.join(one, ["ak", "ah"]).select("k", "h", "other"))
        found = both.join(seqs, ["k", "h"]).select("k", "h", "other", "seq", "at", "sizes").mapInArrow(run, "k long, h long, gone array<int>").where(F.size("gone") > 0)
        found = scratch.cut(found.groupBy("k", "h").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone")))
        scratch.drop(both)
        return found

    found = compare(alike)
    tried, more = None, 1
    while True:
        near = posts.join(left.select("passage").distinct(), "passage")
        if tried is not None:
            near = near.join(tried, "passage").where(me > F.col("last")).select("k", "h", "passage")
        place = F.row_number().over(Window.partitionBy("passage").orderBy("k", "h"))
        near = scratch.cut(near.withColumn("place", place).where(F.col("place") <= more).select("passage", F.col("k").alias("ak"), F.col("h").alias("ah")))
        pairs = left.join(near, "passage").where(F.struct("ak", "ah") < me).select("ak", "ah", "k", "h").distinct()
        pairs = scratch.cut(pairs)
        if pairs.isEmpty():
            return found
        found = found.unionByName(compare(pairs)).groupBy("k", "h").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
        found = scratch.cut(found)
        rest = pairs.select("k", "h").distinct().join(seqs, ["k", "h"]).join(found, ["k", "h"], "left").select("k", "h", "seq", "at", "sizes", "gone")
        rest = rest.mapInArrow(still, "k long, h long, passage long")
        last = near.groupBy("passage").agg(F.max(F.struct(F.col("ak").alias("k"), F.col("ah").alias("h"))).alias("last"))
        tried = scratch.cut(last)
        left = scratch.cut(left.join(rest, ["k", "h", "passage"], "left_semi").join(tried, "passage").where(F.col("last") < me).select("k", "h", "passage"))
        more = min(MOST, max(2, rare) * more)


def dedup(spark: SparkSession, docs: DataFrame, *, key: str = "doc_id", text: str = "text", rare: int = RARE, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the common blocks deleted from ``text``, and n_lines_removed, n_lines_left (lines with a word) added."""
    gone = find(spark, docs, key=key, text=text, rare=rare, min_words=min_words).select("k", "h", "gone").mapInArrow(_masks, "__k long, __h long, __gone array<boolean>")
    k, h = _identity(key, text)
    on = (k == F.col("__k")) & (h == F.col("__h"))
    joined = docs.drop("n_lines_removed", "n_lines_left").join(gone, on, "left")
    rows = F.split(F.col(text), "\n")
    left = F.filter(rows, lambda x, i: ~F.coalesce(F.get("__gone", i), F.lit(False)))
    joined = joined.withColumn("n_lines_removed", F.coalesce(F.size(F.filter("__gone", lambda x: x)), F.lit(0)))
    joined = joined.withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(left, "\n")))
    words = F.coalesce(F.size(F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))), F.lit(0))
    return joined.withColumn("n_lines_left", words).drop("__k", "__h", "__gone")
