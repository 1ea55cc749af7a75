"""Branch merge, whitening and decontamination against plain models, and their defined cases."""

import collections
import glob
import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evidlake.llm import decontaminate, merge, queries, whiten

DATA = "/root/testdata/sf0.001"


def plain_merge(rows):
    """id -> (lang, source, text, clean, edit-edit, edit-delete, insert-insert), for distinct ids."""
    out, added = {}, collections.defaultdict(dict)
    for d, text, lang, source in rows:
        base = [lang or "", source or ""], (text or "").split("\n")
        branch = {}
        for b, k in (("L", 1), ("R", 2)):
            code = lambda name: zlib.crc32(f"{b}:{d}:{name}".encode()) % 11  # noqa: B023, E731
            edit = lambda v, c, gone: {0: gone, 1: v + "!", 2: v + "?"}.get(c, v)
            if code("row") in (3, 4):
                added[-k - d][b] = (*base[0], "!" if code("row") == 3 else "?")
            cols = [edit(v, code(n), "") for v, n in zip(base[0], ("lang", "source"), strict=True)]
            lines = [edit(v, code(i), None) for i, v in enumerate(base[1])]
            branch[b] = code("row") == 0, cols, lines, [{3: "!", 4: "?"}.get(code(i)) for i in range(len(lines))]
        (gone_l, *left), (gone_r, *right) = branch["L"], branch["R"]
        whole = [base[0], base[1], [None] * len(base[1])]
        if gone_l or gone_r:
            clash = gone_l != gone_r and (right if gone_l else left) != whole
            out[d] = (*base[0], "\n".join(base[1]), 0, 0, 1, 0) if clash else (None, None, None, 1, 0, 0, 0)
            continue
        n, state = collections.Counter(), []
        for part, (was, x, y) in enumerate(zip(whole, left, right, strict=True)):
            state.append([])
            for v, p, q in zip(was, x, y, strict=True):
                if p != v and q != v and p != q:
                    n["gap" if part == 2 else "delete" if p is None or q is None else "edit"] += 1
                    state[-1].append(v)
                else:
                    n["clean"] += p != v or q != v
                    state[-1].append(p if p != v else q)
        text = [v for pair in zip(state[1], state[2], strict=True) for v in pair if v is not None]
        out[d] = (*state[0], "\n".join(text), n["clean"], n["edit"], n["delete"], n["gap"])
    for d, by in added.items():
        alike = len(set(by.values())) == 1
        out[d] = (*by.get("L", by.get("R")), 1, 0, 0, 0) if alike else (None, None, None, 0, 0, 0, 1)
    return out


def branches(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("rid", F.lit("clash")).withColumn("pos", F.lit(1))
    return merge.merge(spark, docs).collect()


def test_merge_against_a_plain_model(spark):
    rng = random.Random(4)
    say = lambda: rng.choice(["", "a", "line of words", "é 文", "  ", "!"])
    rows = [(i, rng.choice([None, "", "\n\n", *["\n".join(say() for _ in range(rng.randrange(1, 12)))] * 9]), rng.choice(["en", "fr", "", None]), rng.choice(["s", "t", None])) for i in range(700)]
    rows.append((700, "\n".join(f"line {k}" for k in range(30_000)), "en", "s"))
    got = {r[0]: tuple(r)[1:] for r in branches(spark, rows)}
    want = plain_merge(rows)
    assert got == want
    seen = collections.Counter((k, v > 0) for x in want.values() for k, v in zip("abcd", x[3:], strict=True))
    assert min(seen.values()) > 10  # every kind of outcome occurs


def test_merge_of_odd_rows(spark):
    assert branches(spark, []) == []
    adds = next(i for i in range(1, 500) if zlib.crc32(f"L:{i}:row".encode()) % 11 == 3 and zlib.crc32(f"R:{i - 1}:row".encode()) % 11 not in (3, 4))
    row = (adds, "x", "en", "s")
    own = plain_merge([row])
    got = collections.Counter(map(tuple, branches(spark, [row, row])))  # rows with one key merge one by one, equal additions are one
    assert got == collections.Counter({(adds, *own[adds]): 2, (-1 - adds, *own[-1 - adds]): 1})
    got = branches(spark, [row, (adds, "x", "fr", "s"), (-1 - adds - 1000, "y", "", "")])
    assert sorted(r["lang"] for r in got if r["doc_id"] == -1 - adds) == ["en", "fr"] and all(r["n_clean"] == 1 for r in got if r["doc_id"] == -1 - adds)
    got = branches(spark, [row, (-1 - adds, "held", "de", "u")])  # a key that the base holds is not added
    assert [r["text"][:4] for r in got if r["doc_id"] == -1 - adds and r["text"] is not None] in (["held"], [])
    assert sum(r["doc_id"] == -1 - adds for r in got) == 1
    got = branches(spark, [(None, "a\nb", None, None), (2**63 - 1, "a", "en", "s"), (-(2**63), "a", "en", "s")])
    assert sum(r["doc_id"] is None for r in got) == 1 and {2**63 - 1, -(2**63)} <= {r["doc_id"] for r in got}


@pytest.mark.parametrize("name", ["op11_merge", "op13_decontamination"])
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    rel = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in rel.description]
    got = queries.queries()[name](spark, DATA).select(*names).collect()
    key = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    assert key(got) == key(rel.fetchall())


def test_whitening_against_numpy(spark):
    """The query on the whole table: exact deviations, eigenvectors by NumPy, the identity measured again."""
    got = queries.op12_whitening(spark, DATA).toPandas()
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in r[1]] for r in rows], dtype=object)
    n, s = len(x), x.sum(0)
    y = n * x - s
    z = y.astype(float) / n
    v = z.T @ z / n
    e, w = np.linalg.eigh(v)
    want = z @ w[:, ::-1][:, :8] / np.sqrt(e[::-1][:8])
    assert len(got) == 8 * n and set(got["n"]) == {n}
    ids = [r[0] for r in rows]
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert np.abs(np.abs(table) - np.abs(want)).max() < 1e-9
    assert np.abs(table.T @ table / n - np.eye(8)).max() <= 1e-4 and got["identity_error"].nunique() == 1 and got["identity_error"].max() <= 1e-4
    first = got[got["component"] == 1].set_index("vec_id")
    assert [int(first["deviation"][i]) for i in ids] == (y * y).sum(1).tolist()
    assert np.allclose(got[got["vec_id"] == ids[0]].sort_values("component")["explained"], e[::-1][:8] / e.sum(), rtol=1e-6)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=3).tolist()) for i in range(50)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 1.0, 2.0]), (104, [float("inf"), 1.0, 2.0]), (105, [1e300, 1.0, 2.0])]
    flat = [(200, [1.0, 5.0]), (201, [2.0, 5.0]), (None, [4.0, 5.0]), (201, [2.0, 5.0])]  # of another length, one entry is constant
    vectors = spark.createDataFrame([*good, *odd, *flat], "vec_id long, embedding array<double>").withColumn("n", F.lit("clash"))
    rows = whiten.Whitening(spark, vectors).transform().collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r["vec_id"]].append(r)
    assert len(rows) == 50 * 3 + 4 * 2 and set(by) == {*range(50), 200, 201, None} and all(len(by[i]) == 3 and by[i][0]["n"] == 50 for i in range(50))
    assert sorted((r["component"], r["whitened"] is None, r["n"]) for r in by[201]) == [(1, False, 4)] * 2 + [(2, True, 4)] * 2
    assert all(r["identity_error"] < 1e-9 for r in rows)
    assert [r["whitened"] is None for r in whiten.Whitening(spark, vectors.where("vec_id = 7")).transform().collect()] == [True] * 3  # one row has no spread
    assert whiten.Whitening(spark, vectors.limit(0)).transform().count() == 0
    again = whiten.Whitening(spark, vectors.repartition(7)).transform().collect()
    assert all(abs(a["whitened"] - b["whitened"]) < 1e-9 for a, b in zip(*(sorted((r for r in x if r["whitened"] is not None and r["vec_id"] is not None), key=lambda r: (r["vec_id"], r["component"])) for x in (rows, again)), strict=True))


def test_whitening_is_exact_for_large_entries(spark):
    rng = np.random.default_rng(1)
    for bits in (10, 30, 40, 46, 50, 60):
        y = rng.integers(-(1 << bits), 1 << bits, (5, 64))
        assert whiten.deviations(y) == [sum(int(v) ** 2 for v in r) for r in y]
    x = rng.integers(-(1 << 61), 1 << 61, (7, 3))
    s = x.astype(object).sum(0).tolist()
    assert (whiten.numerators(x, 7, s) == 7 * x.astype(object) - np.array(s, dtype=object)).all()
    assert whiten._exact_sums(x) == s


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_hits(docs, items, window=10):
    cut = lambda t: WORDS.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    held = collections.defaultdict(set)
    for item, text in items:
        w = cut(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            held[tuple(w[i : i + n])].add("" if item is None else str(item))
    out = []
    for d, text in docs:
        w, hit, found = cut(text), set(), set()
        for n in {len(x) for x in held}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in held:
                    hit.update(range(i, i + n))
                    found |= held[tuple(w[i : i + n])]
        out.append((d, len(w), len(hit), tuple(sorted(found))))
    return collections.Counter(out)


def windows_in(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("h", F.lit("clash"))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("clash"))
    out = decontaminate.Decontamination(spark, d, i, **more)
    return out, collections.Counter((r["key"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in out.report().collect())


def test_windows_against_a_plain_model(spark):
    rng = random.Random(8)
    vocab = ["the", "of", "É", "文字", "A1", "x", "straße", *(f"w{k}" for k in range(60))]
    say = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", " ", ", ", "\n", "--", " \t"]) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 3, 5, 9, 10, 11, 14, 40]))) for i in range(40)]
    items += [(50, None), (51, " ,."), (52, "the"), (None, say(12)), (3, say(12)), (60, items[8][1]), (61, items[8][1].upper())]
    docs = []
    for d in range(250):
        parts = [say(rng.randrange(0, 40))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            w = rng.choice(items)[1] or ""
            lo = rng.randrange(0, max(1, len(w) // 2))
            parts += [w[lo : lo + rng.choice([30, 60, 400])], say(rng.randrange(0, 15))]
        docs.append((d, " ".join(parts)))
    docs += [(300, None), (301, ""), (302, "the"), (None, items[8][1]), (5, docs[5][1]), (303, (items[8][1] + " ") * 400)]
    got, rows = windows_in(spark, docs, items)
    assert rows == plain_hits(docs, items)
    assert sum(n for (_, _, hit, _), n in rows.items() if hit) > 100
    spans = got.spans().collect()
    assert spans and all(r["stop"] - r["start"] == len(r["words"].split(" ")) for r in spans)


def test_windows_of_nothing(spark):
    docs = [(1, "a b c"), (2, None)]
    for items in ([], [(1, None)], [(1, "z y x")]):
        assert windows_in(spark, docs, items)[1] == plain_hits(docs, items)
    assert not windows_in(spark, [], [(1, "a b")])[1]


def test_words_are_hashed_alike_across_blocks(monkeypatch):
    texts = ["Ab--céé d9", None, "", "x" * 5000 + " y", " ", "tail"]
    whole = decontaminate.words_of(pa.array(texts))
    monkeypatch.setattr(decontaminate, "BLOCK", 3)
    small = decontaminate.words_of(pa.array(["skipped", *texts]).slice(1))
    assert (whole.hashes == small.hashes).all() and (whole.first == small.first).all() and whole.text(0, 3) == small.text(0, 3) == "ab céé d9"
    assert np.diff(whole.first).tolist() == [3, 0, 0, 2, 0, 1]


def test_bitmap_knows_its_hashes(spark):
    h = spark.range(5000).select(F.xxhash64("id").alias("h"))
    held = decontaminate.bitmap(spark, h, 5000).value
    own = np.array([r[0] for r in h.collect()]).view(np.uint64)
    assert len(decontaminate._wanted(own, held)) == 5000 and held[0] >= 5000 * decontaminate.BITS_EACH
    other = np.random.default_rng(1).integers(0, 1 << 62, 20_000).astype(np.uint64)
    assert len(decontaminate._wanted(other, held)) < 0.03 * 20_000
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
