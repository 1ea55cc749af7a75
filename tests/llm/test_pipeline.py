"""The pipeline's stages, each against a plain model of its own input."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    say = {"aa": [f"{a}{b}" for a in "klmr" for b in ("aka", "ala", "ara", "ana")], "bb": [f"{a}{b}" for a in "klmr" for b in ("imi", "ini", "ipi", "iti")]}
    passage = " ".join(rng.choice(say["aa"]) + str(i) for i in range(60))
    out = []
    for i in range(80):
        lang = ("aa", "bb")[i % 2]
        lines = [" ".join(rng.choice(say[lang]) + rng.choice(say[lang]) for _ in range(rng.randrange(60, 90))) for _ in range(3)]
        if i % 10 == 0:
            lines.insert(1, passage)
        out.append((i, "\n".join(lines), lang if i % 7 else None, f"s{i % 4}"))
    for i in range(80, 100):  # near copies: every line with an edit, so line deduplication leaves them
        out.append((i, "\n".join(x + " end" for x in out[i - 80][1].split("\n")), out[i - 80][2], "s0"))
    out += [(100, None, "aa", "s1"), (101, "", "aa", "s1"), (102, "123 456", "aa", "s2"), (103, out[5][1], "bb", None), (104, "kaka mala " * 3000, "aa", "s3"), (None, "no id " + out[3][1], "bb", "s1"), (7, *out[7][1:])]
    return [(*r, len(r[1] or "")) for r in out]


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def shingles(t, k=5):
    w = WORD.findall(t.lower())
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def test_stages(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("component", "class", "h", "size", "__id_pred", "n_lines_left", "taken", "ids"):
        docs = docs.withColumn(name, F.lit("clash"))
    seen = []
    for name, stage in P.STAGES:
        out = stage(spark, docs, "")
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert tuple(out.columns) == P.COLUMNS
        seen.append(out)
        docs = out
    language, lines, near, mixed, packed = seen

    left = {r["doc_id"] for r in language.collect()}
    assert left == {r[0] for r in rows} - {100, 101, 102}
    assert language.where("lang IS NULL").count() == 0

    before, after = dict(texts(language)), dict(texts(lines))
    passage = before[0].split("\n")[1]
    assert [d for d, t in after.items() if passage in t.split("\n")] == [0]
    assert 103 not in after  # nothing was left of it
    assert all(set(t.split("\n")) <= set(before[d].split("\n")) for d, t in after.items())

    kept = texts(near)
    sets = [(d, shingles(t)) for d, t in texts(lines)]
    groups = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if 100 * len(a & b) >= 80 * len(a | b):
                old, new = groups[i], groups[j]
                groups = [new if g == old else g for g in groups]
    by = collections.defaultdict(list)
    for g, (d, _) in zip(groups, sets, strict=True):
        by[g].append(d)
    assert sorted((d for d, _ in kept), key=str) == sorted((min((d for d in v if d is not None), default=None) for v in by.values()), key=str)
    assert {d for d, _ in kept} & set(range(80, 100)) == set()

    size = {d: len(WORD.findall(t)) for d, t in kept}
    got = collections.Counter()
    for d, t in texts(mixed):
        got[d] += len(WORD.findall(t))
    assert all(n <= 2 * size[d] for d, n in got.items())
    assert abs(sum(got.values()) - 1.5 * sum(size.values())) <= 200

    from tokenizers import Tokenizer
    import public_tokenizers

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = sum(len(tok.encode(t, add_special_tokens=False).ids) + 1 for _, t in texts(mixed))
    used, sizes = collections.Counter(), []
    for r in packed.collect():
        used[r["sequence_id"]] += r["length"]
        sizes.append(r["length"])
    bins: list[int] = []  # best fit with all bins open, the longest first
    for n in sorted(sizes, reverse=True):
        fits = [i for i, free in enumerate(bins) if free >= n]
        if fits:
            bins[min(fits, key=bins.__getitem__)] -= n
        else:
            bins.append(1024 - n)
    assert sum(used.values()) == total and max(used.values()) <= 1024
    assert len(used) == len(bins)


def test_stages_on_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in P.STAGES:
        assert stage(spark, docs, "").count() == 0


@pytest.mark.parametrize("name", ["op2_jaccard", "op8_sharding", "op10_embed"])
def test_queries_match_their_sql(spark, name):
    import duckdb

    from evidlake.llm import queries as q

    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{table}.parquet')")
    rel = con.sql(q.oracle_sql()[name])
    df = q.queries()[name](spark, "/root/testdata/sf0.001")
    assert sorted(df.columns) == sorted(rel.columns)
    assert sorted(map(str, (tuple(r) for r in df.select(*rel.columns).collect()))) == sorted(map(str, rel.fetchall()))


def test_registration():
    import __spark_entry__ as e

    names = list(e.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert [n for n, _ in P.STAGES] == ["language", "line_dedup", "near_duplicates", "mixing", "packing"] and P.ORACLE_SQL is None
