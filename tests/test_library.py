"""Functions, segmentation, sources and sinks against plain models."""

import json
import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from evidlake.functions import nested as N
from evidlake.functions import text as X
from evidlake.operators import matching as M
from evidlake.operators import relational as R
from evidlake.operators import segment as S
from evidlake.plans import release as P
from evidlake.sources import readers, writers
from evidlake.streaming import events as E


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "c string").select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("value", "expr", "want"),
    [
        (None, lambda: X.clean("c"), ""),
        ("a b\t\n c\x01d", lambda: X.clean("c"), "a b c d"),
        ("CRÈME brûlée", lambda: X.norm("c"), "CR ME BR L E"),
        ("CRÈME brûlée ß", lambda: X.norm_folded("c"), "CREME BRULEE SS"),
        ("l'eau d’Œuf", lambda: X.key_text("c"), "LEAU DOEUF"),
        ("Doli® 500mg (fr)", lambda: X.norm_key("c"), "DOLI 500MG"),
        ("ab-12 3/x", lambda: X.norm_code("c"), "AB123X"),
        ("", lambda: X.append_flag("c", "f"), "f"),
        ("ok", lambda: X.append_flag("c", "f"), "f"),
        ("f", lambda: X.append_flag("c", "f"), "f"),
        ("g", lambda: X.append_flag("c", "f"), "g;f"),
        ("Ã©tÃ©", lambda: X.repair("c"), "été"),
        ("a; b and c/d, e", lambda: F.array_join(X.split_names("c"), "|"), "a|b|c|d|e"),
        ("12abc", lambda: X.safe_int("c", 5), 5),
        ("<p>a</p><script>x</script><p>b &amp; c</p>", lambda: X.strip_html("c"), "a\nb & c"),
        ("Doliprane 500 MG B/20", lambda: X.product_base("c"), "Doliprane"),
        ("%PDF-1.7", lambda: X.magic(F.col("c").cast("binary")), "pdf"),
    ],
)
def test_text(spark, value, expr, want):
    assert one(spark, value, expr()) == want


def test_normal_forms_are_idempotent(spark):
    df = spark.createDataFrame([("Été  ß µg",), ("x-1 (y)",), (None,)], "c string")
    for f in (X.clean, X.norm, X.norm_folded, X.key_text, X.norm_code, X.slug):
        assert df.where(f(f("c")) != f("c")).count() == 0


def test_sections_partition_and_respect_limits():
    body = "Traitement de longue durée. " * 6
    t = f"Entête\n4.1 Indications thérapeutiques\n{body}\n4.3 Contre-indications\n{body}\n4.9 Surdosage\n{'x' * 30000}"
    got = S.sections(t, S.FRENCH)
    assert [s.kind for s in got] == ["indication", "contraindication", "overdose"]
    assert all(a.end == b.start for a, b in zip(got, got[1:], strict=False)) and got[-1].end - got[-1].start == 12000
    assert all(t[s.start : s.end].strip() == s.text for s in got)
    assert S.sections("4.9 Surdosage\nshort", S.FRENCH) == [] and S.sections(None, S.FRENCH) == []
    assert S.strict_then_words("")[0] == "no_text_extracted"
    kind, words = S.strict_then_words("La posologie est " + "y" * 1200 + " et le surdosage " + "z" * 200)
    assert kind == "fallback" and [s.kind for s in words] == ["dosage", "overdose"]
    for lang, titles in S.NUMBERED.items():
        doc = "\n".join(f"{n} {title}\n{'word ' * 30}" for n, (_, title) in zip(S.NUMBERS, titles, strict=True))
        assert [s.kind for s in S.sections(doc, S.numbered_rules(lang))] == [k for k, _ in titles]


def test_items_of_nested_responses(spark):
    fields = ("resultados", "data", "results", "items", "medicamentos", "content")

    def plain(v):
        if isinstance(v, list):
            return [x for x in v if isinstance(x, dict)]
        if not isinstance(v, dict):
            return []
        for f in fields:
            if isinstance(v.get(f), list):
                return [x for x in v[f] if isinstance(x, dict)]
            if isinstance(v.get(f), dict) and (inner := plain(v[f])):
                return inner
        return [v] if any(k.lower() in ("nregistro", "nombre", "pactivos", "labtitular") for k in v) else []

    rng = random.Random(4)

    def make(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.2:
            return rng.choice([1, "x", "[1]", '{"nombre": 1}', None, True, 2.5, "é \" \n"])
        if kind < 0.45:
            return [make(depth - 1) for _ in range(rng.randrange(3))]
        return {rng.choice([*fields, "Nombre", "NREGISTRO", "other", "é"]): make(depth - 1) for _ in range(rng.randrange(4))}

    docs = [make(3) for _ in range(300)] + [{"data": {"results": {"items": [{"a": 1}]}}}, {"resultados": [], "data": [{"a": 1}]}, {"resultados": {"items": []}, "data": [{"a": 1}]}]
    rows = [(i, json.dumps(x, ensure_ascii=False)) for i, x in enumerate(docs)] + [(-1, "{broken"), (-2, None), (-3, "")]
    got = {r["i"]: [json.loads(x) for x in r["items"]] for r in spark.createDataFrame(rows, "i long, j string").select("i", N.json_items("j").alias("items")).collect()}
    assert [(x, got[i], plain(x)) for i, x in enumerate(docs) if got[i] != plain(x)] == []
    assert got[-1] == got[-2] == got[-3] == []
    held = spark.createDataFrame([('{"a": {"Name": {"x": [1, " b "]}, "name": ["u", ["v", {"name": "w"}]]}}',)], "j string").select(N.json_values("j", ["name"]).alias("v")).first()["v"]
    assert held == ['{"x": [1, " b "]}', 'u v {"name": "w"}', "w"]
    maps = spark.createDataFrame([({"Nombre": None, "name": "b"},), ({"X": "1", "NAME": "  b "},), ({},), (None,)], "m map<string,string>")
    assert [r[0] for r in maps.select(N.pick_key("m", "nombre", "name")).collect()] == ["", "b", "", ""]


def test_pieces_are_those_of_a_plain_walk(spark):
    def plain(text, most, after, least):
        out, pos = [], 0
        while pos < len(text):
            rest = text[pos : pos + most]
            cut = rest.rfind("\n", after + 1) if pos + most < len(text) else -1
            pos, piece = (pos + cut, rest[:cut]) if cut > 0 else (pos + most, rest)
            out += [piece.strip()] * (len(piece.strip()) >= least)
        return out

    rng = random.Random(5)
    texts = ["".join(rng.choice("ab \n" if k % 2 else "abcdefgh\n") for _ in range(rng.randrange(0, 400))) for k in range(200)] + ["x" * 1000, "\n" * 300, None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", S.chunked(F.col("t"), 50, 20, 5).alias("p")).collect()
    assert all(r["p"] == S.chunks(r["t"], 50, 20, 5) == plain(r["t"] or "", 50, 20, 5) for r in rows)


def test_chunks():
    t = ("line of text here\n" * 2000).strip()
    got = S.chunks(t)
    assert all(200 <= len(x) <= 4500 for x in got) and re.sub(r"\s", "", "".join(got)) in re.sub(r"\s", "", t)
    assert S.chunks("a" * 199) == [] and len(S.chunks("a" * 9500)) == 3


def test_sequence_ratio_is_difflib(spark):
    rows = [("doliprane", "doliprane 500"), ("", "x"), ("abc", "abd"), ("x" * 250, "x" * 249 + "y")]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", M.sequence_ratio("a", "b").alias("r")).collect()
    assert all(r["r"] == difflib.SequenceMatcher(None, r["a"], r["b"]).ratio() for r in got)


def test_release_invariants(spark):
    rows = [(1, "D_support", "indication", False), (2, "A_local", "identity", False), (3, "A_local", "indication", True), (4, "B_x", "indication", False)]
    df = spark.createDataFrame(rows, "id int, tier string, kind string, mismatch boolean").withColumn("accepted", F.lit(True)).withColumn("quality_flags", F.lit("ok"))
    got = P.corrected(df, F.col("mismatch")).collect()
    assert [r["id"] for r in got if r["accepted"]] == [4]
    assert sum(r["fix_support"] + r["fix_metadata"] + r["fix_mismatch"] for r in got) == 3
    graded = P.graded(spark.createDataFrame([("chembl_ebi_api", "X", 1), ("other", "Y", 2)], "source_system string, tier string, rank int")).collect()
    assert [(r["tier"], r["rank"]) for r in graded] == [("D_support_pharmacology", 56), ("Y", 2)]


def test_sources_and_sinks(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text('﻿Row_ID,nom\n1,"a\nb ""q"""\n2,\n', encoding="utf-8")
    df = readers.csv(spark, str(p), ["row_id", "nom", "amm"])
    assert [tuple(r) for r in df.orderBy("row_id").collect()] == [("1", 'a\nb "q"', ""), ("2", "", "")]
    assert readers.csv(spark, str(tmp_path / "none.csv"), ["a"]).count() == 0
    writers.csv(df, str(tmp_path / "out"), ["nom", "row_id", "more"], single=True)
    assert spark.read.option("header", True).option("multiLine", True).csv(str(tmp_path / "out")).columns == ["nom", "row_id", "more"]
    t = tmp_path / "x.txt"
    t.write_bytes("1\té\n2\n".encode("latin-1"))
    assert [tuple(r) for r in readers.tab_export(spark, str(t), ["a", "b", "c"]).orderBy("a").collect()] == [("1", "é", ""), ("2", "", "")]
    j = tmp_path / "j"
    j.mkdir()
    (j / "a.json").write_text('{"a":1}')
    (j / "b.json").write_text("")
    assert readers.json_documents(spark, str(j)).where("parsed IS NOT NULL").count() == 1
    x = tmp_path / "r.xml"
    x.write_text("<all><rec><n>One</n></rec><rec><n>Two</n></rec></all>")
    assert readers.xml_records(spark, str(x), "rec", ["two"]).count() == 1
    old, new = spark.createDataFrame([(1, "o"), (2, "o")], "k int, v string"), spark.createDataFrame([(2, "n"), (3, "n")], "k int, v string")
    assert sorted(tuple(r) for r in writers.upsert(old, new, ["k"]).collect()) == [(1, "o"), (2, "n"), (3, "n")]
    assert sorted(tuple(r) for r in writers.upsert(old, new, ["k"], replace=False).collect()) == [(1, "o"), (2, "o"), (3, "n")]


def test_binary_documents(spark, tmp_path):
    import zipfile

    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 body")
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("in/c.html", "<p>x</p>")
    got = readers.document_text(readers.contents(spark, str(tmp_path)), parse_pdf=lambda b: "pdf text").collect()
    assert {(r["path"].rsplit("/", 1)[1], r["kind"], r["status"]) for r in got} == {("a.pdf", "pdf", "ok"), ("c.html", "markup", "ok")}
    none = readers.document_text(readers.contents(spark, str(tmp_path), "*.pdf")).first()
    assert none["status"] == "no_parser"
    assert readers.files(spark, str(tmp_path)).count() == 2


def test_row_ids_are_gapless(spark):
    df = R.with_row_id(spark.range(1000).selectExpr("(id * 7919) % 1000 AS v"), [F.col("v")])
    assert df.where("row_id <> v + 1").count() == 0 and df.count() == 1000


def test_stream_equals_batch(spark, tmp_path):
    src = "/root/testdata/sf0.001"
    q = E.windowed(E.read(spark, src), late="400 days").writeStream.format("memory").queryName("w").outputMode("complete").option("checkpointLocation", str(tmp_path)).start()
    try:
        q.processAllAvailable()
        got = {(r["start"], r["event_type"], r["n"]) for r in spark.table("w").collect()}
    finally:
        q.stop()
    want = {(r["start"], r["event_type"], r["n"]) for r in E.windowed(spark.read.parquet(f"{src}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))).collect()}
    assert got == want and got


def test_jobs_run_queries_and_write_results(spark, tmp_path):
    from evidlake.__main__ import Job, parse

    job = parse(["source_audit", "--tables", "/root/testdata/sf0.001", "--out", str(tmp_path / "x"), "--format", "csv"])
    assert job == Job("source_audit", "/root/testdata/sf0.001", str(tmp_path / "x"), "csv")
    n = job.run(spark).count()
    assert spark.read.option("header", True).csv(job.out).count() == n > 0
    with pytest.raises(ValueError, match="no query named"):
        Job("none", ".").run(spark)


def test_index_lookup_prefers_equal_keys_and_finds_parts_of_words(spark):
    names = spark.createDataFrame([(1, "amoxicillin 500"), (2, "moxi tablets"), (3, "none here"), (4, "a b"), (5, None)], "id int, name string")
    keys = spark.createDataFrame([("amoxicillin 500",), ("amoxicillin",), ("amoxicillin tablets",), ("zz amoxi tablets",)], "k string")
    got = {r["id"]: r["hit"] for r in M.index_lookup(names, keys, "id", "name", "k").collect()}
    assert got == {1: "amoxicillin 500", 2: "amoxicillin tablets", 3: None, 4: None, 5: None}


def test_blocks_with_hot_words_share_what_they_share(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    draw = lambda: list({rng.choice(words[: rng.choice([3, 30])]) for _ in range(rng.randrange(1, 9))})
    a, b = [(i, draw()) for i in range(60)], [(i, draw()) for i in range(40)]
    left, right = spark.createDataFrame(a, "x int, tokens array<string>"), spark.createDataFrame(b, "y int, tokens array<string>")
    want = {(i, j): len(set(s) & set(t)) for i, s in a for j, t in b}
    for least in (1, 2, 4):
        got = {(r["x"], r["y"]): r["shared"] for r in R.blocked(left, right, "x", "y", least=least).collect()}
        assert got == {k: n for k, n in want.items() if n >= least}


def test_adapter_searches_once_for_equal_rows(spark):
    """Every row has the sections of its best record that has any; records meet equal rows once."""
    from evidlake.operators import routing as G

    rows = spark.createDataFrame([(i, i % 3, "x" if i % 2 else None) for i in range(300)], "k long, block int, w string")
    recs = spark.createDataFrame([(i, i % 3, None if i % 5 == 0 else f"t{i}") for i in range(300)], "r long, block int, t string")
    sections = F.when(F.col("t").isNotNull(), F.array(F.struct(F.lit("a").alias("kind"), F.lit("T").alias("title"), F.col("t").alias("text"))))
    score = F.when(F.col("w").isNull(), (F.col("r") % 10) / 10.0).otherwise((F.col("r") % 7) / 7.0)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    got = {r["k"]: (r["r"], r["text"]) for r in G.adapter(rows, recs, "block", "k", "r", counted(score), 0.5, F.coalesce(sections, F.array().cast("array<struct<kind:string,title:string,text:string>>"))).collect()}
    want = {}
    for k in range(300):
        rank = lambda r: (r % 7) / 7.0 if k % 2 else (r % 10) / 10.0  # noqa: B023, E731
        best = sorted((-rank(r), r) for r in range(300) if r % 3 == k % 3 and rank(r) >= 0.5)[:3]
        first = next((r for _, r in best if r % 5), None)
        if first is not None:
            want[k] = (first, f"t{first}")
    assert got == want and len(got) > 50 and seen.value < 3_000  # all pairs: 30,000


def test_segments_are_made_a_few_documents_at_a_time(spark, monkeypatch):
    """Of a large batch of documents the sections of a slice are handed on before the next slice is read."""
    from evidlake.operators import segment as S

    sizes = []

    class Frame:
        dtypes = [("k", "bigint")]

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            import pyarrow as pa

            n = 10 * S.SLICE + 3
            batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([None if i == 5 else "y" * i for i in range(n)])], ["k", "t"])
            sizes.extend(b.num_rows for b in run(iter([batch])))
            return sizes

    how = lambda t: [S.Section("a", "T", x, 0, 1) for x in (t or "")[:2]]
    S.segment(Frame(), "k", "t", how)
    assert len(sizes) == 11 and max(sizes) <= 2 * S.SLICE and sum(sizes) == 2 * (10 * S.SLICE + 3) - 2 - 1 - 2
    sizes.clear()
    S.statuses(Frame(), "k", "t", lambda t: ("ok", how(t)))
    assert sizes == [S.SLICE] * 10 + [3]
