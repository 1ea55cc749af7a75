"""Steps that must not grow faster than their input: what is made once a row, read in slices, or never shuffled."""

import random
import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from evidlake import catalogue_marks, catalogue_rules
from evidlake.functions import nested as N
from evidlake.functions import unicode as U
from evidlake.operators import containment as C
from evidlake.operators import relational as R
from evidlake.operators import segment as S
from evidlake.plans import coverage as V


def uses(column, name="the_text"):
    """How often an expression names a column."""
    return column._jc.toString().count(name)


def test_a_text_is_named_once_by_folding(spark):
    assert uses(U.fold(F.col("the_text"))) == 1


def test_a_text_is_named_once_by_document_kinds(spark):
    assert uses(S.document_kind(F.col("the_text"))) == 1


def test_a_text_is_named_once_by_language(spark):
    assert uses(S.language(F.col("the_text"), F.col("the_name"))) == 1
    assert uses(S.language(F.col("the_text"), F.col("the_name")), "the_name") == 1


def test_a_text_is_named_once_by_name_candidates(spark):
    assert uses(S.name_candidates(F.col("the_text"))) == 1


def test_letters_of_a_document_are_made_once(spark):
    assert uses(catalogue_rules._document(catalogue_rules.HEADINGS["es"], " "), "regexp_replace") == 1


def test_folding_looks_a_character_up_once_a_text(monkeypatch):
    class Counted(dict):
        asked = 0

        def get(self, *args):
            Counted.asked += 1
            return dict.get(self, *args)

    known = Counted(U.table())
    monkeypatch.setattr(U, "table", lambda: known)
    assert U.folded("É tañ é" * 500, lower=True) == ("e tan e" * 500, None)
    assert Counted.asked <= 3


def test_folding_in_python_is_that_of_every_character():
    one = lambda c: U.table().get(c, c) if c > "\x7f" else c
    for text in ("ΟΔΟΣ ΣΑΣ", "ǽ und æ", "ǽ", "İstanbul ŞĞ", "½ ﬁ x", "áé", "Ünï 中", unicodedata.normalize("NFD", "kůň"), "Ⅷ", "ÅÄÖ åäö"):
        for lower in (False, True):
            parts = [one(c).lower() if lower else one(c) for c in text]
            low, places = U.folded(text, lower)
            assert low == "".join(parts)
            assert list(range(len(text)) if places is None else places) == [i for i, p in enumerate(parts) for _ in p]


def _plan(df):
    return [(len(x) - len(x.lstrip(" :+-|")), x.lstrip(" :+-|").split(" ")[0]) for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines()]


def _over_joins(df):
    """Aggregates that read what a join made."""
    plan = _plan(df)
    below = lambda n: [x for x in plan[n + 1 : next((m for m in range(n + 1, len(plan)) if plan[m][0] <= plan[n][0]), len(plan))]]
    return [x for n, (_, x) in enumerate(plan) if x == "Aggregate" and any(y == "Join" for _, y in below(n))]


def test_pairs_of_preferred_rows_are_made_last(spark):
    assert _over_joins(catalogue_marks.preferred_rows(spark, "/root/testdata/sf0.001")) == []


def test_preferred_pairs_are_those_of_preferred(spark):
    rng = random.Random(5)
    some = lambda *xs: rng.choice([*xs, None])
    rows = spark.createDataFrame([(n % 70, some("a", "b"), some("x", "y"), some("t", "u", "v")) for n in range(90)], "k long, name string, brand string, kind string")
    asked = F.when(F.col("k") % 5 > 0, F.col("k") % 3 > 0)
    cands = rows.select(F.col("k").alias("cand"), "name", "brand", F.col("kind").alias("other"))
    pairs = rows.join(cands, ["name", "brand"]).where("k <> cand")
    new = R.preferred_pairs(rows, "k", "cand", ["name", "brand"], "kind", asked)
    for strict in (False, True):
        want = R.preferred(pairs.dropDuplicates(["k", "cand", "kind", "other"]), "k", F.col("kind") == F.col("other"), asked, strict=strict).select("k", "cand", "narrowed")
        got = new.where("strict") if strict else new
        key = lambda df: {tuple(r) for r in df.select("k", "cand").collect()}
        first = rows.groupBy("k").count().where("count = 1").select("k")
        assert key(got.join(first, "k")) == key(want.join(first, "k"))


def test_nested_documents_are_taken_apart_in_slices():
    batch = pa.array([str(n) for n in range(3 * N.SLICE + 5)] + [None])
    held, most = [], 0

    def one(doc):
        held.append(doc)
        return [("kind", "title", doc)] if doc else []

    got = []
    for part in N._sliced(one)(iter([batch, pa.array([], pa.string())])):
        most, held = max(most, len(held)), []
        got.extend(part.to_pylist())
    assert most <= N.SLICE and [x[0]["text"] if x else None for x in got] == batch.to_pylist()


def test_sections_of_broken_documents_are_none(spark):
    rows = spark.createDataFrame([(n, None if n % 3 == 0 else "{" if n % 3 == 1 else "[1]") for n in range(100)], "k long, doc string")
    got = rows.select("k", N.json_titled("doc", str).alias("j"), N.xml_label_sections("doc").alias("x")).collect()
    assert len(got) == 100 and all(r["j"] == [] and r["x"] == [] for r in got)


def test_lines_are_ranked_before_they_meet_orders(spark):
    plan = _plan(catalogue_marks.first_productive_of_three(spark, "/root/testdata/sf0.001"))
    windows = [n for n, (_, x) in enumerate(plan) if x == "Window"]
    assert windows and not any(x == "Join" and m > n and all(plan[i][0] > plan[n][0] for i in range(n + 1, m + 1)) for n in windows for m, (_, x) in enumerate(plan))


def test_the_whole_registry_is_no_join_key(spark):
    text = catalogue_marks.narrowed_registry(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "inline(array(" in text and "array([all,]" not in text


def test_rows_of_a_common_needle_are_made_in_cells(spark, monkeypatch):
    monkeypatch.setattr(R, "SIDE", 8)
    monkeypatch.setattr(R, "PAIRS", 200)
    texts = [(n, "x12" if n % 2 else f"y{n}x12") for n in range(60)] + [(None, "x12"), (7, "x12"), (9, None), (10, "z")]
    needles = [(n, "12" if n % 3 else "x") for n in range(50)] + [(None, "12"), (3, "12"), (4, "")]
    got = C.holders(spark, spark.createDataFrame(texts, "t long, text string"), spark.createDataFrame(needles, "n long, needle string"), "t", "text", "n", "needle").withColumn("p", F.spark_partition_id()).collect()
    assert Counter((r["t"], r["n"]) for r in got) == Counter((t, n) for t, text in texts for n, needle in needles if text and needle and needle in text)
    tasks = Counter(r["p"] for r in got)
    assert len(tasks) > 8 and max(tasks.values()) < len(got) / 4


def test_bulk_search_reads_a_record_once(spark):
    rng = random.Random(3)
    words = ["ASPIRIN", "DOLO", "DOLORAN", "RANI", "MG", "ABCDE", "BCDE"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(rng.randrange(n)))
    queries, records = [(n, say(7)) for n in range(30)] + [(30, None), (31, "DOLO DOLO RANI")], [(n, say(9)) for n in range(80)] + [(80, None), (81, "DOLORAN")]
    got = V.bulk_search(spark.createDataFrame(queries, "q long, norm string"), spark.createDataFrame(records, "r long, the_text string").select("r", F.col("the_text").alias("norm")), "q", "r", k=20, per_word=10)
    assert "the_text" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = set()
    for q, text in queries:
        asked = [w for w in (text or "").split() if len(w) >= 4]
        near = {r for w in asked for r in [r for r, t in records if w in (t or "").split()][:10]}
        scored = sorted((-round(sum(w in t for w in asked) / len(asked) + 0.2 * (text in t), 4), r) for r, t in records if r in near)
        want |= {(q, r, -s, n) for n, (s, r) in enumerate(scored[:20], 1)}
    assert {(x["q"], x["r"], x["score"], x["rank"]) for x in got.collect()} == want and len(want) > 100


def test_marked_texts_in_rounds(spark):
    texts, needles = [(1, "AB CDE"), (2, "CDE"), (2, "CDE"), (3, None), (4, "XABX CD")], ["AB", "CDE", "CD", "AB CDE", None, "", "AB"]
    for size in (1 << 20, 30):
        got = C.marked(spark.createDataFrame(texts, "k long, text string"), spark.createDataFrame([(n,) for n in needles], "n string"), "k", "text", size=size).collect()
        assert sorted((r["k"], sorted(r["words"]), sorted(r["held"])) for r in got) == [(1, ["AB", "CDE"], ["AB", "AB CDE", "CD", "CDE"]), (2, ["CDE"], ["CD", "CDE"]), (2, ["CDE"], ["CD", "CDE"]), (3, [], []), (4, ["CD"], ["AB", "CD"])]


def test_rules_are_tried_only_where_their_letters_stand():
    rules = [p for profile in S.PROFILES.values() for _, p in profile.rules]
    assert sum(bool(S._begins(p)) for _, p in S.SWISS) == len(S.SWISS)
    rng = random.Random(8)
    words = sorted({w for p in rules for w in re.findall("[a-z]{4,}", p)}) + ["4.1", "4.1.", "/", "et", "in", "d'emploi", "and", "x"]
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "s ", "\n", "/", "-", "", "_"]) for _ in range(40))
        for p in rules:
            for flags in (0, re.M):
                assert [m.span() for m in S._matches(p, text, flags)] == [m.span() for m in re.finditer(p, text, flags)]
