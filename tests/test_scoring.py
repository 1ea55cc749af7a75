"""Scores, threshold joins, containment, narrowing and waterfalls against plain models over all pairs."""

import random
import re
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from evidlake.operators import containment as C
from evidlake.operators import registry as L
from evidlake.operators import routing as G
from evidlake.operators import scoring as K

MEDICINE = "m long, m_brand string, m_generic string, m_lab string, m_form string, m_dose string"
RECORD = "r long, name string, active string, holder string, form string, dose string, combined string, context string, head string, numbers array<string>, has_sections boolean, kind string"


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("ABC") for _ in range(rng.choice([2, 3, 4, 5, 6])))
    pool = [word() for _ in range(40)] + ["ACIDE", "VACCIN", "MG", "POUR", "20", "5"]
    say = lambda lo, hi: " ".join(rng.choice(pool) for _ in range(rng.randrange(lo, hi)))
    meds = [(i, say(0, 4), say(0, 3), say(0, 4), say(0, 3), rng.choice(["", "5 MG", "20 MG", "2 5 ML"])) for i in range(70)]
    recs = []
    for i in range(70):
        m = rng.choice(meds)
        name = rng.choice([m[1], f"{m[1]} {say(0, 2)}".strip(), f"{say(1, 2)} {m[1]}".strip(), say(0, 4), m[1].split(" ")[0]])
        active, holder, form, dose = rng.choice([m[2], say(0, 3), f"{m[2]}X"]), rng.choice([m[3], say(0, 3), ""]), rng.choice([m[4], say(0, 3)]), rng.choice(["", "5 MG", "20 MG TABLET"])
        recs.append((i, name, active, holder, form, dose, f"{name} {active} {dose}", holder, f"{name} {active} {form}", re.findall(r"\d+", dose), i % 2 == 0, rng.choice(["SMPC", "PIL"])))
    return meds, recs


def first(ws):
    return ws[0] if ws else ""


def plain_score(source, m, r):
    """A source's score, part by part."""
    _, brand, generic, lab, form, dose = m
    _, name, active, holder, rform, rdose, combined, context, head, numbers, sections, _ = r
    token = first([w for w in brand.split() if len(w) >= 3])
    lab_in = lambda f: bool(lab and f and any(w in f for w in lab.split()[:3] if len(w) >= 4))
    form_in = lambda f: bool(form and f and any(w in f for w in form.split() if len(w) >= 5))
    either = lambda hay, a, b: a if brand and brand in hay else b if token and name.startswith(token) else 0
    if source == "bdpm":
        return min(0.95, 0.55 * bool(generic and (generic in active or generic in name)) + 0.35 * bool(brand and brand in name) + 0.05 * bool(form and form in rform) + 0.05 * bool(dose and dose in rdose))
    if source == "cima":
        return min(0.95, 0.55 * bool(generic and (generic in active or generic in name)) + either(name, 0.50, 0.45) + 0.05 * lab_in(holder) + 0.03 * bool(dose and rdose and dose in rdose) + 0.02 * form_in(rform))
    if source == "aifa":
        return min(0.95, 0.55 * bool(generic and (generic in active or generic in name)) + either(name, 0.45, 0.40) + 0.05 * lab_in(holder) + 0.03 * form_in(rform) + 0.02 * bool(dose and rdose and dose in rdose))
    if source == "health_canada":
        return min(0.90, either(name, 0.50, 0.42) + 0.35 * bool(generic and generic in active) + 0.05 * lab_in(holder))
    if source == "titck":
        return min(0.95, 0.55 * bool(generic and generic in active) + either(name, 0.45, 0.40) + 0.05 * lab_in(holder))
    if source == "cecmed":
        return min(0.95, 0.55 * bool(generic and generic in combined) + either(combined, 0.52, 0.44) + 0.08 * any(n in combined for n in re.findall(r"\d+(?:[.,]\d+)?", dose)) + 0.05 * lab_in(context))
    words = lambda t, n: [w for w in t.split() if len(w) >= n and w not in K.SWISS_STOP]
    s, own = 0.0, first(words(brand, 3))
    if brand and name:
        s += 0.55 if brand in name or name in brand else 0.40 if own and (name.startswith(own) or own in name.split()[:4]) else 0
    if generic:
        g = words(generic, 4)
        s += 0.30 if active and (generic in active or active in generic) else 0.18 if g and all(w in head for w in g[:2]) else 0.10 if any(w in head for w in g[:3]) else 0
    s += 0.08 * bool(holder and any(w in holder for w in words(lab, 4)[:4])) + 0.04 * bool(set(re.findall(r"\d+(?:[.,]\d+)?", dose)) & set(numbers)) + 0.03 * any(w in head for w in words(form, 5)[:3]) + 0.03 * sections
    return min(0.97, s)


@pytest.mark.parametrize("source", list(K.SOURCES))
def test_threshold_join_is_the_join_of_all_pairs(spark, tables, source):
    meds, recs = tables
    spec = K.SOURCES[source]
    all_ = {(m[0], r[0]): round(plain_score(source, m, r), 4) for m, r in product(meds, recs)}
    got = {(x["m"], x["r"]): x["score"] for x in K.matches(spark, spark.createDataFrame(meds, MEDICINE), spark.createDataFrame(recs, RECORD), source, "m", "r").collect()}
    assert got == {k: s for k, s in all_.items() if s >= spec.threshold}
    assert 20 < len(got) < len(all_) / 2
    every = K.prepared(spark.createDataFrame(meds, MEDICINE)).crossJoin(spark.createDataFrame(recs, RECORD)).select("m", "r", K.score(spec).alias("s")).collect()
    assert {(x["m"], x["r"]): x["s"] for x in every} == all_


def test_no_more_parts_are_indexed_than_needed(spark):
    weights = {s: sorted((p.weight for p in K.decisive(spec, spec.threshold)), reverse=True) for s, spec in K.SOURCES.items()}
    assert weights == {"bdpm": [0.55, 0.35], "cima": [0.55, 0.50, 0.45], "aifa": [0.55, 0.45, 0.40], "health_canada": [0.50, 0.42], "titck": [0.55, 0.45], "cecmed": [0.55, 0.52, 0.44], "swissmedic": [0.55, 0.40, 0.30]}
    with pytest.raises(ValueError):
        K.decisive(K.SOURCES["cima"], 0.05)


def plain_fast(m, r):
    _, brand, generic, lab, _, dose = m
    title, holder, kind = r[1], r[3], r[11]
    own = [w for w in brand.split() if len(w) >= 3 and w not in K.NO_BRAND]
    forms = []
    for v in [brand, re.split(r"\b\d", brand, maxsplit=1)[0].strip(), *(" ".join(own[:k]) if len(own) >= k else "" for k in (3, 2, 1))]:
        if v and v not in forms:
            forms.append(v)
    actives = [w for w in generic.split() if len(w) >= 4 and w not in K.NO_ACTIVE][:8]
    labs = [w for w in lab.split()[:8] if len(w) >= 4]
    doses = list(dict.fromkeys(x.replace(" ", "") for x in re.findall(rf"\d+(?:[.,]\d+)?\s*(?:{K.UNITS})?", f"{dose} {brand}")))
    begins = lambda v: title == v or title.startswith(v + " ")
    na, nl, nd = sum(w in title for w in actives), sum(w in holder or w in title for w in labs), sum(w in title.replace(" ", "") for w in doses)
    first_own = [w for w in (forms[0].split() if forms else []) if len(w) >= 3 and w not in K.NO_BRAND]
    shared = sum(w in title.split() for w in first_own)
    gate = any(len(v) >= 5 and v in title for v in forms[:3]) or len(first_own) >= 2 and shared >= 2 or len(first_own) == 1 and shared == 1 and begins(first_own[0]) or na >= 2 and nl >= 1
    if not gate:
        return 0.0
    at = max([0.80 - 0.03 * i if begins(v) else 0.70 - 0.03 * i if v in title else 0 for i, v in enumerate(forms)], default=0)
    return round(min(0.98, at + min(0.18, 0.06 * na) + min(0.12, 0.05 * nl) + min(0.08, 0.04 * nd) + 0.03 * (kind == "SMPC")), 4)


def test_gated_titles_are_those_of_all_pairs(spark, tables):
    meds, recs = tables
    got = {(x["m"], x["r"]): x["score"] for x in K.fast_matches(spark, spark.createDataFrame(meds, MEDICINE), spark.createDataFrame(recs, RECORD), "m", "r").collect()}
    want = {(m[0], r[0]): s for m, r in product(meds, recs) if (s := plain_fast(m, r)) >= 0.45}
    assert got == want and len(got) > 20


def test_containment_in_ranges(spark):
    rng = random.Random(2)
    say = lambda n: "".join(rng.choice("abé ") for _ in range(rng.randrange(n)))
    texts, needles = [say(30) for _ in range(200)] + [None, ""], [say(6) for _ in range(60)] + [None, "", "x" * 100, "a" * 25]
    want = {(t, n, t.index(n)) for t in texts for n in needles if t and n and n in t}
    for size in (1 << 20, 200):  # one automaton, and many
        got = C.contained(spark, spark.createDataFrame([(t,) for t in texts], "t string"), spark.createDataFrame([(n,) for n in needles], "n string"), size=size)
        rows = [tuple(r) for r in got.collect()]
        assert set(rows) == want and len(rows) == len(want)
    assert C.contained(spark, spark.createDataFrame([], "t string"), spark.createDataFrame([("a",)], "n string")).count() == 0


def plain_narrowed(q, registry):
    """Narrowing and scoring of one query against all rows."""
    weights = {"amm": 100, "nom": 40, **L.SOFT}
    rows = dict(enumerate(registry))
    code = [i for i, r in rows.items() if q["amm"] and r["amm"] == q["amm"]]
    if len(code) == 1:
        return code[0], 100, "AMM exact"
    named = [i for i, r in rows.items() if q["nom"] and r["nom"] == q["nom"]]
    left = set(code or rows) & set(named) if named else set(code or rows)
    if not left:
        return None, 0, "No candidate"
    scored = {i: sum(w for f, w in weights.items() if q[f] and q[f] == rows[i][f]) for i in left}
    best = max(scored.values())
    if best == 0:
        return None, 0, "No scored match"
    tied = [i for i, s in scored.items() if s == best]
    if len(tied) == 1:
        return tied[0], best, "Scored unique"
    shown = [i for i in tied if q["presentation"] and rows[i]["presentation"] == q["presentation"]]
    return (shown[0], best + 1, "Tie-broken by presentation") if len(shown) == 1 else (None, best, f"Ambiguous tie ({len(tied)})")


def test_narrowing_against_all_rows(spark):
    rng = random.Random(6)
    fields = ["amm", "nom", *L.SOFT]
    make = lambda wide: {f: rng.choice(["", *(f"{f}{k}" for k in range(wide if f in ("amm", "nom") else 4))]) for f in fields}
    registry, asked = [make(12) for _ in range(60)], [make(15) for _ in range(400)]
    registry.append({**make(12), "amm": "one"})
    asked += [{**make(15), "amm": "one"}, dict.fromkeys(fields, ""), {**dict.fromkeys(fields, ""), "labo": "none"}]
    df = lambda rows, p, k: spark.createDataFrame([(i, *(r[f] for f in fields)) for i, r in enumerate(rows)], f"{k} long, " + ", ".join(f"{p}{f} string" for f in fields))
    got = {r["id"]: (r["cand"], r["score"], r["outcome"]) for r in L.narrowed(df(asked, "q_", "id"), df(registry, "r_", "cand"), "id", "cand").collect()}
    want = {i: plain_narrowed(q, registry) for i, q in enumerate(asked)}
    assert got == want
    assert len(Counter(o.split(" (")[0] for _, _, o in want.values())) == 6


def test_waterfall_asks_only_for_what_is_left(spark):
    rows = spark.range(20).withColumnRenamed("id", "k")
    seen = {}

    def source(name, holds):
        def ask(left):
            seen[name] = {r["k"] for r in left.collect()}
            return left.where(holds).select("k", F.explode(F.array(F.lit(2), F.lit(1))).alias("v"))

        return name, ask

    answers, asked = G.staged_waterfall(rows, "k", [source("a", "k < 12"), source("b", "k % 2 = 0"), source("c", "k > 100"), source("d", "k >= 0"), source("e", "true")], ["v"])
    assert {r["k"]: (r["source"], r["v"]) for r in answers.collect()} == {k: ("a" if k < 12 else "b" if k % 2 == 0 else "d", 1) for k in range(20)}
    assert seen == {"a": set(range(20)), "b": set(range(12, 20)), "c": {13, 15, 17, 19}, "d": {13, 15, 17, 19}}
    assert {tuple(r) for r in asked.collect()} == {("a", 20, 12), ("b", 8, 4), ("c", 4, 0), ("d", 4, 4)}


def plain_vaccine(m, title, kind):
    """Score and reasons of one document for one row."""
    _, name, generic, lab = m[:4]
    base = " ".join(re.sub(r"\b\d+(?:MG|MCG|UG|ML|UI|U|DOSE|DOSES)\b", " ", name).split())
    terms = [x for x in (name, generic, lab, base) if x]
    for k, v in K.SYNONYMS.items():
        if k in base or base in k or k in name:
            terms += v
    text = " ".join([name, generic, lab])
    for words, more in K.DERIVED:
        if any(w in text for w in words):
            terms += more
    terms = [t for t in dict.fromkeys(terms) if len(t) >= 3]
    words = lambda t: {w for w in t.split() if len(w) >= 3 and w not in K.TITLE_STOP}
    s, why = 0.0, []

    def add(cond, n, reason):
        nonlocal s
        if cond:
            s += n
            why.append(reason)

    add(name and name in title, 0.60, "name_in_title")
    add(not (name and name in title) and base and base in title, 0.55, "base_name_in_title")
    for t in terms:
        shared = t in ("COVID 19", "INFLUENZA", "POLIO", "POLIOMYELITIS", "HEPATITIS B")
        add(len(t) >= 5 and t in title, 0.08 if shared else 0.20, f"{'generic' if shared else 'term'}:{t}")
    mine = words(" ".join([name, generic, lab, *terms]))
    both = mine & words(title)
    add(both, min(0.25, 0.25 * len(both) / max(1, min(len(mine), 8))), "tokens:" + "/".join(sorted(both)[:6]))
    own = name + " " + lab
    add(any(x in title for x in ("BIONTECH", "PFIZER")) and any(x in own for x in ("BIONTECH", "PFIZER")), 0.20, "manufacturer_biontech")
    for k, n in (("moderna", 0.22), ("astrazeneca", 0.22), ("sinovac", 0.22)):
        add(k.upper() in title and k.upper() in own, n, f"manufacturer_{k}")
    add("BIOFARMA" in title.replace(" ", "") and ("BIO FARMA" in lab or "BIOFARMA" in lab.replace(" ", "")), 0.22, "manufacturer_biofarma")
    add("SANOFI" in title and "SANOFI" in own, 0.18, "manufacturer_sanofi")
    add(kind, K.DOCUMENT_WEIGHTS.get(kind, 0.0), f"doc_type:{kind}")
    add(base and len(base.split()) == 1 and base not in title and not any(x in title for x in K.SYNONYMS.get(base, ())), -0.15, "single_token_guard")
    add("PENTAXIM" in name and "HEXAXIM" in title, -0.40, "reject_hexaxim_for_pentaxim")
    add(("SPUTNIK" in name or "GAM COVID VAC" in name) and not any(x in title for x in ("SPUTNIK", "GAMALEYA", "GAM COVID")), -0.35, "sputnik_guard")
    add("CORONAVAC" in name and not any(x in title for x in ("CORONAVAC", "SINOVAC")), -0.35, "coronavac_guard")
    return round(max(0.0, min(0.98, s)), 6), ";".join(why)


def test_vaccine_documents_are_those_of_all_pairs(spark):
    rng = random.Random(9)
    names = ["PENTAXIM", "COMINARTY", "COMIRNATY 30UG DOSE", "GC FLU", "CORONAVAC", "SPUTNIK LIGHT", "GAM COVID VAC", "EUVAX B 10MCG", "HEPAVAX GENE", "BCG", "", "VAXIGRIPTETRA", "COVID 19 VACCINE MODERNA", "ORAL POLIO VACCINE", "UNKNOWN VACCIN"]
    labs = ["SANOFI PASTEUR", "PFIZER BIONTECH", "BIO FARMA", "BIOFARMA", "GREEN CROSS", "SINOVAC", "MODERNA", ""]
    rows = [(i, n, g, rng.choice(labs)) for i, (n, g) in enumerate(product(names, ["", "VACCIN GRIPPE", "HEPATITE B", "COVID ARNM", "POLIO"]))]
    extra = ["PRODUCT INFORMATION", "SANOFI", "PFIZER", "BIO FARMA", "SINOVAC", "HEXAXIM", "INFLUENZA", "HEPATITIS B", "COVID 19 MRNA", "POLIOMYELITIS", "GAMALEYA", "MODERNA"]
    docs = [(i, " ".join(rng.sample(extra, rng.randrange(0, 4)) + [n] * (rng.random() < 0.6)).strip(), rng.choice([*K.DOCUMENT_WEIGHTS, "other", "", None])) for i, n in enumerate(names * 5)]
    got = {(r["m"], r["d"]): (r["score"], r["reasons"]) for r in K.vaccine_matches(spark, spark.createDataFrame(rows, "m long, m_brand string, m_generic string, m_lab string"), spark.createDataFrame(docs, "d long, title string, kind string"), "m", "d").collect()}
    want = {(m[0], d[0]): x for m, d in product(rows, docs) if (x := plain_vaccine(m, d[1], d[2] or ""))[0] >= 0.55}
    assert got == want and 200 < len(got) < len(rows) * len(docs) / 2
    assert len({re.sub(r"[:].*", "", x) for _, s in want.values() for x in s.split(";")}) > 8


def shuffled(spark):
    """Records that all stages so far have written to shuffles."""
    gateway = spark.sparkContext._gateway
    stages = spark._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


@pytest.mark.parametrize("source", ["cima", "gated"])
def test_pairs_of_a_common_value_are_not_shuffled(spark, source):
    meds = [(i, f"BRAND N{i}", "AAAA", "", "", "") for i in range(400)]
    recs = [(i, f"BRAND X{i % 7}", "AAAA", "", "", "", "", "", "", [], False, "PIL") for i in range(400)]
    join = K.fast_matches if source == "gated" else lambda s, m, r, a, b: K.matches(s, m, r, source, a, b)
    before = shuffled(spark)
    pairs = join(spark, spark.createDataFrame(meds, MEDICINE), spark.createDataFrame(recs, RECORD), "m", "r").collect()
    assert len({(x["m"], x["r"]) for x in pairs}) == len(pairs) == 160_000
    assert shuffled(spark) - before < 20_000


def test_classes_hold_every_record_once(spark, monkeypatch):
    monkeypatch.setattr(K, "MEMBERS", 50)
    rows = [(i, "hot" if i % 2 else f"n{i % 10}", None) for i in range(2000)]
    got = K.classes(spark.createDataFrame(rows, "r long, name string, kind string"), "r", ["name", "kind"]).collect()
    assert sorted(r for x in got for r in x["members"]) == list(range(2000))
    assert all(rows[r][1] == x["name"] for x in got for r in x["members"])
    assert 10 < len(got) < 100 and max(len(x["members"]) for x in got) < 200


@pytest.mark.parametrize("source", list(K.SOURCES))
def test_scores_are_short_enough_to_be_compiled(spark, tables, source):
    """The JVM interprets methods of more than 8,000 bytes."""
    meds, recs = tables
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = K.matches(spark, spark.createDataFrame(meds[:9], MEDICINE), spark.createDataFrame(recs[:9], RECORD), source, "m", "r")
        code = spark._jvm.PythonSQLUtils.explainString(pairs._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert len(sizes) > 3 and max(sizes) < 8000


@pytest.mark.parametrize(("source", "most"), [("bdpm", 3), ("cima", 1), ("aifa", 2), ("health_canada", 1), ("titck", 3), ("cecmed", 1)])
def test_best_are_those_of_all_pairs(spark, tables, monkeypatch, source, most):
    if most > 1 or source == "cima":  # the others from pairs
        monkeypatch.setattr(K, "FEW", 0)
    meds, recs = tables
    all_ = {}
    for m, r in product(meds, recs):
        if (s := round(plain_score(source, m, r), 4)) >= K.SOURCES[source].threshold:
            all_.setdefault(m[0], []).append((-s, r[0]))
    got = K.best(spark, spark.createDataFrame(meds, MEDICINE), spark.createDataFrame(recs, RECORD), source, "m", "r", most)
    assert sorted((x["m"], -x["score"], x["r"]) for x in got.collect()) == sorted((m, s, r) for m, x in all_.items() for s, r in sorted(x)[:most])


def test_best_makes_no_pairs_of_a_common_value(spark, monkeypatch):
    meds = [(i, f"BRAND N{i % 9}", "AAAA", "", "", "") for i in range(400)]
    recs = [(i, f"BRAND X{i % 7}", "AAAA", "", "", "", "", "", "", [], False, "PIL") for i in range(400)]
    cells, made = K.in_cells, []

    def counted(*args):
        out = cells(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(K, "in_cells", counted)
    monkeypatch.setattr(K, "FEW", 0)
    got = K.best(spark, spark.createDataFrame(meds, MEDICINE), spark.createDataFrame(recs, RECORD), "cima", "m", "r", 1).collect()
    assert sorted(tuple(x) for x in got) == [(i, 0, 0.95) for i in range(400)]
    assert sum(made) < 200
