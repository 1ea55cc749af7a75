"""Folding, character references and addresses against Python's own, over whole tables of characters."""

import html
import html.entities
import random
import unicodedata
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from evidlake.functions import text as X
from evidlake.functions import unicode as U
from evidlake.operators import segment as S


def test_folding_is_nfkd_without_marks(spark):
    chars = [chr(i) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000]
    rows = spark.createDataFrame([(c, f"a{c}b") for c in chars], "c string, t string").select("c", "t", U.fold(F.col("c")).alias("f"), U.fold(F.col("t")).alias("g"), X.fold_in_place("t").alias("p")).collect()
    nfkd = lambda c: "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
    assert [r["c"] for r in rows if r["c"] not in U.SPELLED and ord(r["c"]) not in U._HANGUL and r["f"] != nfkd(r["c"])] == []
    assert [r["c"] for r in rows if r["g"] != U.folded(r["t"])[0]] == []
    assert all(len(r["p"]) == 3 for r in rows)
    got = spark.createDataFrame([("Łódź Příliš žluťoučký kůň, Őrült szörny; ŞĞİı ﬁﬂ Ⅷ ﷺ",)], "t string").select(U.fold(F.col("t"))).first()[0]
    assert got.startswith("Łodz Prilis zlutoucky kun, Orult szorny; SGIi fifl VIII ") and len(got.split(" ")) > 10


def test_folded_places(spark):
    rng = random.Random(3)
    letters = "aZéİıßﬁ½ŞâœⅧ한 ́"
    for _ in range(300):
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 30)))
        low, places = U.folded(t, lower=True)
        places = list(range(len(t))) if places is None else places.tolist()
        assert len(low) == len(places) and low == "".join(U.folded(c, lower=True)[0] for c in t)
        assert all(c in U.folded(t[i], lower=True)[0] for c, i in zip(low, places, strict=True))


def test_character_references(spark):
    rng = random.Random(1)
    names = list(html.entities.html5)
    cases = ["&" + n for n in names] + [f"x&{n.rstrip(';')}y" for n in names]
    numbers = [*range(400), 0xD7FF, 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0x1F600, 0x1FFFE, 0x10FFFF, 0x110000, 99_999_999_999]
    cases += [f"&#{i};" for i in numbers] + [f"&#x{i:X}" for i in numbers] + [f"&#0{i}é" for i in numbers]
    cases += ["", "&", "&&amp;", "&amp;lt;", "&#;", "&#x;", "&#xg;", "&notit;", "caf&#233; &ecirc;tre &rsquo; &#x20AC; &ccedil;", "& lt;", "&copy2024", "a&lt;b&gt;c", "&Acirc", "&" * 50]
    cases += ["".join(rng.choice(["&", "amp", "lt", ";", "#", "x", "41", "é", " ", "not", "in", "copy", "&#"]) for _ in range(12)) for _ in range(2000)]
    rows = spark.createDataFrame([(c,) for c in cases], "t string").select("t", X.unescape("t").alias("f")).collect()
    assert [(r["t"], r["f"]) for r in rows if r["f"] != html.unescape(r["t"])] == []
    assert spark.createDataFrame([(None,)], "t string").select(X.unescape("t")).first()[0] == ""


@pytest.mark.parametrize("base", ["https://x.example/list/all", "https://x.example/list/a/b.html?q=1&r=2", "http://x.example", "https://x.example/", "https://x.example/a/b/"])
def test_addresses(spark, base):
    refs = ["a.pdf", "../a.pdf", "../../a.pdf", "../../../../a", "./a", ".", "..", "a/../b", "a/./b/", "?x=1", "#f", "?x=1#f", "/d/../e", "/", "//y.example/z", "https://z.example/q", "mailto:a@b.c", "a//b", "a?b=../c", "a#../c", "../", "x/y/../../z?q"]
    rows = spark.createDataFrame([(r,) for r in refs], "t string").select("t", X.absolute_url("t", base).alias("u")).collect()
    assert [(r["t"], r["u"], urljoin(base, r["t"])) for r in rows if r["u"] != urljoin(base, r["t"])] == []


def test_headings_of_other_scripts_are_found():
    body = "metin " * 40
    labels = ["4.1. Terapötik endikasyonlar", "4.2 Pozoloji ve uygulama şekli", "4.4. ÖZEL KULLANIM UYARILARI VE ÖNLEMLERİ", "4.5 Diğer tıbbi ürünler ile etkileşimler", "4.8. İstenmeyen etkiler", "4.9 Doz aşımı"]
    text = "½ ﬁrst " + " ".join(f"{h} {body.strip()}" for h in labels)
    got = S.by_profile(text, S.PROFILES["tr"])
    assert [s.kind for s in got] == ["indication", "dosage", "warning", "interaction", "adverse_effect", "overdose"]
    assert [s.text[: len(h)] for s, h in zip(got, labels, strict=True)] == labels and all(text[s.start :].startswith(h) for s, h in zip(got, labels, strict=True))
    spanish = f"1. NOMBRE DEL MEDICAMENTO Advertencias {body} 4.3 Contraindicaciones {body}"
    assert "warning" not in {s.kind for s in S.by_profile(spanish.replace("Advertencias", "de uso"), S.PROFILES["es"])}
