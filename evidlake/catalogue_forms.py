"""Registered queries of nested forms: JSON, XML and HTML, built from whole tables and taken apart again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidlake.catalogue import _t, c, lit, query
from evidlake.functions import nested as N
from evidlake.operators import routing as G
from evidlake.operators import segment as S


def _json(*pairs: tuple[str, Column]) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in pairs]))


@query("""SELECT event_id, ['label','class','approximate','properties','other','invalid'][1 + event_id % 6] AS shape FROM events""")
def json_shapes(spark: SparkSession, d: str) -> DataFrame:
    """The kind of a response by the fields it has."""
    m, v = c("event_id") % 6, c("event_type")
    doc = F.when(m == 0, _json(("results", F.array(v)))).when(m == 1, _json(("rxclassDrugInfoList", F.struct(v.alias("x"))))).when(m == 2, _json(("approximateGroup", F.struct(v.alias("x"))))).when(m == 3, _json(("propConceptGroup", F.struct(v.alias("x"))))).when(m == 4, c("props")).otherwise(F.concat(lit("{"), v))
    return _t(spark, d, "events").select("event_id", N.json_shape(doc).alias("shape"))


@query("""SELECT o_orderkey, i AS ord, '{"nregistro":"' || o_custkey || '","n":' || i || '}' AS item FROM orders, range(2) r(i) WHERE o_orderkey % 4 < 3 UNION ALL SELECT o_orderkey, 0, '{"Nombre":"' || o_orderstatus || '"}' FROM orders WHERE o_orderkey % 4 = 3""")
def json_item_lists(spark: SparkSession, d: str) -> DataFrame:
    """Items of responses, whichever field holds them, nested or not."""
    item = lambda i: F.struct(c("o_custkey").cast("string").alias("nregistro"), lit(i).alias("n"))
    two, m = F.array(item(0), item(1)), c("o_orderkey") % 4
    doc = F.when(m == 0, _json(("resultados", two))).when(m == 1, _json(("total", lit(2)), ("data", F.struct(two.alias("items"))))).when(m == 2, F.to_json(two)).otherwise(_json(("Nombre", c("o_orderstatus"))))
    return _t(spark, d, "orders").select("o_orderkey", doc.alias("doc")).select("o_orderkey", F.posexplode(N.json_items("doc")).alias("ord", "item"))


@query("""SELECT p_partkey, [p_name, p_brand, p_type] AS names, [p_brand || ' x'] AS ids, ['https://x/' || p_partkey, 'see /en/medicines/' || p_size] AS urls FROM part""")
def json_recursive_search(spark: SparkSession, d: str) -> DataFrame:
    """Values by key, ids and addresses anywhere in nested documents."""
    inner = F.struct(F.struct(c("p_brand").alias("NAME"), F.array(F.concat(lit("see /en/medicines/"), c("p_size").cast("string")), lit("none")).alias("x")).alias("b"), F.array(F.struct(c("p_type").alias("name"), F.concat("p_brand", lit(" x")).alias("product_id"))).alias("c"))
    url = F.concat(lit("https://x/"), c("p_partkey").cast("string"))
    doc = _json(("name", c("p_name")), ("links", F.array(url, url)), ("inner", inner), ("product_id_2", F.concat("p_brand", lit(" x"))))
    return _t(spark, d, "part").select("p_partkey", N.json_values(doc, ["name"]).alias("names"), N.json_ids(doc, "product").alias("ids"), N.json_urls(doc).alias("urls"))


@query("""WITH t AS (SELECT doc_id, trim(regexp_replace(regexp_replace(coalesce(text, ''), '[<>&]', '', 'g'), '[\\s\\x{a0}\\x{85}\\x{2028}\\x{2029}\\x{1c}-\\x{1f}]+', ' ', 'g')) AS t FROM documents)
SELECT doc_id, kind, title, text FROM (SELECT doc_id, 'indication' AS kind, '4.1 Therapeutic indications' AS title, t AS text FROM t UNION ALL SELECT doc_id, 'warning', 'Precautions', t || ' again' FROM t) WHERE length(text) >= 80""")
def json_titled_sections(spark: SparkSession, d: str) -> DataFrame:
    """Objects with a title and a text, at any depth, as sections of known kinds."""
    body = lambda x: F.struct(F.concat(lit("<div><p>"), x, lit("</p></div>")).alias("div"))
    t = F.regexp_replace(F.coalesce("text", lit("")), "[<>&]", "")
    one = F.struct(lit("4.1 Therapeutic indications").alias("title"), body(t).alias("text"))
    two = F.struct(lit("Precautions").alias("title"), body(F.concat(t, lit(" again"))).alias("text"))
    three = F.struct(lit("Annex").alias("title"), body(t).alias("text"))
    doc = _json(("title", lit("Leaflet")), ("section", F.array(one, three)), ("more", F.struct(F.array(two).alias("section"))))
    return _t(spark, d, "documents").select("doc_id", F.inline(N.json_titled(doc, lambda x: S.heading_kind(x, S.PROFILES["en"]))))


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'Médicament : ' || s_name || '. Forme pharmaceutique : f' || s_nationkey || '.' WHEN 1 THEN 'Composition BDPM. name : ' || s_name || '. k : a' || s_nationkey || '. b.' ELSE 'plain ' || s_name END AS sentence FROM supplier""")
def json_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Payloads as readable sentences."""
    m, nation = c("s_suppkey") % 3, c("s_nationkey").cast("string")
    doc = F.when(m == 0, _json(("name", c("s_name")), ("cis", lit("")), ("form", F.concat(lit("f"), nation)))).when(m == 1, _json(("name", c("s_name")), ("x", F.array(F.struct(F.concat(lit("a"), nation).alias("k"))).cast("array<struct<k:string>>")), ("y", F.array(lit("b"))))).otherwise(F.concat(lit("plain "), c("s_name")))
    kind = F.when(m == 0, "identity").when(m == 1, "composition").otherwise("presentation")
    rows = _t(spark, d, "supplier").select("s_suppkey", doc.alias("j"), kind.alias("k"))
    return rows.select("s_suppkey", N.json_sentence(c("j"), c("k"), lit("")).alias("sentence"))


@query("""SELECT p_partkey, 'identity' AS kind, 'Identité' AS title, 'Name: ' || p_name || CASE WHEN p_size > 25 THEN '; Size: ' || p_size ELSE '' END AS text FROM part UNION ALL SELECT p_partkey, 'presentation', 'Présentation', 'Box: ' || p_type FROM part WHERE length(p_type) >= 7""")
def metadata_to_sections(spark: SparkSession, d: str) -> DataFrame:
    """Synthetic sections from a record's fields, too short ones left out."""
    size = F.when(c("p_size") > 25, c("p_size").cast("string"))
    parts = N.metadata_sections([("identity", "Identité", [("Name", c("p_name")), ("Size", size)]), ("presentation", "Présentation", [("Box", c("p_type"))])], least=0)
    rows = _t(spark, d, "part").select("p_partkey", "p_type", F.inline(parts))
    return rows.where((c("kind") == "identity") | (F.length("p_type") >= 7)).drop("p_type")


def _escaped(t: Column) -> Column:
    return F.replace(F.replace(F.replace(t, lit("&"), lit("&amp;")), lit("<"), lit("&lt;")), lit(">"), lit("&gt;"))


@query("""WITH t AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', ' ', 'g')) AS t FROM documents)
SELECT doc_id, kind, title, trim(text) AS text FROM (SELECT doc_id, 'indication' AS kind, '1 Indications and Usage' AS title, '1 Indications and Usage ' || left(t, 70) AS text FROM t UNION ALL SELECT doc_id, 'warning', 'Warnings and precautions (boxed)', 'Warnings and precautions (boxed) ' || t FROM t) q WHERE length(trim(text)) >= 80""")
def xml_label_sections(spark: SparkSession, d: str) -> DataFrame:
    """Sections of label documents by title, whatever the namespace; short and unknown ones left out."""
    t = F.trim(F.regexp_replace(F.coalesce("text", lit("")), "[^A-Za-z]+", " "))
    sec = lambda title, x: F.concat(lit(f"<section><title>{title}</title><text><p>"), x, lit("</p></text></section>"))
    xml = F.concat(lit('<d xmlns="urn:hl7-org:v3">'), sec("1 Indications and Usage", F.left(t, lit(70))), sec("Package label", t), sec("Warnings and precautions (boxed)", t), lit("</d>"))
    return _t(spark, d, "documents").select("doc_id", F.inline(N.xml_label_sections(xml))).withColumn("text", F.trim("text"))


@query("""SELECT p_partkey, [p_name, 'h' || p_size] AS found, p_brand AS brand FROM part""")
def xml_hinted_values(spark: SparkSession, d: str) -> DataFrame:
    """Texts and attributes by hints about their names, and one element without a parser."""
    xml = F.concat(lit('<r xmlns:a="urn:x"><a:productTitle>'), _escaped(c("p_name")), lit('</a:productTitle><x authHolder="h'), c("p_size").cast("string"), lit('"><y>no</y></x><brand>'), _escaped(c("p_brand")), lit("</brand></r>"))
    return _t(spark, d, "part").select("p_partkey", N.xml_hinted(xml, ["product", "authholder"]).alias("found"), N.tag_value(xml, "brand").alias("brand"))


@query("""SELECT c_custkey, 'Name' AS label, c_name AS value FROM customer UNION ALL SELECT c_custkey, 'Phone', c_mktsegment FROM customer""")
def html_table_records(spark: SparkSession, d: str) -> DataFrame:
    """Label and value cells of table rows."""
    html = F.concat(lit("<table class=x><tr><th>Name</th><td><b>"), c("c_name"), lit("</b></td></tr><tr id=2><td> Phone </td><td>"), c("c_mktsegment"), lit("</td></tr></table>"))
    rows = _t(spark, d, "customer").select("c_custkey", F.explode(N.table_cells(html)).alias("x"))
    return rows.select("c_custkey", F.element_at("x", 1).alias("label"), F.element_at("x", 2).alias("value"))


@query("""SELECT o_orderkey, s AS summary, b AS body FROM (SELECT o_orderkey, unnest([o_orderpriority, o_orderstatus || ' clerk']) AS s, unnest([o_orderstatus || ' body', 'x']) AS b FROM orders)""")
def html_details(spark: SparkSession, d: str) -> DataFrame:
    """Sections in details and summary elements."""
    one = lambda s, b: F.concat(lit("<details open><summary><b>"), s, lit("</b></summary><p>"), b, lit("</p></details>"))
    html = F.concat(one(c("o_orderpriority"), F.concat("o_orderstatus", lit(" body"))), one(lit(""), lit("none")), one(F.concat("o_orderstatus", lit(" clerk")), lit("x")))
    return _t(spark, d, "orders").select("o_orderkey", F.inline(N.details(html)))


@query("""SELECT p_partkey, p_name AS label, '/f/' || p_partkey || '.pdf' AS href FROM part WHERE p_size % 12 <= 8 AND p_partkey % 5 <> 0""")
def link_document_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each product link with the first document among the nine links after it, unless a page link comes before."""
    link = lambda href, label: F.struct(href.alias("href"), label.alias("label"))
    other = F.transform(F.sequence(lit(1), c("p_size") % 12), lambda i: link(F.concat(lit("/o/"), i.cast("string")), lit("other")))
    other = F.when(c("p_size") % 12 == 0, F.slice(other, 1, 0)).otherwise(other)
    stop = F.when(c("p_partkey") % 5 == 0, F.array(link(lit("/p/2"), lit("page 2"))))
    page = F.concat(F.array(link(lit("/registro/rcp/x"), c("p_name"))), F.coalesce(stop, F.slice(other, 1, 0)), other, F.array(link(F.concat(lit("/f/"), c("p_partkey").cast("string"), lit(".pdf")), lit("Descargar"))))
    html = F.array_join(F.transform(page, lambda x: F.concat(lit('<li><a class=l href="'), x["href"], lit('">'), x["label"], lit("</a></li>"))), "")
    product = lambda x: F.contains(x["href"], lit("/registro/rcp/"))
    document = lambda x: x["href"].endswith(".pdf")
    stops = lambda x: F.lower(x["label"]).startswith("page")
    rows = _t(spark, d, "part").select("p_partkey", N.anchors(html).alias("links"))
    return rows.select("p_partkey", F.inline(N.paired(c("links"), product, document, stops)))


@query(r"""SELECT page_id, trim(regexp_replace(substr(html, greatest(1, p - 800), least(p - 1, 800) + 4 + 800), '<[^>]+>', '', 'g')) AS context FROM (SELECT page_id, html, strpos(html, '<h1>') AS p FROM pages) WHERE p > 0""")
def context_window(spark: SparkSession, d: str) -> DataFrame:
    """The text within 800 characters of a page's heading."""
    p = _t(spark, d, "pages").where(F.contains("html", lit("<h1>")))
    return p.select("page_id", N.around(c("html"), lit("<h1>")).alias("context"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_brand WHEN 2 THEN '' ELSE p_type END AS picked FROM part""")
def picked_keys(spark: SparkSession, d: str) -> DataFrame:
    """A record's field under the first of several names, whatever their case."""
    m = c("p_partkey") % 4
    fields = F.create_map(F.when(m == 0, "NOMBRE").when(m == 1, "Other").when(m == 2, "nombre").otherwise("x"), F.when(m == 2, "").otherwise(F.concat(lit("  "), "p_name")), F.when(m == 3, "NAME").otherwise("Name"), F.when(m == 3, c("p_type")).otherwise(c("p_brand")))
    return _t(spark, d, "part").select("p_partkey", N.pick_key(fields, "Nombre", "name").alias("picked"))


@query("""SELECT p_partkey, p_partkey % 3 = 1 OR contains(upper(p_name), 'RAGE') AS vaccine FROM part""")
def vaccine_products(spark: SparkSession, d: str) -> DataFrame:
    """Products that a vaccine source is asked for."""
    name = F.when(c("p_partkey") % 3 == 1, F.concat("p_name", lit(" Varicelle"))).otherwise(c("p_name"))
    return _t(spark, d, "part").select("p_partkey", G.vaccine_like(name, lit(None).cast("string")).alias("vaccine"))
