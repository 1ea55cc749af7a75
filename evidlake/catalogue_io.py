"""Registered queries of sources and sinks: tables written in a format and read again through the library."""

from __future__ import annotations

import io
import os
import sqlite3
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidlake.catalogue import _CLEAN, _n, _t, c, lit, query
from evidlake.functions import text as X
from evidlake.sources import readers as I
from evidlake.sources import archives as A
from evidlake.sources import writers as O
from evidlake.streaming import incremental as V


def _path(spark: SparkSession) -> str:
    return f"{O.scratch(spark)}/io-{uuid.uuid4().hex}"


def _texts(df: DataFrame, path: str) -> None:
    """Lines of a text column, as files."""
    df.write.mode("overwrite").text(path)


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, '' AS missing, s_nationkey::VARCHAR AS nation FROM supplier")
def csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """Fixed columns with a byte-order mark, extras dropped; read by name and alias, missing ones empty."""
    path = _path(spark)
    O.csv(_t(spark, d, "supplier"), path, ["s_suppkey", "s_name", "s_nationkey", "none"], bom=True)
    return I.csv(spark, path, ["s_suppkey", "s_name", "missing", "nation"], aliases={"nation": ["S_NATIONKEY"]})


@query(f"SELECT doc_id::VARCHAR AS doc_id, {_CLEAN.format('text')} AS text FROM documents")
def csv_scan_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts with newlines and quotes through CSV, cleaned on the way back."""
    path = _path(spark)
    O.csv(_t(spark, d, "documents"), path, ["doc_id", "text"])
    return I.csv(spark, path, ["doc_id", "text"], cleaned=True)


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, upper(replace(n_name, '_', ' ')) || '|' || n_regionkey AS key FROM nation")
def catalogue_scan(spark: SparkSession, d: str) -> DataFrame:
    """A tab-separated catalogue by its ending, with required columns and a derived key."""
    path = _path(spark) + ".tsv"
    n = _t(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    n.write.option("header", True).option("sep", "\t").csv(path)
    return I.catalogue(spark, path, required=["N_NAME"], keys={"key": ["n_name", "n_regionkey"]}).select("n_nationkey", "n_name", "key")


@query("SELECT p_partkey::VARCHAR AS code, 'é ' || p_name AS name, CASE WHEN p_size > 25 THEN p_size::VARCHAR ELSE '' END AS size FROM part")
def tab_export_scan(spark: SparkSession, d: str) -> DataFrame:
    """A headerless Latin-1 export whose short rows lack their last column."""
    path = _path(spark)
    line = F.concat_ws("\t", c("p_partkey").cast("string"), F.concat(lit("é "), c("p_name")), F.when(c("p_size") > 25, c("p_size").cast("string")))
    _t(spark, d, "part").select(line.alias("value")).write.option("encoding", "ISO-8859-1").option("quote", "").option("sep", "\x01").csv(path)
    return I.tab_export(spark, path, ["code", "name", "size"])


@query("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN n_name END AS name, n_nationkey % 3 = 0 AS valid FROM nation")
def json_document_scan(spark: SparkSession, d: str) -> DataFrame:
    """Whole JSON files, one in three valid, one broken, one empty."""
    path = _path(spark)
    m = c("n_nationkey") % 3
    body = F.when(m == 0, F.to_json(F.struct(c("n_name").alias("name")))).when(m == 1, lit("{broken")).otherwise("")
    O.side_files(_t(spark, d, "nation").select("n_nationkey", body.alias("body")), "n_nationkey", "body", path)
    docs = I.json_documents(spark, path)
    return docs.select(F.regexp_extract("path", r"n_nationkey=(\d+)", 1).cast("int").alias("n_nationkey"), F.try_variant_get("parsed", "$.name", "string").alias("name"), c("parsed").isNotNull().alias("valid"))


@query("SELECT r_name AS CLASS_NAME, n_name AS SUBCLASS_NAME, r_regionkey::VARCHAR AS CLASS_CODE, n_nationkey::VARCHAR AS SUBCLASS_CODE FROM nation JOIN region ON n_regionkey = r_regionkey")
def class_map_scan(spark: SparkSession, d: str) -> DataFrame:
    """A dimension kept as one JSON document."""
    path = _path(spark)
    rows = _t(spark, d, "nation").join(_t(spark, d, "region"), c("n_regionkey") == c("r_regionkey"))
    sub = F.struct(c("r_regionkey").cast("string").alias("CLASS_CODE"), c("r_name").alias("CLASS_NAME"), c("n_nationkey").cast("string").alias("SUBCLASS_CODE"), c("n_name").alias("SUBCLASS_NAME"))
    _texts(rows.agg(F.to_json(F.struct(F.collect_list(sub).alias("subclasses"))).alias("value")), path)
    return I.class_map(spark, path).select("CLASS_CODE", "CLASS_NAME", "SUBCLASS_CODE", "SUBCLASS_NAME")


def _xml(spark: SparkSession, d: str, prefix: str = "") -> str:
    """Files of records, all their elements with a prefix."""
    path, p = _path(spark), prefix
    name = F.replace(F.replace(c("p_name"), lit("&"), lit("&amp;")), lit("<"), lit("&lt;"))
    rec = F.concat(lit(f'<{p}rec id="'), c("p_partkey").cast("string"), lit(f'">\n<{p}name>'), name, lit(f"</{p}name><{p}size>"), c("p_size").cast("string"), lit(f"</{p}size>\n</{p}rec>"))
    file = _t(spark, d, "part").groupBy((c("p_partkey") % 16).alias("file")).agg(F.concat(lit("<all>"), F.array_join(F.collect_list(rec), "\n"), lit("</all>")).alias("x"))
    O.side_files(file, "file", "x", path)
    return path


@query("SELECT p_partkey::BIGINT AS id, p_name AS name, p_size::BIGINT AS size FROM part")
def xml_row_scan(spark: SparkSession, d: str) -> DataFrame:
    """Records of an XML file whose elements have a prefix, attributes too."""
    rows = I.xml_rows(spark, _xml(spark, d, "p:"), "rec", "_id long, name string, size long")
    return rows.select(c("_id").alias("id"), "name", "size")


@query("SELECT p_partkey::VARCHAR AS id, p_name AS name FROM part WHERE contains(p_name, 'green') OR p_size = 7")
def xml_record_scan(spark: SparkSession, d: str) -> DataFrame:
    """Raw records of a large XML file, those with a needle only, cut without a parser."""
    rows = I.xml_records(spark, _xml(spark, d), "rec", ["GREEN", "<size>7<"])
    return rows.select(F.regexp_extract("value", 'id="([0-9]+)"', 1).alias("id"), F.regexp_extract("value", "<name>(.*?)</name>", 1).alias("name"))


@query("SELECT item_id, octet_length(encode(coalesce(text, ''))) + 1 AS bytes, coalesce(text, '') AS text FROM benchmark")
def text_side_files(spark: SparkSession, d: str) -> DataFrame:
    """A file of text for each item, listed and read again."""
    path = _path(spark)
    O.side_files(_t(spark, d, "benchmark"), "item_id", "text", path)
    number = lambda x: F.regexp_extract(x, r"item_id=(\d+)", 1).cast("long").alias("item_id")
    listed = I.files(spark, path, "*.txt").select(number("path"), c("length").alias("bytes"))
    got = spark.read.text(path, wholetext=True).select(number(F.input_file_name()), "value")
    return listed.join(got, "item_id").select("item_id", "bytes", F.expr("left(value, length(value) - 1)").alias("text"))


@query("SELECT page_id, 'markup' AS kind, upper(substr(sha256(html), 1, 8)) AS sha FROM pages UNION ALL SELECT 1000000 + doc_id, CASE doc_id % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'zip' ELSE 'other' END, '' FROM documents")
def magic_sniff(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of contents by their first bytes."""
    pages = _t(spark, d, "pages").select("page_id", X.magic(F.encode("html", "UTF-8")).alias("kind"), F.upper(F.left(F.sha2(F.encode("html", "UTF-8"), 256), lit(8))).alias("sha"))
    m = c("doc_id") % 3
    head = F.when(m == 0, lit("%PDF-1.7")).when(m == 1, lit("PK\x03\x04")).otherwise(lit("plain"))
    docs = _t(spark, d, "documents").select((c("doc_id") + 1_000_000).alias("page_id"), X.magic(F.encode(head, "UTF-8")).alias("kind"), lit("").alias("sha"))
    return pages.unionByName(docs)


@query(r"""WITH t AS (SELECT doc_id, doc_id % 5 AS m, trim(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', ' ', 'g')) AS t FROM documents)
SELECT doc_id, CASE m WHEN 4 THEN t WHEN 3 THEN '' WHEN 2 THEN '' WHEN 1 THEN CASE WHEN t = '' THEN '' ELSE t END ELSE t END AS text, CASE m WHEN 0 THEN CASE WHEN t = '' THEN '' ELSE 'first' END WHEN 1 THEN CASE WHEN t = '' THEN '' ELSE 'second' END WHEN 4 THEN 'decode' ELSE '' END AS parser,
 CASE m WHEN 0 THEN CASE WHEN t = '' THEN 'no_text_extracted' ELSE 'ok' END WHEN 1 THEN CASE WHEN t = '' THEN 'no_text_extracted' ELSE 'ok' END WHEN 2 THEN 'unreadable' WHEN 3 THEN 'extract_failed' ELSE CASE WHEN t = '' THEN 'no_text_extracted' ELSE 'ok' END END AS status FROM t""")
def document_dispatch(spark: SparkSession, d: str) -> DataFrame:
    """Bodies to text by kind, through parsers in order, unreadable results refused."""

    def first(body: bytes) -> str:
        mode, _, text = body[5:].decode().partition("|")
        if mode == "3":
            raise ValueError("no such file")
        return {"0": text, "1": "% 12 34 56 //", "2": "0 0 0 // 1 1"}[mode]

    def second(body: bytes) -> str:
        mode, _, text = body[5:].decode().partition("|")
        if mode == "3":
            raise ValueError("no such file")
        return text if mode != "2" else "..."

    t, m = F.trim(F.regexp_replace(F.coalesce("text", lit("")), "[^A-Za-z]+", " ")), c("doc_id") % 5
    body = F.when(m == 4, t).otherwise(F.concat(lit("%PDF-"), m.cast("string"), lit("|"), t))
    docs = _t(spark, d, "documents").select("doc_id", F.encode(body, "UTF-8").alias("content")).withColumn("kind", F.when(m == 4, "other").otherwise(X.magic("content")))
    return I.document_text(docs, parsers=[("first", first), ("second", second)], readable=True).select("doc_id", "text", "parser", "status")


@query("SELECT 'a.zip!d/' || r_name || '.txt' AS name, 'other' AS kind, r_name || ' text' AS text FROM region UNION ALL SELECT 'b.html', 'markup', '<p>b</p>'")
def archive_members(spark: SparkSession, d: str) -> DataFrame:
    """Files of a folder, archives replaced by their members."""
    path, held = _path(spark), io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for r in _t(spark, d, "region").select("r_name").collect():
            z.writestr(f"d/{r['r_name']}.txt", f"{r['r_name']} text")
    O.put(spark, f"{path}/a.zip", held.getvalue())
    O.put(spark, f"{path}/b.html", b"<p>b</p>")
    got = I.contents(spark, path)
    return got.select(F.regexp_replace("path", r"^.*/io-[0-9a-f]+/", "").alias("name"), "kind", F.decode("content", "UTF-8").alias("text"))


@query("""SELECT doc_id, source, h, drop AS batch FROM (SELECT doc_id, source, md5(coalesce(text, '')) AS h, (doc_id % 4)::INT AS drop, row_number() OVER (PARTITION BY md5(coalesce(text, '')) ORDER BY doc_id % 4, doc_id) AS n FROM documents) WHERE n = 1""")
def incremental_release(spark: SparkSession, d: str) -> DataFrame:
    """Documents that arrive in four drops, each taken in by a run of its own: the first of equal texts is released."""
    path = _path(spark)
    docs = _t(spark, d, "documents").select("doc_id", "source", F.md5(F.encode(F.coalesce("text", lit("")), "UTF-8")).alias("h"))
    out = V.Release(spark, f"{path}/release", ["h"], ["doc_id"], buckets=16)
    for drop in range(4):
        docs.where(c("doc_id") % 4 == drop).write.mode("append").parquet(f"{path}/landing")
        out.run(f"{path}/landing", docs.schema)
    return out.rows().select("doc_id", "source", "h", "batch")


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey FROM customer")
def sqlite_scan(spark: SparkSession, d: str) -> DataFrame:
    """A SQLite table, read in ranges of row numbers by several tasks."""
    path = f"{_path(spark).removeprefix('file:')}.db"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE customer (c_custkey INTEGER, c_name TEXT, c_nationkey INTEGER)")
        db.executemany("INSERT INTO customer VALUES (?, ?, ?)", _t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey").toLocalIterator())
    return A.sqlite_table(spark, path, "customer", rows=400)


@query("SELECT c_custkey AS id, c_name AS name, 1 AS src_ord, 'customers' AS system, 90 AS rank FROM customer UNION ALL SELECT s_suppkey, s_name, 2, 'suppliers', 50 FROM supplier")
def multiplexed_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources in order as one table, each with its configuration."""
    a = _t(spark, d, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"))
    b = _t(spark, d, "supplier").select(c("s_suppkey").alias("id"), c("s_name").alias("name"))
    return I.multiplex([(a, {"system": "customers", "rank": 90}), (b, {"system": "suppliers", "rank": 50})])


@query("SELECT event_id, event_type, value FROM events")
def json_lines_sink(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark)
    O.json_lines(_t(spark, d, "events").select("event_id", "event_type", "value"), path)
    return spark.read.schema("event_id long, event_type string, value double").json(path)


@query("SELECT count(*) AS orders, sum(o_totalprice)::DECIMAL(18,2)::VARCHAR AS total FROM orders")
def summary_sink(spark: SparkSession, d: str) -> DataFrame:
    """A summary document of one row, parsed again."""
    doc = O.summary(_t(spark, d, "orders").agg(_n().alias("orders"), F.sum(c("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").cast("string").alias("total")))
    return spark.range(1).select(F.from_json(lit(doc), "orders long, total string").alias("x")).select("x.*")


@query("SELECT o_orderkey, try_cast(o_orderstatus AS INTEGER) AS status_code, o_totalprice::DECIMAL(12,2) AS price, NULL::DATE AS shipped FROM orders")
def typed_schema(spark: SparkSession, d: str) -> DataFrame:
    """An all-text table under a declared schema; what does not fit is null."""
    raw = O.all_text(_t(spark, d, "orders").select("o_orderkey", c("o_orderstatus").alias("status_code"), c("o_totalprice").cast("decimal(12,2)").alias("price")))
    return O.typed(raw, "o_orderkey bigint, status_code int, price decimal(12,2), shipped date")


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, coalesce(c_mktsegment, '') AS c_mktsegment FROM customer")
def all_text_table(spark: SparkSession, d: str) -> DataFrame:
    """A raw import as an all-text table, sorted so that readers can skip."""
    path = _path(spark)
    O.table(O.all_text(_t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")), path, ["c_custkey"])
    O.views(spark, {"evidlake_customers": spark.read.parquet(path)})
    return spark.table("evidlake_customers")


@query("SELECT doc_id, CASE WHEN length(text) > 32000 THEN left(text, 31997) || '...' ELSE coalesce(text, '') END AS cell FROM documents")
def workbook_cells(spark: SparkSession, d: str) -> DataFrame:
    """Texts as workbook cells hold them."""
    return _t(spark, d, "documents").select("doc_id", O.excel_text("text").alias("cell"))


@query("SELECT 1 AS version, count(*) AS n FROM supplier UNION ALL SELECT 2, count(*) FROM supplier WHERE s_nationkey > 5")
def versioned_release(spark: SparkSession, d: str) -> DataFrame:
    """A correction as a new version; the old one stays as it was."""
    path, s = _path(spark), _t(spark, d, "supplier")
    first = O.release(s, path, 1)
    second = O.release(spark.read.parquet(first).where("s_nationkey > 5"), path, 2)
    parts = [spark.read.parquet(p).agg(_n().alias("n")).select(lit(v).alias("version"), "n") for v, p in ((1, first), (2, second))]
    return parts[0].unionByName(parts[1])


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'new' ELSE s_name END AS name FROM supplier UNION ALL SELECT s_suppkey + 1000000, 'new' FROM supplier WHERE s_suppkey % 3 = 0")
def upsert_replace(spark: SparkSession, d: str) -> DataFrame:
    """New rows replace old ones of the same key, others are added."""
    old = _t(spark, d, "supplier").select("s_suppkey", c("s_name").alias("name"))
    new = old.where("s_suppkey % 3 = 0").withColumn("name", lit("new"))
    return O.upsert(old, new.unionByName(new.withColumn("s_suppkey", c("s_suppkey") + 1_000_000)), ["s_suppkey"])


@query("SELECT s_suppkey, s_name AS name FROM supplier UNION ALL SELECT s_suppkey + 1000000, 'new' FROM supplier WHERE s_suppkey % 3 = 0")
def upsert_ignore(spark: SparkSession, d: str) -> DataFrame:
    """Old rows stay, only new keys are added."""
    old = _t(spark, d, "supplier").select("s_suppkey", c("s_name").alias("name"))
    new = old.where("s_suppkey % 3 = 0").withColumn("name", lit("new"))
    return O.upsert(old, new.unionByName(new.withColumn("s_suppkey", c("s_suppkey") + 1_000_000)), ["s_suppkey"], replace=False)


@query("SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 40 THEN 'middle' ELSE 'large' END AS part, count(*) AS n FROM lineitem GROUP BY 1")
def split_outputs(spark: SparkSession, d: str) -> DataFrame:
    """One result written as several by predicate, counted again."""
    path, q = _path(spark), c("l_quantity")
    parts = {"small": q < 10, "middle": (q >= 10) & (q < 40), "large": q >= 40}
    O.split(_t(spark, d, "lineitem").select("l_orderkey", "l_quantity"), parts, path)
    counts = [spark.read.parquet(f"{path}/{name}").agg(_n().alias("n")).select(lit(name).alias("part"), "n") for name in parts]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).where("n > 0")


def _landed(spark: SparkSession, d: str) -> str:
    path = _path(spark)
    rows = _t(spark, d, "customer").where("c_custkey % 3 > 0").select(F.to_json(F.struct(c("c_custkey").cast("string").alias("key"), c("c_name").alias("body"))).alias("value"))
    _texts(rows, path)
    return path


@query("SELECT c_custkey::VARCHAR AS c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS body, c_custkey % 3 > 0 AS hit FROM customer")
def landing_cache(spark: SparkSession, d: str) -> DataFrame:
    """What has been fetched already, and what is left to fetch."""
    return I.landed(spark, _landed(spark, d), _t(spark, d, "customer"), "c_custkey")


@query("SELECT 'a.csv' AS path, 'row_id' AS key, s_suppkey::VARCHAR AS value FROM supplier UNION ALL SELECT 'b.csv', 'amm', s_name FROM supplier")
def discovered_keys(spark: SparkSession, d: str) -> DataFrame:
    """All CSV files below a root, by whichever key they have, some folders left out."""
    root, s = _path(spark), _t(spark, d, "supplier")

    def put(folder: str, df: DataFrame) -> None:
        df.coalesce(1).write.option("header", True).csv(f"{root}/{folder}")

    put("x/a.csv", s.select(c("s_suppkey").alias("ROW_ID"), "s_name"))
    put("y/b.csv", s.select(c("s_name").alias("amm")))
    put("skip/c.csv", s.select(c("s_suppkey").alias("row_id")))
    put("z/d.csv", s.select("s_nationkey"))
    found = I.discover(spark, root, skip=["skip"])
    return found.withColumn("path", F.when(c("key") == "row_id", "a.csv").otherwise("b.csv"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE CASE WHEN p_partkey % 2 = 0 THEN '/first/' ELSE '/second/' END || p_partkey || '.pdf' END AS resolved FROM part")
def resolved_paths(spark: SparkSession, d: str) -> DataFrame:
    """Relative paths under the first of several roots where they are."""
    p = _t(spark, d, "part").select("p_partkey", F.concat(c("p_partkey").cast("string"), lit(".pdf")).alias("file"))
    m = c("p_partkey") % 4
    have = p.where(m != 3).select(F.explode(F.when(m == 0, F.array(lit("/first/"), lit("/second/"))).when(m == 1, F.array(lit("/second/"))).otherwise(F.array(lit("/first/")))).alias("r"), "file").select(F.concat("r", "file").alias("path"))
    return I.resolve(p, "file", have, ["/first", "/second/"]).select("p_partkey", "resolved")
