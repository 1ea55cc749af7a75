"""Further registered queries: coverage, availability, review, contracts and matchers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidlake.catalogue import _n, _normf, _t, _values, c, lit, query
from evidlake.functions import nested as N
from evidlake.functions import text as X
from evidlake.operators import matching as M
from evidlake.operators import relational as R
from evidlake.operators import routing as G
from evidlake.operators import scoring as K
from evidlake.plans import coverage as V


@query("""WITH s AS (SELECT user_id, bool_or(event_type='view') AS m, bool_or(event_type='click' AND value>90) AS l, bool_or(event_type='signup' AND value>95) AS n, bool_or(event_type='error' AND value>97) AS lab, CASE WHEN user_id % 4 = 0 THEN 404 ELSE 200 END AS st FROM events GROUP BY user_id)
SELECT user_id, m OR l AS has_rcp, n AS has_notice, m OR l OR n AS has_detail, m OR l OR n OR lab AS has_actual_or_lab, st=404 AND NOT (m OR l) AS is_404 FROM s""")
def availability_flags(spark: SparkSession, d: str) -> DataFrame:
    any_ = lambda cond: F.bool_or(cond)
    t, v = c("event_type"), c("value")
    s = _t(spark, d, "events").groupBy("user_id").agg(any_(t == "view").alias("m"), any_((t == "click") & (v > 90)).alias("l"), any_((t == "signup") & (v > 95)).alias("n"), any_((t == "error") & (v > 97)).alias("lab"))
    return s.select("user_id", *[x.alias(k) for k, x in V.availability(c("m"), c("l"), c("n"), c("lab"), F.when(c("user_id") % 4 == 0, 404).otherwise(200)).items()])


@query("""WITH s AS (SELECT user_id, list(DISTINCT CASE event_type WHEN 'view' THEN 'rcp' WHEN 'click' THEN 'notice' WHEN 'error' THEN 'unknown' END) AS k FROM events WHERE event_type IN ('view','click','error') AND value > 90 GROUP BY user_id)
SELECT user_id, user_id % 9 = 0 OR list_contains(k,'rcp') AS local_rcp, list_contains(k,'notice') AS local_notice, NOT (user_id % 9 = 0 OR list_contains(k,'rcp')) AND NOT list_contains(k,'notice') AS local_unknown, true AS local_any FROM s""")
def local_coverage_flags(spark: SparkSession, d: str) -> DataFrame:
    t = c("event_type")
    kind = F.when(t == "view", "rcp").when(t == "click", "notice").when(t == "error", "unknown")
    s = _t(spark, d, "events").where("value > 90").withColumn("kind", kind).where("kind IS NOT NULL").groupBy("user_id").agg(F.collect_set("kind").alias("k"))
    return s.select("user_id", *[x.alias(n) for n, x in V.local_coverage(c("user_id") % 9 == 0, lit(False), lit(False), c("k")).items()])


@query("""SELECT source, CASE WHEN q > 0 THEN 'usable_sections_found' WHEN t > 0 THEN 'terminology_or_class_metadata_only' WHEN n > 0 THEN 'queried_no_result' ELSE 'catalogue_only' END AS status
FROM (SELECT source, count(*) FILTER (WHERE n_chars > 30000) AS q, count(*) FILTER (WHERE n_chars BETWEEN 14000 AND 30000) AS t, count(*) AS n FROM documents GROUP BY source)""")
def review_status_ladder(spark: SparkSession, d: str) -> DataFrame:
    g = _t(spark, d, "documents").groupBy("source").agg(F.count_if(c("n_chars") > 30000).alias("q"), F.count_if(c("n_chars").between(14000, 30000)).alias("t"), _n().alias("n"))
    return g.select("source", V.review_ladder(c("q"), c("t"), c("n")).alias("status"))


@query(r"""SELECT event_id, s AS source_system, CASE s WHEN 'aifa_rcp_pdf' THEN 0.72 WHEN 'titck_metadata' THEN 0.56 ELSE round(greatest(0.55, least(value/100.0, 0.95)),4) END::DOUBLE AS confidence, CASE s WHEN 'aifa_rcp_pdf' THEN 73 WHEN 'titck_metadata' THEN 56 ELSE 60 END AS evidence_rank,
 CASE s WHEN 'aifa_rcp_pdf' THEN 'it' WHEN 'titck_metadata' THEN 'tr' ELSE '' END AS language, sha1(s||'|'||event_id||'|'||trim(props)) AS content_hash FROM (SELECT *, CASE event_id % 3 WHEN 0 THEN 'aifa_rcp_pdf' WHEN 1 THEN 'titck_metadata' ELSE 'unknown_source' END AS s FROM events)""")
def section_contract(spark: SparkSession, d: str) -> DataFrame:
    m = c("event_id") % 3
    ev = _t(spark, d, "events").withColumn("source_system", F.when(m == 0, "aifa_rcp_pdf").when(m == 1, "titck_metadata").otherwise("unknown_source"))
    return V.section_contract(ev, "source_system", c("value") / 100.0, "props", "event_id").select("event_id", "source_system", "confidence", "evidence_rank", "language", "content_hash")


_NAMES = ["PENTAXIM", "COMINARTY", "GC FLU", "CORONAVAC", "SPUTNIK LIGHT", "EUVAX B 10MCG", "HEPAVAX GENE", "BCG", "VACCIN"]
#: Vaccines and documents about them. Both engines read these texts.
_VACCINES = f"""SELECT p_partkey, concat(element_at(array({", ".join(f"'{n}'" for n in _NAMES)}), cast(1 + p_partkey % 9 AS INT)), CASE WHEN p_partkey % 4 = 0 THEN concat(' ', upper(p_name)) ELSE '' END) AS m_brand,
 element_at(array('', 'VACCIN GRIPPE', 'HEPATITE B', 'COVID ARNM'), cast(1 + p_size % 4 AS INT)) AS m_generic, element_at(array('SANOFI PASTEUR', 'PFIZER', 'BIO FARMA', 'GREEN CROSS', upper(p_type)), cast(1 + p_partkey % 5 AS INT)) AS m_lab FROM part"""
_VACCINE_DOCS = f"""SELECT n_nationkey, concat(element_at(array({", ".join(f"'{n}'" for n in ["PENTAXIM", "COMIRNATY", "GCFLU", "CORONAVAC", "SPUTNIK", "EUVAX", "HEXAXIM SANOFI"])}), cast(1 + n_nationkey % 7 AS INT)), ' ', element_at(array('INFLUENZA', 'BIO FARMA', 'PFIZER', 'RED WIDGET'), cast(1 + n_nationkey % 4 AS INT)), CASE WHEN n_nationkey % 2 = 0 THEN ' PRODUCT INFORMATION' ELSE '' END) AS title, element_at(array('package_insert', 'report', 'other'), cast(1 + n_nationkey % 3 AS INT)) AS kind FROM nation"""


def _duck(sql: str) -> str:
    return sql.replace("element_at(array(", "list_extract(list_value(")


def _vaccine_sql() -> str:
    texts = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    some = lambda hay, xs: f"len(list_filter({texts(xs)}, lambda x: contains({hay}, x))) > 0"
    syn = " || ".join(f"CASE WHEN contains(base, '{k}') OR contains('{k}', base) OR contains(m_brand, '{k}') THEN {texts(v)} ELSE [] END" for k, v in K.SYNONYMS.items())
    more = " || ".join(f"CASE WHEN {some('whole', w)} THEN {texts(t)} ELSE [] END" for w, t in K.DERIVED)
    words = lambda x: f"list_filter(list_distinct(string_split({x}, ' ')), lambda w: length(w) >= 3 AND NOT list_contains({texts(K.TITLE_STOP)}, w))"
    weight = "CASE kind " + " ".join(f"WHEN '{k}' THEN {w}" for k, w in K.DOCUMENT_WEIGHTS.items()) + " ELSE 0 END"
    single = " OR ".join(f"(base = '{k}' AND {some('title', v)})" for k, v in K.SYNONYMS.items())
    makers = " + ".join(f"CASE WHEN {some('title', n)} AND {some(own, n)} THEN {w} ELSE 0 END" for own, n, w in (("m_brand || ' ' || m_lab", ("BIONTECH", "PFIZER"), 0.20), ("m_brand || ' ' || m_lab", ("SINOVAC",), 0.22), ("m_brand || ' ' || m_lab", ("SANOFI",), 0.18)))
    return f"""WITH r AS (SELECT *, trim(regexp_replace(regexp_replace(m_brand, '\\b[0-9]+(MG|MCG|UG|ML|UI|U|DOSE|DOSES)\\b', ' ', 'g'), ' +', ' ', 'g')) AS base, m_brand || ' ' || m_generic || ' ' || m_lab AS whole FROM ({_duck(_VACCINES)})),
u AS (SELECT p_partkey, unnest([m_brand, m_generic, m_lab, base] || {syn} || {more}) AS t FROM r), v AS (SELECT p_partkey, list(DISTINCT t) FILTER (WHERE length(t) >= 3) AS terms FROM u GROUP BY p_partkey),
j AS (SELECT *, {words("whole || ' ' || array_to_string(terms, ' ')")} AS mine, {words('title')} AS own FROM r JOIN v USING (p_partkey), ({_duck(_VACCINE_DOCS)}) d),
s AS (SELECT p_partkey, n_nationkey, CASE WHEN m_brand <> '' AND contains(title, m_brand) THEN 0.60 WHEN base <> '' AND contains(title, base) THEN 0.55 ELSE 0 END + coalesce(list_sum(list_transform(list_filter(terms, lambda t: length(t) >= 5 AND contains(title, t)), lambda t: CASE WHEN list_contains({texts(K.SHARED_TERMS)}, t) THEN 0.08 ELSE 0.20 END)), 0)
 + least(0.25, 0.25 * len(list_intersect(mine, own)) / greatest(1, least(8, len(mine)))) + {makers} + CASE WHEN contains(replace(title, ' ', ''), 'BIOFARMA') AND contains(replace(m_lab, ' ', ''), 'BIOFARMA') THEN 0.22 ELSE 0 END + {weight}
 - CASE WHEN base <> '' AND NOT contains(base, ' ') AND NOT contains(title, base) AND NOT ({single}) THEN 0.15 ELSE 0 END - CASE WHEN contains(m_brand, 'PENTAXIM') AND contains(title, 'HEXAXIM') THEN 0.40 ELSE 0 END
 - CASE WHEN contains(m_brand, 'SPUTNIK') AND NOT ({some('title', ('SPUTNIK', 'GAMALEYA', 'GAM COVID'))}) THEN 0.35 ELSE 0 END - CASE WHEN contains(m_brand, 'CORONAVAC') AND NOT ({some('title', ('CORONAVAC', 'SINOVAC'))}) THEN 0.35 ELSE 0 END AS score FROM j)
SELECT p_partkey, n_nationkey, round(greatest(0, least(0.98, score)), 6)::DOUBLE AS score FROM s WHERE round(least(0.98, score), 6) >= 0.55"""


@query(_vaccine_sql())
def vaccine_document_score(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of vaccines and documents from the threshold on."""
    rows = spark.sql(_VACCINES.replace("FROM part", "FROM {part}"), part=_t(spark, d, "part"))
    docs = spark.sql(_VACCINE_DOCS.replace("FROM nation", "FROM {nation}"), nation=_t(spark, d, "nation"))
    return K.vaccine_matches(spark, rows, docs, "p_partkey", "n_nationkey").select("p_partkey", "n_nationkey", "score")


@query(f"""WITH q AS (SELECT item_id, n, list_filter(string_split(n, ' '), lambda w: length(w) >= 4) AS t FROM (SELECT item_id, {_normf('text')} AS n FROM benchmark)), r AS (SELECT doc_id, {_normf('text')} AS n FROM documents),
qt AS (SELECT DISTINCT item_id, unnest(t) AS t FROM q), rt AS (SELECT DISTINCT doc_id, unnest(string_split(n,' ')) AS t FROM r),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id) AS i FROM rt) WHERE i <= 500), h AS (SELECT DISTINCT item_id, doc_id FROM qt JOIN k USING (t)),
s AS (SELECT item_id, doc_id, round(len(list_filter(q.t, lambda w: contains(r.n, w))) / len(q.t) + CASE WHEN contains(r.n, q.n) THEN 0.2 ELSE 0 END, 4) AS score FROM h JOIN q USING (item_id) JOIN r USING (doc_id))
SELECT item_id, doc_id, score::DOUBLE AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 50""")
def bulk_record_search(spark: SparkSession, d: str) -> DataFrame:
    """The fifty best records per query, as the search returns them."""
    q = _t(spark, d, "benchmark").select("item_id", X.norm_folded("text").alias("norm"))
    r = _t(spark, d, "documents").select("doc_id", X.norm_folded("text").alias("norm"))
    return V.bulk_search(q, r, "item_id", "doc_id")


@query("""WITH k AS (SELECT p_partkey, unnest([p_type, p_brand]) AS term, unnest([0.72, 0.62]) AS conf FROM part), t AS (SELECT DISTINCT p_type AS term FROM part WHERE p_size > 40 UNION SELECT DISTINCT p_brand FROM part WHERE p_size > 45)
SELECT p_partkey, term, max(conf)::DOUBLE AS confidence FROM k JOIN t USING (term) GROUP BY 1, 2""")
def exact_term_confidence(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part")
    terms = p.where("p_size > 40").select(c("p_type").alias("term")).union(p.where("p_size > 45").select("p_brand")).distinct()
    return V.term_matches(p, terms, "p_partkey", "p_brand", "p_type", "label").select("p_partkey", "term", "confidence")


@query("""SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY floor(value)+greatest(0,100-20*(event_id % 7)) DESC, floor(value) DESC, event_id % 7, event_id) AS rn FROM events) WHERE rn = 1""")
def source_choice(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events").select("user_id", "event_id", F.floor("value").alias("s"), (c("event_id") % 7).alias("r"))
    first = ev.groupBy("user_id", "s", "r").agg(F.min("event_id").alias("event_id"))
    return V.choose_source(first, "user_id", "s", "r").select("user_id", "event_id")


@query("""WITH a AS (SELECT user_id AS source, event_id, event_type='error' AS lim, sum(CASE WHEN event_type='error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM events),
b AS (SELECT *, lim AND sum(CASE WHEN lim THEN 1 ELSE 0 END) OVER (PARTITION BY source, g ORDER BY event_id) >= 3 AS hit FROM a)
SELECT source, event_id, coalesce(bool_or(hit) OVER (PARTITION BY source ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS skipped FROM b""")
def rate_limit_stop(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events").select(c("user_id").alias("source"), "event_id", "event_type")
    return V.rate_limited(ev, c("event_id"), c("event_type") == "error", 3).select("source", "event_id", "skipped")


@query("""SELECT p_partkey, 'https://x/a/'||p_partkey AS url, 'a' AS src FROM part UNION ALL SELECT p_partkey, 'https://x/b/'||p_partkey, 'b' FROM part""")
def candidate_urls(spark: SparkSession, d: str) -> DataFrame:
    parts = [("a", "https://x/a/{code}"), ("b", "https://x/b/{code}"), ("c", "https://x/a/{code}")]
    return _t(spark, d, "part").select("p_partkey", F.inline(V.candidate_urls(c("p_partkey").cast("string"), parts))).select("p_partkey", "url", "src")


@query("""SELECT p_partkey, src, CASE src WHEN 'belgium' THEN 'registered_contact' ELSE 'registered_no_live_adapter' END AS status, CASE src WHEN 'belgium' THEN 'https://b.example/' WHEN 'spain' THEN 'https://s.example/' ELSE '' END AS url FROM (SELECT p_partkey, ['belgium', 'spain', 'japan'][1 + p_partkey % 3] AS src FROM part)""")
def registered_only_status(spark: SparkSession, d: str) -> DataFrame:
    """Rows of sources that are only registered: their status and address, no document."""
    known = _values(spark, [("belgium", " registered_contact ", "https://b.example/"), ("spain", "", "https://s.example/")], "source string, status string, url string")
    rows = _t(spark, d, "part").select("p_partkey", F.get(F.array(lit("belgium"), lit("spain"), lit("japan")), c("p_partkey") % 3).alias("src"))
    return G.registered_only(rows, "src", known).select("p_partkey", "src", "status", "url")


_SYSTEM_ROWS = "SELECT l_orderkey, l_linenumber, element_at(array('cima', 'aifa', 'titck', 'canada', 'ema', 'pmda'), cast(1 + l_orderkey % 6 AS INT)) AS src, element_at(array('ok_fi', 'OK_RCP', 'ok_kt', 'ok_kub', 'ok_other', 'not_found'), cast(1 + l_partkey % 6 AS INT)) AS status, element_at(array('https://x/dochtml/P/1', 'https://x/Foglio', 'https://x/?ts=RCP', 'https://x/?ts=rcp', 'https://x/a.PDF', 'https://x/documentPathKt'), cast(1 + l_suppkey % 6 AS INT)) AS url FROM lineitem"


@query(f"""SELECT l_orderkey, l_linenumber, CASE WHEN src = 'cima' THEN CASE WHEN url ILIKE '%/dochtml/p/%' THEN 'aemps_cima_prospecto' ELSE 'aemps_cima_ficha_tecnica' END
 WHEN src = 'aifa' THEN CASE WHEN status ILIKE '%ok_fi%' OR url ILIKE '%foglio%' THEN 'aifa_foglio_illustrativo_pdf' WHEN status ILIKE '%ok_rcp%' OR url LIKE '%ts=RCP%' THEN 'aifa_rcp_pdf' ELSE 'aifa_metadata' END
 WHEN src = 'titck' THEN CASE WHEN NOT starts_with(lower(status), 'ok_') THEN 'titck_metadata' WHEN status ILIKE '%ok_kt%' OR url ILIKE '%documentpathkt%' THEN 'titck_kt_pdf' WHEN status ILIKE '%ok_kub%' OR url ILIKE '%.pdf' THEN 'titck_kub_pdf' ELSE 'titck_metadata' END
 WHEN src = 'canada' THEN 'health_canada_dpd' WHEN src = 'ema' THEN 'ema_medicine_finder' ELSE src END AS system FROM ({_SYSTEM_ROWS.replace("element_at(array(", "list_extract(list_value(")})""")
def source_systems(spark: SparkSession, d: str) -> DataFrame:
    """What records are filed under, by source, status and address."""
    rows = spark.sql(_SYSTEM_ROWS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=_t(spark, d, "lineitem"))
    return rows.select("l_orderkey", "l_linenumber", G.source_system(c("src"), c("status"), c("url")).alias("system"))


@query("""SELECT l_orderkey, l_linenumber, round(l_quantity*l_discount,6) AS score, least(0.95, greatest(0.05, round(l_discount,2)))::DOUBLE AS clamped, l_quantity::INT // 10 AS bucket FROM lineitem""")
def score_arithmetic(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.round(c("l_quantity") * c("l_discount"), 6).alias("score"), F.least(lit(0.95), F.greatest(lit(0.05), F.round("l_discount", 2))).alias("clamped"), F.floor(c("l_quantity").cast("int") / 10).alias("bucket"))


@query("""SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING','AUTOMOBILE') AND length(trim(c_name)) >= 10 AND c_acctbal > 0 AND contains(upper(c_name),'1')""")
def gate_filters(spark: SparkSession, d: str) -> DataFrame:
    """Membership, minimum length, mask and substring filters; all reach the scan or stay in generated code."""
    cust = _t(spark, d, "customer")
    return cust.where(c("c_mktsegment").isin("BUILDING", "AUTOMOBILE") & (F.length(F.trim("c_name")) >= 10) & (c("c_acctbal") > 0) & G.mentions(F.upper("c_name"), ["1"])).select("c_custkey", "c_name", "c_mktsegment")


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END AS place FROM orders ORDER BY place, o_totalprice DESC, o_orderkey LIMIT 100""")
def case_ordered_queue(spark: SparkSession, d: str) -> DataFrame:
    """The hundred most pressing rows (a top-k report): CASE order, then mixed directions."""
    p = c("o_orderpriority")
    o = _t(spark, d, "orders").withColumn("place", F.when(p == "1-URGENT", 0).when(p == "2-HIGH", 1).otherwise(2))
    return o.orderBy("place", F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", "place")


@query("""SELECT k AS kind, n FROM (SELECT 'both' AS k, count(*) AS n FROM documents d JOIN labels USING (doc_id) UNION ALL SELECT 'document_only', count(*) FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id=d.doc_id) UNION ALL SELECT 'label_only', count(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id=l.doc_id))""")
def coverage_sets(spark: SparkSession, d: str) -> DataFrame:
    """Set algebra of ids in one full outer join."""
    a, b = _t(spark, d, "documents").select("doc_id", lit(1).alias("a")), _t(spark, d, "labels").select("doc_id", lit(1).alias("b"))
    kind = F.when(c("a").isNotNull() & c("b").isNotNull(), "both").when(c("a").isNotNull(), "document_only").otherwise("label_only")
    got = a.join(b, "doc_id", "full").groupBy(kind.alias("kind")).agg(_n().alias("n"))
    names = spark.range(1).select(F.explode(F.array(lit("both"), lit("document_only"), lit("label_only"))).alias("kind"))
    return names.join(got, "kind", "left").select("kind", F.coalesce("n", lit(0)).alias("n"))


@query("""WITH k AS (SELECT DISTINCT p_name || ' ' || p_size % 3 AS k FROM part), n AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name || ' 1' WHEN 1 THEN p_size % 4 || ' ' || left(split_part(p_name, ' ', 2), 4) || ' ' || left(p_name, 3) ELSE 'no such' END AS name FROM part), u AS (SELECT DISTINCT name FROM n),
h AS (SELECT name, coalesce(min(k) FILTER (WHERE k = name), min(k)) AS hit FROM u JOIN k ON len(list_filter(string_split(name, ' '), lambda w: length(w) > 2 AND NOT contains(k, w))) = 0 GROUP BY name)
SELECT p_partkey, hit FROM n LEFT JOIN h USING (name)""")
def index_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The key that is a name, else the first key by order that holds all its longer words."""
    p, m = _t(spark, d, "part"), c("p_partkey") % 3
    keys = p.select(F.concat_ws(" ", "p_name", (c("p_size") % 3).cast("string")).alias("k")).distinct()
    name = F.when(m == 0, F.concat("p_name", lit(" 1"))).when(m == 1, F.concat_ws(" ", (c("p_size") % 4).cast("string"), F.left(F.get(F.split("p_name", " "), lit(1)), lit(4)), F.left("p_name", lit(3)))).otherwise("no such")
    rows = p.select("p_partkey", name.alias("name"))
    hits = M.index_lookup(rows.select(c("name").alias("id"), "name").distinct(), keys, "id", "name", "k")
    return rows.join(hits, c("name") == c("id"), "left").select("p_partkey", "hit")


@query("""SELECT p_partkey, score, ok FROM (SELECT p_partkey, round((p_size % 30)/100.0 + 0.70,2)::DOUBLE AS score, p_size % 4 AS sh FROM part) q, LATERAL (SELECT score >= 0.97 OR (score >= 0.90 AND sh >= 1) OR (score >= 0.84 AND sh >= 2) AS ok)""")
def acceptance_rules(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part").select("p_partkey", F.round((c("p_size") % 30) / 100.0 + 0.70, 2).alias("score"), (c("p_size") % 4).alias("sh"))
    return p.select("p_partkey", "score", M.acceptable(c("score"), c("sh"), "nom").alias("ok"))


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def upsert_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Insert or replace by key: the last row of each key stays."""
    return R.pick(_t(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], [c("o_orderkey")], last=True)
