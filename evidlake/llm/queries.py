"""The registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, embed, html, jaccard, langid, linededup, lm, merge, mixing, packing, quality, sharding, whiten
from .common import Scratch, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base features, base verdict and the verdict of risk-controlled thresholds for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = quality.assess(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), scratch=Scratch(spark))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("rejected_by", ",").alias("rejected_by"))


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document at a Jaccard similarity of 0.9 on 3-word shingles."""
    return jaccard.join(spark, table(spark, sf_dir, "documents"), words=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, learned from four of five folds."""
    return langid.identify(spark, table(spark, sf_dir, "documents"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and suffix-tree scores of every document, learned from six of seven folds."""
    out = lm.score_all(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the blocks of lines that it shares with an earlier one."""
    out = linededup.dedup(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines_removed", "n_lines_left", "text")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix to weights 5, 2, 1, ... takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.Mix(spark, docs).taken().select("doc_id", "size", "source_size", "target", "taken")


def op10_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    return embed.near_duplicates(spark, table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document: eight shards that all hold the sources in proportion."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    out = sharding.interleave(docs, 8, extra=(F.col("text_crc32"), F.col("size")))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 1024 tokens."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = Scratch(spark).cut(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("ids"))
    return packing.pack(spark, cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document ever present after both branches are merged, and what was merged and in conflict."""
    out = merge.merge(spark, table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return out.select("doc_id", "lang", "source", F.sha2("text", 256).alias("text_sha256"), "n_clean", "n_edit_edit", "n_edit_delete", "n_insert_insert")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of every usable embedding."""
    out = whiten.Whitening(spark, table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).transform()
    return out.withColumn("deviation", F.expr("try_cast(deviation AS LONG)"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item, and the items."""
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text")
    out = decontaminate.Decontamination(spark, docs, items).report()
    names = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return out.select(F.col("key").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), names, (F.col("n_hit") > 0).alias("contaminated"))


def queries() -> dict[str, Query]:
    ops = (op1_quality, op2_jaccard, op3_langid, op4_html, op5_lm, op6_linededup, op7_mixing, op8_sharding, op9_packing, op10_embed, op11_merge, op12_whitening, op13_decontamination)
    return {f.__name__: f for f in ops}


#: Links reach: the smallest id within reach of each node of ``e`` (x, y in both directions).
_REACH = """r AS (SELECT x AS node, y AS seen FROM e UNION SELECT r.node, e.y FROM r JOIN e ON r.seen = e.x), c AS (SELECT node, least(node, min(seen)) AS component_id FROM r GROUP BY node)"""

OP2_SQL = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM t a JOIN t b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p), {_REACH}
SELECT doc_id, len(s) AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM s LEFT JOIN c ON node = doc_id"""

OP10_SQL = f"""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))) > 0),
p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.95), e AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p), {_REACH},
n AS (SELECT x, count(*) AS n FROM e GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept FROM embeddings LEFT JOIN c ON node = vec_id LEFT JOIN n ON x = vec_id"""


#: CRC-32 as SQL: the table of its polynomial, then one look-up a byte.
_CRC = "t AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"

OP8_SQL = rf"""WITH {_CRC},
b AS (SELECT doc_id, source, list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM documents),
d AS (SELECT doc_id, coalesce('s' || source, '-') AS src, (len(b) + 1)::BIGINT AS size, xor(list_reduce([4294967295::BIGINT] || b, lambda c, x: xor(c >> 8, t.t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM b, t),
h AS (SELECT *, md5(concat_ws(':', '{sharding.SEED}', coalesce(doc_id::VARCHAR, ''), text_crc32, size)) AS h FROM d),
r AS (SELECT *, (2 * (row_number() OVER (PARTITION BY src ORDER BY h, doc_id NULLS FIRST, text_crc32, size) - 1) + 1) / (2 * count(*) OVER (PARTITION BY src)) AS frac FROM h),
p AS (SELECT *, row_number() OVER (ORDER BY frac, src, h, doc_id NULLS FIRST, text_crc32, size) - 1 AS pos, count(*) OVER () AS n FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, (pos * 8 // n)::INTEGER AS shard, pos - (pos * 8 // n * n + 7) // 8 AS slot, NULL::INTEGER AS grown_shard FROM p"""


#: Each branch's rows, columns and lines as two tables of changes; then rows are judged one by one.
OP11_SQL = rf"""WITH {_CRC},
d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
n AS (SELECT doc_id, unnest(['row', 'lang', 'source'] || [i::VARCHAR for i in range(len(x))]) AS name, unnest(['row', lang, source] || x) AS v FROM d),
k AS (SELECT doc_id, name, v, b, xor(list_reduce([4294967295::BIGINT] || [ascii(c) for c in string_split(b || ':' || doc_id || ':' || name, '')], lambda c, x: xor(c >> 8, t.t[(xor(c, x) & 255) + 1])), 4294967295) % 11 AS c FROM n, t, (VALUES ('L'), ('R')) z(b)),
p AS (SELECT l.doc_id, l.name, l.v, l.c AS cl, r.c AS cr FROM k l JOIN k r USING (doc_id, name) WHERE l.b = 'L' AND r.b = 'R'),
u AS (SELECT doc_id, name, 0 AS gap, v, CASE WHEN cl = 0 THEN CASE WHEN name IN ('lang', 'source') THEN '' END WHEN cl = 1 THEN v || '!' WHEN cl = 2 THEN v || '?' ELSE v END AS l,
  CASE WHEN cr = 0 THEN CASE WHEN name IN ('lang', 'source') THEN '' END WHEN cr = 1 THEN v || '!' WHEN cr = 2 THEN v || '?' ELSE v END AS r FROM p WHERE name <> 'row'
  UNION ALL SELECT doc_id, name, 1, NULL, CASE cl WHEN 3 THEN '!' WHEN 4 THEN '?' END, CASE cr WHEN 3 THEN '!' WHEN 4 THEN '?' END FROM p WHERE name NOT IN ('row', 'lang', 'source')),
m AS (SELECT *, l IS DISTINCT FROM v AS dl, r IS DISTINCT FROM v AS dr, l IS DISTINCT FROM r AS x FROM u),
w AS (SELECT *, CASE WHEN dl AND dr AND x THEN v WHEN dl THEN l ELSE r END AS o, dl AND dr AND x AS bad, TRY_CAST(name AS BIGINT) AS line FROM m),
g AS (SELECT doc_id, bool_or(dl) AS any_l, bool_or(dr) AS any_r, count(*) FILTER ((dl OR dr) AND NOT bad) AS clean, count(*) FILTER (bad AND gap = 0 AND l IS NOT NULL AND r IS NOT NULL) AS ee,
  count(*) FILTER (bad AND gap = 0 AND (l IS NULL OR r IS NULL)) AS ed, count(*) FILTER (bad AND gap = 1) AS ii, max(o) FILTER (name = 'lang') AS lang, max(o) FILTER (name = 'source') AS source,
  coalesce(string_agg(o, chr(10) ORDER BY line, gap) FILTER (line IS NOT NULL AND o IS NOT NULL), '') AS text FROM w GROUP BY doc_id),
j AS (SELECT d.*, g.* EXCLUDE (doc_id, lang, source), g.lang AS new_lang, g.source AS new_source, cl, cr, CASE WHEN cl = 0 AND cr = 0 THEN 'gone' WHEN cl = 0 THEN CASE WHEN any_r THEN 'bad' ELSE 'gone' END WHEN cr = 0 THEN CASE WHEN any_l THEN 'bad' ELSE 'gone' END ELSE 'kept' END AS how
  FROM d JOIN g USING (doc_id) JOIN p USING (doc_id) WHERE p.name = 'row'),
a AS (SELECT -1 - doc_id AS doc_id, 'L' AS b, CASE cl WHEN 3 THEN '!' ELSE '?' END AS text, lang, source FROM j WHERE cl IN (3, 4) UNION ALL SELECT -2 - doc_id, 'R', CASE cr WHEN 3 THEN '!' ELSE '?' END, lang, source FROM j WHERE cr IN (3, 4)),
b AS (SELECT doc_id, count(DISTINCT (text, lang, source)) > 1 AS bad, min(text) AS text, min(lang) AS lang, min(source) AS source FROM a GROUP BY doc_id)
SELECT doc_id, CASE how WHEN 'kept' THEN new_lang WHEN 'bad' THEN lang END AS lang, CASE how WHEN 'kept' THEN new_source WHEN 'bad' THEN source END AS source, CASE how WHEN 'kept' THEN sha256(text) WHEN 'bad' THEN sha256(array_to_string(x, chr(10))) END AS text_sha256,
  CASE how WHEN 'kept' THEN clean WHEN 'gone' THEN 1 ELSE 0 END AS n_clean, CASE how WHEN 'kept' THEN ee ELSE 0 END AS n_edit_edit, CASE how WHEN 'kept' THEN ed WHEN 'bad' THEN 1 ELSE 0 END AS n_edit_delete, CASE how WHEN 'kept' THEN ii ELSE 0 END AS n_insert_insert FROM j
UNION ALL SELECT doc_id, CASE WHEN NOT bad THEN lang END, CASE WHEN NOT bad THEN source END, CASE WHEN NOT bad THEN sha256(text) END, CASE WHEN bad THEN 0 ELSE 1 END, 0, 0, CASE WHEN bad THEN 1 ELSE 0 END FROM b"""

#: Every run of words of a document as long as some window, compared with all windows.
OP13_SQL = r"""WITH f AS (SELECT 'd' AS k, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
s AS (SELECT k, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM f),
i AS (SELECT DISTINCT id AS item, least(10, len(w)) AS n, unnest([array_to_string(w[j : j + least(10, len(w)) - 1], ' ') for j in range(1, len(w) - least(10, len(w)) + 2)]) AS win FROM s WHERE k = 'i' AND len(w) > 0),
z AS (SELECT DISTINCT n FROM i),
o AS (SELECT id, n, unnest(range(1, len(w) - n + 2)) AS pos, unnest([array_to_string(w[j : j + n - 1], ' ') for j in range(1, len(w) - n + 2)]) AS win FROM s, z WHERE k = 'd' AND len(w) >= n),
h AS (SELECT o.id, o.n, pos, item FROM o JOIN i USING (win)),
c AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(pos, pos + n)) AS p FROM (SELECT DISTINCT id, n, pos FROM h)) GROUP BY id),
t AS (SELECT id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS x FROM (SELECT DISTINCT id, item::VARCHAR AS item FROM h) GROUP BY id)
SELECT s.id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(x, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM s LEFT JOIN c ON s.id = c.id LEFT JOIN t ON s.id = t.id WHERE k = 'd'"""


def oracle_sql() -> dict[str, str]:
    """The operators that SQL can express on small tables; the tests hold the others against plain models."""
    return {"op2_jaccard": OP2_SQL, "op8_sharding": OP8_SQL, "op10_embed": OP10_SQL, "op11_merge": OP11_SQL, "op13_decontamination": OP13_SQL}
