"""Coverage, availability and review plans, the section contract, and further matchers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidlake.functions import text as X
from evidlake.functions.unicode import once
from evidlake.operators import containment as C
from evidlake.operators import relational as R

# Fixed values: (confidence, rank, language) that adapters give their sections.
ADAPTERS = {
    "aemps_cima_ficha_tecnica": (0.72, 74, "es"), "aemps_cima_prospecto": (0.68, 70, "es"), "ema_medicine_finder": (0.70, 72, "en"), "mhra_products_smpc": (0.66, 69, "en"), "emc_smpc_html": (0.62, 63, "en"), "aifa_rcp_pdf": (0.72, 73, "it"),
    "aifa_foglio_illustrativo_pdf": (0.66, 67, "it"), "aifa_metadata": (0.58, 57, "it"), "titck_kub_pdf": (0.70, 71, "tr"), "titck_kt_pdf": (0.64, 65, "tr"), "titck_metadata": (0.56, 56, "tr"), "health_canada_dpd": (0.58, 58, "en"), "cecmed_rcp_pdf": (0.70, 71, "es"),
    "chembl_ebi_api": (0.55, 56, "en"), "pubchem_annotations": (0.52, 53, "en"), "openfda_live_label": (0.68, 68, "en"), "dailymed_live_spl": (0.64, 66, "en"),
}


def availability(rcp_mapped: Column, rcp_listed: Column, notice: Column, lab: Column, status: Column) -> dict[str, Column]:
    """Flags of a medicine's documents; a 404 counts only where nothing else is there."""
    rcp = rcp_mapped | rcp_listed
    detail = rcp | notice
    return {"has_rcp": rcp, "has_notice": notice, "has_detail": detail, "has_actual_or_lab": detail | lab, "is_404": (status == 404) & ~rcp}


def local_coverage(stem: Column, downloaded: Column, text: Column, kinds: Column) -> dict[str, Column]:
    """Local coverage flags from file matches and the set of document kinds found."""
    has = lambda *k: F.arrays_overlap(kinds, F.array(*[F.lit(x) for x in k]))
    rcp, notice = stem | downloaded | text | has("rcp", "both"), has("notice", "both")
    unknown = (F.size(kinds) > 0) & ~rcp & ~notice
    return {"local_rcp": rcp, "local_notice": notice, "local_unknown": unknown, "local_any": rcp | notice | unknown}


def review_ladder(usable: Column, terminology: Column, queried: Column) -> Column:
    """How far the review of a medicine without evidence has come."""
    return F.when(usable > 0, "usable_sections_found").when(terminology > 0, "terminology_or_class_metadata_only").when(queried > 0, "queried_no_result").otherwise("catalogue_only")


def section_contract(df: DataFrame, source: str, score: Column, text: str, key: str) -> DataFrame:
    """Adds confidence, evidence_rank, language and content_hash as adapters give them; unknown sources follow the score."""
    names = F.create_map(*[F.lit(x) for name, v in ADAPTERS.items() for x in (name, name)])
    known = F.element_at(names, F.col(source)).isNotNull()

    def of(i: int, default: Column) -> Column:
        m = F.create_map(*[F.lit(x) for name, v in ADAPTERS.items() for x in (name, v[i])])
        return F.when(known, F.element_at(m, F.col(source))).otherwise(default)

    return df.withColumns({
        "confidence": F.round(of(0, F.greatest(F.lit(0.55), F.least(score, F.lit(0.95)))), 4),
        "evidence_rank": of(1, F.lit(60)),
        "language": of(2, F.lit("")),
        "content_hash": X.content_hash(F.col(source), F.col(key).cast("string"), F.left(X.clean(text), F.lit(500))),
    })


def bulk_search(queries: DataFrame, records: DataFrame, query_id: str, record_id: str, text: str = "norm", k: int = 50, per_word: int = 500, least: int = 4) -> DataFrame:
    """Records by the share of query words that they hold (as parts of words, too), plus 0.2 for the whole query; the best k.

    Both sides have ``text``, a normal form. Words of ``least`` letters or more are looked up; of each the first ``per_word``
    records by id are candidates (the search's own limit, which also bounds what a hot word costs).
    """
    q = queries.select(query_id, F.col(text).alias("__q"), F.filter(F.split(text, " "), lambda w: F.length(w) >= least).alias("__qt")).where(F.size("__qt") > 0)
    asked = q.select(query_id, F.explode(F.array_distinct("__qt")).alias("__t"))
    # each record is read once; what follows sees the words and queries that it holds, never its text
    rows = C.marked(records, asked.select("__t").union(q.select("__q")), record_id, text)
    posts = rows.select(record_id, F.explode("words").alias("__t"))
    near = asked.join(R.top(posts, ["__t"], [F.col(record_id)], per_word, "__n"), "__t").select(query_id, record_id).distinct()
    full = near.join(rows.select(record_id, "held"), record_id).join(q, query_id)
    # looked up by hash first, since records hold many words; a query's words count as often as they come
    shared = once(F.array_intersect("__qt", "held"), lambda both: F.size(F.filter("__qt", lambda w: F.array_contains(both, w))))
    score = F.round(shared / F.size("__qt") + F.when(F.array_contains("held", F.col("__q")), 0.2).otherwise(0.0), 4)
    return R.top(full.withColumn("score", score), [query_id], [F.desc("score"), F.col(record_id)], k).select(query_id, record_id, "score", "rank")


def term_matches(rows: DataFrame, terms: DataFrame, row_id: str, brand: str, generic: str, kind: str) -> DataFrame:
    """Exact term matches, by generic name first, with the confidences of a kind of record."""
    from evidlake.operators.matching import TERM_CONFIDENCE

    by_generic, by_brand = TERM_CONFIDENCE[kind]
    keys = rows.select(row_id, F.explode(F.array(F.struct(F.lit("generic").alias("by"), F.col(generic).alias("term")), F.struct(F.lit("brand").alias("by"), F.col(brand).alias("term")))).alias("x")).select(row_id, "x.*").where(F.length("term") >= 3)
    got = keys.join(terms, "term").withColumn("confidence", F.when(F.col("by") == "generic", by_generic).otherwise(by_brand))
    return R.pick(got, [row_id, "term"], [F.col("confidence")], last=True)


def choose_source(df: DataFrame, key: str, score: str, rank: str) -> DataFrame:
    """The source with the largest (adapter score + max(0, 100 - 20 rank), adapter score, -rank)."""
    best = F.max_by(F.struct("*"), F.struct(F.col(score) + F.greatest(F.lit(0), 100 - 20 * F.col(rank)), F.col(score), -F.col(rank)))
    return df.groupBy(key).agg(best.alias("x")).select("x.*")


def rate_limited(df: DataFrame, order: Column, limited: Column, stop: int) -> DataFrame:
    """Marks what a fetcher would skip: everything after ``stop`` consecutive rate limits (by partition of one source)."""
    from pyspark.sql import Window

    w = Window.partitionBy("source").orderBy(order)
    runs = df.withColumn("__ok", F.sum(F.when(limited, 0).otherwise(1)).over(w))
    streak = F.sum(F.when(limited, 1).otherwise(0)).over(Window.partitionBy("source", "__ok").orderBy(order))
    hit = runs.withColumn("__hit", F.when(limited & (streak >= stop), 1).otherwise(0))
    before = F.coalesce(F.max("__hit").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return hit.withColumn("skipped", before == 1).drop("__ok", "__hit")


def candidate_urls(code: Column, parts: Sequence[tuple[str, str]]) -> Column:
    """array<struct<src, url>> of document addresses by templates, in order, equal addresses once."""
    made = F.array(*[F.struct(F.lit(src).alias("src"), F.replace(F.lit(t), F.lit("{code}"), code).alias("url")) for src, t in parts])
    urls = F.transform(made, lambda x: x["url"])
    return F.filter(made, lambda x, i: F.array_position(urls, x["url"]) == i + 1)
