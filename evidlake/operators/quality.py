"""Quality flags, corrections, validation, readiness and review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidlake.functions import text as T

# Section kinds.
CLINICAL_KINDS = ("indication", "dosage", "contraindication", "interaction", "warning", "adverse_effect", "special_population", "overdose", "pharmacology", "pharmacodynamic", "pharmacokinetic", "administration", "renal_hepatic_adjustment", "composition", "storage")
METADATA_KINDS = ("identity", "presentation", "generic_group", "document_reference")
SUPPORT_SOURCES = ("pubchem_annotations", "chembl_ebi_api")
# Gap names in order.
GAPS = ("cdss_match", "local_document", "ingredient_link", "indication", "dosage", "contraindication", "interaction", "special_population")
# What to do next, in order of precedence, by the gap.
ACTIONS = (
    ("cdss_match", "P0 map medicine to CDSS/product identity"), ("ingredient_link", "P0 resolve ingredient/DCI link"), ("interaction", "P0 add interaction safety"), ("contraindication", "P0 add contraindication safety"), ("dosage", "P1 add dosage"),
    ("local_document", "P1 acquire local RCP/notice"), ("indication", "P1 add indication"), ("special_population", "P2 add pregnancy/pediatric/geriatric/lactation"),
)
ENRICH = "P3 enrich evidence"


def flags(text: Column, kind: Column, source: Column, query: Column, brand: Column, generic: Column) -> tuple[Column, Column]:
    """(flags, accepted) of a section."""
    short = F.length(T.clean(text)) < 20
    unknown = (source == "chembl_ebi_api") & (T.norm(text) == "UNKNOWN")
    by_brand = (source == "pubchem_annotations") & (T.norm(query) != "") & (T.norm(query) == T.norm(brand)) & (T.norm(query) != T.norm(generic))
    listed = T.join_flags([(short, "empty_or_too_short"), (unknown, "noninformative_unknown_mechanism"), (by_brand, "brand_query_support_source_needs_review"), (source.isin(*SUPPORT_SOURCES), "support_only_not_full_rcp"), ((kind != "") & ~kind.isin(*CLINICAL_KINDS), "non_clinical_or_metadata_section")])
    return listed, ~(short | unknown | by_brand)


def validation(medicines: DataFrame, evidence: DataFrame) -> DataFrame:
    """(name, value): the scalar checks of a release, in one pass over each table and two anti joins.

    ``medicines``: row_id, amm, status, accepted_rows; ``evidence``: row_id, section_id, content_hash, source_system, tier,
    kind, amm, quality_flags, accepted. The check of the file itself is whether both tables can be read and have rows.
    """
    one = F.count(F.lit(1))
    flag = lambda name: F.array_contains(F.split(F.coalesce("quality_flags", F.lit("")), ";"), name)
    ok = F.col("accepted")
    sums = evidence.agg(
        one.alias("evidence_rows"),
        F.count_if(ok).alias("accepted_evidence_rows"),
        F.countDistinct(F.when(ok, F.col("row_id"))).alias("accepted_medicine_rows"),
        F.count_if(ok & (F.col("tier").startswith("D_") | flag("support_only_not_full_rcp"))).alias("accepted_support_only_rows"),
        F.count_if(ok & (F.col("kind").isin(*METADATA_KINDS) | flag("non_clinical_or_metadata_section"))).alias("accepted_nonclinical_metadata_rows"),
    )
    meds = medicines.agg(
        one.alias("medicine_rows"),
        F.count_if(F.col("status").startswith("uncovered")).alias("uncovered_medicine_rows"),
        F.count_if(F.col("status").startswith("covered") & (F.col("accepted_rows") == 0)).alias("covered_zero_accepted_medicines"),
        F.count_if(F.col("status").startswith("uncovered") & (F.col("accepted_rows") > 0)).alias("uncovered_with_accepted_medicines"),
    )
    twice = lambda df, key, name: df.groupBy(key).agg(one.alias("n")).agg(F.count_if(F.col("n") > 1).alias(name))
    known = medicines.select(F.col("row_id").alias("__id"), F.col("amm").alias("__amm")).distinct()
    orphans = evidence.join(known, F.col("row_id") == F.col("__id"), "left_anti").agg(one.alias("orphan_evidence_rows"))
    lab = evidence.where(ok & (F.col("source_system") == "tunisia_lab_local_document") & (F.coalesce("amm", F.lit("")) != ""))
    unlike = lab.join(known.where(F.coalesce("__amm", F.lit("")) != ""), F.col("row_id") == F.col("__id")).agg(F.count_if(T.norm_code_loose("amm") != T.norm_code_loose("__amm")).alias("accepted_lab_amm_mismatch_rows"))
    parts = [sums, meds, twice(medicines, "row_id", "duplicate_medicine_row_ids"), orphans, twice(evidence, "section_id", "duplicate_section_ids"), twice(evidence.where(F.coalesce("content_hash", F.lit("")) != ""), "content_hash", "duplicate_content_hashes"), unlike]
    rows = [p.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("value")) for c in p.columns]))) for p in parts]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    sound = out.where(F.col("name").isin("evidence_rows", "medicine_rows")).agg(F.min("value").alias("v")).select(F.lit("integrity_check").alias("name"), (F.col("v") > 0).cast("long").alias("value"))
    return out.unionByName(sound)


def source_counts(evidence: DataFrame) -> DataFrame:
    """Rows and medicines by source, tier and acceptance."""
    return evidence.groupBy("source_system", "tier", "accepted").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("row_id").alias("medicines"))


# Names of the buckets by the best accepted tier.
BUCKETS = (("A_", "A local Tunisia clinical evidence"), ("B_", "B foreign official clinical evidence only"), ("C_", "C cached fallback clinical evidence only"), ("D_", "D support-only evidence only"))
NO_EVIDENCE = "No accepted clinical evidence"


def medicine_buckets(medicines: DataFrame, evidence: DataFrame) -> DataFrame:
    """(bucket, medicines) by the best tier of accepted evidence."""
    best = evidence.where("accepted").groupBy("row_id").agg(F.min(F.left("tier", F.lit(2))).alias("t"))
    name = F.lit(NO_EVIDENCE)
    for tier, label in reversed(BUCKETS):
        name = F.when(F.col("t") == tier, label).otherwise(name)
    return medicines.select("row_id").join(best, "row_id", "left").groupBy(name.alias("bucket")).agg(F.count(F.lit(1)).alias("medicines"))


def near_cap(sections: DataFrame, index: DataFrame, length: Column, stem: str, least: int = 4800, cap: int = 5000) -> DataFrame:
    """Documents whose sections come near the length cap, with their file from an index by normalised stem (null if none).

    ``sections``: stem; ``index``: stem, path (the first path of a stem counts).
    """
    near = sections.withColumn("__n", length).where(F.col("__n") >= least)
    got = near.groupBy(T.norm(stem).alias("stem")).agg(F.count(F.lit(1)).alias("near_cap"), F.count_if(F.col("__n") == cap).alias("at_cap"), F.max("__n").alias("longest"))
    files = index.groupBy(T.norm(stem).alias("stem")).agg(F.min("path").alias("path"))
    return got.join(files, "stem", "left")


def priority(critical: Column, have: Column, need: int) -> Column:
    """1 for critical medicines, then complete (2), partial (3) and empty (4) ones, by how many of the needed parts there are."""
    return F.when(critical, 1).when(have >= need, 2).when(have > 0, 3).otherwise(4)


def correct(df: DataFrame, rules: list[tuple[str, Column, str]], accepted: str = "accepted", flags_: str = "quality_flags") -> DataFrame:
    """Applies (name, condition, flag) rules in turn to rows still accepted; adds one boolean column per rule."""
    for name, cond, flag in rules:
        df = df.withColumn(name, F.col(accepted) & F.coalesce(cond, F.lit(False)))
        df = df.withColumn(flags_, F.when(F.col(name), T.append_flag(flags_, flag)).otherwise(F.col(flags_))).withColumn(accepted, F.col(accepted) & ~F.col(name))
    return df


def action_log(df: DataFrame, names: list[str]) -> DataFrame:
    """(action_name, affected_rows) of corrections, in one pass."""
    row = df.agg(*[F.count_if(F.col(n)).alias(n) for n in names])
    return row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("action_name"), F.col(n).alias("affected_rows")) for n in names])))


def readiness(document: Column, matched: Column, indication: Column, dosage: Column, contraindication: Column, interaction: Column) -> Column:
    """high, medium or low from what is known about a medicine (counts and booleans)."""
    full = document & matched & (indication > 0) & (dosage > 0) & (contraindication > 0) & (interaction > 0)
    some = matched & ((indication > 0) | (dosage > 0)) & ((contraindication > 0) | (interaction > 0))
    return F.when(full, "high").when(some, "medium").otherwise("low")


def gap_text(have: dict[str, Column]) -> Column:
    """'missing_x; ' for each gap, in order."""
    return T.gap_flags([(~have[g], f"missing_{g}") for g in GAPS if g in have])


def next_action(have: dict[str, Column]) -> tuple[Column, Column]:
    """(action, its place in the order of precedence)."""
    action, place = None, None
    for n, (gap, label) in enumerate(ACTIONS):
        if gap not in have:
            continue
        action = F.when(~have[gap], label) if action is None else action.when(~have[gap], label)
        place = F.when(~have[gap], n) if place is None else place.when(~have[gap], n)
    return action.otherwise(ENRICH), place.otherwise(len(ACTIONS))


def bucket(tier: Column) -> Column:
    """The letter before a tier's underscore, A to D, else none."""
    letter = F.left(tier, F.lit(2))
    return F.when(letter.isin("A_", "B_", "C_", "D_"), F.left(tier, F.lit(1))).otherwise("none")


def review_reasons(score: Column, candidates: Column, generic: Column, least: float = 0.93) -> Column:
    """Why a match needs a look: array of reasons."""
    return F.array_compact(F.array(F.when(score < least, F.lit("low_score")), F.when(candidates > 1, F.lit("multiple_candidates")), F.when(generic, F.lit("generic_match"))))


def manifest(df: DataFrame, source: str, kept: Column, accepted: Column) -> DataFrame:
    """Rows loaded, accepted and rejected (duplicates and unaccepted ones) per source."""
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("loaded_rows"), F.count_if(kept & accepted).alias("accepted_rows"), F.count_if(~(kept & accepted)).alias("rejected_rows"))


def status_probe(status: Column, content_type: Column, first: Column) -> Column:
    """What a document address gives, from an HTTP status, a content type and the first bytes (text)."""
    pdf = F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("pdf")) | first.startswith("%PDF")
    return F.when(status.isNull(), "not_checked").when(status.isin(404, 410), "not_found").when(status >= 400, "http_error").when(first.startswith("%PDF"), "verified").when(pdf, "not_a_pdf").otherwise("not_a_pdf")
