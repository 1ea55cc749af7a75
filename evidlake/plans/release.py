"""The evidence release, its corrections, coverage and the prescription mart as chained, immutable plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidlake.functions import text as X
from evidlake.operators import quality as Q
from evidlake.operators import relational as R

# Release sources in order of priority: (file, source system, tier, rank, language); blank: the row's own.
SOURCES = (
    ("rcp_section_extraction_candidates", "tunisia_dpm_local_rcp_pdf", "A_local_official_rcp", 95, "fr"),
    ("lab_document_section_candidates", "tunisia_lab_local_document", "A_local_lab_document", 90, "fr"),
    ("local_document_recovered_sections", "local_ocr_html_recovered_document", "A_local_recovered_document", 88, "fr"),
    ("fallback_label_section", "", "C_cached_us_label_fallback", None, ""),
    ("bdpm_api_fallback_sections", "bdpm_api_medicaments_fr", "B_bdpm_fr_metadata", 58, "fr"),
    ("openfda_live_fallback_sections", "openfda_live_label", "B_us_official_label", 68, "en"),
    ("eu_uk_live_fallback_sections", "", "", None, "en"),
    ("global_regulatory_cima_cache_recovered_sections", "aemps_cima_ficha_tecnica", "B_eu_regulatory_rcp", 74, "es"),
    ("swissmedic_aips_targeted_sections", "swissmedic_aips_professional_info", "B_ch_regulatory_professional_info", 76, "de/fr/it"),
    ("who_vaccine_fallback_sections", "who_vaccine_product_information", "B_who_vaccine_product_info", 74, "en"),
    ("global_regulatory_fallback_sections_cecmed_v3", "cecmed_rcp_pdf", "B_foreign_regulatory_rcp", 70, "es"),
    ("global_regulatory_fallback_sections", "", "C_global_regulatory_metadata", 50, ""),
)
# Tier and rank by source system, before the file's own.
OVERRIDES = {
    "emc_smpc_html": ("B_uk_regulatory_smpc", 63), "chembl_ebi_api": ("D_support_pharmacology", 56), "pubchem_annotations": ("D_support_pubchem_annotation", 53),
    "bdpm_api_medicaments_fr": ("B_bdpm_fr_metadata", 58), "openfda_live_label": ("B_us_official_label", 68), "dailymed_spl": ("B_us_official_label", 72),
}


def graded(df: DataFrame, source: str = "source_system", tier: str = "tier", rank: str = "rank") -> DataFrame:
    """Tier and rank by source system where one is set, else the row's own."""
    t, r = F.col(tier), F.col(rank)
    for name, (tt, rr) in OVERRIDES.items():
        t, r = F.when(F.col(source) == name, tt).otherwise(t), F.when(F.col(source) == name, rr).otherwise(r)
    return df.withColumn(tier, t).withColumn(rank, r)


def sections(df: DataFrame, key: list[Column], order: list[Column]) -> DataFrame:
    """The first section of each content hash, by source order."""
    return R.pick(df.withColumn("content_hash", X.content_hash(*key)), ["content_hash"], order)


def rollup(df: DataFrame, by: str, accepted: Column, lang: str) -> DataFrame:
    """Per source: sections, accepted ones, languages, and the sorted list of accepted languages, in one shuffle."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("section_rows"),
        F.count_if(accepted).alias("accepted_rows"),
        F.countDistinct(lang).alias("n_langs"),
        R.concat_set(F.when(accepted, F.col(lang))).alias("accepted_langs"),
    )


def coverage(medicines: DataFrame, evidence: DataFrame, key: str, rank: str, source: str, accepted: str) -> DataFrame:
    """Per medicine: evidence rows, accepted ones, best rank, best source (ties by name) and a status; one aggregate."""
    got = evidence.groupBy(key).agg(
        F.count(F.lit(1)).alias("evidence_rows"),
        F.count_if(F.col(accepted)).alias("accepted_rows"),
        F.coalesce(F.max(F.when(F.col(accepted), F.col(rank))), F.lit(0)).alias("best_rank"),
        F.min(F.when(F.col(accepted), F.struct((-F.col(rank)).alias("r"), F.col(source).alias("s")))).alias("__b"),
    )
    out = medicines.join(got, key, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    status = F.when(F.coalesce("accepted_rows", F.lit(0)) > 0, "covered_by_accepted_clinical_evidence").otherwise("uncovered_no_accepted_clinical_evidence")
    return out.select(*medicines.columns, zero("evidence_rows"), zero("accepted_rows"), zero("best_rank"), F.coalesce(F.col("__b.s"), F.lit("")).alias("best_source"), status.alias("status"))


def corrected(df: DataFrame, mismatch: Column) -> DataFrame:
    """The three corrections in turn: support-only tiers, metadata kinds, registration mismatches."""
    return Q.correct(
        df,
        [
            ("fix_support", F.col("tier").startswith("D_"), "support_only_not_clinical_evidence"),
            ("fix_metadata", F.col("kind").isin(*Q.METADATA_KINDS), "metadata_not_clinical_section"),
            ("fix_mismatch", mismatch, "registration_number_mismatch"),
        ],
    )


def modules(df: DataFrame, counts: list[str]) -> DataFrame:
    """(module, rows_with, total): coverage of every module in one scan."""
    row = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c) > 0).alias(c) for c in counts])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("module"), F.col(c).alias("rows_with"), F.col("total").alias("total_rows")) for c in counts])))
