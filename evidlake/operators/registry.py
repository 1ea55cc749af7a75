"""Matching against a registry by narrowing: the code first, then the name, then weighted agreement of all other fields.

A code that one row has decides. Several rows with the code are narrowed by the name, if the registry knows it; without a code
the name alone narrows; without either, all rows are candidates. Of the candidates the one that agrees in the heaviest
fields wins; ties are broken by the presentation or reported.

No query meets its candidates one by one. For every scope (a code, a name, both, or the whole registry) and every set of
fields the registry's rows are counted by their values, which combines in the tasks that read them; a query looks its own
values up, at most 32 sets of them. The heaviest set that is found is the best agreement, its count says how many rows share
it: a row that agreed in two sets of that weight would agree in their union, which is heavier.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weights of fields.
CODE, NAME = 100, 40
SOFT = {"dosage": 20, "forme": 15, "presentation": 10, "nom_generique": 10, "labo": 5}
_SEP = "\x1f"


def _sets() -> list[tuple[str, ...]]:
    return [s for n in range(len(SOFT) + 1) for s in combinations(SOFT, n)]


def _agreements(prefix: str) -> Column:
    """array<struct<fields, weight, shown, value>>: every set of fields of which none is empty."""
    out = []
    for n, fields in enumerate(_sets()):
        own = [F.col(prefix + f) for f in fields]
        row = F.struct(F.lit(n).alias("fields"), F.lit(sum(SOFT[f] for f in fields)).alias("weight"), F.lit("presentation" in fields).alias("shown"), F.concat_ws(_SEP, *own).alias("value"))
        full = F.lit(True)
        for c in own:
            full = full & (c != "")
        out.append(F.when(full, row))
    return F.array_compact(F.array(*out))


def narrowed(queries: DataFrame, registry: DataFrame, key: str, candidate: str) -> DataFrame:
    """(key, candidate, score, outcome) for every query.

    ``queries`` have q_amm, q_nom and q_<field> for the fields of SOFT, ``registry`` the same with r_, as comparison keys (empty for none).
    Outcomes: AMM exact, Scored unique, Tie-broken by presentation, Ambiguous tie (n), No candidate, No scored match; the candidate
    is null for the last three. Of rows that share a code alone the smallest candidate stands where only their number counts.
    """
    count = F.count(F.lit(1))
    codes = registry.where("r_amm <> ''").groupBy(F.col("r_amm").alias("q_amm")).agg(count.alias("n_code"), F.min(candidate).alias("by_code"))
    names = registry.where("r_nom <> ''").groupBy(F.col("r_nom").alias("q_nom")).agg(count.alias("n_name"))
    both = registry.where("r_amm <> '' AND r_nom <> ''").groupBy(F.col("r_amm").alias("q_amm"), F.col("r_nom").alias("q_nom")).agg(count.alias("n_both"))
    q = queries.join(codes, "q_amm", "left").join(names, "q_nom", "left").join(both, ["q_amm", "q_nom"], "left")
    some = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    scope = F.when(F.col("n_code") == 1, "decided").when(some("n_code") & some("n_both"), "both").when(some("n_code") & some("n_name"), "none").when(some("n_code"), "code").when(some("n_name"), "name").otherwise("all")
    q = q.withColumn("scope", scope).withColumn("within", F.when(F.col("scope") == "both", F.concat_ws(_SEP, "q_amm", "q_nom")).when(F.col("scope") == "code", F.col("q_amm")).when(F.col("scope") == "name", F.col("q_nom")).otherwise(""))
    asked = q.where(F.col("scope").isin("both", "code", "name", "all"))
    narrow = asked.where("scope <> 'all'").select("scope", "within").distinct()
    place = lambda scope, within: F.struct(F.lit(scope).alias("scope"), F.coalesce(within, F.lit("")).alias("within"))
    scopes = F.array(place("code", F.col("r_amm")), place("name", F.col("r_nom")), place("both", F.concat_ws(_SEP, "r_amm", "r_nom")))
    # the whole registry is one scope, taken as it is: joined by it, all rows would go to one task
    whole = registry.select("*", F.lit("all").alias("scope"), F.lit("").alias("within"))
    rows = registry.select("*", F.inline(scopes)).join(narrow, ["scope", "within"]).select(whole.columns).unionByName(whole)
    # without a common field there is no match in it, so the empty set, whose value all rows share, is never looked up
    sets = lambda df, prefix, *more: df.select(*more, "scope", "within", F.inline(_agreements(prefix))).where("scope <> 'all' OR weight > 0")
    index = sets(rows, "r_", candidate).groupBy("scope", "within", "fields", "value").agg(count.alias("n"), F.min(candidate).alias("one"))
    met = sets(asked, "q_", key).join(index, ["scope", "within", "fields", "value"])
    levels = met.groupBy(key, "weight").agg(F.sum("n").alias("n"), F.min("one").alias("one"), F.sum(F.when(F.col("shown"), F.col("n"))).alias("n_shown"), F.min(F.when(F.col("shown"), F.col("one"))).alias("shown"))
    best = levels.groupBy(key).agg(F.max_by(F.struct("weight", "n", "one", "n_shown", "shown"), "weight").alias("b"))
    out = q.select(key, "scope", "by_code").join(best, key, "left").select(key, "scope", "by_code", "b.*")
    base = F.when(F.col("scope") == "both", CODE + NAME).when(F.col("scope") == "code", CODE).when(F.col("scope") == "name", NAME).otherwise(0)
    decided, unique, shown = F.col("scope") == "decided", F.col("n") == 1, F.col("n_shown") == 1
    outcome = F.when(decided, "AMM exact").when(F.col("scope") == "none", "No candidate").when(F.col("n").isNull(), "No scored match").when(unique, "Scored unique").when(shown, "Tie-broken by presentation").otherwise(F.concat(F.lit("Ambiguous tie ("), F.col("n").cast("string"), F.lit(")")))
    score = F.when(decided, CODE).otherwise(F.coalesce(base + F.col("weight") + F.when(~unique & F.coalesce(shown, F.lit(False)), 1).otherwise(0), F.lit(0)))
    return out.select(key, F.when(decided, F.col("by_code")).when(unique, F.col("one")).when(shown, F.col("shown")).alias(candidate), score.cast("int").alias("score"), outcome.alias("outcome"))
