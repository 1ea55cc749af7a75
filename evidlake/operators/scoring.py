"""Scores of foreign records for medicines, by source, and the join of all pairs at or above a threshold.

A score is a sum of groups; a group is a list of alternatives, of which the first that holds counts. Each alternative has
a weight and, where pairs can be found by it, the columns of which one holds the other. The join orders alternatives by
what they can add and indexes as few as are needed for the bound: a pair for which none of those holds cannot reach the
threshold with all others. Pairs come from containment (``contained``) and equal needles alone, so rows looked at grow with the
pairs that share a decisive part, and the result is that of all pairs. A pair is made once, by the first of its decisive
parts, and never shuffled: records that are equal in all that counts are scored as one, and the rows of a value meet in cells of
bounded size (``in_cells``), so what is stored and sent grows with the tables and neither common values nor their pairs with memory.

Columns are normal forms: of medicines ``m_brand``, ``m_generic``, ``m_lab``, ``m_form``, ``m_dose``; of records as each source names them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidlake.operators.containment import contained
from evidlake.operators.relational import in_cells, top
from evidlake.sources.writers import stored

Key = tuple[str, str, bool]  #: (column whose value is held, column whose value holds it, whether it must begin with it)

#: Records in one row of a class; medicines by records of which all pairs are made, since that takes fewer jobs.
MEMBERS, FEW = 4096, 1 << 30


@dataclass(frozen=True)
class Part:
    """One alternative: its weight, when it holds, and what finds all pairs for which it does.

    ``exact``: whether it holds for every pair that a key finds; it never holds for others. ``looks``: the columns of medicines and of
    records that it looks at, where it has no keys.
    """

    weight: float
    holds: Column
    keys: tuple[Key, ...] = ()
    exact: bool = True
    looks: tuple[str, ...] = ()


@dataclass(frozen=True)
class Source:
    groups: Callable[..., list[list[Part]]]  #: given how many form words and numbers a medicine has at most, if that is known and small
    cap: float
    threshold: float
    columns: tuple[str, ...]  #: of records, all that the parts look at


def words(c: Column, least: int, most: int | None = None) -> Column:
    """Words of a normal form: the long ones among the first ``most``."""
    all_ = F.split(c, " ")
    return F.filter(F.slice(all_, 1, most) if most else all_, lambda w: F.length(w) >= least)


def held(needle: str, *fields: str) -> Column:
    n = F.col(needle)
    return (n != "") & reduce(Column.__or__, [F.contains(F.col(f), n) for f in fields])


def some(ws: Column, field: Column, most: int | None = None) -> Column:
    """Whether a field holds one of the words, of which there are at most ``most``: without a lambda, which costs most of the time of a pair."""
    if most is None:
        return (field != "") & F.exists(ws, lambda w: F.contains(field, w))
    return (field != "") & reduce(Column.__or__, [F.coalesce(F.contains(field, F.get(ws, F.lit(i))), F.lit(False)) for i in range(most)], F.lit(False))


def listed(ws: Column, field: str, most: int | None = None) -> Column:
    """Whether a list holds one of the words, of which there are at most ``most``."""
    if most is None:
        return F.arrays_overlap(ws, F.col(field))
    return reduce(Column.__or__, [F.coalesce(F.array_contains(field, F.get(ws, F.lit(i))), F.lit(False)) for i in range(most)], F.lit(False))


def first_word(c: Column, least: int = 3) -> Column:
    """The first word of three letters or more, empty if there is none."""
    return F.coalesce(F.get(words(c, least), F.lit(0)), F.lit(""))


def _brand(weight: float, field: str) -> Part:
    return Part(weight, held("m_brand", field), (("m_brand", field, False),))


def _token(weight: float, field: str) -> Part:
    return Part(weight, (F.col("m_token") != "") & F.col(field).startswith(F.col("m_token")), (("m_token", field, True),))


def _generic(weight: float, *fields: str) -> Part:
    return Part(weight, held("m_generic", *fields), tuple(("m_generic", f, False) for f in fields))


def _lab(weight: float, field: str) -> Part:
    return Part(weight, some(F.col("m_lab_words"), F.col(field), 3), looks=("m_lab_words", field))


def _form(weight: float, field: str, most: int | None) -> Part:
    return Part(weight, some(F.col("m_form_words"), F.col(field), most), looks=("m_form_words", field))


def _dose(weight: float, field: str) -> Part:
    return Part(weight, held("m_dose", field), looks=("m_dose", field))


def _numbers(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"([0-9]+(?:[.,][0-9]+)?)"), 1)


def _bdpm(most: int | None = None) -> list[list[Part]]:
    return [[_generic(0.55, "active", "name")], [_brand(0.35, "name")], [Part(0.05, held("m_form", "form"), looks=("m_form", "form"))], [_dose(0.05, "dose")]]


def _cima(most: int | None = None) -> list[list[Part]]:
    return [[_generic(0.55, "active", "name")], [_brand(0.50, "name"), _token(0.45, "name")], [_lab(0.05, "holder")], [_dose(0.03, "dose")], [_form(0.02, "form", most)]]


def _aifa(most: int | None = None) -> list[list[Part]]:
    return [[_generic(0.55, "active", "name")], [_brand(0.45, "name"), _token(0.40, "name")], [_lab(0.05, "holder")], [_form(0.03, "form", most)], [_dose(0.02, "dose")]]


def _health_canada(most: int | None = None) -> list[list[Part]]:
    return [[_brand(0.50, "name"), _token(0.42, "name")], [_generic(0.35, "active")], [_lab(0.05, "holder")]]


def _titck(most: int | None = None) -> list[list[Part]]:
    return [[_generic(0.55, "active")], [_brand(0.45, "name"), _token(0.40, "name")], [_lab(0.05, "holder")]]


def _cecmed(most: int | None = None) -> list[list[Part]]:
    """``combined``: product, context and address of the document."""
    numbers = some(F.col("m_numbers"), F.col("combined"), most)
    return [[_generic(0.55, "combined")], [_brand(0.52, "combined"), _token(0.44, "name")], [Part(0.08, numbers, looks=("m_numbers", "combined"))], [_lab(0.05, "context")]]


# Words that are no tokens of names in Swiss records.
SWISS_STOP = ("MG", "ML", "UI", "IU", "GR", "G", "L", "DE", "DU", "LA", "LE", "ET", "POUR", "SANS", "AVEC")


def _swiss_words(c: Column, least: int) -> Column:
    return F.filter(F.split(c, " "), lambda w: (F.length(w) >= least) & ~w.isin(*SWISS_STOP))


def _swissmedic(most: int | None = None) -> list[list[Part]]:
    """``head``: title, active, holder and the first 1500 characters of the text; ``numbers``: those of the text's first 2500 and of the title."""
    brand, title, active, generic = (F.col(x) for x in ("m_brand", "name", "active", "m_generic"))
    token = F.col("m_swiss_token")
    both = lambda a, b: (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))
    among = F.contains(F.concat(F.lit(" "), F.substring_index(title, " ", 4), F.lit(" ")), F.col("m_swiss_mark"))
    near = (token != "") & (title.startswith(token) | among)  # a token is a word of the brand, so there is one
    long, head = F.col("m_long"), F.col("head")
    all_ = F.contains(head, F.get(long, F.lit(0))) & F.coalesce(F.contains(head, F.get(long, F.lit(1))), F.lit(True))
    return [
        [Part(0.55, both(brand, title), (("m_brand", "name", False), ("name", "m_brand", False))), Part(0.40, near, (("m_swiss_token", "name", False),), exact=False)],
        [Part(0.30, both(generic, active), (("m_generic", "active", False), ("active", "m_generic", False))), Part(0.18, F.coalesce(all_, F.lit(False))), Part(0.10, some(long, head, 3))],
        [Part(0.08, some(F.col("m_swiss_labs"), F.col("holder"), 4))],
        [Part(0.04, listed(F.col("m_numbers"), "numbers", most))],
        [Part(0.03, some(F.col("m_swiss_forms"), head, 3))],
        [Part(0.03, F.col("has_sections"))],
    ]


SOURCES = {
    "bdpm": Source(_bdpm, 0.95, 0.45, ("name", "active", "form", "dose")),
    "cima": Source(_cima, 0.95, 0.50, ("name", "active", "holder", "form", "dose")),
    "aifa": Source(_aifa, 0.95, 0.50, ("name", "active", "holder", "form", "dose")),
    "health_canada": Source(_health_canada, 0.90, 0.45, ("name", "active", "holder")),
    "titck": Source(_titck, 0.95, 0.50, ("name", "active", "holder")),
    "cecmed": Source(_cecmed, 0.95, 0.40, ("name", "combined", "context")),
    "swissmedic": Source(_swissmedic, 0.97, 0.48, ("name", "active", "holder", "head", "numbers", "has_sections")),
}


def prepared(medicines: DataFrame) -> DataFrame:
    """Medicines with the words by which they are found."""
    brand, lab, form = F.col("m_brand"), F.col("m_lab"), F.col("m_form")
    token = F.coalesce(F.get(_swiss_words(brand, 3), F.lit(0)), F.lit(""))
    swiss = {"m_swiss_token": token, "m_swiss_mark": F.concat(F.lit(" "), token, F.lit(" ")), "m_long": F.slice(_swiss_words(F.col("m_generic"), 4), 1, 3), "m_swiss_labs": F.slice(_swiss_words(lab, 4), 1, 4), "m_swiss_forms": F.slice(_swiss_words(form, 5), 1, 3)}
    return medicines.withColumns({"m_token": first_word(brand), "m_lab_words": words(lab, 4, 3), "m_form_words": words(form, 5), "m_numbers": _numbers(F.col("m_dose")), **swiss})


def _whole(weight: float) -> Column:
    return F.lit(round(weight * 10_000))


def _points(group: Sequence[Part], rest: float = 0.0) -> Column:
    """What the first of a group that holds adds, in whole ten-thousandths."""
    if not group:
        return _whole(rest)
    out = F.when(group[0].holds, _whole(group[0].weight))
    for part in group[1:]:
        out = out.when(part.holds, _whole(part.weight))
    return out.otherwise(_whole(rest))


def score(source: Source, most: int | None = None, key: Key | None = None, done: Sequence[Key] = ()) -> Column:
    """The sum of the first alternative that holds of every group, capped, to four places: added up in whole ten-thousandths.

    For pairs that ``key`` has found and none of ``done``, what follows from that is not looked at again. Spark makes one method
    of a score, which the JVM compiles up to 8,000 bytes only: a longer one would be interpreted for every pair.
    """
    terms = []
    for group in source.groups(most):
        tests, rest = [], 0.0
        for part in group:
            if part.keys and set(part.keys) <= set(done):
                continue
            if part.exact and key in part.keys:
                rest = part.weight
                break
            tests.append(part)
        terms.append(_points(tests, rest))
    return F.least(_whole(source.cap), reduce(Column.__add__, terms)) / F.lit(10_000.0)


def decisive(source: Source, threshold: float) -> list[Part]:
    """The alternatives, by falling weight, without all of which no pair reaches the threshold."""
    groups = source.groups()
    open_ = sorted(((p.weight, g, i) for g, group in enumerate(groups) for i, p in enumerate(group)), reverse=True)
    rest = {(g, i) for _, g, i in open_}
    bound = lambda: sum(max((groups[g][i].weight for h, i in rest if h == g), default=0.0) for g in range(len(groups)))
    out = []
    for _, g, i in open_:
        if round(bound(), 6) < threshold:
            break
        if not groups[g][i].keys:
            raise ValueError("pairs can reach the threshold without a part by which they could be found")
        out.append(groups[g][i])
        rest.discard((g, i))
    return out


def classes(records: DataFrame, record: str, columns: Sequence[str]) -> DataFrame:
    """``columns`` of records and members, the ids of the records that are equal in them: at most about ``MEMBERS`` in one row if there are many."""
    one = records.groupBy(*columns, F.pmod(F.xxhash64(record), F.lit(256)).alias("__p")).agg(F.collect_list(record).alias("__m"))
    size = one.withColumn("__n", F.sum(F.size("__m")).over(Window.partitionBy(*columns)))
    return size.groupBy(*columns, F.pmod("__p", F.least(F.lit(256), F.ceil(F.col("__n") / MEMBERS))).alias("__p")).agg(F.flatten(F.collect_list("__m")).alias("members")).drop("__p")


def _is_held(key: Key) -> Column:
    needle, text, begins = key
    n, t = F.col(needle), F.col(text)
    return F.coalesce((n != "") & (t.startswith(n) if begins else F.contains(t, n)), F.lit(False))


def candidates(spark: SparkSession, medicines: DataFrame, records: DataFrame, keys: Sequence[Key]) -> Iterator[DataFrame]:
    """By key, pairs of rows of ``medicines`` and ``records`` (``classes``) for which the value of one column holds that of another, and for no key before: each pair once."""
    found = {}
    for n, (needle, text, begins) in enumerate(keys):
        swapped = not needle.startswith("m_")  # needles of records in medicines, not the other way round
        if swapped not in found:
            own = [k for k in keys if k[0].startswith("m_") is not swapped]
            needles, texts = (records, medicines) if swapped else (medicines, records)
            found[swapped] = stored(contained(spark, reduce(DataFrame.union, [texts.select(h) for h in sorted({k[1] for k in own})]), reduce(DataFrame.union, [needles.select(k) for k in sorted({k[0] for k in own})])))
        hits = found[swapped].where(F.col("first") == 0) if begins else found[swapped]
        if swapped:
            left, right = records.withColumn("__key", F.col(needle)), medicines.join(hits.select(F.col("text").alias(text), F.col("needle").alias("__key")), text)
        else:
            left, right = records.join(hits.select(F.col("text").alias(text), F.col("needle").alias("__key")), text), medicines.withColumn("__key", F.col(needle))
        met = in_cells(left, right, "__key", F.size("members"))
        new = reduce(Column.__and__, [~_is_held(k) for k in keys[:n]], F.lit(True))
        yield met.where(new).select(*medicines.columns, *records.columns)


def matches(spark: SparkSession, medicines: DataFrame, records: DataFrame, source: str, medicine: str, record: str, threshold: float | None = None) -> DataFrame:
    """(medicine, record, score) of all pairs at or above the source's threshold."""
    spec = SOURCES[source]
    least = spec.threshold if threshold is None else threshold
    keys = list(dict.fromkeys(k for p in decisive(spec, least) for k in p.keys))
    rows = stored(prepared(medicines))
    many = rows.agg(F.max(F.greatest(F.size("m_form_words"), F.size("m_numbers")))).first()[0] or 0
    scored = []
    for n, pairs in enumerate(candidates(spark, rows, stored(classes(records, record, spec.columns)), keys)):
        # a row of its own: a filter on a projected score would have it made again for every pair that passes
        once = F.explode(F.array(score(spec, many if many <= 8 else None, keys[n], keys[:n])))
        scored.append(pairs.select(medicine, "members", once.alias("score")).where(F.col("score") >= least))
    return reduce(DataFrame.union, scored).select(medicine, F.explode("members").alias(record), "score")


def patterns(source: Source, threshold: float) -> list[tuple[float, list[Part]]]:
    """(bound, parts): the sets of alternatives with keys, one of a group at most, that can reach the threshold, by falling bound: what a pair has
    at most if it holds these and no others with keys."""
    out = []
    for held_ in product(*[[None, *(p for p in group if p.keys)] for group in source.groups()]):
        chosen = [p for p in held_ if p]
        rest = sum(max((x.weight for x in group if not x.keys), default=0.0) for p, group in zip(held_, source.groups(), strict=True) if p is None)
        bound = round(min(source.cap, sum(p.weight for p in chosen) + rest), 4)
        if bound >= threshold and not chosen:
            raise ValueError("pairs can reach the threshold without a part by which they could be found")
        if bound >= threshold:
            out.append((bound, sum(p.weight for p in chosen), chosen))
    return [(b, chosen) for b, _, chosen in sorted(out, key=lambda x: x[:2], reverse=True)]


def best(spark: SparkSession, medicines: DataFrame, records: DataFrame, source: str, medicine: str, record: str, most: int, threshold: float | None = None) -> DataFrame:
    """(medicine, record, score): of the pairs of ``matches`` the first ``most`` of every medicine by falling score, then record; ids are unique.

    Pairs are not made. By ``patterns``, medicines are reduced to what differs in needles and in the columns that parts without keys look
    at, records to their first ``most`` of every such value; a pair has the pattern's weights and what the other parts add. That is no more than its score, and its score under
    the pattern of all it holds, where a record of a medicine's best is among the first of its value, since all of these score as much. Medicines
    that have ``most`` records above a pattern's bound are not looked up there. Of few rows (``FEW``) the best are taken from all pairs.
    """
    if medicines.count() * records.count() <= FEW:
        return top(matches(spark, medicines, records, source, medicine, record, threshold), [medicine], [F.desc("score"), F.col(record)], most, "__n").drop("__n")
    spec = SOURCES[source]
    least = spec.threshold if threshold is None else threshold
    groups = spec.groups()
    if any(p.keys and not p.exact or not p.keys and not p.looks for g in groups for p in g) or any([p.weight for p in g] != sorted((p.weight for p in g), reverse=True) for g in groups):
        raise ValueError(f"{source} has parts that hold for some of the pairs of a key only")
    rows = stored(prepared(medicines))
    many = rows.agg(F.max(F.greatest(F.size("m_form_words"), F.size("m_numbers")))).first()[0] or 0
    groups = spec.groups(many if many <= 8 else None)
    kept = stored(top(records.select(record, *spec.columns), spec.columns, [F.col(record)], most, "__n").drop("__n"))
    keys = sorted({k for g in groups for p in g for k in p.keys})
    found = stored(contained(spark, reduce(DataFrame.union, [kept.select(h) for h in sorted({k[1] for k in keys})]), reduce(DataFrame.union, [rows.select(k) for k in sorted({k[0] for k in keys})])))
    got = None
    for bound, chosen in patterns(spec, least):
        needles = [p.keys[0][0] for p in chosen]
        fixed = {k for p in chosen for k in p.keys}
        open_ = [[p for p in g if not p.keys] for g in groups if fixed.isdisjoint(k for p in g for k in p.keys)]
        looks = sorted({x for g in open_ for p in g for x in p.looks})
        own, fields = [x for x in looks if x.startswith("m_")], [x for x in looks if not x.startswith("m_")]
        left = rows
        if got is not None:
            done = got.where(F.col("score") > bound).groupBy(medicine).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= most)
            left = rows.join(done.select(medicine), medicine, "left_anti")
        searches = stored(left.groupBy(*dict.fromkeys([*needles, *own])).agg(F.min(medicine).alias("__search")))
        held_ = kept
        for n, p in enumerate(chosen):
            known = found.join(searches.select(F.col(needles[n]).alias("needle")).distinct(), "needle", "left_semi")
            parts = []
            for i, (_, text, begins) in enumerate(p.keys):
                hits = (known.where(F.col("first") == 0) if begins else known).select(F.col("text").alias(text), F.col("needle").alias(f"__k{n}"))
                new = reduce(Column.__and__, [~F.coalesce(F.contains(F.col(t), F.col(f"__k{n}")), F.lit(False)) for _, t, _ in p.keys[:i]], F.lit(True))
                parts.append(held_.join(hits, text).where(new).select(*held_.columns, f"__k{n}"))
            held_ = reduce(DataFrame.union, parts)
        values = [f"__k{n}" for n in range(len(chosen))]
        firsts = top(held_.select(record, *fields, *values), [*fields, *values], [F.col(record)], most, "__n")
        firsts = stored(firsts.select(record, *fields, F.struct(*[F.col(v).alias(x) for v, x in zip(values, needles, strict=True)]).alias("__key")))
        met = in_cells(firsts, searches.select("__search", *own, F.struct(*needles).alias("__key")), "__key", F.lit(1))
        whole = F.least(_whole(spec.cap), reduce(Column.__add__, [_points(g) for g in open_], _whole(sum(p.weight for p in chosen))))
        pairs = met.select("__search", record, F.explode(F.array(whole / F.lit(10_000.0))).alias("score")).where(F.col("score") >= least)
        if most == 1:
            pairs = pairs.groupBy("__search", "score").agg(F.min(record).alias(record))
        answers = top(pairs, ["__search"], [F.desc("score"), F.col(record)], most, "__n").drop("__n")
        of = reduce(Column.__and__, [F.col(f"l.{x}").eqNullSafe(F.col(f"s.{x}")) for x in dict.fromkeys([*needles, *own])])
        new_ = left.alias("l").join(searches.join(answers, "__search").alias("s"), of).select(F.col(f"l.{medicine}"), F.col(f"s.{record}"), F.col("s.score"))
        if got is not None:
            new_ = got.union(new_).groupBy(medicine, record).agg(F.max("score").alias("score"))
        got = stored(top(new_, [medicine], [F.desc("score"), F.col(record)], most, "__n").drop("__n"))
    return got


# --- Swiss titles, gated by the brand ------------------------------------------------------------------------------

# Words that are no part of a brand; words that are no active substance; units of doses.
NO_BRAND = ("ACIDE", "VACCIN", "SOLUTION", "POUR", "COMPRIME", "INJECTABLE", "HUMAINE", "HUMAIN", "DE", "DU", "DES", "LA", "LE", "LES")
NO_ACTIVE = ("HUMAINE", "HUMAIN", "PLASMATIQUE", "VACCIN", "CONTRE", "RECOMBINANT", "RECOMBINANTE", "ACIDE", "CHLORURE", "SOLUTION")
UNITS = "MG|G|ML|UI|IE|IU|U|%|MCG|UG"


def brand_forms(name: Column) -> Column:
    """The forms in which a title may name a brand: whole, up to the first number, and its first three, two and one words."""
    own = F.filter(F.split(name, " "), lambda w: (F.length(w) >= 3) & ~w.isin(*NO_BRAND))
    first = lambda n: F.when(F.size(own) >= n, F.array_join(F.slice(own, 1, n), " ")).otherwise("")
    return F.filter(F.array_distinct(F.array(name, F.trim(F.regexp_extract(name, r"^(.*?)(?:\b[0-9]|$)", 1)), first(3), first(2), first(1))), lambda v: v != "")


def fast_parts(name: Column, active: Column, lab: Column, dose: Column) -> dict[str, Column]:
    """What of a medicine is looked for in Swiss titles: forms of the brand, words of substance and holder, doses."""
    doses = F.regexp_extract_all(F.concat_ws(" ", dose, name), F.lit(rf"([0-9]+(?:[.,][0-9]+)?\s*(?:{UNITS})?)"), 1)
    return {
        "forms": brand_forms(name),
        "actives": F.slice(F.filter(F.split(active, " "), lambda w: (F.length(w) >= 4) & ~w.isin(*NO_ACTIVE)), 1, 8),
        "labs": F.filter(F.slice(F.split(lab, " "), 1, 8), lambda w: F.length(w) >= 4),
        "doses": F.array_distinct(F.transform(doses, lambda x: F.replace(F.replace(x, F.lit(" "), F.lit("")), F.lit(","), F.lit(".")))),
    }


def fast_score(title: Column, holder: Column, kind: Column) -> Column:
    """The score of a title for the parts in columns ``forms``, ``actives``, ``labs`` and ``doses``; 0 where it cannot be about the brand."""
    forms, actives, labs = F.col("forms"), F.col("actives"), F.col("labs")
    is_or_begins = lambda v: (title == v) | title.startswith(F.concat(v, F.lit(" ")))
    n_active = F.size(F.filter(actives, lambda w: F.contains(title, w)))
    n_lab = F.size(F.filter(labs, lambda w: F.contains(holder, w) | F.contains(title, w)))
    n_dose = F.size(F.filter("doses", lambda w: F.contains(F.replace(title, F.lit(" "), F.lit("")), w)))
    own = F.filter(F.split(F.coalesce(F.get(forms, F.lit(0)), F.lit("")), " "), lambda w: (F.length(w) >= 3) & ~w.isin(*NO_BRAND))
    shared = F.size(F.filter(own, lambda w: F.array_contains(F.split(title, " "), w)))
    phrase = F.exists(F.slice(forms, 1, 3), lambda v: (F.length(v) >= 5) & F.contains(title, v))
    lone = (F.size(own) == 1) & (shared == 1) & is_or_begins(F.get(own, F.lit(0)))
    gate = phrase | ((F.size(own) >= 2) & (shared >= 2)) | F.coalesce(lone, F.lit(False)) | ((n_active >= 2) & (n_lab >= 1))
    at = F.transform(forms, lambda v, i: F.when(is_or_begins(v), 0.80 - 0.03 * i).when(F.contains(title, v), 0.70 - 0.03 * i).otherwise(0.0))
    total = F.coalesce(F.array_max(at), F.lit(0.0)) + F.least(F.lit(0.18), 0.06 * n_active) + F.least(F.lit(0.12), 0.05 * n_lab) + F.least(F.lit(0.08), 0.04 * n_dose) + F.when(kind == "SMPC", 0.03).otherwise(0.0)
    return F.when(gate, F.round(F.least(F.lit(0.98), total), 4)).otherwise(0.0)


def fast_matches(spark: SparkSession, medicines: DataFrame, records: DataFrame, medicine: str, record: str, threshold: float = 0.45) -> DataFrame:
    """(medicine, record, score) of all pairs at or above the threshold; medicines have m_brand, m_generic, m_lab, m_dose, records name, holder, kind.

    Without a form of the brand in its title a record has 0.41 at most, so pairs are found by these.
    """
    if threshold <= 0.41:
        raise ValueError("pairs could reach this threshold without the brand")
    rows = medicines.withColumns(fast_parts(F.col("m_brand"), F.col("m_generic"), F.col("m_lab"), F.col("m_dose")))
    rows = stored(rows.select(medicine, "forms", "actives", "labs", "doses"))
    titles = stored(classes(records, record, ("name", "holder", "kind")))
    needles = rows.select("*", F.posexplode("forms").alias("__at", "__key"))
    found = stored(contained(spark, titles.select("name"), needles.select("__key")))
    met = in_cells(titles.join(found.select(F.col("text").alias("name"), F.col("needle").alias("__key")), "name"), needles, "__key", F.size("members"))
    new = ~F.exists(F.slice("forms", F.lit(1), F.col("__at")), lambda v: F.contains(F.col("name"), v))  # each pair by the first form in its title
    scored = met.where(new).select(medicine, "members", fast_score(F.col("name"), F.col("holder"), F.col("kind")).alias("score")).where(F.col("score") >= threshold)
    return scored.select(medicine, F.explode("members").alias(record), "score")


# --- vaccine documents ----------------------------------------------------------------------------------------------

# Weights of document types.
DOCUMENT_WEIGHTS = {"summary_product_characteristics": 0.18, "product_characteristics": 0.16, "product_information": 0.14, "package_insert": 0.12, "package_leaflet": 0.10, "recommendation": 0.02, "report": 0.0}
# Products and further terms for them.
SYNONYMS = {
    "COMINARTY": ("COMIRNATY", "BIONTECH", "PFIZER", "TOZINAMERAN", "COVID 19 MRNA"),
    "COMIRNATY": ("COMINARTY", "BIONTECH", "PFIZER", "TOZINAMERAN", "COVID 19 MRNA"),
    "COVID 19 VACCINE MODERNA": ("MODERNA", "MRNA", "NUCLEOSIDE MODIFIED"),
    "COVID 19 VACCINE ASTRAZENECA": ("ASTRAZENECA", "CHADOX1", "AZD1222", "COVISHIELD"),
    "CORONAVAC": ("CORONAVAC", "SINOVAC"),
    "GAM COVID VAC": ("GAM COVID VAC", "GAMALEYA", "SPUTNIK"),
    "SPUTNIK LIGHT": ("SPUTNIK", "GAMALEYA", "ADENOVIRUS"),
    "GC FLU": ("GCFLU", "GC FLU", "GREEN CROSS", "INFLUENZA"),
    "GCFLU QUADRIVALENT": ("GCFLU", "GC FLU", "GREEN CROSS", "INFLUENZA", "QUADRIVALENT"),
    "HEPAVAX GENE": ("HEPAVAX", "HEPATITIS B", "HEP B"),
    "EUVAX B": ("EUVAX", "HEPATITIS B", "LG"),
    "ORAL POLIO VACCINE": ("ORAL POLIO", "POLIOMYELITIS", "BIO FARMA", "BIOFARMA"),
    "NOVEL ORAL POLIOMYELITIS VACCINE TYPE 2 NVPO2": ("NOPV2", "NOVEL ORAL POLIO", "BIOFARMA", "BIO FARMA"),
    "PENTAXIM": ("PENTAXIM", "SANOFI", "DTP", "HIB", "POLIO"),
    "VAXIGRIPTETRA": ("VAXIGRIP", "SANOFI", "INFLUENZA", "QUADRIVALENT"),
    "VACCIN DTP DTC ADSORBE": ("DTP", "DIPHTHERIA", "TETANUS", "PERTUSSIS", "SERUM INSTITUTE"),
    "VACCIN DU VIRUS VIVANT DE LA ROUGEOLE ET DE LA RUBEOLE USP": ("MEASLES", "RUBELLA", "SERUM INSTITUTE"),
}
# Words in names, substances and makers, and the terms that they stand for; terms that many products share.
DERIVED = ((("INFLUENZA", "ANTIGRIPPE", "GRIPPE"), ("INFLUENZA",)), (("HEPATITE B", "HEPATITIS B"), ("HEPATITIS B",)), (("COVID",), ("COVID 19",)), (("POLIO", "POLIOMYEL"), ("POLIO", "POLIOMYELITIS")))
SHARED_TERMS = ("COVID 19", "INFLUENZA", "POLIO", "POLIOMYELITIS", "HEPATITIS B")
# Words that are no tokens of vaccine titles.
TITLE_STOP = ("VACCINE", "VACCIN", "COVID", "PRODUCT", "INFORMATION", "PACKAGE", "LEAFLET", "INSERT", "WHO", "SUMMARY", "CHARACTERISTICS", "SUSPENSION", "INJECTION", "SOLUTION", "FOR", "THE", "AND", "OF", "DE", "LA", "LE", "A", "B")
# Makers, how each is named in titles and in rows (blanks left out for biofarma), and what that adds.
MAKERS = (("biontech", ("BIONTECH", "PFIZER"), 0.20), ("moderna", ("MODERNA",), 0.22), ("astrazeneca", ("ASTRAZENECA",), 0.22), ("sinovac", ("SINOVAC",), 0.22), ("biofarma", ("BIOFARMA",), 0.22), ("sanofi", ("SANOFI",), 0.18))


def _holds(hay: Column, needles: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.contains(hay, F.lit(n)) for n in needles])


def _maker(kind: str, names: tuple[str, ...], title: bool) -> Column:
    """Whether a title, or a row's name and laboratory, names a maker."""
    if kind == "biofarma":
        return _holds(F.replace(F.col("title" if title else "m_lab"), F.lit(" "), F.lit("")), names)
    return _holds(F.col("title") if title else F.concat_ws(" ", "m_brand", "m_lab"), names)


def vaccine_parts(rows: DataFrame) -> DataFrame:
    """Rows (m_brand, m_generic, m_lab as normal forms) with base (the name without doses), terms and tokens to look for."""
    name, generic, lab = (F.col(x) for x in ("m_brand", "m_generic", "m_lab"))
    base = F.trim(F.regexp_replace(F.regexp_replace(name, r"\b[0-9]+(?:MG|MCG|UG|ML|UI|U|DOSE|DOSES)\b", " "), r"\s+", " "))
    rows = rows.withColumn("base", base)
    whole = F.concat_ws(" ", name, generic, lab)
    none = F.array().cast("array<string>")
    more = [F.when(F.contains(F.col("base"), F.lit(k)) | F.contains(F.lit(k), F.col("base")) | F.contains(name, F.lit(k)), F.array(*map(F.lit, v))).otherwise(none) for k, v in SYNONYMS.items()]
    more += [F.when(_holds(whole, words_), F.array(*map(F.lit, terms))).otherwise(none) for words_, terms in DERIVED]
    terms = F.filter(F.array_distinct(F.concat(F.array(name, generic, lab, F.col("base")), *more)), lambda t: F.length(t) >= 3)
    rows = rows.withColumn("terms", terms)
    return rows.withColumn("tokens", _title_words(F.concat_ws(" ", whole, F.array_join("terms", " "))))


def _title_words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, " "), lambda w: (F.length(w) >= 3) & ~w.isin(*TITLE_STOP)))


def vaccine_score() -> Column:
    """struct<score, reasons> of a document (title, kind) for a row of ``vaccine_parts``."""
    title, name, base = F.col("title"), F.col("m_brand"), F.col("base")
    named = (name != "") & F.contains(title, name)
    based = ~named & (base != "") & F.contains(title, base)
    hits = F.filter("terms", lambda t: (F.length(t) >= 5) & F.contains(title, t))
    shared = F.array_sort(F.array_intersect("tokens", _title_words(title)))
    parts = [(named, 0.60, F.lit("name_in_title")), (based, 0.55, F.lit("base_name_in_title"))]
    terms = F.aggregate(hits, F.lit(0.0), lambda a, t: a + F.when(t.isin(*SHARED_TERMS), 0.08).otherwise(0.20))
    term_reasons = F.transform(hits, lambda t: F.concat(F.when(t.isin(*SHARED_TERMS), "generic:").otherwise("term:"), t))
    overlap = F.least(F.lit(0.25), 0.25 * F.size(shared) / F.greatest(F.lit(1), F.least(F.size("tokens"), F.lit(8))))
    makers = [(_maker(k, names, True) & _maker(k, names, False), w, F.lit(f"manufacturer_{k}")) for k, names, w in MAKERS]
    if_synonym = [(base == k) & _holds(title, v) for k, v in SYNONYMS.items()]
    guards = [
        ((base != "") & ~F.contains(base, F.lit(" ")) & ~F.contains(title, base) & ~reduce(Column.__or__, if_synonym), -0.15, F.lit("single_token_guard")),
        (F.contains(name, F.lit("PENTAXIM")) & F.contains(title, F.lit("HEXAXIM")), -0.40, F.lit("reject_hexaxim_for_pentaxim")),
        (_holds(name, ("SPUTNIK", "GAM COVID VAC")) & ~_holds(title, ("SPUTNIK", "GAMALEYA", "GAM COVID")), -0.35, F.lit("sputnik_guard")),
        (F.contains(name, F.lit("CORONAVAC")) & ~_holds(title, ("CORONAVAC", "SINOVAC")), -0.35, F.lit("coronavac_guard")),
    ]
    kind = F.coalesce("kind", F.lit(""))
    weight = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in DOCUMENT_WEIGHTS.items() for x in kv]), kind), F.lit(0.0))
    add = lambda ps: reduce(Column.__add__, [F.when(cond, w).otherwise(0.0) for cond, w, _ in ps])
    said = lambda ps: F.array(*[F.when(cond, reason) for cond, _, reason in ps])
    total = add(parts) + terms + overlap + add(makers) + weight + add(guards)
    reasons = F.concat(said(parts), term_reasons, F.array(F.when(F.size(shared) > 0, F.concat(F.lit("tokens:"), F.array_join(F.slice(shared, 1, 6), "/")))), said(makers), F.array(F.when(kind != "", F.concat(F.lit("doc_type:"), kind))), said(guards))
    return F.struct(F.round(F.greatest(F.lit(0.0), F.least(F.lit(0.98), total)), 6).alias("score"), F.array_join(F.array_compact(reasons), ";").alias("reasons"))


def vaccine_matches(spark: SparkSession, rows: DataFrame, documents: DataFrame, row: str, document: str, threshold: float = 0.55) -> DataFrame:
    """(row, document, score, reasons) of all pairs at or above the threshold; documents have title and kind.

    Shared tokens and the document's type add 0.43 at most, so pairs are found by names and terms in titles and by makers.
    """
    if threshold <= 0.43:
        raise ValueError("pairs could reach this threshold by shared words alone")
    known = vaccine_parts(rows)
    needles = known.select(row, F.explode(F.array_distinct(F.concat(F.array("m_brand", "base"), F.filter("terms", lambda t: F.length(t) >= 5)))).alias("needle"))
    found = contained(spark, documents.select("title"), needles.select("needle")).join(needles, "needle").join(documents.select(document, F.col("title").alias("text")), "text").select(row, document)
    made = lambda df, key, title: df.select(key, F.explode(F.array_compact(F.array(*[F.when(_maker(k, names, title), F.lit(k)) for k, names, _ in MAKERS]))).alias("maker"))
    pairs = found.union(made(known, row, False).join(made(documents, document, True), "maker").select(row, document)).distinct()
    scored = pairs.join(known, row).join(documents.select(document, "title", "kind"), document).select(row, document, vaccine_score().alias("s")).select(row, document, "s.*")
    return scored.where(F.col("score") >= threshold)
