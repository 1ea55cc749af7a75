"""Text cleaning, normal forms, keys, tokens and hashes, as column expressions.

All stay inside whole-stage code; none is a Python function. White space is made even for non-breaking blanks too, so
that Java's ASCII ``\\s`` and Unicode-aware engines agree.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidlake.functions import unicode as U
from evidlake.functions.unicode import once

# UTF-8 read as Latin-1 or Windows-1252, and what it stood for, in order of replacement.
MOJIBAKE = (
    ("Ã©", "é"), ("Ã¨", "è"), ("Ãª", "ê"), ("Ã«", "ë"), ("Ã ", "à"), ("Ã¢", "â"), ("Ã§", "ç"), ("Ã®", "î"), ("Ã¯", "ï"), ("Ã´", "ô"), ("Ã¹", "ù"), ("Ã»", "û"), ("Ã¼", "ü"),
    ("Ã‰", "É"), ("Ã€", "À"), ("Ã‡", "Ç"), ("Ã”", "Ô"), ("Ã–", "Ö"), ("Â°", "°"), ("Âµ", "µ"), ("Â", " "), ("â– ", " "), ("â‰¥", "≥"), ("â‰¤", "≤"), ("â€™", "'"), ("â€œ", '"'), ("â€", '"'),
)
TRUTHY = ("1", "true", "yes", "y", "oui")
CONTROLS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"

Text = Column | str


def _col(c: Text) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: Text) -> Column:
    """Null as the empty string."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def even(c: Column) -> Column:
    """White space, non-breaking blanks included, as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(F.replace(c, F.lit(" "), F.lit(" ")), r"\s+", " "))


def replace_all(c: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def clean(c: Text) -> Column:
    """Control characters and white space made even; null and a byte-order mark gone."""
    return even(F.regexp_replace(F.replace(blank(c), F.lit("﻿"), F.lit("")), CONTROLS, " "))


def unescape(c: Text) -> Column:
    """All character references resolved."""
    return U.unescape(blank(c))


def clean_html(c: Text) -> Column:
    return clean(unescape(c))


def repair(c: Text) -> Column:
    """Text whose UTF-8 bytes were read as Latin-1, restored where that loses nothing, then the known pairs replaced."""
    t = blank(c)
    latin = F.length(F.regexp_replace(t, r"[\x{0}-\x{FF}]", "")) == 0
    back = F.try_validate_utf8(F.encode(F.when(latin, t), "ISO-8859-1").cast("string"))
    accents = lambda x: F.length(x) - F.length(F.translate(x, "éèàç", ""))
    ok = back.isNotNull() & (accents(back) >= accents(t))
    return replace_all(F.when(ok, back).otherwise(t), MOJIBAKE)


def clean_repaired(c: Text) -> Column:
    return clean(repair(c))


def clean_lines(c: Text) -> Column:
    """As ``clean``, but newlines stay: blanks within lines made even, at most one empty line in a row."""
    t = F.regexp_replace(F.replace(F.replace(blank(c), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), CONTROLS, " ")
    t = F.regexp_replace(F.replace(t, F.lit(" "), F.lit(" ")), r"[ \t]+", " ")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r" ?\n ?", "\n"), r"\n{3,}", "\n\n"), r"^\s+|\s+\z", "")


def trim_only(c: Text) -> Column:
    return F.regexp_replace(blank(c), r"^\s+|\s+$", "")


def fold(c: Text) -> Column:
    """Letters without their marks; ligatures and sharp s spelled out. Lengths may change."""
    return U.fold(blank(c))


def heading(c: Text) -> Column:
    """A line as headings are compared: folded, lower case, apostrophes and signs as blanks, dots kept."""
    return even(F.regexp_replace(F.replace(F.lower(fold(clean(c))), F.lit("'"), F.lit(" ")), r"[^a-z0-9. ]+", " "))


def match_form(c: Text) -> Column:
    """Text as it is matched: lower case, folded, white space made even."""
    return even(F.lower(fold(c)))


def scrub(c: Text) -> Column:
    """Bytes as text, sequences that are no UTF-8 replaced."""
    return F.make_valid_utf8(_col(c).cast("string"))


def fold_in_place(c: Text) -> Column:
    """As ``fold`` for characters that stay one, so that positions stay valid; spelled-out ones become their first letter."""
    return U.fold_in_place(blank(c))


def norm(c: Text) -> Column:
    """Upper case, everything but A-Z and 0-9 as blanks; letters with marks count as other."""
    return F.trim(F.regexp_replace(F.upper(clean(c)), r"[^A-Z0-9]+", " "))


def norm_folded(c: Text, keep: str = "") -> Column:
    """As ``norm``, marks folded first; ``keep``: further characters that stay, such as %."""
    return F.trim(F.regexp_replace(F.upper(fold(clean(c))), rf"[^A-Z0-9{keep}]+", " "))


def norm_key(c: Text) -> Column:
    """As ``norm``, without what stands in parentheses."""
    return norm(F.regexp_replace(clean(c), r"\([^)]*\)", " "))


def key_text(c: Text) -> Column:
    """A comparison key: folded, apostrophes dropped instead of turned into blanks."""
    return norm_folded(F.regexp_replace(blank(c), "['’`]", ""))


def norm_name(c: Text) -> Column:
    """Lower case, folded, trade marks dropped, plus and minus kept."""
    return F.trim(F.regexp_replace(F.lower(fold(F.regexp_replace(clean(c), "[®™]", ""))), r"[^a-z0-9+\-]+", " "))


def norm_code(c: Text) -> Column:
    """Registration numbers: letters and digits only, upper case."""
    return F.regexp_replace(F.upper(blank(c)), r"[^A-Z0-9]", "")


def norm_code_loose(c: Text) -> Column:
    """Registration numbers without blanks and hyphens, as the mismatch audit compares them."""
    return F.translate(F.upper(blank(c)), " -", "")


def composite(*cs: Text) -> Column:
    return F.concat_ws("|", *[norm(c) for c in cs])


def slug(c: Text, most: int = 80) -> Column:
    return F.left(F.regexp_replace(F.regexp_replace(F.lower(fold(clean(c))), r"[^a-z0-9]+", "_"), r"^_+|_+$", ""), F.lit(most))


def split_names(c: Text) -> Column:
    """Names separated by ; , + / and et, in order, empty ones dropped."""
    return F.filter(F.split(clean(c), r"(?i)\s*(?:;|,|\+|\band\b|\bet\b|/)\s*"), lambda x: x != "")


def tokens(c: Text, least: int = 1, stop: tuple[str, ...] = (), digits: bool = True) -> Column:
    """Distinct words of a normal form in order, without short ones, stop words and (on demand) numbers."""
    parts = F.filter(F.split(norm_folded(c), " "), lambda x: (F.length(x) >= max(least, 1)) & (F.lit(digits) | ~x.rlike(r"^[0-9]+$")))
    parts = F.array_distinct(parts)
    return F.array_except(parts, F.array(*[F.lit(s) for s in stop])) if stop else parts


def variants(c: Text) -> Column:
    """The whole normal form, then its first three, two and one words."""
    words = F.split(norm_folded(c), " ")
    return F.array_distinct(F.array(norm_folded(c), *[F.array_join(F.slice(words, 1, n), " ") for n in (3, 2, 1)]))


def numbers(c: Text) -> Column:
    """Numbers with an optional decimal part, in order."""
    return F.regexp_extract_all(blank(c), F.lit(r"([0-9]+(?:[.,][0-9]+)?)"), 1)


def registration_numbers(c: Text) -> Column:
    return F.regexp_extract_all(blank(c), F.lit(r"\b([0-9]{6,8}[A-Za-z]?)\b"), 1)


def product_base(c: Text) -> Column:
    """The name before its presentation: cut at pack marks or a dose."""
    head = F.split(clean(c), r"(?i)\s+B/|\s+FL/|\s+BT/|\s+[0-9]+\s*(?:MG|ML|UI|UG|µG)").getItem(0)
    return F.trim(F.coalesce(head, F.lit("")))


def query_candidates(*cs: Text, least: int = 3) -> Column:
    """Cleaned alternatives in order, short ones dropped, equal normal forms once."""
    pairs = F.filter(F.array(*[F.struct(clean(c).alias("q"), norm(c).alias("k")) for c in cs]), lambda x: F.length(x["q"]) >= least)
    seen = F.transform(pairs, lambda x: x["k"])
    return F.transform(F.filter(pairs, lambda x, i: F.array_position(seen, x["k"]) == i + 1), lambda x: x["q"])


def truncate(c: Text, most: int, mark: str = "...") -> Column:
    t = blank(c)
    return F.when(F.length(t) > most, F.concat(F.left(t, F.lit(most - len(mark))), F.lit(mark))).otherwise(t)


def append_flag(flags: Text, flag: str) -> Column:
    """A flag added to a ;-separated list unless it is there; '' and ok are the empty list."""
    f = blank(flags)
    return F.when(f.isin("", "ok"), F.lit(flag)).when(F.array_contains(F.split(f, ";"), flag), f).otherwise(F.concat(f, F.lit(";" + flag)))


def join_flags(flags: list[tuple[Column, str]]) -> Column:
    """The names of the flags that hold, separated by ;, or ok."""
    names = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in flags]))
    return F.when(F.size(names) == 0, F.lit("ok")).otherwise(F.array_join(names, ";"))


def gap_flags(missing: list[tuple[Column, str]]) -> Column:
    """'name; ' for each that is missing; blanks at the ends go, a last semicolon stays."""
    return F.trim(F.concat(*[F.when(cond, F.lit(f"{name}; ")).otherwise(F.lit("")) for cond, name in missing]))


def readable(c: Text, least: float = 0.55) -> Column:
    """Whether text looks like prose: enough letters among its visible characters, few marks of a raw PDF."""


    def prose(t: Column) -> Column:
        visible = F.length(F.regexp_replace(t, r"\s+", ""))
        letters = visible - F.length(F.regexp_replace(t, r"[A-Za-zÀ-ÿ\s]+", ""))
        marks = F.size(F.regexp_extract_all(t, F.lit(r"(endobj|endstream|/Type|xref)"), 1))
        return (visible > 0) & (letters / F.greatest(visible, F.lit(1)) >= least) & (marks < 3)

    return once(blank(c), prose)


def fill_template(template: Text, q: Text) -> Column:
    """{q} replaced by a percent-encoded query (blanks as %20)."""
    return F.replace(_col(template), F.lit("{q}"), F.replace(F.url_encode(blank(q)), F.lit("+"), F.lit("%20")))


def absolute_url(c: Text, base: str) -> Column:
    """A reference resolved against a page's address, ``.`` and ``..``, queries and fragments included; blank stays blank."""
    scheme, host, path, query = urlsplit(base)[:4]
    root = f"{scheme}://{host}"

    def resolve(t: Column) -> Column:
        own, rest = F.regexp_extract(t, r"^([^?#]*)", 1), F.regexp_extract(t, r"^[^?#]*(.*)$", 1)
        near = F.filter(F.split(own, "/"), lambda x, i: (x != "") | (i == F.size(F.split(own, "/")) - 1))
        parts = F.when(own.startswith("/"), F.split(own, "/")).otherwise(F.concat(F.array(*[F.lit(x) for x in path.split("/")[:-1] or [""]]), near))
        step = lambda at, x: F.when(x == "..", F.slice(at, 1, F.greatest(F.size(at) - 1, F.lit(0)))).when(x == ".", at).otherwise(F.array_append(at, x))
        out = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
        out = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(out, F.lit("/"))).otherwise(out)
        here = F.when(rest.startswith("?"), F.lit(root + path)).otherwise(F.lit(root + path + (f"?{query}" if query else "")))
        return F.when(own == "", F.concat(here, rest)).otherwise(F.concat(F.lit(root), F.when(out.startswith("/"), out).otherwise(F.concat(F.lit("/"), out)), rest))

    t = clean(c)
    return F.when(t == "", "").when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), t).when(t.startswith("//"), F.concat(F.lit(f"{scheme}:"), t)).otherwise(once(t, resolve))


def truthy(c: Text) -> Column:
    return F.lower(F.trim(blank(c))).isin(*TRUTHY)


def content_hash(*cs: Text) -> Column:
    """SHA-1 of the cleaned parts joined by |."""
    return F.sha1(F.concat_ws("|", *[clean(c) for c in cs]).cast("binary"))


def short_id(*cs: Text, most: int = 24) -> Column:
    return F.left(F.sha2(F.concat_ws("|", *[blank(c) for c in cs]).cast("binary"), 256), F.lit(most))


def section_id(hash_: Text) -> Column:
    h = blank(hash_)
    return F.when(h != "", F.concat(F.lit("ev_"), F.left(h, F.lit(24))))


def safe_int(c: Text, default: int = 0) -> Column:
    return F.coalesce(clean(c).try_cast("double").try_cast("int"), F.lit(default))


def strip_html(c: Text) -> Column:
    """Text of HTML: scripts and styles dropped, block ends as newlines, other tags as blanks."""
    t = F.regexp_replace(blank(c), r"(?isu)<(script|style)[^>]*>.*?</(script|style)>", " ")
    t = F.regexp_replace(t, r"(?iu)<br\s*/?>|</(p|div|li|h[1-6]|tr|ul|ol|table|article|section|nav|footer|title|head|body)>", "\n")
    return clean_lines(unescape(F.regexp_replace(t, r"<[^>]+>", " ")))


def magic(c: Text) -> Column:
    """The kind of a file by its first bytes."""
    head = F.hex(F.substring(_col(c), 1, 5))
    return F.when(head == "255044462D", "pdf").when(F.left(head, F.lit(8)) == "504B0304", "zip").when(F.left(head, F.lit(2)) == "3C", "markup").otherwise("other")
