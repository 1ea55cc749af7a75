"""Letters without marks and character references, for all of Unicode, as column expressions.

Both tables come from rules: the decompositions of ``unicodedata`` and the names of ``html.entities``. Folding maps single
characters in one look-up each; characters that become several are rare and handled apart, in texts that may hold one.
Character references are found by cutting a text at its ampersands; names are looked up in one string for each first
letter, numbers computed. Texts without an ampersand are left alone.

``folded`` is the same folding in Python, with the place in the original of every character, for searches that report positions.
"""

from __future__ import annotations

import functools
import html.entities
import string
import unicodedata
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hangul syllables stay whole: they are no letters with marks.
_HANGUL = range(0xAC00, 0xD7A4)
#: Letters that have no decomposition, and how they are spelled out.
SPELLED = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "µ": "u", "ı": "i"}
#: The end of the range in which code points are looked at (all decompositions lie below).
_END = 0x2FA20
#: A class that all characters belong to that become several, but those of ``SPELLED``.
_LATER = r"[^\x00-\x{BB}\x{BF}-\x{131}]"

def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` made once a row, however often ``use`` names it: it is a lambda's argument."""
    return F.element_at(F.transform(F.array(value), use), 1)


def base(c: str) -> str:
    """A character by compatibility decomposition, without combining marks."""
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


@functools.cache
def table() -> dict[str, str]:
    """All characters that fold to something else."""
    out = {chr(i): base(chr(i)) for i in range(0x80, _END) if not 0xD800 <= i < 0xE000 and i not in _HANGUL and (unicodedata.decomposition(chr(i)) or unicodedata.combining(chr(i)))}
    return {**{c: f for c, f in out.items() if f != c}, **SPELLED}


@functools.cache
def _single() -> tuple[str, str]:
    """Characters and what each becomes, those that vanish last; only planes whose characters are one Java character."""
    one = {c: f for c, f in table().items() if len(f) <= 1 and ord(c) < 0x10000}
    order = sorted(one, key=lambda c: (one[c] == "", c))
    return "".join(order), "".join(one[c] for c in order)


@functools.cache
def _several() -> dict[str, str]:
    return {c: f for c, f in table().items() if (len(f) > 1 or ord(c) >= 0x10000) and c not in SPELLED}


@functools.cache
def _ranges() -> str:
    """A character class that covers all of ``_several``, and some more."""
    out: list[list[int]] = []
    for i in sorted(map(ord, _several())):
        if out and i - out[-1][1] <= 48:
            out[-1][1] = i
        else:
            out.append([i, i])
    # of most characters the first class tells, before all ranges are gone through
    return f"[{_LATER}&&[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in out) + "]]"


def _expand(t: Column) -> Column:
    """Every character of ``_several`` as what it becomes: the text is cut around them, and all other pieces stay as they are."""
    short = {c: f for c, f in _several().items() if len(f) <= 4 and ord(c) < 0x10000}
    keys = "".join(short)

    def part(c: Column, n: int) -> Column:
        mine = [k for k in keys if len(short[k]) > n]
        got = F.translate(c, "".join(mine), "".join(short[k][n] for k in mine))
        return got if n == 0 else F.nullif(got, c)

    pieces = F.split(t, f"(?<={_ranges()})|(?={_ranges()})")
    out = F.array_join(F.transform(pieces, lambda c: F.when(F.length(c) == 1, F.concat_ws("", *[part(c, n) for n in range(4)])).otherwise(c)), "")
    for c, f in _several().items():
        if len(f) > 4 and ord(c) < 0x10000:
            out = F.replace(out, F.lit(c), F.lit(f))
    return out


def fold(t: Column) -> Column:
    """Letters without their marks, other characters by compatibility; ligatures and sharp s spelled out.

    Characters beyond the first plane stay as they are.
    """

    def spelled(t: Column) -> Column:
        return replaced(functools.reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), [p for p in SPELLED.items() if len(p[1]) > 1], t))

    def replaced(t: Column) -> Column:
        return once(t, lambda t: F.translate(F.when(t.rlike(_ranges()), _expand(t)).otherwise(t), *_single()))

    # the text is named often below, so it is made once; ASCII has a byte a character
    return once(t, lambda t: F.when(F.octet_length(t) == F.length(t), t).otherwise(spelled(t)))


def fold_in_place(t: Column) -> Column:
    """Each character by one: its folded form's first letter where it is spelled out, itself where it becomes several others or none."""
    keys, values = _single()
    keys = keys[: len(values)]
    more = "".join(c for c in SPELLED if c not in keys)
    return F.translate(t, keys + more, values + "".join(SPELLED[c][0] for c in more))


def folded(text: str, lower: bool = False) -> tuple[str, np.ndarray | None]:
    """The folded text and, for each of its characters, the place in ``text`` it comes from (None: its own)."""
    if text.isascii():
        return (text.lower() if lower else text), None
    known = table()
    odd = {c: known.get(c, c) for c in set(text) if c > "\x7f"}
    new = {c: f for c, f in odd.items() if f != c}
    if all(len(f) == 1 and len(f.lower()) == 1 for f in odd.values()) and "\u03a3" not in odd.values() and new.keys().isdisjoint(new.values()):
        # every character stays one (whole words are lower-cased as their letters are, but for a last sigma)
        for c, f in new.items():
            text = text.replace(c, f)
        return (text.lower() if lower else text), None
    parts = [odd.get(c, c) for c in text]
    if lower:
        parts = [p.lower() for p in parts]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    if (lengths == 1).all():
        return "".join(parts), None
    return "".join(parts), np.repeat(np.arange(len(parts)), lengths)


# --- character references ------------------------------------------------------------------------------------------

#: What may stand after an ampersand to be a reference.
_REFERENCE = r"^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Between the names and the texts of a table.
_NAME, _TEXT = "\x01", "\x02"
#: Numbers from 0x80 to 0x9F stand for characters of code page 1252, where it has one.
_CP1252 = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)]


@functools.cache
def _names() -> list[str]:
    """By first letter, A to Z and a to z: name and text of every reference in one string."""
    out = dict.fromkeys(string.ascii_letters, "")
    for name, text in html.entities.html5.items():
        out[name[0]] += f"{_NAME}{name}{_TEXT}{text}"
    return [out[c] + _NAME for c in sorted(out)]


@functools.cache
def _bare() -> str:
    """A pattern for names that need no semicolon, the longest first."""
    return "^(?:" + "|".join(sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"


def _by_name(name: Column) -> Column:
    """The text of a name, null if there is none."""
    tables = F.array(*[F.lit(t) for t in _names()])
    at = lambda code: F.when(code.between(65, 90), code - 64).when(code.between(97, 122), code - 70)
    text = lambda held, place: F.when(place > 0, F.substring_index(F.substr(held, place + F.length(name) + 2), _NAME, 1))
    return once(F.element_at(tables, once(F.ascii(name), at)), lambda held: once(F.instr(held, F.concat(F.lit(_NAME), name, F.lit(_TEXT))), lambda place: text(held, place)))


def _by_number(digits: Column, radix: int) -> Column:
    """The character of a number, as browsers read it."""

    def character(n: Column) -> Column:
        out = F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("\ufffd")).when(n == 13, F.lit("\r")).when(n.between(0x80, 0x9F), F.element_at(F.array(*[F.lit(c) for c in _CP1252]), n - 0x7F))
        nothing = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        return out.when(nothing, F.lit("")).otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))

    number = lambda d: F.when(F.length(d) > 7, F.lit(0x110000)).when(d == "", F.lit(0)).otherwise(F.conv(d, radix, 10).cast("int"))
    return once(once(F.regexp_replace(digits, "^0+", ""), number), character)


def unescape(t: Column) -> Column:
    """All character references of HTML resolved: names with or (old ones) without a semicolon, decimal and hexadecimal numbers."""

    def resolved(piece: Column) -> Column:
        after = lambda x: F.substr(piece, F.length(x) + 1)
        left = F.concat(F.lit("&"), piece)
        number = lambda ref: F.when(F.substr(ref, F.lit(2), F.lit(1)).isin("x", "X"), _by_number(F.regexp_extract(ref, "([0-9a-fA-F]+)", 1), 16)).otherwise(_by_number(F.regexp_extract(ref, "([0-9]+)", 1), 10))
        old = lambda ref: once(F.regexp_extract(ref, _bare(), 0), lambda bare: F.when(bare == "", left).otherwise(F.concat(_by_name(bare), after(bare))))
        name = lambda ref: once(_by_name(ref), lambda text: F.when(text.isNotNull(), F.concat(text, after(ref))).otherwise(old(ref)))
        return once(F.regexp_extract(piece, _REFERENCE, 0), lambda ref: F.when(ref == "", left).when(ref.startswith("#"), F.concat(number(ref), after(ref))).otherwise(name(ref)))

    pieces = F.transform(F.split(t, "&"), lambda p, i: F.when(i == 0, p).otherwise(resolved(p)))
    return F.when(F.contains(t, F.lit("&")), F.array_join(pieces, "")).otherwise(t)
