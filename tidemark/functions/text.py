"""Text functions over columns."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x20\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Latin letters and punctuation that have no accent to drop and
# become one ASCII character (public Unicode CLDR Latin-ASCII transform).
ONE_TO_ONE = {
    "Ð": "D", "Ø": "O", "ð": "d", "ø": "o", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h",
    "ı": "i", "ĸ": "q", "Ł": "L", "ł": "l", "Ŋ": "N", "ŋ": "n", "Ŧ": "T", "ŧ": "t",
    "ſ": "s", "ƀ": "b", "Ɓ": "B", "Ƈ": "C", "ƈ": "c", "Ɖ": "D", "Ɗ": "D", "Ɛ": "E",
    "Ƒ": "F", "ƒ": "f", "Ɠ": "G", "Ɨ": "I", "Ƙ": "K", "ƙ": "k", "Ɲ": "N", "ƞ": "n",
    "Ƥ": "P", "ƥ": "p", "ƫ": "t", "Ƭ": "T", "ƭ": "t", "Ʈ": "T", "Ʋ": "V", "Ƴ": "Y",
    "ƴ": "y", "Ƶ": "Z", "ƶ": "z", "Ǥ": "G", "ǥ": "g", "ȷ": "j", "Ⱥ": "A", "Ȼ": "C",
    "ȼ": "c", "Ƚ": "L", "Ⱦ": "T", "Ɇ": "E", "ɇ": "e", "Ɉ": "J", "ɉ": "j", "Ɍ": "R",
    "ɍ": "r", "Ɏ": "Y", "ɏ": "y", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-",
    "―": "-", "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "‟": '"',
    "′": "'", "″": '"', "‹": "<", "›": ">", "․": ".", "⁄": "/", "−": "-", "×": "*",
    "÷": "/", "\xa0": " ", "\u2002": " ", "\u2003": " ", "\u2009": " ", "\u202f": " ",
    "\u3000": " ", "\xad": "-",
}

# Letters and signs that become several ASCII characters (same source).
ONE_TO_MANY = {
    "Æ": "AE", "Þ": "TH", "ß": "ss", "æ": "ae", "þ": "th", "Ĳ": "IJ", "ĳ": "ij",
    "ŉ": "'n", "Œ": "OE", "œ": "oe", "ƕ": "hv", "Ƣ": "OI", "ƣ": "oi", "Ǆ": "DZ",
    "ǅ": "Dz", "ǆ": "dz", "Ǉ": "LJ", "ǈ": "Lj", "ǉ": "lj", "Ǌ": "NJ", "ǋ": "Nj",
    "ǌ": "nj", "Ǳ": "DZ", "ǲ": "Dz", "ǳ": "dz", "ȸ": "db", "ȹ": "qp", "ẞ": "SS",
    "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st",
    "„": ",,", "«": "<<", "»": ">>", "…": "...", "‥": "..", "‖": "||", "©": "(C)",
    "®": "(R)", "¼": " 1/4", "½": " 1/2", "¾": " 3/4", "№": "No", "℠": "SM", "℡": "TEL", "™": "TM",
}


def _accented_letters() -> dict[str, str]:
    """Letters of the Latin blocks that are an ASCII letter plus accents."""
    found = {}
    for block in (range(0x00C0, 0x0250), range(0x1E00, 0x1F00)):
        for point in block:
            letter = chr(point)
            base, *marks = unicodedata.normalize("NFD", letter)
            if base.isascii() and base.isalpha() and marks:
                if all(unicodedata.combining(m) for m in marks):
                    found[letter] = base
    return found


# The block of full-width forms follows ASCII from the exclamation mark to the tilde.
FULL_WIDTH = {chr(0xFF01 + k): chr(0x21 + k) for k in range(0x5E)}

SINGLE = _accented_letters() | ONE_TO_ONE | FULL_WIDTH
_FROM = "".join(SINGLE)
_TO = "".join(SINGLE.values())


def trim_text(c: Column) -> Column:
    """Strip every kind of leading and trailing white space, in linear time."""
    return F.trim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _is_ascii(c: Column) -> Column:
    return F.length(c) == F.octet_length(c)


def _unless_ascii(c: Column, change: Callable[[Column], Column]) -> Column:
    """``change`` applied to text that is not plain ASCII.

    The one-element array gives the text a name, so that it is worked out once
    and the expression does not grow with every step put on top of it.
    """
    changed = F.transform(F.array(c), lambda x: F.when(F.length(x) == F.octet_length(x), x).otherwise(change(x)))
    return F.element_at(changed, 1)


def _letters(c: Column) -> Column:
    bare = F.regexp_replace(c, r"(?<=[\p{IsLatin}0-9])\p{Mn}+", "")
    return F.translate(F.when(c.rlike(r"\p{Mn}"), bare).otherwise(c), _FROM, _TO)


def _signs(c: Column) -> Column:
    for sign, spelled in ONE_TO_MANY.items():
        c = F.replace(c, F.lit(sign), F.lit(spelled))
    return c


def latin_ascii(c: Column) -> Column:
    """Latin letters and typographic punctuation in ASCII; other scripts stay.

    Three steps of growing cost, each only for text that is not plain ASCII yet:
    loose accents and single letters, the sharp s, all other signs.
    """
    sharp = _unless_ascii(_unless_ascii(c, _letters), lambda x: F.replace(x, F.lit("ß"), F.lit("ss")))
    return _unless_ascii(sharp, _signs)


def latin_ascii_name(name: str) -> str:
    """The same transliteration for a column name."""
    name = unicodedata.normalize("NFC", name)
    spelled = "".join(ONE_TO_MANY.get(ch, SINGLE.get(ch, ch)) for ch in name)
    return re.sub("(?<=[A-Za-z0-9])[\u0300-\u036f]+", "", spelled)


def date_prefix(c: Column) -> Column:
    """Date held in the first ten characters; null where there is none."""
    return F.try_to_date(F.substring(c.cast("string"), 1, 10), "yyyy-MM-dd")


def version_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def snapshot_label(ts: Column) -> Column:
    """Time stamp text without ``:`` and ``-`` and with ``_`` for the space."""
    return F.translate(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), " :-", "_")


def render_set(values: Column, has_null: Column | None = None) -> Column:
    """Comma-joined text of an array, a null member shown as ``NA``."""
    shown = F.array_join(F.transform(values, lambda v: v.cast("string")), ", ", "NA")
    if has_null is None:
        return shown
    tail = F.when(F.size(values) > 0, F.lit(", NA")).otherwise(F.lit("NA"))
    return F.concat(shown, F.when(has_null, tail).otherwise(F.lit("")))


def strip_affix(c: Column, affix: str, where: str = "any") -> Column:
    """Remove a fixed text: ``prefix``, ``suffix`` or ``any`` occurrence."""
    literal = F.lit(affix)
    if where == "any":
        return F.replace(c, literal, F.lit(""))
    size = len(affix)
    if where == "prefix":
        return F.when(c.startswith(literal), F.substring(c, F.lit(size + 1), F.length(c))).otherwise(c)
    if where == "suffix":
        return F.when(c.endswith(literal), F.substring(c, F.lit(1), F.length(c) - size)).otherwise(c)
    raise ValueError(f"where must be prefix, suffix or any, not {where!r}")


def match_pattern(c: Column, pattern: str) -> Column:
    return c.rlike(pattern)
