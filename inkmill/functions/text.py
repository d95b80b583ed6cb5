"""Text functions: Column -> Column, all of them JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every white space character, as a class for regular expressions (fixed values).
SPACE_CLASS = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: The same characters, one by one.
SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity)$"


def _text(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: Column | str) -> Column:
    """True for null, and for NaN in a floating column."""
    c = _text(c)
    return c.isNull() | (F.typeof(c).isin("double", "float") & (c.cast("string") == "NaN"))


def to_text(c: Column | str) -> Column:
    """The value as text; missing values are empty."""
    c = _text(c)
    return F.when(is_missing(c), "").otherwise(c.cast("string"))


def clean_text(c: Column | str) -> Column:
    """Runs of white space become one space, none at the ends; missing values are empty."""
    # white space becomes spaces by character, so that the pattern meets runs of two and more alone and not every space
    return F.trim(F.regexp_replace(F.translate(to_text(c), SPACES, " " * len(SPACES)), " {2,}", " "))


def normalize_key(c: Column | str) -> Column:
    """clean_text in lower case: equal keys mean the same thing."""
    return F.lower(clean_text(c))


def strip(c: Column | str) -> Column:
    """No white space at the ends; what is inside stays; missing values are empty."""
    return F.regexp_replace(to_text(c), f"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")


def normalize_category(c: Column | str) -> Column:
    return strip(F.lower(to_text(c)))


def contains_ci(c: Column | str, term: str) -> Column:
    """Whether the text contains term, in any case, also inside words; the empty term is in every text."""
    return F.lower(to_text(c)).contains(term.lower())


def join_list(c: Column | str, separator: str = ", ") -> Column:
    """An array of strings as one string; null gives the empty string."""
    return F.coalesce(F.array_join(_text(c), separator), F.lit(""))


def to_number(c: Column | str) -> Column:
    """A double; 0 for what is missing or isn't a number as a whole."""
    text = strip(_text(c).cast("string"))
    return F.coalesce(F.when(text.rlike(_NUMBER), text.try_cast("double")), F.lit(0.0))


def truncate(c: Column | str, n: int) -> Column:
    return F.substring(_text(c), 1, n)
