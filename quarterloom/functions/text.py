"""Text functions of the extraction, as Column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

# What counts as a hyphen in a table cell.
HYPHENS = "—\x97\x96–-"

#: Longest provenance text that is kept.
KEPT = 1024


def _accent_map() -> tuple[str, str]:
    """Letters whose canonical decomposition has one ASCII letter, by rule."""
    src, dst = [], []
    for o in range(0x80, 0x10000):
        base = [c for c in unicodedata.normalize("NFD", chr(o)) if c < "\x80"]
        if len(base) == 1:
            src.append(chr(o))
            dst.append(base[0])
    return "".join(src), "".join(dst)


_FROM, _TO = _accent_map()


def sanitize(c: Column) -> Column:
    """ASCII text: accents folded, other characters deleted, blanks
    collapsed, cut to the stored length."""
    t = F.regexp_replace(F.translate(c, _FROM, _TO), r"[^\x00-\x7F]", "")
    return F.substring(F.regexp_replace(t, r"\s+", " "), 1, KEPT)


def is_hyphen(c: Column) -> Column:
    return c.rlike(f"^[{HYPHENS}]+$")


def item_value(c: Column) -> Column:
    """Number in a table cell: a bare hyphen is zero, a leading bracket makes
    it negative, a text without digits is null, an unreadable one NaN."""
    bare = F.regexp_replace(c, r"[$%,*]", "")
    tight = F.regexp_replace(bare, r"\s+", "")
    bracket = F.regexp_extract(tight, r"^\(([0-9.]+)\)?", 1)
    first = F.regexp_extract(tight, r"([0-9.]+)", 1)
    nan = F.lit(float("nan"))
    number = F.when(bracket != "", -F.coalesce(bracket.try_cast("double"), nan)).otherwise(F.coalesce(first.try_cast("double"), nan))
    return F.when(is_hyphen(bare), F.lit(0.0)).when(bare.rlike("[0-9]"), number)


def is_row_part(c: Column) -> Column:
    """Whether a cell looks like a value: a number that is neither a year nor
    the last day of a month, or a hyphen."""
    t = F.trim(F.lower(c))
    v = item_value(t)
    number = t.rlike(r"^[$(]?\s*[0-9,]+\.?[0-9]*[)%]*$")
    return F.when(number, v.isNotNull() & ~v.between(2000, 2050) & ~v.between(28, 31)).otherwise(is_hyphen(t))
