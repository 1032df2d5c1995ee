"""Company numbers, however spelled."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FULL_WIDTH = "".join(map(chr, range(0xFF10, 0xFF1A)))


def company_digits(c: Column) -> Column:
    """The digits of the number a ``cik`` text denotes, without leading zeros
    and decimals; '' if it has none."""
    t = F.translate(c, FULL_WIDTH, "0123456789")
    t = F.regexp_replace(t, r"\.0*\s*$", "")
    return F.regexp_replace(F.regexp_replace(t, "[^0-9]", ""), "^0+(?=.)", "")


def company_number(c: Column) -> Column:
    """The number a ``cik`` text denotes as bigint, null if it has no digit.

    ``0009000123``, ``9000123``, ``9000123.0``, ``9,000,123`` and full-width
    digits are one company.  A number of more than 12 digits gets a negative
    stand-in, so that it still denotes a company; two such numbers may share
    one, :func:`company_digits` tells them apart.
    """
    d = company_digits(c)
    long = -F.pmod(F.xxhash64(d), F.lit(1 << 42)) - 1
    return F.when(d.isNull() | (F.length(d) == 0), None).when(F.length(d) <= 12, d.try_cast("bigint")).otherwise(long)
