"""Fiscal periods: ``YYYYQn`` text and the quarter index 4*year + quarter - 1.

Everything is a Column expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def index_of(text: Column) -> Column:
    """Quarter index of a ``YYYYQn`` text; null if it is no such text."""
    return F.when(text.rlike(r"^[0-9]{4}Q[1-4]$"), F.substring(text, 1, 4).cast("int") * 4 + F.substring(text, 6, 1).cast("int") - 1)


def index(year: Column, quarter: Column) -> Column:
    return year.cast("int") * 4 + quarter.cast("int") - 1


def year_of(q: Column) -> Column:
    return F.floor(q / 4).cast("int")


def quarter_of(q: Column) -> Column:
    return (F.pmod(q, F.lit(4)) + 1).cast("int")


def text_of(q: Column) -> Column:
    """``YYYYQn`` text of a quarter index."""
    return F.concat(year_of(q).cast("string"), F.lit("Q"), quarter_of(q).cast("string"))


def plus(text: Column, quarters: Column | int) -> Column:
    """The period so many quarters later, earlier if negative."""
    return text_of(index_of(text) + (F.lit(quarters) if isinstance(quarters, int) else quarters))


def minus(a: Column, b: Column) -> Column:
    """Quarters from period ``b`` to period ``a``."""
    return index_of(a) - index_of(b)


def from_fpe_date(fye: Column, fpe: Column) -> Column:
    """The fiscal period that ends on ``fpe`` in a fiscal year ending on ``fye``.

    A period ending in the first six days of a month belongs to the month
    before (of the same calendar year, as January's does to December); whole
    quarters between the two months count back from the fourth quarter, four
    of them are a year.  Fiscal years ending before June carry the number of
    the year before.  Null if ``fpe`` lies after ``fye``.
    """
    month = F.when(F.dayofmonth(fpe) < 7, F.when(F.month(fpe) > 1, F.month(fpe) - 1).otherwise(12)).otherwise(F.month(fpe))
    back = F.floor(((F.year(fye) - F.year(fpe)) * 12 + F.month(fye) - month) / 3)
    years = F.when(back >= 4, F.floor(back / 4)).otherwise(0)
    quarter = F.greatest(4 - F.when(back >= 4, F.pmod(back, F.lit(4))).otherwise(back), F.lit(1))
    year = F.year(fye) - years - F.when(F.month(fye) >= 6, 0).otherwise(1)
    return F.when(fpe <= fye, F.concat(year.cast("int").cast("string"), F.lit("Q"), quarter.cast("int").cast("string")))


def fye_from_mmdd(fpe: Column, form: Column, mmdd: Column) -> Column:
    """Fiscal year end told by a filing page: an annual report ends it, else
    the page's month and day (three or four digits), the day cut to the
    month's length; otherwise the period end itself."""
    month = F.substring(mmdd, 1, 2).try_cast("int")
    day = F.substring(mmdd, 3, 2).try_cast("int")
    seen = F.when(F.dayofmonth(fpe) > 7, F.month(fpe)).otherwise(F.month(fpe) - 1)
    year = F.year(fpe) + F.when(seen > month, 1).otherwise(0)
    first = F.when(month.between(1, 12), F.make_date(year, F.greatest(F.least(month, F.lit(12)), F.lit(1)), F.lit(1)))
    told = F.when(day >= 1, F.date_add(first, F.least(day, F.dayofmonth(F.last_day(first))) - 1))
    return F.when(form.endswith("10-K") | ~F.length(mmdd).between(3, 4), fpe).otherwise(told)


def item_fpe(fye: Column, quarter: Column) -> Column:
    """Period end of an item: quarters 1 to 3 lie 9, 6 and 3 months before the
    fiscal year end the page tells; a fourth quarter is announced when that
    already is the next year's, 12 months later."""
    return F.when(quarter == 4, F.add_months(fye, -12)).otherwise(F.add_months(fye, (quarter - 4) * 3))


def resolve_quarter_to_date(text: Column, filing_period: Column) -> Column:
    """``YYYYQTD`` becomes the quarter before the filing's own."""
    return F.when(text.rlike(r"^[0-9]+QTD$"), plus(filing_period, -1)).otherwise(text)
