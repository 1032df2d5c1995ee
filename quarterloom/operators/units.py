"""Problem 4: quantities recorded in different units.

A unit inside the figure's own text goes before the unit column.  Where both
are missing, a mixture on the log scale, whose components are offset by the
known conversion factors, gives each factor a posterior; rows without a clear
winner are flagged.  The same mixture tells the scale of stored values, which
have no unit of their own.  Everything but the matching of item names stays in the
JVM; the fit sees a histogram of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from quarterloom.functions.companies import FULL_WIDTH, company_number
from quarterloom.functions.items import PER_SHARE, item_entries, item_meaning
from quarterloom.functions.let import let
from quarterloom.session import written

#: Known conversion factors of the mixture.
FACTORS = (0.01, 1.0, 1e3, 1e5, 1e6, 1e9)

#: Factors between a stored value and the amount it stands for: the value may
#: be short of it or have been scaled twice.
SCALINGS = tuple(sorted({1.0, *(x for f in FACTORS for x in (f, 1 / f))}))

#: Most spread of a component of the scalings: a value off by 50 or more lies
#: over six of them from the component of none.
CLOSE = 0.25

#: Flat density that takes what no component explains.
FLOOR = 1e-4

#: Levels of companies and items that may be broadcast (40 bytes each).
LEVELS = 1_000_000

#: A posterior below this leaves the unit uncertain.
SURE = 0.9

_DASH = "-‐-―−"
_MONEY = r"(?:US\$|USD|\$|＄)"
_FIGURE = rf"(?i)^\s*{_MONEY}?\s*([(\[{_DASH}]*)\s*{_MONEY}?\s*([{_DASH}]?)\s*((?:[0-9][0-9,' ]*)?(?:\.[0-9]+)?)(.*)$"
_LONE_DASH = rf"(?i)^\s*{_MONEY}?\s*[{_DASH}]+\s*$"

# Units written behind a figure.
TEXT_UNITS = {
    "hundred thousand": 1e5, "hundred thousands": 1e5, "hundreds of thousands": 1e5,
    "thousand": 1e3, "thousands": 1e3, "thsd": 1e3, "k": 1e3, "000": 1e3, "000s": 1e3,
    "million": 1e6, "millions": 1e6, "mln": 1e6, "mn": 1e6, "mm": 1e6, "m": 1e6,
    "billion": 1e9, "billions": 1e9, "bln": 1e9, "bn": 1e9,
    "cent": 0.01, "cents": 0.01, "¢": 0.01, "c": 0.01, "c per share": 0.01,
}
#: One or two letters in brackets are a note, not a unit.
_WORDS = "|".join(sorted(TEXT_UNITS, key=len, reverse=True))
_LONG = "|".join(sorted((w for w in TEXT_UNITS if len(w) > 2), key=len, reverse=True))
_UNIT = rf"^[)\]]?\s*(?:({_WORDS})(?![a-z0-9])|[(\[]({_LONG})[)\]])"


def plain_number_text(c: Column) -> Column:
    """ASCII digits and single ordinary blanks."""
    return F.regexp_replace(F.translate(c, FULL_WIDTH, "0123456789"), r"(?U)[\s   ]+", " ")


def _text_factor(rest: Column) -> Column:
    def factor(word: Column) -> Column:
        out = F.lit(None).cast("double")
        for f in sorted(set(TEXT_UNITS.values())):
            out = F.when(word.isin([w for w, x in TEXT_UNITS.items() if x == f]), F.lit(f)).otherwise(out)
        return out

    found = F.trim(F.regexp_replace(F.regexp_extract(F.lower(rest), _UNIT, 0), r"[()\[\]]", ""))
    return F.when(F.length(F.trim(rest)) > 0, let(found, factor))


def read_figure(c: Column) -> Column:
    """Struct of ``figure`` and ``factor``, the factor of a unit written
    behind the figure; null where there is none.

    A lone dash is zero; an opening bracket, closed or not, or a minus makes
    the figure negative; currency signs and notes behind it are ignored.
    """

    def parts(p: Column) -> Column:
        value = F.regexp_replace(F.get(p, F.lit(1)), "[, ']", "").try_cast("double")
        signed = F.when(F.length(F.get(p, F.lit(0))) > 0, -value).otherwise(value)
        return F.struct(signed.alias("figure"), F.when(value.isNotNull(), _text_factor(F.get(p, F.lit(2)))).alias("factor"))

    def text(t: Column) -> Column:
        zero = F.struct(F.lit(0.0).alias("figure"), F.lit(None).cast("double").alias("factor"))
        split = F.split(F.regexp_replace(t, _FIGURE, "$1$2\u0001$3\u0001$4"), "\u0001")
        return F.when(t.rlike(_LONE_DASH), zero).otherwise(let(split, parts))

    return let(plain_number_text(c), text)


def column_factor(c: Column) -> Column:
    """The factor a ``src_units`` text tells, null if it tells none."""
    u = F.lower(c)
    return (
        F.when(u.rlike(r"100,?000|hundred"), 1e5)
        .when(u.rlike(r"thous|thsd|000"), 1e3)
        .when(u.rlike(r"billion|bln|\bbn\b|\$bn"), 1e9)
        .when(u.rlike(r"million|mln|\bmn\b|mm\b"), 1e6)
        .when(u.rlike(r"dollar|\$|usd|as stated"), 1.0)
        .when(u.rlike(r"cents?\b|¢"), 0.01)
        .when(u.rlike(r"per share|whole|actual"), 1.0)
    )


def money(entries: dict[int, str]) -> Column:
    """Struct of ``figure``, ``factor`` (null: no unit given) and ``source``
    ('value', 'units' or 'missing') of a row with ``q_item``."""
    per_share = [i for i, t in entries.items() if t in PER_SHARE]
    told = column_factor(F.col("src_units"))
    # units of thousands and more in the column are not meant for per share items
    units = let(told, lambda u: F.when(F.col("q_item").isin(per_share) & (u > 1), F.lit(1.0)).otherwise(u))

    def both(x: Column) -> Column:
        source = F.when(x["r"]["factor"].isNotNull(), "value").when(x["u"].isNotNull(), "units").otherwise("missing")
        return F.struct(x["r"]["figure"].alias("figure"), F.coalesce(x["r"]["factor"], x["u"]).alias("factor"), source.alias("source"))

    return let(F.struct(read_figure(F.col("src_value")).alias("r"), units.alias("u")), both)


def parsed(df: DataFrame, refs: DataFrame) -> DataFrame:
    """``df`` with ``q_company``, ``q_item`` (reference id, 0 for none) and
    ``q_money``, see :func:`money`."""
    entries = item_entries(refs)
    out = df.withColumns({"q_company": company_number(F.col("cik")), "q_item": item_meaning(F.col("item"), entries)})
    return out.withColumn("q_money", money(entries))


def spread_out(p: DataFrame) -> DataFrame:
    return p.select("*", *[F.col(f"q_money.{n}").alias(f"q_{n}") for n in ("figure", "factor", "source")]).drop("q_money")


def dollars(m: Column) -> Column:
    """Amount in dollars (per share: dollars per share) of a ``q_money``;
    without any unit the figure is in dollars, without a figure null."""
    return let(m, lambda x: x["figure"] * F.coalesce(x["factor"], F.lit(1.0)))


def levels(p: DataFrame) -> DataFrame:
    """Mean and spread of log10 amounts of each company and item where a
    unit is told."""
    known = p.where(F.col("q_factor").isNotNull() & (F.abs("q_figure") > 0) & F.col("q_company").isNotNull())
    x = F.log10(F.abs(F.col("q_figure") * F.col("q_factor")))
    return known.groupBy("q_company", "q_item").agg(F.avg(x).alias("q_level"), F.coalesce(F.stddev_pop(x), F.lit(0.0)).alias("q_spread"), F.count(F.lit(1)).alias("q_known"))


def fit_mixture(bins: list[tuple[float, int]], factors: tuple[float, ...] = FACTORS, rounds: int = 50, most: float = 1.0) -> tuple[list[float], float]:
    """Weights and common spread, at most ``most``, of a mixture of normals at
    the offsets ``-log10(factor)``, from a histogram of ``log10|figure| -
    level``."""
    mu = [-math.log10(f) for f in factors]
    pi, sd = [1.0 / len(mu)] * len(mu), min(0.5, most)
    n = sum(c for _, c in bins)
    if not n:
        return pi, sd
    for _ in range(rounds):
        mass, var = [0.0] * len(mu), 0.0
        for x, c in bins:
            w = [p * math.exp(-0.5 * ((x - m) / sd) ** 2) / sd for p, m in zip(pi, mu)]
            s = sum(w) + FLOOR
            for k, m in enumerate(mu):
                r = c * w[k] / s
                mass[k] += r
                var += r * (x - m) ** 2
        total = sum(mass) or 1.0
        pi = [(m + 0.5) / (total + 0.5 * len(mu)) for m in mass]
        sd = min(most, max(0.05, math.sqrt(var / total)))
    return pi, sd


def by_posterior(rows: DataFrame, factors: tuple[float, ...], most: float = 1.0, spread: Column | None = None) -> DataFrame:
    """``rows`` with ``q_guess``, the factor of the highest posterior of the
    mixture fitted to their column ``q_gap``, ``q_posterior`` and
    ``q_uncertain``.

    A null gap has no posterior and is uncertain.  The posterior leaves room
    for none of the factors, so a gap far from all of them is uncertain.  The
    fit sees a histogram of at most 801 bins; ``spread`` widens the components
    row by row.
    """
    bins = [(r[0] / 20.0, r[1]) for r in rows.where("q_gap is not null").groupBy(F.greatest(F.lit(-400), F.least(F.lit(400), F.round(F.col("q_gap") * 20))).cast("int").alias("b")).count().collect()]
    pi, sd = fit_mixture(bins, factors, most=most)
    wide = F.lit(sd) if spread is None else F.sqrt(spread * spread + F.lit(sd * sd))

    offsets, logs, known = np.log10(np.array(factors)), np.log(np.array(pi)), np.array(factors)

    @F.pandas_udf("guess double, posterior double")
    def told(gap: pd.Series, spreads: pd.Series) -> pd.DataFrame:
        g, w = gap.to_numpy(float)[:, None], spreads.to_numpy(float)[:, None]
        score = logs - 0.5 * ((g + offsets) / w) ** 2
        best = np.where(np.isnan(score), -np.inf, score).argmax(axis=1)
        top = score[np.arange(len(score)), best][:, None]
        total = np.exp(score - top).sum(axis=1) + FLOOR * w[:, 0] * np.exp(-top[:, 0])
        return pd.DataFrame({"guess": np.where(np.isnan(g[:, 0]), np.nan, known[best]), "posterior": 1.0 / total})

    out = rows.withColumn("q_told", told("q_gap", wide)).select("*", F.col("q_told.guess").alias("q_guess"), F.col("q_told.posterior").alias("q_posterior")).drop("q_told")
    return out.withColumn("q_uncertain", F.coalesce(F.col("q_posterior") < SURE, F.lit(True)))


def assigned(p: DataFrame, factors: tuple[float, ...] = FACTORS) -> DataFrame:
    """Rows of ``parsed`` without a unit, with the factor that the mixture
    assigns, see :func:`by_posterior`.  The level is that of the same company
    and item where a unit is told; without one, and for zero or unreadable
    figures, there is no posterior."""
    known = levels(p)
    few = known.limit(LEVELS + 1).count() <= LEVELS
    lost = p.where(F.col("q_source") == "missing").join(F.broadcast(known) if few else known, ["q_company", "q_item"], "left")
    lost = lost.withColumn("q_gap", F.log10(F.nullif(F.abs("q_figure"), F.lit(0.0))) - F.col("q_level"))
    return by_posterior(lost, factors, spread=F.col("q_spread")).drop("q_gap")


def converted(df: DataFrame, refs: DataFrame, key: str = "stmt_id", missing: str = "dollars") -> DataFrame:
    """One row per row of ``df``: key, figure, factor, source of the unit and
    amount, and for rows without a unit the mixture's factor, posterior and
    uncertainty.  ``missing='dollars'`` takes such figures as dollars and fits
    nothing, ``missing='mixture'`` converts them by the factor assigned.

    Extra columns do not disturb; nulls in any column give null amounts.
    """
    p = parsed(df.select(key, "cik", "item", "item_value", "src_value", "src_units"), refs).drop("cik", "item", "src_value", "src_units")
    unknown = {"q_guess": F.lit(None).cast("double"), "q_posterior": F.lit(None).cast("double"), "q_uncertain": F.lit(False)}
    if missing != "mixture":
        return spread_out(p).withColumns(unknown).withColumn("q_amount", F.col("q_figure") * F.coalesce("q_factor", F.lit(1.0)))
    # parsed once, read three times
    p = spread_out(written(p, "units"))
    told = p.where(F.col("q_source") != "missing").withColumns(unknown)
    both = told.unionByName(assigned(p).select(*told.columns))
    return both.withColumn("q_amount", F.col("q_figure") * F.coalesce("q_factor", "q_guess", F.lit(1.0)))


def value_scalings(df: DataFrame, refs: DataFrame, key: str = "stmt_id") -> DataFrame:
    """Rows with a stored value and a readable figure, and the unit of the
    stored value: ``item_value`` has none of its own, so the mixture assigns
    one.  Its level is the amount in dollars that the row's text tells;
    ``q_guess`` is the factor that makes the value that amount."""
    c = written(converted(df, refs, key).select(key, F.col("item_value").cast("double").alias("v"), "q_amount"), "values")
    # a filter before would parse again
    c = c.where("v is not null and q_amount is not null")
    size = lambda x: F.log10(F.nullif(F.abs(x), F.lit(0.0)))
    return by_posterior(c.withColumn("q_gap", size("v") - size("q_amount")), SCALINGS, most=CLOSE)


def misconverted(df: DataFrame, refs: DataFrame, key: str = "stmt_id", factor: float = 50.0) -> DataFrame:
    """``key`` of the rows whose ``item_value`` is off the amount in dollars
    by ``factor`` or more either way: those to which the mixture assigns
    another scale, or none surely, checked exactly.  Zero against anything else is off
    without bound; zero against zero is right."""
    c = value_scalings(df, refs, key).where(F.col("q_uncertain") | (F.col("q_guess") != 1.0))
    v, a = F.abs("v"), F.abs("q_amount")
    # the ratio is compared with a little slack for decimals read as doubles
    off = (F.greatest(v, a) >= F.least(v, a) * (factor * (1 - 1e-9))) & ~((v == 0) & (a == 0))
    return c.where(off).select(key)
