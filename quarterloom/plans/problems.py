"""Queries of the general data problems (1, 4 and 5) over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarterloom.operators import orphans, spikes, units
from quarterloom.plans.named import NUMBER
from quarterloom.session import spread, table


def _orphan_rows(spark: SparkSession, d: str) -> DataFrame:
    return orphans.find_orphans(
        table(spark, d, "cik"),
        [(table(spark, d, "prelim_filing"), "prelim_filing", "filing_id"), (table(spark, d, "prelim_statement"), "prelim_statement", "stmt_id")],
    )


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphan_rows(spark, d).select("tbl", "row_id")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(_orphan_rows(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return units.misconverted(spread(table(spark, d, "prelim_statement")), table(spark, d, "ref_label"))


def p4_amounts(spark: SparkSession, d: str) -> DataFrame:
    """Every amount in dollars."""
    c = units.converted(spread(table(spark, d, "prelim_statement")), table(spark, d, "ref_label"))
    return c.where("q_amount is not null").select("stmt_id", F.round("q_amount", 4).alias("amount"), F.col("q_source").alias("unit_from"))


def p4_figures(spark: SparkSession, d: str) -> DataFrame:
    """What each figure's text and the unit column tell."""
    r = units.read_figure(F.col("src_value"))
    s = table(spark, d, "prelim_statement").select("stmt_id", r.alias("r"), units.column_factor(F.col("src_units")).alias("unit"))
    return s.select("stmt_id", F.round("r.figure", 6).alias("figure"), F.col("r.factor").alias("factor"), "unit")


def p4_missing_units(spark: SparkSession, d: str) -> DataFrame:
    """Rows without a unit and what the mixture makes of them."""
    c = units.converted(spread(table(spark, d, "prelim_statement")), table(spark, d, "ref_label"), missing="mixture")
    a = c.where("q_source = 'missing' and q_figure is not null")
    return a.select("stmt_id", F.col("q_guess").alias("factor"), F.round("q_posterior", 6).alias("posterior"), F.col("q_uncertain").alias("uncertain"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return spikes.implausible(spread(table(spark, d, "prelim_statement")), table(spark, d, "ref_label")).select("stmt_id")


def p5_reasons(spark: SparkSession, d: str) -> DataFrame:
    found = spikes.implausible(spread(table(spark, d, "prelim_statement")), table(spark, d, "ref_label"))
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("readings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_report, p4_found, p4_amounts, p4_figures, p4_missing_units, p5_found, p5_reasons)}


_ORPHANS = f"""
with parents as (
  select {NUMBER} as company, added_on, removed_on from cik
), refs as (
  select 'prelim_filing' as tbl, filing_id as row_id, {NUMBER} as company, filing_date from prelim_filing
  union all
  select 'prelim_statement', stmt_id, {NUMBER}, filing_date from prelim_statement
), lost as (
  select tbl, row_id, filing_date from refs r
  where company is not null and not exists (
    select 1 from parents p where p.company = r.company
      and (p.added_on is null or r.filing_date is null or p.added_on <= r.filing_date)
      and (p.removed_on is null or r.filing_date is null or r.filing_date < p.removed_on))
)
"""


_SPACE = r"[\x{00A0}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}\s]+"
_DASHES = r"[-‐-―−]"
_FIGURES = rf"""
with p as (select stmt_id, src_units, trim(regexp_replace(translate(src_value, '０１２３４５６７８９', '0123456789'), '{_SPACE}', ' ', 'g')) as t from prelim_statement),
m as (select stmt_id, src_units, t, regexp_extract(t, '(?i)^(?:us\$|usd|\$|＄)?\s*([(\[-‐-―−]*)\s*(?:us\$|usd|\$|＄)?\s*({_DASHES}?)\s*((?:[0-9][0-9,'' ]*)?(?:\.[0-9]+)?)(.*)$', ['a', 'b', 'n', 'rest']) as x from p),
n as (select stmt_id, src_units, t, try_cast(regexp_replace(x.n, '[, '']', '', 'g') as double) as v, x.a || x.b <> '' as neg,
  regexp_extract(lower(x.rest), '^[)\]]?\s*(?:(hundreds? of thousands|hundred thousands?|thousands?|millions?|billions?|thsd|000s|000|mln|bln|cents?|mm|mn|bn|c per share|k|m|c|¢)($|[^a-z0-9])|[(\[](hundreds? of thousands|hundred thousands?|thousands?|millions?|billions?|thsd|000s|000|mln|bln|cents?|c per share)[)\]])', ['w', 'e', 'y']) as u from m),
w as (select *, case when u.w <> '' then u.w else u.y end as word, lower(src_units) as c from n)
select stmt_id, case when regexp_full_match(t, '(?i)\s*(us\$|usd|\$|＄)?\s*{_DASHES}+\s*') then 0.0 else round(case when neg then -v else v end, 6) end as figure,
  case when v is null then null when word in ('hundred thousand', 'hundred thousands', 'hundreds of thousands') then 1e5 when word in ('thousand', 'thousands', 'thsd', 'k', '000', '000s') then 1e3
    when word in ('million', 'millions', 'mln', 'mn', 'mm', 'm') then 1e6 when word in ('billion', 'billions', 'bln', 'bn') then 1e9 when word in ('cent', 'cents', '¢', 'c', 'c per share') then 0.01 end::double as factor,
  case when regexp_matches(c, '100,?000|hundred') then 1e5 when regexp_matches(c, 'thous|thsd|000') then 1e3 when regexp_matches(c, 'billion|bln|\bbn\b|\$bn') then 1e9 when regexp_matches(c, 'million|mln|\bmn\b|mm\b') then 1e6
    when regexp_matches(c, 'dollar|\$|usd|as stated') then 1.0 when regexp_matches(c, 'cents?\b|¢') then 0.01 when regexp_matches(c, 'per share|whole|actual') then 1.0 end::double as unit
from w"""


def oracle_sql() -> dict[str, str]:
    return {
        "p4_figures": _FIGURES,
        "p1_found": _ORPHANS + "select tbl, row_id from lost",
        "p1_report": _ORPHANS + "select tbl, year(filing_date)::varchar || 'Q' || quarter(filing_date)::varchar as period, count(*) as orphans from lost group by 1, 2",
    }
