"""Named queries over whole tables, and the SQL that says the same."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarterloom.functions import grammar, periods, text, titles
from quarterloom.functions.companies import company_number
from quarterloom.operators import extract, grids, quality, report, store
from quarterloom.plans import pipeline
from quarterloom.session import shared_folder, spread, table, written
from quarterloom.sources import filings

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _statements(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prelim_statement")


def _numbered(df: DataFrame) -> DataFrame:
    """``cik`` as the company number its text denotes, null for none."""
    return df.withColumn("cik", company_number(F.col("cik")))


def _best(spark: SparkSession, d: str, keep: tuple[str, ...] = quality.CHECKED) -> DataFrame:
    return quality.query_prelims(_numbered(_statements(spark, d)), keep=keep)


_ITEMS = ", ".join(f"'{i}'" for i in quality.ITEMS)
#: The company number a text denotes.
NUMBER = "try_cast(nullif(regexp_replace(regexp_replace(translate(cik, '０１２３４５６７８９', '0123456789'), '\\.0*\\s*$', ''), '[^0-9]', '', 'g'), '') as bigint)"
#: The tables with company numbers.
_BY_NUMBER = {t: f"(select * replace ({NUMBER} as cik) from {t})" for t in ("prelim_statement", "prelim_filing", "cik")}
_BEST = f"""best as (select * exclude (rn) from (
  select *, row_number() over (partition by cik, filing_date, item order by table_rank nulls last, item_rank nulls last, filing_href, stmt_id) as rn
  from {_BY_NUMBER["prelim_statement"]} where item_value is not null) where rn = 1)"""
_Q = "(cast(substr(fiscal_period, 1, 4) as int) * 4 + cast(substr(fiscal_period, 6, 1) as int) - 1)"
_TEXT = lambda q: f"(cast({q} // 4 as varchar) || 'Q' || cast({q} % 4 + 1 as varchar))"


# --- best value ------------------------------------------------------------------
@query(f"with {_BEST} select stmt_id, cik, filing_date, item, cast(item_value as double) as item_value from best")
def choose_by_rank(spark, d):
    return _best(spark, d).select("stmt_id", "cik", "filing_date", "item", F.col("item_value").cast("double").alias("item_value"))


@query("""select item, fiscal_period, stmt_id from (
  select *, row_number() over (partition by item, fiscal_period order by table_rank nulls last, item_rank nulls last, filing_href, stmt_id) as rn
  from prelim_statement) where rn = 1""")
def choose_by_rank_nulls(spark, d):
    return quality.choose_by_rank(_statements(spark, d), keys=("item", "fiscal_period")).select("item", "fiscal_period", "stmt_id")


# --- periods ---------------------------------------------------------------------
@query(f"""select stmt_id, cast({_Q} as bigint) as q, cast({_Q} // 4 as bigint) as year, cast({_Q} % 4 + 1 as bigint) as quarter,
  cast(case when {_Q} % 4 = 3 then fpe_date - interval 12 month else fpe_date - to_months(cast(3 * (3 - {_Q} % 4) as int)) end as date) as item_end
  from prelim_statement where fpe_date is not null""")
def period_parts(spark, d):
    q = periods.index_of(F.col("fiscal_period"))
    quarter = periods.quarter_of(q)
    s = _statements(spark, d).where("fpe_date is not null")
    return s.select("stmt_id", q.cast("bigint").alias("q"), periods.year_of(q).cast("bigint").alias("year"), quarter.cast("bigint").alias("quarter"), periods.item_fpe(F.col("fpe_date"), quarter).alias("item_end"))


@query(f"""select stmt_id, n, {_TEXT(f"({_Q} + n)")} as shifted, cast({_Q} - 8040 as bigint) as since
  from prelim_statement, (values (-9), (-4), (-1), (0), (3), (6)) as t(n)""")
def period_arith(spark, d):
    s = _statements(spark, d).select("stmt_id", "fiscal_period", F.explode(F.array(*map(F.lit, (-9, -4, -1, 0, 3, 6)))).alias("n"))
    return s.select("stmt_id", "n", periods.plus(F.col("fiscal_period"), F.col("n")).alias("shifted"), periods.minus(F.col("fiscal_period"), F.lit("2010Q1")).cast("bigint").alias("since"))


_FYE = """select fpe_date as fpe, m, k, last_day(make_date(year(fpe_date) + k, m, 1)) as fye
  from (select distinct fpe_date from prelim_statement where fpe_date is not null), (values (1), (2), (6), (9), (10), (12)) as a(m), (values (0), (1), (2)) as b(k)"""


@query(f"""with x as ({_FYE}), y as (
  select fpe, fye, (year(fye) - year(fpe)) * 12 + month(fye) - case when day(fpe) < 7 then case when month(fpe) > 1 then month(fpe) - 1 else 12 end else month(fpe) end as months from x where fpe <= fye),
  z as (select *, cast(floor(months / 3.0) as int) as back from y)
  select fpe, fye, cast(year(fye) - case when back >= 4 then back // 4 else 0 end - case when month(fye) >= 6 then 0 else 1 end as varchar)
    || 'Q' || cast(greatest(4 - case when back >= 4 then back % 4 else back end, 1) as varchar) as fiscal_period from z""")
def fiscal_from_fpe(spark, d):
    s = _statements(spark, d).where("fpe_date is not null").select(F.col("fpe_date").alias("fpe")).distinct()
    s = s.withColumn("m", F.explode(F.array(*map(F.lit, (1, 2, 6, 9, 10, 12))))).withColumn("k", F.explode(F.array(*map(F.lit, (0, 1, 2)))))
    s = s.withColumn("fye", F.last_day(F.make_date(F.year("fpe") + F.col("k"), F.col("m"), F.lit(1)))).where("fpe <= fye")
    return s.select("fpe", "fye", periods.from_fpe_date(F.col("fye"), F.col("fpe")).alias("fiscal_period"))


@query("""with x as (select distinct fpe_date as fpe from prelim_statement where fpe_date is not null),
  y as (select fpe, form, mmdd, cast(substr(mmdd, 1, 2) as int) as m, cast(substr(mmdd, 3) as int) as dd,
    case when day(fpe) > 7 then month(fpe) else month(fpe) - 1 end as seen
    from x, (values ('Form 10-Q', '1231'), ('Form 10-Q', '0930'), ('Form 10-Q', '0631'), ('Form 10-Q', '0229'), ('Form 10-K', '1231')) as t(form, mmdd)),
  z as (select *, make_date(year(fpe) + case when seen > m then 1 else 0 end, m, 1) as one from y)
  select fpe, form, mmdd, cast(case when form like '%10-K' then fpe else one + cast(least(dd, day(last_day(one))) - 1 as int) end as date) as fye from z""")
def fye_from_mmdd(spark, d):
    s = _statements(spark, d).where("fpe_date is not null").select(F.col("fpe_date").alias("fpe")).distinct()
    kinds = (("Form 10-Q", "1231"), ("Form 10-Q", "0930"), ("Form 10-Q", "0631"), ("Form 10-Q", "0229"), ("Form 10-K", "1231"))
    s = s.withColumn("t", F.explode(F.array(*[F.struct(F.lit(a).alias("form"), F.lit(b).alias("mmdd")) for a, b in kinds]))).select("fpe", "t.*")
    return s.select("fpe", "form", "mmdd", periods.fye_from_mmdd(F.col("fpe"), F.col("form"), F.col("mmdd")).alias("fye"))


# --- quality ---------------------------------------------------------------------
_CHECKS_OF_BEST = f"""s as (select *, {_Q} as q from best),
  ranges as (select cik, min(q) - 1 as a, max(q) + 1 as b from s group by cik),
  pairs as (select distinct cik, item from s),
  miss as (select p.cik, p.item, t.q from pairs p join ranges r on p.cik is not distinct from r.cik, lateral (select unnest(generate_series(r.a + 1, r.b - 1)) as q) t
    where not exists (select 1 from s where s.cik is not distinct from p.cik and s.item = p.item and s.q = t.q)),
  lags as (select cik, item, q, cast(item_value as double) as v, lag(cast(item_value as double)) over (partition by cik, item, q order by filing_date, filing_href, stmt_id) as p from s),
  dup as (select distinct cik, item, q from lags where p is not null and ((p <> 0 and abs(1 - v / p) >= 0.25) or (p = 0 and v <> 0))),
  outl as (select distinct cik, item, q from s where abs(cast(item_value as double)) > 1e12)"""
_CHECKS = f"{_BEST}, {_CHECKS_OF_BEST}"
_RUNS = lambda t: (
    f"(select cik, item, min(q) as a, max(q) as b, count(*) as n from (select cik, item, q, q - row_number() over (partition by cik, item order by q) as g from {t}) group by cik, item, g)"
)
_PERIOD = f"case when n = 1 then {_TEXT('a')} else {_TEXT('a')} || ' to ' || {_TEXT('b')} || ': ' || cast(n as varchar) || ' periods' end"
_ALL = f"""select p.cik, p.item, cast(null as varchar) as period, 'empty' as msg_type, 'No values for item' as message
    from (select * from (select distinct cik from s), (select unnest([{_ITEMS}]) as item)) p where not exists (select 1 from s where s.cik is not distinct from p.cik and s.item = p.item)
  union all select cik, item, {_PERIOD}, 'missing', 'Missing period' from {_RUNS('miss')} where item in ({_ITEMS})
  union all select cik, item, {_PERIOD}, 'duplicate', 'Duplicate period' from {_RUNS('dup')} where item in ({_ITEMS})
  union all select cik, item, {_PERIOD}, 'outlier', 'Potential outlier' from {_RUNS('outl')} where item in ({_ITEMS})"""


@query(f"with {_CHECKS} select cik, item, {_TEXT('q')} as period from miss")
def missing_periods(spark, d):
    return quality.missing_periods(_best(spark, d)).select("cik", "item", periods.text_of(F.col("q")).alias("period"))


@query(f"with {_CHECKS} select cik, item, {_TEXT('q')} as period from dup")
def duplicate_periods(spark, d):
    return quality.duplicate_periods(_best(spark, d)).select("cik", "item", periods.text_of(F.col("q")).alias("period"))


@query(f"with {_CHECKS} select cik, item, {_TEXT('q')} as period from outl")
def outlier_periods(spark, d):
    return quality.outlier_periods(_best(spark, d)).select("cik", "item", periods.text_of(F.col("q")).alias("period"))


@query(f"""with {_CHECKS} select p.cik, p.item from (select * from (select distinct cik from s), (select unnest([{_ITEMS}]) as item)) p
  where not exists (select 1 from s where s.cik is not distinct from p.cik and s.item = p.item)""")
def empty_items(spark, d):
    return quality.empty_items(_best(spark, d))


@query(f"with {_CHECKS}, obs as (select distinct cik, item, q from s) select cik, item, {_PERIOD} as period from {_RUNS('obs')}")
def compress_periods(spark, d):
    s = _best(spark, d).withColumn("q", periods.index_of(F.col("fiscal_period")))
    return quality.compress(s)


@query(f"with {_CHECKS} select * from ({_ALL})")
def validate_all(spark, d):
    return quality.validate(_best(spark, d))


@query(f"""with {_CHECKS}, said as (select cik, item, count(*) filter (msg_type = 'missing') as missing, count(*) filter (msg_type = 'duplicate') as duplicate,
    count(*) filter (msg_type = 'outlier') as outlier from ({_ALL}) group by 1, 2),
  stats as (select cik, item, count(fiscal_period) as count, min(fiscal_period) as start, max(fiscal_period) as "end" from s where item in ({_ITEMS}) group by 1, 2),
  grid as (select * from (select distinct cik from s), (select unnest([{_ITEMS}]) as item)),
  names as (select {NUMBER} as cik, min(company_name) as company_name, min(ticker) as ticker from cik group by 1)
  select g.cik, n.company_name, n.ticker, g.item, coalesce(t.count, 0) as count,
    cast(case when t.count is null then coalesce(max(t.count) over (partition by g.cik), 0) else coalesce(m.missing, 0) end as bigint) as missing,
    coalesce(m.duplicate, 0) as duplicate, coalesce(m.outlier, 0) as outlier, coalesce(t.start, '-') as start, coalesce(t."end", '-') as "end"
  from grid g left join stats t on g.cik is not distinct from t.cik and g.item = t.item left join said m on g.cik is not distinct from m.cik and g.item = m.item left join names n on g.cik = n.cik
  order by g.cik, company_name, ticker, g.item""")
def summarize(spark, d):
    return quality.summarize(_best(spark, d), _numbered(table(spark, d, "cik")))


# --- reports ---------------------------------------------------------------------
@query(f"""with {_BEST}, v as (select item, cast(item_value as double) as x from best)
  select item, count(x) as count, round(avg(x) / 1e6, 4) as mean, round(stddev_samp(x) / 1e6, 4) as std, min(x) as min,
  round(quantile_cont(x, 0.25), 3) as p25, round(quantile_cont(x, 0.5), 3) as p50, round(quantile_cont(x, 0.75), 3) as p75, max(x) as max from v group by item""")
def describe_items(spark, d):
    r = report.describe(_best(spark, d))
    return r.select("item", "count", *[F.round(F.col(c) / 1e6, 4).alias(c) for c in ("mean", "std")], "min", *[F.round(c, 3).alias(c) for c in ("p25", "p50", "p75")], "max")


_WIDE = ", ".join(f"max(case when item = '{i}' then cast(item_value as double) end) as {i.replace(' ', '_')}" for i in quality.ITEMS)
_FILL = ", ".join(f"last_value({i.replace(' ', '_')} ignore nulls) over w as {i.replace(' ', '_')}" for i in quality.ITEMS)


@query(f"""with {_BEST}, wide as (select cik, filing_date, {_WIDE} from best group by 1, 2)
  select cik, filing_date, {_FILL} from wide window w as (partition by cik order by filing_date rows between unbounded preceding and current row)""")
def pivot_ffill(spark, d):
    return report.pivot_filled(_best(spark, d), quality.ITEMS)


@query("""select stmt_id, '<a href="' || filing_href || '">' || fiscal_period || '</a>' as link, strftime(filing_date, '%Y-%m-%d') as filed,
  fiscal_period || '#' || filing_href as source from prelim_statement""")
def linked_listing(spark, d):
    return report.linked(_statements(spark, d))


# --- store -----------------------------------------------------------------------
_KEY = "cik is not distinct from b.cik and a.filing_date = b.filing_date and a.filing_type = b.filing_type and a.filing_href = b.filing_href"


@query(f"""select a.filing_id from prelim_filing a where not exists (select 1 from prelim_filing b where b.is_prelim = false and a.{_KEY})""")
def ledger_anti(spark, d):
    led = table(spark, d, "prelim_filing")
    return store.unvisited(led, led).select("filing_id")


@query(f"select a.filing_id from prelim_filing a where not exists (select 1 from prelim_statement b where a.{_KEY})")
def unloaded_filings(spark, d):
    return store.unloaded(table(spark, d, "prelim_filing"), _statements(spark, d)).select("filing_id")


@query(f"select a.filing_id from prelim_filing a where exists (select 1 from prelim_statement b where a.{_KEY})")
def loaded_semi(spark, d):
    led, facts = table(spark, d, "prelim_filing"), _statements(spark, d)
    keys = facts.select(*store.CORE).distinct()
    return led.alias("a").join(keys.alias("b"), store._alike("a", "b", store.CORE), "left_semi").select("filing_id")


@query(f"select c.cik, c.company_name from {_BY_NUMBER['cik']} c where exists (select 1 from {_BY_NUMBER['prelim_statement']} s where s.cik = c.cik)")
def exists_companies(spark, d):
    return _numbered(table(spark, d, "cik")).join(_numbered(_statements(spark, d).select("cik").distinct()).distinct(), "cik", "left_semi").select("cik", "company_name")


_DAY = dt.date(2015, 6, 30)


@query(f"""with o as (select cik, filing_date, filing_type, filing_href, item, stmt_id + 1000000000 as stmt_id, cast(item_value as double) * 2 as item_value from prelim_statement where table_rank = 0)
  select a.stmt_id, cast(a.item_value as double) as item_value, a.is_overridden from prelim_statement a where not exists (select 1 from o b where a.{_KEY} and a.item = b.item)
  union all select stmt_id, item_value, true from o""")
def override_merge(spark, d):
    facts = _statements(spark, d).select(*store.PRIMARY, "stmt_id", F.col("item_value").cast("double").alias("item_value"), "table_rank", "is_overridden")
    new = facts.where("table_rank = 0").withColumns({"stmt_id": F.col("stmt_id") + 1_000_000_000, "item_value": F.col("item_value") * 2})
    return store.override(facts.drop("table_rank"), new.drop("table_rank", "is_overridden")).select("stmt_id", "item_value", "is_overridden")


@query(f"""with {_BEST}, e as (select filing_date, item, stmt_id, cik, case when item_rank = 1 then item_value + 1 else item_value end as item_value, item_value as old,
    case when item_rank = 2 then null else fiscal_period end as fiscal_period, fiscal_period as old_period from best)
  select cik, stmt_id, cast(item_value as double) as item_value, fiscal_period from e where item_value is distinct from old or fiscal_period is distinct from old_period""")
def changed_rows(spark, d):
    best = _best(spark, d, keep=("cik", "stmt_id", "filing_date", "item", "item_rank", *store.OVERRIDES))
    rank = F.col("item_rank")
    value = F.when(rank == 1, F.col("item_value") + 1).otherwise(F.col("item_value")).cast("decimal(21,5)")
    edited = best.withColumns({"item_value": value, "fiscal_period": F.when(rank == 2, F.lit(None)).otherwise(F.col("fiscal_period"))})
    diff = store.changed(best, edited, keys=("cik", "filing_date", "item"))
    return diff.select("cik", "stmt_id", F.col("item_value").cast("double").alias("item_value"), "fiscal_period")


_COMPANY = "(select min(cik) from prelim_statement where cik similar to '[0-9]{10}')"


def _company(spark: SparkSession, d: str) -> str:
    return _statements(spark, d).where(F.col("cik").rlike("^[0-9]{10}$")).agg(F.min("cik")).first()[0]


_NUMBERED, _LEDGER = _BY_NUMBER["prelim_statement"], _BY_NUMBER["prelim_filing"]
#: The company of the most statements, whatever their spelling of it.
_LARGEST = f"(select cik from {_NUMBERED} where cik is not null group by 1 order by count(*) desc, cik limit 1)"


def _largest(facts: DataFrame) -> int:
    return facts.where("cik is not null").groupBy("cik").count().orderBy(F.desc("count"), "cik").first()[0]


@query(f"""select stmt_id from {_NUMBERED} where not coalesce(cik = {_LARGEST} and filing_date between date '2010-01-01' and date '2100-01-01' and not coalesce(is_overridden, false), false)""")
def reload_delete(spark, d):
    facts = _numbered(_statements(spark, d))
    return store.delete_for_reload(facts, _largest(facts), dt.date(2010, 1, 1)).select("stmt_id")


@query(f"""select filing_id, case when cik = {_LARGEST} and filing_date = (select min(filing_date) from {_LEDGER} where cik = {_LARGEST}) then false else is_prelim end as is_prelim from {_LEDGER}""")
def discard(spark, d):
    facts, led = _numbered(_statements(spark, d)), _numbered(table(spark, d, "prelim_filing"))
    c = _largest(facts)
    day = led.where(F.col("cik") == c).agg(F.min("filing_date")).first()[0]
    return store.discard(facts, led, c, day)[1].select("filing_id", "is_prelim")


@query(f"""select stmt_id from {_NUMBERED} where not coalesce(cik = {_LARGEST} and filing_date = (select min(filing_date) from {_NUMBERED} where cik = {_LARGEST}), false)""")
def discard_facts(spark, d):
    facts = _numbered(_statements(spark, d))
    c = _largest(facts)
    day = facts.where(F.col("cik") == c).agg(F.min("filing_date")).first()[0]
    return store.discard(facts, _numbered(table(spark, d, "prelim_filing")), c, day)[0].select("stmt_id")


@query(f"""select cik, filing_date, filing_type, filing_href from prelim_filing
  union all select distinct cik, filing_date, filing_type, filing_href from prelim_statement a where not exists (select 1 from prelim_filing b where a.{_KEY})""")
def insert_if_absent(spark, d):
    led = table(spark, d, "prelim_filing").select(*store.CORE)
    return store.insert_if_absent(led, _statements(spark, d).select(*store.CORE))


@query(f"select cik, coalesce(max(filing_date), date '2002-06-01') as since from {_NUMBERED} group by 1")
def high_water_mark(spark, d):
    return store.high_water_mark(_numbered(_statements(spark, d)))


@query("select filing_id, cik, filing_date from prelim_filing where filing_date between date '2010-01-01' and date '2012-12-31' and filing_type like '8-%' order by filing_date, filing_id")
def filings_range(spark, d):
    found = store.filings_between(table(spark, d, "prelim_filing"), dt.date(2010, 1, 1), dt.date(2012, 12, 31))
    return found.where(F.col("filing_type").startswith("8-")).select("filing_id", "cik", "filing_date").orderBy("filing_date", "filing_id")


@query("select c.* from cik c where exists (select 1 from prelim_statement s where s.cik = c.cik) order by c.cik")
def companies_with_statements(spark, d):
    """Full scan of the dimension, ascending."""
    return table(spark, d, "cik").join(_statements(spark, d).select("cik"), "cik", "left_semi").orderBy("cik")


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/quarterloom/{name}-{uuid.uuid4().hex}"


@query("select cik, sic, sic_description, company_name, ticker from cik")
def companies_saved(spark, d):
    """The company dimension loaded twice: truncated, then filled."""
    s = store.Store(spark, _place(spark, "store"))
    companies = table(spark, d, "cik")
    s.save_companies(companies.where("ticker is not null"))
    s.save_companies(companies)
    return s.read("company")


@query("select cik, sic, sic_description, company_name, ticker from cik")
def companies_csv(spark, d):
    """Written as CSV and read by the source of the dimension."""
    path = _place(spark, "csv")
    report.write_csv(table(spark, d, "cik").select(*store.COMPANY.fieldNames()), path)
    return filings.companies(spark, path)


@query(f"""with best as (select * exclude (rn) from (select *, row_number() over (partition by cik, filing_date, item order by table_rank nulls last, item_rank nulls last, filing_href, stmt_id) as rn
    from prelim_statement where item_value is not null and cik is not null) where rn = 1),
  {_CHECKS_OF_BEST},
  said as (select cik, count(*) as n from ({_ALL}) group by 1)
  select cik, 'company' as section, count(*) as lines from cik c where cik is not null and exists (select 1 from best b where b.cik = c.cik) group by 1
  union all select cik, 'values', count(*) from best group by 1 union all select cik, 'sources', count(*) from best group by 1 union all select cik, 'messages', n from said""")
def report_lines(spark, d):
    """Lines in each section of the reports of all companies."""
    lines = report.report_lines(_statements(spark, d), table(spark, d, "cik"), quality.ITEMS)
    return lines.groupBy("cik", "section").agg(F.max("nth").cast("bigint").alias("lines"))


@query("select cik from (select distinct cik from cik) order by cik desc nulls last limit 50")
def companies_to_load(spark, d):
    return pipeline.companies_to_load(table(spark, d, "cik"), 50)


@query("select filing_id, cik, filing_date from prelim_filing where upper(filing_type) = '8-K'")
def current_reports(spark, d):
    return extract.only_current_reports(table(spark, d, "prelim_filing")).select("filing_id", "cik", "filing_date")


# --- text ------------------------------------------------------------------------
@query(r"""select doc_id, substr(regexp_replace(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g'), '\s+', ' ', 'g'), 1, 1024) as clean from documents where text is not null""")
def sanitize_documents(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", text.sanitize(F.col("text")).alias("clean"))


# Words of a title: lower case, runs of digits as #, without remarks and notes;
# where letters stand apart, two blanks part the words.
_TITLE_WORDS = r"""with t as (select distinct src_table from prelim_statement where src_table is not null),
  a as (select src_table, regexp_replace(regexp_replace(lower(regexp_replace(src_table, '[\x{AD}\x{34F}\x{200B}-\x{200F}\x{2060}\x{FEFF}]', '', 'g')), '[''’]', '', 'g'), '[\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]', ' ', 'g') as v from t),
  b as (select src_table, case when regexp_matches(v, '[a-z] [a-z] [a-z] [a-z] ') then replace(replace(replace(v, '  ', chr(1)), ' ', ''), chr(1), ' ') else v end as v from a),
  u as (select src_table, regexp_replace(trim(regexp_replace(v, '\(unaudited\)|unaudited', ' ', 'g')), '(\s*(\(\s*[a-z0-9$]\s?[a-z0-9$]?\s*\)|\*))+$', '') as v from b),
  w as (select src_table, ' ' || array_to_string(list_transform(regexp_extract_all(v, '[a-z]+|[0-9]+'), lambda x: case when x similar to '[0-9]+' then '#' else x end), ' ') || ' ' as w from u)"""
# Ranks read by hand for the kinds of title that the statements hold.
_TITLE_KINDS = (
    (0, " (quarterly |condensed )*consolidated statements?( s)? of ((net|comprehensive) )*(income|earnings|loss|operations) .*"),
    (1, ".* consolidated statements?( s)? of ((net|comprehensive) )*(income|earnings|loss|operations) (condensed |comprehensive )*"),
    (4, " (condensed )?consolidated ((financial|selected|key|other) )*(highlights?|summary|results|data) .*"),
    (5, ".* consolidated ((financial|selected|key|other) )*(highlights?|summary|results|data) (financial )*"),
    (7, " consolidated balance sheets? .*"),
    (8, ".* consolidated balance sheets? "),
    (11, " (quarterly )?(key|summary|supplemental|condensed|#) (quarterly )?(financial|operating) (quarterly )?(highlights|information|results|data) .*"),
    (12, ".* (key|summary|supplemental|condensed|#) (quarterly )?(financial|operating) (quarterly )?(highlights|information|results|data) .*"),
    (13, " (selected |quarterly |by |quarter )*(financial|operating|key) (quarterly )?(highlights|information|results|data) (selected |quarterly |by |quarter |continued )*"),
    (14, " (results|statements?) of operations? .*"),
    (15, ".* (results|statements?) of operations? .*"),
    (16, " (select |selected |key |financial |and )*(ratios|data) .*"),
    (17, " summary of business results .*"),
    (18, ".* summary of business results .*"),
    (22, " quarterly performance summary .*"),
    (23, " statements? of (financial )?condition .*"),
    (24, " (earnings|revenue) summary .*"),
    (25, " (financial )?highlights .*"),
    (26, " statements? of (income|earnings) .*"),
    (27, " income (statements?|data|summary) .*"),
    (28, " balance sheet .*"),
    (29, " net interest income and net interest margin .*"),
    (32, " per share related information .*"),
    (33, " income trend (statement )?analysis .*"),
    (36, " allowance for credit losses .*"),
    (38, " capital (measures|information|ratios) .*"),
    (41, " earnings .*"),
)
_TITLE_RANKS = "case " + " ".join(f"when w similar to '{pattern}' then {rank}" for rank, pattern in _TITLE_KINDS) + " end"


def _dealt(values: DataFrame) -> DataFrame:
    """In as many pieces as cores: the adaptive plan would see few bytes, not
    the work of reading them."""
    return values.repartition(values.sparkSession.sparkContext.defaultParallelism)


@query(f"{_TITLE_WORDS} select src_table, cast({_TITLE_RANKS} as bigint) as title_rank from w")
def title_match(spark, d):
    t = _statements(spark, d).where("src_table is not null").select("src_table").distinct()
    return _dealt(t).select("src_table", titles.title_rank_column(F.col("src_table")).alias("title_rank"))


_CENTS = "cast(round(l_extendedprice * 100) as bigint)"


@query(f"""select l_orderkey, l_linenumber, cast(case when l_linenumber % 4 = 0 then 0 when l_linenumber % 4 = 1 then -1 else 1 end * {_CENTS} as double) / 100 as v,
  l_linenumber % 4 = 3 as blank from lineitem""")
def cell_value_parse(spark, d):
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    num = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    k = F.col("l_linenumber") % 4
    shown = F.when(k == 0, F.lit("—")).when(k == 1, F.concat(F.lit("$ ("), num, F.lit(")"))).when(k == 2, F.concat(F.lit("$"), num, F.lit("*"))).otherwise(F.concat(F.lit(" "), num, F.lit(" %")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.item_value(shown).alias("v"), (k == 3).alias("blank"))


@query("""select l_orderkey, l_linenumber, not (l_quantity between 28 and 31) as plain, not (floor(l_extendedprice) between 28 and 31 or floor(l_extendedprice) between 2000 and 2050) as money, true as hyphen, false as word from lineitem""")
def row_part_flag(spark, d):
    lines = table(spark, d, "lineitem")
    t, money = F.col("l_quantity").cast("int").cast("string"), F.format_number(F.floor("l_extendedprice"), 0)
    part = text.is_row_part
    return lines.select("l_orderkey", "l_linenumber", part(t).alias("plain"), part(F.concat(F.lit("$ "), money)).alias("money"), part(F.lit("–")).alias("hyphen"), part(F.concat(t, F.lit(" months"))).alias("word"))


@query(r"""with b as (select stmt_id, regexp_replace(src_value, '[$%,*]', '', 'g') as bare from prelim_statement where src_value is not null),
  t as (select stmt_id, bare, regexp_replace(bare, '\s+', '', 'g') as tight from b),
  n as (select *, regexp_extract(tight, '^\(([0-9.]+)', 1) as bracket, regexp_extract(tight, '([0-9.]+)', 1) as first from t)
  select stmt_id, case when regexp_full_match(bare, '[—–\x{96}\x{97}-]+') then 0.0 when not regexp_matches(bare, '[0-9]') then null
    when bracket <> '' then -coalesce(try_cast(bracket as double), 'nan'::double) else coalesce(try_cast(first as double), 'nan'::double) end as value from n""")
def cell_values(spark, d):
    """The figures of the statements' own cells."""
    return _statements(spark, d).where("src_value is not null").select("stmt_id", text.item_value(F.col("src_value")).alias("value"))


_DATES = "(select distinct year(o_orderdate) + 10 as y, quarter(o_orderdate) as q from orders)"
# A heading in lower case, every blank an ordinary one, without its remark.
_UNSEEN = r"'[\x{AD}\x{34F}\x{200B}-\x{200F}\x{2060}\x{FEFF}]'"
_HEAD = rf"trim(regexp_replace(regexp_replace(lower(regexp_replace(src_column, {_UNSEEN}, '', 'g')), '[\x{{00A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\s]+', ' ', 'g'), '\(?unaudited\)?', '', 'g'))"
_MONTH_Q = "(feb|mar|may|jun|aug|sep|nov|dec)"
_BY_MONTH = "case m when 'feb' then 1 when 'mar' then 1 when 'may' then 2 when 'jun' then 2 when 'aug' then 3 when 'sep' then 3 when 'nov' then 4 when 'dec' then 4 end"


@query(rf"""with t as (select distinct src_column from prelim_statement where src_column is not null), h as (select src_column, {_HEAD} as h from t),
  p as (select src_column, case
    when regexp_matches(h, '[1-4]\s*q(tr)?\s*(20)?[0-9][0-9]$') then regexp_extract(h, '([1-4])\s*q(?:tr)?\s*((?:20)?[0-9][0-9])$', ['q', 'y'])
    when regexp_matches(h, 'q(tr)?\s*[1-4]\s+(20)?[0-9][0-9]$') then regexp_extract(h, 'q(?:tr)?\s*([1-4])\s+((?:20)?[0-9][0-9])$', ['q', 'y'])
    when regexp_matches(h, '20[0-9][0-9]\s*q\s*[1-4]$') then regexp_extract(h, '()(20[0-9][0-9])\s*q\s*([1-4])$', ['m', 'y', 'q'])
    when regexp_matches(h, '[0-9][0-9] (first|second|third|fourth)( quarter)?$') then regexp_extract(h, '()((?:20)?[0-9][0-9]) (first|second|third|fourth)', ['m', 'y', 'o'])
    when regexp_matches(h, '(first|second|third|fourth)( quarter)? (20)?[0-9][0-9]$') then regexp_extract(h, '()(first|second|third|fourth)(?: quarter)? ((?:20)?[0-9][0-9])$', ['m', 'o', 'y'])
    when regexp_matches(h, '{_MONTH_Q}(ruary|ch|e|ust|t|tember|ember)?\.? [0-9]+, ?(20)?[0-9][0-9]$') then regexp_extract(h, '{_MONTH_Q}(?:ruary|ch|e|ust|t|tember|ember)?\.? [0-9]+, ?((?:20)?[0-9][0-9])$', ['m', 'y'])
    when regexp_matches(h, '{_MONTH_Q}(ruary|ch|e|ust|t|tember|ember)?\.? [0-9]+ (20)?[0-9][0-9]$') then regexp_extract(h, '{_MONTH_Q}(?:ruary|ch|e|ust|t|tember|ember)?\.? [0-9]+ ((?:20)?[0-9][0-9])$', ['m', 'y'])
    when regexp_matches(h, '(three months|quarter) ended (28|29|30|31) {_MONTH_Q}(ruary|ch|e|ust|t|tember|ember)?\.? (20)?[0-9][0-9]$') then regexp_extract(h, '{_MONTH_Q}(?:ruary|ch|e|ust|t|tember|ember)?\.? ((?:20)?[0-9][0-9])$', ['m', 'y'])
    when regexp_matches(h, '[0-9]+-{_MONTH_Q}[a-z]*-[0-9][0-9]$') then regexp_extract(h, '{_MONTH_Q}[a-z]*-([0-9][0-9])$', ['m', 'y'])
    when regexp_matches(h, '(^|[^0-9])0?(3|6|9|12)/[0-9]+/(20)?[0-9][0-9]$') then regexp_extract(h, '()(3|6|9|12)/[0-9]+/((?:20)?[0-9][0-9])$', ['q', 'n', 'y']) end as x, h from h),
  r as (select src_column, x.y as y, coalesce(try_cast(nullif(x.q, '') as int), try_cast(x.n as int) // 3,
    case x.o when 'first' then 1 when 'second' then 2 when 'third' then 3 when 'fourth' then 4 end, {_BY_MONTH.replace("case m", "case x.m")}) as q from p)
  select src_column, case when y <> '' and q is not null then (case when length(y) = 2 then '20' else '' end) || y || 'Q' || q end as period from r""")
def period_text_parse(spark, d):
    """Headings as the statements have them; ``period_text_rules`` renders
    the other spellings."""
    heads = _statements(spark, d).where("src_column is not null").select("src_column").distinct()
    return _dealt(heads).select("src_column", grammar.period_column(F.col("src_column")).alias("period"))


def _spelled_by_rule(y: Column, q: Column) -> Column:
    """Spellings of a quarter, at least one for each of ``SPELLINGS``, then
    cells that tell a quarter but name something else."""
    pick = lambda *xs: F.element_at(F.array(*map(F.lit, xs)), q.cast("int"))
    say = lambda t: F.format_string(t, *[c.cast("string") for c in (y, q, pick("March", "June", "September", "December"), pick("31", "30", "30", "31"), pick("first", "second", "third", "fourth"), F.substring(y.cast("string"), 3, 2), pick("3", "6", "9", "12"))])
    # 1 year, 2 quarter, 3 month, 4 its last day, 5 ordinal, 6 short year, 7 number of the month
    return F.array(*map(say, (
        "%2$sQ%6$s", "Qtr %2$s %1$s", "%1$sQ%2$s", "%1$s %5$s quarter", "%5$s quarter %1$s", "Quarter %1$s %5$s",
        "Three months ended %3$s %4$s, %1$s", "Quarter ended %3$s %4$s, '%6$s", "%3$s %4$s, %1$s", "For the three months ended %7$s/%4$s/%1$s",
        "Quarter ended %4$s %3$s %1$s (unaudited)", "Three months ended %1$s %3$s %4$s", "%4$s-%3$s-%6$s", "%7$s/%4$s/%6$s", "Q%2$s %1$s", "%1$s QTD", "QTR %1$s", "%1$s %3$s %4$s",
        "Q%2$s %1$s vs Q%2$s %1$s", "%% change Q%2$s %1$s", "Year-to-date %3$s %4$s, %1$s", "Six months ended %3$s %4$s, %1$s", "Income, nine months ended %3$s %4$s, %1$s", "Income, fiscal year ended %7$s/%4$s/%1$s",
    )))


@query(f"""select y, q, k, case when k in (15, 16) then cast(y as varchar) || 'QTD' when k < 18 then cast(y as varchar) || 'Q' || cast(q as varchar) end as period
  from {_DATES}, (select unnest(generate_series(0, 23)) as k)""")
def period_text_rules(spark, d):
    o = table(spark, d, "orders").select((F.year("o_orderdate") + 10).cast("bigint").alias("y"), F.quarter("o_orderdate").cast("bigint").alias("q")).distinct()
    o = o.select("y", "q", F.posexplode(_spelled_by_rule(F.col("y"), F.col("q"))).alias("k", "t"))
    return o.select("y", "q", F.col("k").cast("bigint").alias("k"), grammar.period_column(F.col("t")).alias("period"))


_PLAIN = rf"regexp_replace(lower(regexp_replace(s, {_UNSEEN}, '', 'g')), '[\x{{00A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\s]+', ' ', 'g')"


@query(rf"""with t as (select distinct src_column as s from prelim_statement where src_column is not null union select distinct src_row from prelim_statement where src_row is not null),
  h as (select s, {_PLAIN} as h from t)
  select s, regexp_matches(h, '(^|[^a-z])(quarters?|years?|ytd|first|second|third|fourth|feb|february|mar|march|may|jun|june|aug|august|sep|sept|september|nov|november|dec|december)([^a-z]|$)')
    or regexp_matches(h, '(^|[^a-z0-9])(three|six|nine|twelve|3|6|9|12) months?([^a-z]|$)') or regexp_matches(h, '(^|[^a-z])as (reported|adjusted)([^a-z]|$)')
    or regexp_matches(h, '^\s*[0-9]+/[0-9]+/[0-9]+\s*$') or regexp_matches(h, '^\s*[1-4]\s*q') or regexp_matches(h, '^\s*q[1-4]\s*$')
    or regexp_matches(h, '([1-4]\s*q(tr)?|q(tr)? ?[1-4])\s*(20)?[0-9][0-9]\s*$') or regexp_matches(h, '[0-9][0-9]\s*q\s*[1-4]\s*$') or regexp_matches(h, '^\s*\(?unaudited\)?\s*$') as header from h""")
def header_part_flag(spark, d):
    s = _statements(spark, d)
    cells = s.select(F.explode(F.array_distinct(F.array("src_column", "src_row"))).alias("s")).where("s is not null").distinct()
    return _dealt(cells).select("s", grammar.header_part_column(F.col("s")).alias("header"))


@query("""select stmt_id, case
    when src_units in ('(Dollars in thousands)', '(in thousands)', '(dollars in thousands, except share amounts)', 'in thousands, except per share data', '$000s', 'In Thousands of Dollars', 'in 000''s', '($ in 000’s)') then 1e3
    when src_units in ('(dollars in millions)', '$ in millions', 'in millions, except per share data', '(in millions)', 'IN MILLIONS', 'amounts in millions unless noted') then 1e6
    when src_units in ('in billions', '(dollars in billions)') then 1e9 else 1.0 end::double as scale from prelim_statement where src_units is not null""")
def units_scale(spark, d):
    return _statements(spark, d).where("src_units is not null").select("stmt_id", grammar.scale_column(F.col("src_units")).alias("scale"))


# --- tables and filings ------------------------------------------------------------
def _supplier_sums(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("l_extendedprice").cast("decimal(18,2)")
    return table(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.sum(v).alias("total"), F.count(F.lit(1)).alias("n"))


def _money(cents: Column) -> Column:
    """Whole number with separators."""
    return F.format_number(cents.cast("bigint"), 0)


@query("""with t as (select l_suppkey, l_returnflag, cast(floor(sum(cast(l_extendedprice as decimal(18,2)))) as bigint) as total, count(*) as n from lineitem group by 1, 2)
  select l_suppkey, l_returnflag as label, total, n from t""")
def html_grid(spark, d):
    s = _supplier_sums(spark, d)
    row = F.concat(F.lit("<tr><td>"), F.col("l_returnflag"), F.lit("<td>$<td align=right>("), _money(F.floor("total")), F.lit(")</td><td>"), F.col("n").cast("string"), F.lit("</tr>"))
    pages = s.withColumn("row", row).groupBy("l_suppkey").agg(F.array_join(F.sort_array(F.collect_list("row")), "\n").alias("rows"))
    html = F.concat(F.lit("<p>Sums<table><thead><tr><th>flag</th><th colspan=2>total</th><th>n</th></tr></thead>"), F.col("rows"), F.lit("</table>"))
    c = grids.cells(pages.select("l_suppkey", html.alias("html")), "l_suppkey").where("row_no > 0")
    wide = c.groupBy("l_suppkey", "row_no").agg(*[F.max(F.when(F.col("col_no") == i, F.col("cell"))).alias(f"c{i}") for i in (0, 2, 3)])
    return wide.select("l_suppkey", F.col("c0").alias("label"), (-text.item_value(F.col("c2"))).cast("bigint").alias("total"), F.col("c3").cast("bigint").alias("n"))


@query("""with t as (select l_suppkey, l_returnflag, cast(floor(sum(cast(l_extendedprice as decimal(18,2)))) as bigint) as total, count(*) + 100 as n from lineitem group by 1, 2)
  select l_suppkey, 'line ' || l_returnflag as label, '$' || format('{:,}', total) as this, cast(n as varchar) as last from t""")
def html_split_clean(spark, d):
    """Messy tables: titles across, signs in columns of their own, blank
    rows, a header over two rows with the units between."""
    s = _supplier_sums(spark, d)
    row = F.concat(F.lit("<tr><td>line "), F.col("l_returnflag"), F.lit("</td><td>$</td><td>"), _money(F.floor("total")), F.lit("</td><td></td><td>"), (F.col("n") + 100).cast("string"), F.lit("</td></tr><tr><td></td><td></td><td></td><td></td><td></td></tr>"))
    pages = s.withColumn("row", row).groupBy("l_suppkey").agg(F.array_join(F.sort_array(F.collect_list("row")), "\n").alias("rows"))
    head = "<table><tr><td></td><td colspan=2>Three months ended</td><td colspan=2>Three months ended</td></tr><tr><td>(in thousands)</td><td></td><td></td><td></td><td></td></tr><tr><td></td><td colspan=2>March 31, 2019</td><td colspan=2>March 31, 2018</td></tr>"
    c = grids.cells(pages.select("l_suppkey", F.concat(F.lit(head), F.col("rows"), F.lit("</table>")).alias("html")), "l_suppkey", cleaned=True).where("row_no > 0")
    wide = c.groupBy("l_suppkey", "row_no").agg(*[F.max(F.when(F.col("col_no") == i, F.col("cell"))).alias(f"c{i}") for i in (0, 1, 2)])
    return wide.select("l_suppkey", F.col("c0").alias("label"), F.col("c1").alias("this"), F.col("c2").alias("last"))


_MONTH_END = {1: "March 31", 2: "June 30", 3: "September 30", 4: "December 31"}


def _filed(spark: SparkSession, d: str) -> DataFrame:
    """A filing per bucket of customers and quarter, with figures that the
    orders of that quarter give; headings tell years of this century only, so
    ten years are added."""
    v = F.col("o_totalprice").cast("decimal(18,2)")
    part = lambda s: F.sum(F.when(F.col("o_orderstatus") == s, v).otherwise(0))
    o = table(spark, d, "orders").groupBy(
        F.lpad((F.col("o_custkey") % 100).cast("string"), 10, "0").alias("cik"), (F.year("o_orderdate") + 10).alias("y"), F.quarter("o_orderdate").alias("q")
    )
    return o.agg(F.floor(F.sum(v)).cast("bigint").alias("income"), F.floor(part("F")).cast("bigint").alias("provision"), F.count(F.lit(1)).alias("n"))


def _sgml(f: DataFrame) -> DataFrame:
    when = F.concat(F.element_at(F.create_map(*[F.lit(x) for kv in _MONTH_END.items() for x in kv]), F.col("q").cast("int")), F.lit(", "), F.col("y").cast("string"))
    line = lambda label, c: F.concat(F.lit(f"<tr><td>{label}</td><td>$</td><td>"), c, F.lit("</td></tr>\n"))
    html = F.concat(
        F.lit("<p>CONSOLIDATED STATEMENTS OF INCOME (unaudited)</p><p>(in thousands, except per share data)</p>\n<table><tr><td></td><td colspan=2>Three months ended "), when, F.lit("</td></tr>\n"),
        line("Total interest income", _money(F.col("income"))), line("Provision for credit losses (1)", _money(F.col("provision"))),
        line("Net income (loss)", F.concat(F.lit("("), _money(F.col("n") * 1000), F.lit(")"))), line("Book value per share", F.concat(F.col("n").cast("string"), F.lit(".25"))), F.lit("</table>"),
    )
    number = F.concat(F.col("cik"), F.lit("-"), F.col("y").cast("string"), F.lit("-"), F.col("q").cast("string"))
    head = F.concat(F.lit("<SEC-DOCUMENT>"), number, F.lit(".txt : 1\n<SEC-HEADER>\nCENTRAL INDEX KEY:\t\t\t"), F.col("cik"), F.lit("\n</SEC-HEADER>\n"))
    doc = lambda kind, name, body: F.concat(F.lit(f"<DOCUMENT>\n<TYPE>{kind}\n<FILENAME>{name}\n<TEXT>\n"), body, F.lit("\n</TEXT>\n</DOCUMENT>\n"))
    raw = F.concat(head, doc("8-K", "form.txt", F.lit("cover")), doc("EX-99", "ex99.htm", html), doc("GRAPHIC", "logo.htm", F.lit("<table></table>")))
    return f.select("cik", "y", "q", number.alias("submission"), raw.alias("raw"))


@query("""select lpad(cast(o_custkey % 100 as varchar), 10, '0') as cik, lpad(cast(o_custkey % 100 as varchar), 10, '0') || '-' || (year(o_orderdate) + 10) || '-' || quarter(o_orderdate) || '.txt : 1' as number, cast(1 as bigint) as documents
  from orders group by 1, 2""")
def submission_split(spark, d):
    p = filings.parse_submissions(_sgml(_filed(spark, d)).select("raw"))
    return p.select("cik", "number", F.size("documents").cast("bigint").alias("documents"))


_FILED = """with f as (select lpad(cast(o_custkey % 100 as varchar), 10, '0') as cik, year(o_orderdate) + 10 as y, quarter(o_orderdate) as q,
  cast(floor(sum(cast(o_totalprice as decimal(18,2)))) as bigint) as income, cast(floor(sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18,2)) else 0 end)) as bigint) as provision, count(*) as n
  from orders group by 1, 2, 3)"""


@query(_FILED + """, p as (select *, cast(y as varchar) || 'Q' || cast(q as varchar) as fiscal_period from f)
  select cik, fiscal_period, 'interest income' as item, cast(income as double) * 1000 as item_value, '(in thousands, except per share data)' as src_units from p
  union all select cik, fiscal_period, 'provision for loan losses', cast(provision as double) * 1000, '(in thousands, except per share data)' from p
  union all select cik, fiscal_period, 'net income', cast(n as double) * -1000000, '(in thousands, except per share data)' from p
  union all select cik, fiscal_period, 'book value per share', cast(n as double) + 0.25, '(in thousands, except per share data)' from p""")
def extract_items_e2e(spark, d):
    # as many pieces as cores: the adaptive plan would see few bytes, not the work
    raw = _sgml(_filed(spark, d)).select("submission", "raw").repartition(spark.sparkContext.defaultParallelism, "submission")
    found = extract.extract(filings.parse_submissions(raw), key=("submission", "cik"))
    best = extract.best_items(found, key=("submission", "cik"))
    return best.select("cik", "fiscal_period", "item", "item_value", "src_units")


def _xml(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _list_pages(spark: SparkSession, d: str) -> DataFrame:
    """The ledger as XML list pages below a root of their own; addresses have
    an entity, every third filing an XBRL link, every tenth page breaks off."""
    led = table(spark, d, "prelim_filing")
    xbrl = F.when(F.col("filing_id") % 3 == 0, F.lit("<XBRLREF>x</XBRLREF>")).otherwise(F.lit(""))
    entry = F.concat(F.lit("<filing><dateFiled>"), F.col("filing_date").cast("string"), F.lit("</dateFiled><type>"), _xml(F.col("filing_type")), F.lit("</type><filingHREF>"), _xml(F.concat("filing_href", F.lit("?a&b"))), F.lit("</filingHREF>"), xbrl, F.lit("</filing>"))
    pages = led.select(F.coalesce("cik", F.lit("")).alias("cik"), F.floor(F.col("filing_id") / 100).alias("page"), entry.alias("e")).groupBy("cik", "page").agg(F.array_join(F.collect_list("e"), "\n").alias("e"))
    end = F.when(F.col("page") % 10 == 9, F.lit("<oops")).otherwise(F.lit("</results></list>"))
    return pages.select("cik", F.concat(F.lit("<?xml version='1.0'?><list><results>"), F.col("e"), end).alias("xml"))


_LISTED = "select coalesce(cik, '') as cik, filing_date, filing_type, filing_href || '?a&b' as filing_href from prelim_filing where (filing_id // 100) % 10 <> 9 and filing_type like '8-%'"


@query(_LISTED)
def xml_filing_list(spark, d):
    return filings.filing_list(_list_pages(spark, d))


@query(f"{_LISTED} and filing_id % 3 = 0 and filing_date between date '2010-01-01' and date '2014-12-31'")
def xml_filing_list_xbrl(spark, d):
    return filings.filing_list(_list_pages(spark, d), require_xbrl=True, start=dt.date(2010, 1, 1), end=dt.date(2014, 12, 31))


@query("""select trim(cik) as cik, coalesce(nullif(trim(sic), ''), 'Unknown') as sic, coalesce(nullif(trim(sic_description), ''), 'Unknown') as sic_description, trim(company_name) as company_name
  from cik where nullif(trim(cik), '') is not null and nullif(trim(company_name), '') is not null""")
def company_info(spark, d):
    part = lambda tag, c: F.concat(F.lit(f"<{tag}>"), _xml(F.coalesce(F.col(c), F.lit(""))), F.lit(f"</{tag}>"))
    xml = F.concat(F.lit("<r><companyInfo>"), part("CIK", "cik"), part("SIC", "sic"), part("SICDescription", "sic_description"), part("name", "company_name"), F.lit("</companyInfo></r>"))
    return filings.company_info(table(spark, d, "cik").select(xml.alias("xml")))


@query("""select filing_id, filing_id % 4 as k, case when filing_id % 4 < 2 then filing_href end as href, case when filing_id % 4 = 2 then 'no submission link' when filing_id % 4 = 3 then 'more than one submission link' end as error,
  case filing_id % 3 when 0 then 'a.xml' when 1 then 'b.xml' end as xbrl_href, filing_date as fpe_date,
  cast(make_date(year(filing_date) + case when (case when day(filing_date) > 7 then month(filing_date) else month(filing_date) - 1 end) > 12 then 1 else 0 end, 12, 31) as date) as fye_date
  from (select * replace (coalesce(filing_href, 'x') || '.txt' as filing_href) from prelim_filing)""")
def landing_pages(spark, d):
    """Pages with one, no or several links to the submission, beside links of
    other documents, and XBRL links by description, by type or none."""
    led = table(spark, d, "prelim_filing").withColumns({"k": F.col("filing_id") % 4, "to": F.concat(F.coalesce("filing_href", F.lit("x")), F.lit(".txt"))})
    link = lambda c: F.concat(F.lit('<a href="'), c, F.lit('">file</a>'))
    row = lambda *cells: F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>"))
    other = row(F.lit("1"), F.lit("cover"), link(F.lit("cover.txt")), F.lit("8-K"))
    own = row(F.lit("&nbsp;"), F.lit("Complete submission text file"), link(F.col("to")), F.lit("&nbsp;"))
    more = row(F.lit("2"), F.lit("another submission"), link(F.concat(F.lit("2"), F.col("to"))), F.lit(""))
    rows = F.when(F.col("k") < 2, F.concat(other, own)).when(F.col("k") == 2, other).otherwise(F.concat(own, more))
    n = F.col("filing_id") % 3
    data = F.when(n == 0, row(F.lit("3"), F.lit("XBRL INSTANCE DOCUMENT"), link(F.lit("a.xml")), F.lit("EX-101.INS"))).when(n == 1, row(F.lit("3"), F.lit("x"), link(F.lit("b.xml")), F.lit("EX-101.INS"))).otherwise(row(F.lit("3"), F.lit("schema"), link(F.lit("c.xml")), F.lit("EX-101.SCH")))
    html = F.concat(
        F.lit('<div id="formName"><strong>Form 10-Q</strong></div><div class="infoHead">Period of Report</div> <div class="info">'), F.col("filing_date").cast("string"),
        F.lit('</div><p class="identInfo">Fiscal Year End: <strong>1231</strong><br></p><table class="tableFile" summary="Document Format Files">'), rows, F.lit('</table><table summary="Data Files">'), data, F.lit("</table>"),
    )
    return filings.landing_facts(led.select("filing_id", "k", html.alias("html"))).select("filing_id", "k", "href", "error", "xbrl_href", "fpe_date", "fye_date")


#: Whitespace that ``str.strip`` takes off.
_BLANKS = " || ".join(f"chr({c})" for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288))
#: An empty line ends a paragraph.
_PARAGRAPH = r"\n[ \t\r]*\n"


@query(f"""with p as (select doc_id, unnest(parts) as part, generate_subscripts(parts, 1) as i from (
    select doc_id, regexp_split_to_array(text, '{_PARAGRAPH}') as parts from documents where text is not null)),
  t as (select doc_id, i, trim(part, {_BLANKS}) as text from p)
  select doc_id, cast(row_number() over (partition by doc_id order by i) - 1 as bigint) as block_no, text from t where text <> ''""")
def page_text_blocks(spark, d):
    """Every text as a page with an element per paragraph."""
    docs = spread(table(spark, d, "documents")).where("text is not null")
    esc = F.col("text")
    for c, e in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        esc = F.replace(esc, F.lit(c), F.lit(e))
    html = F.concat(F.lit("<div><p>"), F.regexp_replace(esc, _PARAGRAPH, "</p><p>"), F.lit("</p></div>"))
    return grids.text_blocks(docs.select("doc_id", html.alias("html")), "doc_id").select("doc_id", F.col("block_no").cast("bigint").alias("block_no"), "text")


@query("select distinct cik, filing_date, filing_type, filing_href from prelim_filing")
def stream_incremental(spark, d):
    """Landed ledger rows loaded as a stream, twice: nothing is added twice."""
    from quarterloom.streaming.incremental import follow

    base = _place(spark, "stream")
    led = table(spark, d, "prelim_filing").select(*store.LEDGER.fieldNames())
    led.write.parquet(f"{base}/landing")
    s = store.Store(spark, f"{base}/store")
    for n in (1, 2):
        follow(spark, f"{base}/landing", s, f"{base}/checkpoint{n}").awaitTermination()
    return s.read("ledger").select("cik", "filing_date", "filing_type", "filing_href")


# --- the load as a whole -------------------------------------------------------------
_PERIOD_END = "cast(case when q = 4 then make_date(cast(y - 1 as int), 12, 31) else last_day(make_date(cast(y as int), cast(q * 3 as int), 1)) end as date)"


def _landed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Listed filings and their submissions, a filing of two statements a
    quarter; every filing of a fifth company holds nothing."""
    f = filings.parse_submissions(_sgml(_filed(spark, d)).select("submission", "y", "q", "raw").withColumnRenamed("submission", "filing_href"))
    f = f.repartition(spark.sparkContext.defaultParallelism, "filing_href")
    day = F.make_date(F.col("y") + F.when(F.col("q") == 4, 1).otherwise(0), F.when(F.col("q") == 4, 1).otherwise(F.col("q") * 3 + 1), F.lit(15))
    listed = f.select("cik", day.alias("filing_date"), F.lit("8-K").alias("filing_type"), "filing_href")
    fye = F.make_date(F.col("y"), F.lit(12), F.lit(31))
    nothing = F.col("cik").try_cast("int") % 5 == 4
    docs = F.when(nothing, F.array(F.lit("<p>nothing</p>"))).otherwise(F.col("documents"))
    return listed, f.select("filing_href", docs.alias("documents"), fye.alias("fye_date"), F.concat("y", F.lit("Q"), "q").alias("report_period"))


_ALL_ITEMS = _FILED + """, p as (select *, cik || '-' || y || '-' || q as filing_href, cast(y as varchar) || 'Q' || cast(q as varchar) as fiscal_period from f where cast(cik as int) % 5 <> 4),
  i as (select *, 'interest income' as item, cast(income as double) * 1000 as item_value from p union all select *, 'provision for loan losses', cast(provision as double) * 1000 from p
    union all select *, 'net income', cast(n as double) * -1000000 from p union all select *, 'book value per share', cast(n as double) + 0.25 from p)"""


@query(f"{_ALL_ITEMS} select cik, filing_href, item, item_value, fiscal_period, {_PERIOD_END} as fpe_date, false as is_overridden from i")
def load_statements(spark, d):
    """Loaded into a store, twice: the second load adds nothing."""
    target = store.Store(spark, _place(spark, "store"))
    listed, submissions = _landed(spark, d)
    for _ in (1, 2):
        pipeline.load(target, listed, submissions)
    return target.read("statement").select("cik", "filing_href", "item", F.col("item_value").cast("double").alias("item_value"), "fiscal_period", "fpe_date", "is_overridden")


@query(_FILED + " select cik, cik || '-' || y || '-' || q as filing_href, cast(cik as int) % 5 <> 4 as is_prelim from f")
def load_ledger(spark, d):
    """The ledger of that load: filings without an item are marked."""
    target = store.Store(spark, _place(spark, "store"))
    pipeline.load(target, *_landed(spark, d))
    return target.read("ledger").select("cik", "filing_href", "is_prelim")


@query(f"{_ALL_ITEMS} select cik, count(*) as facts from i where cik in (select distinct cik from i order by cik desc limit 3) group by 1")
def load_some_companies(spark, d):
    """Stopped after three companies that loaded anything."""
    target = store.Store(spark, _place(spark, "store"))
    listed, submissions = _landed(spark, d)
    listed = written(listed, "listed")
    pipeline.load_companies(target, listed.select("cik"), listed, written(submissions, "submissions"), 3)
    return target.read("statement").groupBy("cik").agg(F.count(F.lit(1)).alias("facts"))


@query(f"select stmt_id from prelim_statement where not coalesce(cik = {_COMPANY} and filing_date between date '2011-12-31' and date '2014-12-31' and not coalesce(is_overridden, false), false)")
def reload_store(spark, d):
    """A company's range taken out of a store for its next load."""
    target = store.Store(spark, _place(spark, "store"))
    target.append("statement", _statements(spark, d))
    pipeline.reload_between(target, _company(spark, d), dt.date(2012, 1, 1), dt.date(2014, 12, 31))
    return target.read("statement").select("stmt_id")


@query(f"select {_COMPANY} as cik, date '1999-01-01' as filing_date, '8-K' as filing_type, 'Unknown' as filing_href, unnest([{_ITEMS}]) as item, cast(null as double) as item_value")
def override_blank(spark, d):
    """A day without facts shows a blank row for each item."""
    view = pipeline.overrides_view(_statements(spark, d), _company(spark, d), dt.date(1999, 1, 1))
    return view.select("cik", "filing_date", "filing_type", "filing_href", "item", F.col("item_value").cast("double").alias("item_value"))


@query(_FILED + """ select cik || '-' || y || '-' || q as submission, 'net income' as item, cast(n as double) * -1000000 as item_value, cast(y as varchar) || 'Q' || cast(q as varchar) as fiscal_period from f""")
def table_function_items(spark, d):
    """The SQL table function, kept to one item."""
    pipeline.register(spark)
    raw = _sgml(_filed(spark, d)).select("submission", "raw").repartition(spark.sparkContext.defaultParallelism, "submission")
    view = f"landed_{uuid.uuid4().hex}"
    filings.parse_submissions(raw).select("submission", "cik", F.explode("documents").alias("html")).createOrReplaceTempView(view)
    return spark.sql(f"select l.submission, i.item, i.item_value, i.fiscal_period from {view} l, lateral statement_items(l.cik, l.html, array('net income')) i")


@query(_FILED + """, p as (select cik || '-' || y || '-' || q as submission, *, cast(y as varchar) || 'Q' || cast(q as varchar) as fiscal_period from f)
  select submission, 'interest income' as item, 0 as table_rank, cast(income as double) * 1e3 as item_value, fiscal_period, '(in thousands)' as src_units from p
  union all select submission, 'total revenue', 0, cast(n as double) * 1e3, fiscal_period, '(in thousands)' from p
  union all select submission, 'net income', 24, cast(n + 7 as double) * 1e3, fiscal_period, 'inferred: thousands' from p""")
def extract_ranked(spark, d):
    """Tables of several titles, columns of several periods, headers borrowed
    by a continued table: the best title's latest quarter is taken, and what
    only a lesser table tells comes from there."""
    f = _filed(spark, d)
    y, n = F.col("y"), lambda c: F.col(c).cast("string")
    when = F.concat(F.element_at(F.create_map(*[F.lit(x) for kv in _MONTH_END.items() for x in kv]), F.col("q").cast("int")), F.lit(", "))
    heads = F.concat(F.lit("<tr><td></td><td>Three months ended "), when, (y - 1).cast("string"), F.lit("</td><td>Nine months ended "), when, y.cast("string"), F.lit("</td><td>Three months ended "), when, y.cast("string"), F.lit("</td></tr>"))
    row = lambda label, c: F.concat(F.lit(f"<tr><td>{label}</td><td>1</td><td>2</td><td>"), c, F.lit("</td></tr>"))
    whole = lambda *rows: F.concat(F.lit("<table>"), *rows, row("Other items", F.lit("3")), F.lit("</table>"))
    html = F.concat(
        F.lit("<p>Earnings summary</p>"), whole(heads, row("Net income", (F.col("n") + 7).cast("string")), row("Total interest income", F.lit("5"))),
        F.lit("<p>Consolidated statements of income</p><p>(in thousands)</p>"), whole(heads, row("Total interest income", n("income"))),
        F.lit("<p>Consolidated statements of income, continued</p><p>(in thousands)</p>"), whole(row("Total revenues", n("n"))),
    )
    pages = f.select(F.concat("cik", F.lit("-"), n("y"), F.lit("-"), n("q")).alias("submission"), "cik", F.array(html).alias("documents"))
    found = extract.extract(pages.repartition(spark.sparkContext.defaultParallelism, "submission"))
    return extract.best_items(found).select("submission", "item", "table_rank", "item_value", "fiscal_period", "src_units")


@query("""select stmt_id, cast(loaded_at as date) as loaded, case when stmt_id % 3 <> 0 then cast(item_value as double) end as item_value,
  case when stmt_id % 2 = 0 and regexp_full_match(fiscal_period, '[0-9]{4}Q[1-4]') then """ + _TEXT(f"({_Q} - 1)") + """ when stmt_id % 2 = 1 then fiscal_period end as fiscal_period from prelim_statement""")
def stored_form(spark, d):
    """Days for timestamps, null for NaN; a quarter-to-date heading is the
    quarter before the filing's own."""
    s = _statements(spark, d)
    value = F.when(F.col("stmt_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("item_value").cast("double"))
    heading = F.when(F.col("stmt_id") % 2 == 0, F.concat(F.year("filing_date").cast("string"), F.lit("QTD"))).otherwise(F.col("fiscal_period"))
    period = periods.resolve_quarter_to_date(heading, F.col("fiscal_period"))
    return store.persistable(s.select("stmt_id", F.col("loaded_at").alias("loaded"), value.alias("item_value"), period.alias("fiscal_period")))


@query(f"""with {_BEST.replace("from prelim_statement) where", "from prelim_statement where cik = " + _COMPANY + ") where")}, {_CHECKS_OF_BEST} select item, period, msg_type, message from ({_ALL})""")
def company_messages(spark, d):
    """Messages of one company's report."""
    frames = report.quality_report(_statements(spark, d), table(spark, d, "cik"), _company(spark, d), quality.ITEMS)
    return frames["messages"].select("item", "period", "msg_type", "message")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
