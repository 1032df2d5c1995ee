"""Quality of quarterly series: best value per item, missing, duplicate and
outlier periods, their compression and the summary.

A series is a company and an item.  Windows run over the quarters of one
company only, whose number the calendar bounds; the best-value choice is a
partial aggregate, so companies of any size do no harm.  Rows without a
company form a company of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quarterloom.functions import periods

ITEMS = ("net income", "net interest income", "interest income", "provision for loan losses", "total revenue", "book value per share")

#: Columns that the checks and the summary read.
CHECKED = ("stmt_id", "cik", "filing_date", "filing_href", "item", "fiscal_period", "item_value")


def choose_by_rank(df: DataFrame, keys: Sequence[str] = ("cik", "filing_date", "item"), tiebreak: Sequence[str] = ("filing_href", "stmt_id"), keep: Sequence[str] | None = None) -> DataFrame:
    """The row of the least (table rank, item rank) per key; nulls last, then
    link and id decide.  With ``keep`` only these columns are carried."""
    last = F.lit(1_000_000)
    order = F.struct(
        F.coalesce(F.col("table_rank").cast("int"), last).alias("t"),
        F.coalesce(F.col("item_rank").cast("int"), last).alias("i"),
        *[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")).alias(f"k{j}") for j, c in enumerate(tiebreak)],
    )
    wanted = list(df.columns if keep is None else keep)
    rest = [c for c in wanted if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("b"))
    return best.select(*keys, *[F.col("b")[c].alias(c) for c in rest]).select(*wanted)


def query_prelims(df: DataFrame, *clauses: Column, keep: Sequence[str] | None = None) -> DataFrame:
    """Best values that are there, under any further conditions."""
    for c in clauses:
        df = df.where(c)
    v = F.col("item_value").cast("double")
    return choose_by_rank(df.where(v.isNotNull() & ~F.isnan(v)), keep=keep)


def _series(df: DataFrame) -> DataFrame:
    return df.withColumn("q", periods.index_of(F.col("fiscal_period"))).where("q is not null")


def company_ranges(df: DataFrame) -> DataFrame:
    """First quarter less one and last quarter plus one of each company."""
    return _series(df).groupBy("cik").agg((F.min("q") - 1).alias("first"), (F.max("q") + 1).alias("last"))


def _gaps(first: Column, last: Column, before: Column, after: Column) -> Column:
    """Runs of quarters without a value beside a quarter ``q``: before it if it
    is the first of its series, and behind it."""
    q = F.col("q")
    head = F.when(q.isNotNull() & before.isNull() & (q > first), F.struct(first.alias("a"), (q - 1).alias("b")))
    tail = F.when(F.coalesce(after, last + 1) - q > 1, F.struct((q + 1).alias("a"), (F.coalesce(after, last + 1) - 1).alias("b")))
    return F.filter(F.array(head, tail), lambda g: g.isNotNull())


def missing_periods(df: DataFrame) -> DataFrame:
    """``(cik, item, q)``: quarters of the company's range, from its first to
    its last of any item, without a value of the item."""
    seen = _series(df).select("cik", "item", "q").distinct()
    company, series = Window.partitionBy("cik"), Window.partitionBy("cik", "item").orderBy("q")
    gaps = _gaps(F.min("q").over(company), F.max("q").over(company), F.lag("q").over(series), F.lead("q").over(series))
    runs = seen.withColumn("gaps", gaps).select("cik", "item", F.inline("gaps"))
    return runs.select("cik", "item", F.explode(F.sequence("a", "b")).alias("q"))


def _flagged(s: DataFrame, threshold: float) -> DataFrame:
    """Adds ``far``: the value differs from the one filed before for the same
    quarter by the threshold or more of it."""
    w = Window.partitionBy("cik", "item", "q").orderBy("filing_date", "filing_href", "stmt_id")
    v = F.col("item_value").cast("double")
    s = s.withColumn("v", v).withColumn("p", F.lag("v").over(w))
    far = F.abs(1 - F.try_divide(F.col("v"), F.col("p"))) >= threshold
    zero = (F.col("p") == 0) & (F.col("v") != 0)
    return s.withColumn("far", F.col("q").isNotNull() & F.col("p").isNotNull() & (F.coalesce(far, F.lit(False)) | zero))


def duplicate_periods(df: DataFrame, threshold: float = 0.25) -> DataFrame:
    """``(cik, item, q)``: quarters in which a value differs from the one
    filed before by the threshold or more of it."""
    return _flagged(_series(df), threshold).where("far").select("cik", "item", "q").distinct()


def outlier_periods(df: DataFrame, threshold: float = 1e12) -> DataFrame:
    return _series(df).where(F.abs(F.col("item_value").cast("double")) > threshold).select("cik", "item", "q").distinct()


def _period(a: Column, b: Column) -> Column:
    """Text of the quarters from ``a`` to ``b``."""
    many = F.concat(periods.text_of(a), F.lit(" to "), periods.text_of(b), F.lit(": "), (b - a + 1).cast("string"), F.lit(" periods"))
    return F.when(a == b, periods.text_of(a)).otherwise(many)


def compress(df: DataFrame, keys: Sequence[str] = ("cik", "item")) -> DataFrame:
    """Runs of consecutive quarters as one text each: ``2018Q1`` or
    ``2018Q3 to 2019Q1: 3 periods``.  Repeats do not break a run."""
    d = df.select(*keys, "q").distinct()
    w = Window.partitionBy(*keys).orderBy("q")
    runs = d.withColumn("island", F.col("q") - F.row_number().over(w)).groupBy(*keys, "island").agg(F.min("q").alias("a"), F.max("q").alias("b"))
    return runs.select(*keys, _period(F.col("a"), F.col("b")).alias("period"))


def empty_items(df: DataFrame, items: Sequence[str] = ITEMS) -> DataFrame:
    """``(cik, item)`` of the configured items a company has no value for."""
    seen = df.groupBy("cik").agg(F.collect_set(F.when(F.col("item").isin(*items), F.col("item"))).alias("seen"))
    return seen.select("cik", F.explode(F.array_except(F.array(*map(F.lit, items)), "seen")).alias("item"))


def _quarters(df: DataFrame, duplicate: float, outlier: float) -> DataFrame:
    """One row per company, item and quarter with all that the checks ask: one
    pass over the values, one shuffle by series and one by company."""
    s = df.select(*CHECKED).withColumn("q", periods.index_of(F.col("fiscal_period")))
    s = _flagged(s, duplicate)
    out = F.col("q").isNotNull() & (F.abs(F.col("v")) > outlier)
    told = F.col("fiscal_period")
    per = s.groupBy("cik", "item", "q").agg(F.max("far").alias("far"), F.coalesce(F.max(out), F.lit(False)).alias("out"), F.count(told).alias("n"), F.min(told).alias("lo"), F.max(told).alias("hi"))
    company, series = Window.partitionBy("cik"), Window.partitionBy("cik", "item").orderBy("q")
    before = F.lag(F.struct("q", "far", "out")).over(series)
    return per.withColumns(
        {
            "first": F.min("q").over(company),
            "last": F.max("q").over(company),
            "before": before,
            "after": F.lead("q").over(series),
            # a run of flagged quarters shares the difference of quarter and rank
            "far_rank": F.sum(F.col("far").cast("int")).over(series),
            "out_rank": F.sum(F.col("out").cast("int")).over(series),
        }
    )


# What a message of a kind says.
MESSAGES = {"empty": "No values for item", "missing": "Missing period", "duplicate": "Duplicate period", "outlier": "Potential outlier"}


def validate(df: DataFrame, items: Sequence[str] = ITEMS, duplicate: float = 0.25, outlier: float = 1e12) -> DataFrame:
    """``(cik, item, period, msg_type, message)`` of all checks.

    The range of quarters is the company's, over all of its rows; all
    messages come from one pass over the quarters.
    """
    q = _quarters(df, duplicate, outlier)
    company = Window.partitionBy("cik")
    q = q.withColumns({"seen": F.collect_set(F.when(F.col("item").isin(*items), F.col("item"))).over(company), "nth": F.row_number().over(company.orderBy("item", "q"))})
    entry = lambda item, kind, island, a, b: F.struct(item.alias("item"), F.lit(kind).alias("kind"), island.cast("int").alias("island"), a.cast("int").alias("a"), b.cast("int").alias("b"))
    null = F.lit(None)
    gaps = F.transform(_gaps(F.col("first"), F.col("last"), F.col("before.q"), F.col("after")), lambda g: entry(F.col("item"), "missing", g["a"], g["a"], g["b"]))
    flags = F.array(
        F.when(F.col("far"), entry(F.col("item"), "duplicate", F.col("q") - F.col("far_rank"), F.col("q"), F.col("q"))),
        F.when(F.col("out"), entry(F.col("item"), "outlier", F.col("q") - F.col("out_rank"), F.col("q"), F.col("q"))),
    )
    none = F.array()
    own = F.when(F.col("item").isin(*items), F.concat(gaps, F.filter(flags, lambda x: x.isNotNull()))).otherwise(none)
    empty = F.transform(F.array_except(F.array(*map(F.lit, items)), "seen"), lambda i: entry(i, "empty", null, null, null))
    said = q.select("cik", F.inline(F.concat(own, F.when(F.col("nth") == 1, empty).otherwise(none))))
    runs = said.groupBy("cik", "item", "kind", "island").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    text = F.create_map(*[F.lit(x) for kv in MESSAGES.items() for x in kv])
    return runs.select("cik", "item", _period(F.col("a"), F.col("b")).alias("period"), F.col("kind").alias("msg_type"), text[F.col("kind")].alias("message"))


def summarize(df: DataFrame, companies: DataFrame, items: Sequence[str] = ITEMS, duplicate: float = 0.25, outlier: float = 1e12) -> DataFrame:
    """Per company and item: values, first and last period, and the number of
    messages of each kind, ordered by company and item.  An item without
    values counts as many missing as the company's fullest item has values;
    companies without values are left out, unknown companies keep null names.
    ``companies.cik`` is compared as it stands with ``df.cik``."""
    q = _quarters(df, duplicate, outlier)
    gaps = F.size(_gaps(F.col("first"), F.col("last"), F.col("before.q"), F.col("after")))
    starts = lambda c: (F.col(c) & ~F.coalesce(F.col(f"before.{c}") & (F.col("before.q") == F.col("q") - 1), F.lit(False))).cast("bigint")
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    per = q.groupBy("cik", "item").agg(
        F.sum("n").alias("count"), F.min("lo").alias("start"), F.max("hi").alias("end"),
        F.sum(gaps).alias("missing"), F.sum(starts("far")).alias("duplicate"), F.sum(starts("out")).alias("outlier"),
    )
    row = F.struct("item", "count", "start", "end", "missing", "duplicate", "outlier")
    by = per.groupBy("cik").agg(F.collect_list(F.when(F.col("item").isin(*items), row)).alias("rows"))
    by = by.withColumn("full", F.coalesce(F.array_max(F.transform("rows", lambda r: r["count"])), F.lit(0)))
    grid = by.withColumn("item", F.explode(F.array(*map(F.lit, items)))).withColumn("r", F.get(F.expr("filter(rows, r -> r.item = item)"), F.lit(0)))
    # several rows of a company: the least name and ticker
    names = companies.groupBy("cik").agg(F.min("company_name").alias("company_name"), F.min("ticker").alias("ticker"))
    out = grid.join(names, "cik", "left").select(
        "cik", "company_name", "ticker", "item", whole(F.col("r.count")).alias("count"),
        F.when(F.col("r").isNull(), F.col("full")).otherwise(F.col("r.missing")).cast("bigint").alias("missing"),
        whole(F.col("r.duplicate")).alias("duplicate"), whole(F.col("r.outlier")).alias("outlier"),
        F.coalesce("r.start", F.lit("-")).alias("start"), F.coalesce("r.end", F.lit("-")).alias("end"),
    )
    return out.orderBy("cik", "company_name", "ticker", "item")
