"""Report frames: descriptive statistics, filled pivots, linked listings."""

from __future__ import annotations

import csv
import html
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quarterloom.session import written


#: Groups of fewer values are ranked whole; of larger ones only the values in
#: the narrow band around a quantile, one in some thousands of them.
SMALL = 50_000
#: Accuracy of the quantiles that bound the band, and half its width: in the
#: least group that has one, ten ranks, five of them beyond the error.
ACCURACY, BAND = 10_000, 2e-4


def quantiles(df: DataFrame, by: str, value: str, at: Sequence[float]) -> DataFrame:
    """``(by, p0, p1, ...)``: exact interpolated quantiles of a double column.

    No task holds the values of a group: approximate quantiles, whose error
    is bounded, give a band that surely holds the one asked for; values below
    the band are counted, those within it, about one in 2,000, are ranked.
    """
    bounds = [b for p in at for b in (max(0.0, p - BAND), min(1.0, p + BAND))]
    told = df.groupBy(by).agg(F.count(value).alias("n"), F.min(value).alias("least"), F.max(value).alias("most"), F.percentile_approx(value, bounds, ACCURACY).alias("near")).where("n > 0")
    small = F.col("n") < SMALL
    band = lambda k: F.struct(
        F.lit(k).alias("k"),
        F.when(small, F.col("least")).otherwise(F.col("near")[2 * k]).alias("lo"),
        F.when(small, F.col("most")).otherwise(F.col("near")[2 * k + 1]).alias("hi"),
        (F.lit(at[k]) * (F.col("n") - 1)).alias("rank"),
    )
    bands = told.select(F.col(by).alias("g"), F.array(*map(band, range(len(at)))).alias("bands"))
    rows = df.where(F.col(value).isNotNull()).select(F.col(by).alias("own"), F.col(value).alias("x")).join(bands, F.col("own").eqNullSafe(F.col("g"))).select("g", "x", F.inline("bands")).where("x <= hi")
    counted = rows.groupBy("g", "k", "rank", F.when(F.col("x") >= F.col("lo"), F.col("x")).alias("x")).agg(F.count(F.lit(1)).alias("m"))
    w = Window.partitionBy("g", "k").orderBy(F.col("x").asc_nulls_first())
    placed = counted.withColumn("upto", F.sum("m").over(w)).where("x is not null")
    first, second = F.floor("rank"), F.ceil("rank")
    holds = lambda r: F.when((F.col("upto") > r) & (F.col("upto") - F.col("m") <= r), F.col("x"))
    found = placed.groupBy("g", "k", "rank").agg(F.max(holds(first)).alias("a"), F.max(holds(second)).alias("b"))
    exact = F.when(first == second, F.col("a")).otherwise((second - F.col("rank")) * F.col("a") + (F.col("rank") - first) * F.col("b"))
    return found.groupBy(F.col("g").alias(by)).agg(*[F.max(F.when(F.col("k") == k, exact)).alias(f"p{k}") for k in range(len(at))])


def describe(df: DataFrame, by: str = "item", value: str = "item_value") -> DataFrame:
    """Count, mean, sample deviation, least, quartiles and largest."""
    v = written(df.select(F.col(by), F.col(value).cast("double").alias("v")), "described")
    agg = v.groupBy(by).agg(F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    quart = quantiles(v, by, "v", (0.25, 0.5, 0.75)).withColumnRenamed(by, "g")
    out = agg.join(quart, F.col(by).eqNullSafe(F.col("g")), "left")
    return out.select(by, "count", "mean", "std", "min", F.col("p0").alias("p25"), F.col("p1").alias("p50"), F.col("p2").alias("p75"), "max")


def pivot_filled(df: DataFrame, items: Sequence[str], keys: Sequence[str] = ("cik",), at: str = "filing_date") -> DataFrame:
    """One row per key and date with a column per item, gaps filled with the
    value before.  ``df`` holds one value per key, date and item."""
    v = F.col("item_value").cast("double")
    wide = df.groupBy(*keys, at).agg(*[F.max(F.when(F.col("item") == i, v)).alias(i.replace(" ", "_")) for i in items])
    w = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return wide.select(*keys, at, *[F.last(i.replace(" ", "_"), ignorenulls=True).over(w).alias(i.replace(" ", "_")) for i in items])


def linked(df: DataFrame, *keys: str) -> DataFrame:
    """Provenance listing: period linked to its filing, dates as text."""
    link = F.concat(F.lit('<a href="'), F.col("filing_href"), F.lit('">'), F.col("fiscal_period"), F.lit("</a>"))
    return df.select(*keys, "stmt_id", link.alias("link"), F.date_format("filing_date", "yyyy-MM-dd").alias("filed"), F.concat_ws("#", "fiscal_period", "filing_href").alias("source"))


def quality_report(facts: DataFrame, companies: DataFrame, cik: str, items: Sequence[str]) -> dict[str, DataFrame]:
    """The frames of one company's report: its card, best values, statistics,
    filled series, messages and sources."""
    from quarterloom.operators import quality

    best = quality.query_prelims(facts, F.col("cik") == cik)
    return {
        "company": companies.where(F.col("cik") == cik),
        "values": best.orderBy("filing_date", "item"),
        "statistics": describe(best),
        "series": pivot_filled(best, items).orderBy("filing_date"),
        "messages": quality.validate(best, items).orderBy("item", "period"),
        "sources": linked(best),
    }


def report_lines(facts: DataFrame, companies: DataFrame, items: Sequence[str]) -> DataFrame:
    """``(cik, section, nth, line)``: the lines of the reports of all companies
    with statements - their card, best values, messages and sources - each an
    HTML table row, numbered from 1 within the section."""
    from quarterloom.operators import quality

    best = written(quality.query_prelims(facts.where("cik is not null"), keep=quality.CHECKED), "best")
    row = lambda *cells: F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), F.coalesce(_escaped(c), F.lit("")), F.lit("</td>")) for c in cells], F.lit("</tr>"))
    section = lambda df, name, order, *cells: df.select("cik", F.lit(name).alias("section"), order.alias("o"), row(*cells).alias("line"))
    card = companies.join(best.select("cik").distinct(), "cik", "left_semi")
    day = F.date_format("filing_date", "yyyy-MM-dd")
    listing = linked(best.select("cik", "stmt_id", "filing_href", "fiscal_period", "filing_date"), "cik")
    out = section(card, "company", F.coalesce("company_name", F.lit("")), "company_name", "ticker", "sic", "sic_description")
    out = out.unionByName(section(best, "values", F.concat_ws(" ", day, "item", F.col("stmt_id").cast("string")), day, "item", "fiscal_period", F.col("item_value").cast("string")))
    messages = quality.validate(best, items)
    out = out.unionByName(section(messages, "messages", F.concat_ws(" ", "item", "period", "msg_type"), "item", "period", "msg_type", "message"))
    link = F.concat(F.lit("<tr><td>"), F.coalesce("link", F.lit("")), F.lit("</td><td>"), F.coalesce("filed", F.lit("")), F.lit("</td></tr>"))
    out = out.unionByName(listing.select("cik", F.lit("sources").alias("section"), F.concat_ws(" ", "filed", F.col("stmt_id").cast("string")).alias("o"), link.alias("line")))
    w = Window.partitionBy("cik", "section").orderBy("o", "line")
    return out.select("cik", "section", F.row_number().over(w).alias("nth"), "line")


def _escaped(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


#: Lines of a report in one file.
PAGE = 10_000


def write_reports(facts: DataFrame, companies: DataFrame, folder: str, items: Sequence[str], again: bool = False) -> int:
    """Reports of all companies with statements, written by the executors:
    a folder per company, ``cik=...``, with pages of bounded length in order.
    A company whose folder exists is left as it is unless ``again``; returns
    the number of companies written."""
    spark = facts.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path) and not again:
        done = spark.createDataFrame([(s.getPath().getName().removeprefix("cik="),) for s in fs.listStatus(path) if s.isDirectory()], "cik string")
        facts = facts.join(done, facts["cik"].cast("string") == done["cik"], "left_anti")
    lines = report_lines(facts, companies, items).withColumn("page", F.floor((F.col("nth") - 1) / PAGE))
    head = F.when(F.col("nth") == 1, F.concat(F.lit("<h2>"), F.col("section"), F.lit("</h2>"))).otherwise(F.lit(""))
    order = F.expr("array_position(array('company', 'values', 'messages', 'sources'), section)")
    text = lines.select("cik", order.alias("s"), "page", "nth", F.concat(head, "line").alias("value"))
    text = text.repartitionByRange("cik", "s", "page").sortWithinPartitions("cik", "s", "nth")
    text.select("cik", "value").write.partitionBy("cik").mode("overwrite" if again else "append").text(folder)
    return sum(1 for s in fs.listStatus(path) if s.isDirectory()) if fs.exists(path) else 0


def write_csv(df: DataFrame, path: str) -> None:
    """A frame as CSV with a header; null and empty text stay apart."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', nullValue="", emptyValue='""')


def write_report(frames: dict[str, DataFrame], path: str, rows: int = 10_000, again: bool = False) -> bool:
    """One company's report as an HTML file; an existing one is kept unless
    ``again``.  A page shows at most ``rows`` lines per frame; a longer frame
    is written whole beside it, ``path`` with the frame's name and ``.csv``,
    and the page says how many lines it leaves out."""
    import os

    if os.path.exists(path) and not again:
        return False
    parts = []
    for name, df in frames.items():
        shown, note, beside = df.limit(rows + 1).toPandas(), "", f"{path}.{name}.csv"
        if len(shown) > rows:
            n = _write_whole(df, beside)
            note = f"<p>{rows:,} of {n:,} rows, {n - rows:,} left out; all are in {html.escape(os.path.basename(beside))}</p>"
        elif os.path.exists(beside):
            os.remove(beside)  # of a longer frame before
        parts.append(f"<h2>{name}</h2>{note}{shown[:rows].to_html(index=False, escape=name != 'sources')}")
    with open(path, "w", encoding="utf-8") as f:
        f.write(f"<html><meta charset='utf-8'>{''.join(parts)}</html>")
    return True


def _write_whole(df: DataFrame, path: str) -> int:
    """Writes every row, a partition at a time, and counts them."""
    n = 0
    with open(path, "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f)
        out.writerow(df.columns)
        for n, row in enumerate(df.toLocalIterator(), 1):
            out.writerow(row)
    return n
