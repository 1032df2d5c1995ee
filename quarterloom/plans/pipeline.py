"""Bulk and incremental load: listings and submissions to stored facts.

One batch is one plan: listed filings are pruned against the ledger and the
facts by anti joins, what is left is parsed and extracted, and facts and
ledger are appended once.  A replayed batch adds nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import udtf

from quarterloom.functions import periods
from quarterloom.operators import extract, quality, store
from quarterloom.operators.store import CORE, LEDGER, STATEMENT, Store
from quarterloom.session import intermediates, written


@dataclass(frozen=True)
class Loaded:
    filings: int
    values: int
    failed: int


def pending(listed: DataFrame, ledger: DataFrame, facts: DataFrame) -> DataFrame:
    """Current reports that are neither known to hold nothing nor loaded."""
    return store.unloaded(store.unvisited(extract.only_current_reports(listed), ledger), facts)


def facts_of(filings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows and failures of ``filings``: the core key, ``documents``,
    ``fye_date`` and ``report_period``."""
    found = written(extract.extract(filings, key=(*CORE, "fye_date", "report_period")), "extracted")
    best = extract.best_items(found, key=(*CORE, "fye_date", "report_period"))
    rows = extract.filing_rows(best, F.col("report_period"), F.col("fye_date"))
    cast = [F.col(f.name).cast(f.dataType).alias(f.name) for f in STATEMENT.fields]
    return store.persistable(rows).select(*cast), found.where("error is not null").select(*CORE, "error").distinct()


def load(target: Store, listed: DataFrame, submissions: DataFrame) -> Loaded:
    """Loads the pending filings of ``listed``.  ``submissions`` holds
    ``filing_href``, ``documents``, ``fye_date`` and ``report_period``.  A
    filing that fails or holds no item is noted as no statement."""
    with intermediates():
        return _load(target, listed, submissions)


def _load(target: Store, listed: DataFrame, submissions: DataFrame) -> Loaded:
    target.create("ledger", LEDGER)
    target.create("statement", STATEMENT)
    todo = pending(listed.select(*CORE).distinct(), target.read("ledger"), target.read("statement"))
    with_text = written(todo.join(submissions.select("filing_href", "documents", "fye_date", "report_period"), "filing_href"), "pending")
    rows, failed = facts_of(with_text)
    rows = written(rows, "facts")
    hits = rows.select(*CORE).distinct().withColumn("hit", F.lit(True))
    visited = with_text.select(*CORE).distinct().join(hits, list(CORE), "left").select(*CORE, F.coalesce("hit", F.lit(False)).alias("is_prelim"))
    visited = written(visited, "visited")
    target.append("statement", rows)
    target.append("ledger", visited)
    return Loaded(visited.count(), rows.count(), failed.count())


def reload_between(target: Store, cik: str, start: dt.date, end: dt.date | None = None, delete_filings: bool = False) -> None:
    """Takes a company's filings of a range out, so that the next load takes
    them in again; overridden values stay.  The range begins a day early."""
    start = start - dt.timedelta(days=1)
    target.replace("statement", store.delete_for_reload(target.read("statement"), cik, start, end))
    if delete_filings:
        gone = (F.col("cik") == cik) & F.col("filing_date").between(start, end or store.END)
        target.replace("ledger", target.read("ledger").where(~F.coalesce(gone, F.lit(False))))


def discard(target: Store, cik: str, day: dt.date) -> None:
    facts, ledger = store.discard(target.read("statement"), target.read("ledger"), cik, day)
    target.replace("statement", facts)
    target.replace("ledger", ledger)


def overrides_view(facts: DataFrame, cik: str, day: dt.date | None = None, item: str | None = None, items: Sequence[str] = quality.ITEMS) -> DataFrame:
    """Best values of a company to be edited, with the columns that may
    change.  Where there are none for the day asked for, blank rows: one for
    the item, or for each of ``items``."""
    rows = facts.where(F.col("cik") == cik)
    rows = rows if day is None else rows.where(F.col("filing_date") == F.lit(day))
    rows = rows if item is None else rows.where(F.col("item") == item)
    best = quality.choose_by_rank(rows, tiebreak=("filing_href",)).select(*STATEMENT.fieldNames())
    if day is None or not best.isEmpty():
        return best
    given = {"cik": F.lit(cik), "filing_date": F.lit(day), "filing_type": F.lit("8-K"), "filing_href": F.lit("Unknown"), "item": F.col("item")}
    wanted = [item] if item is not None else list(items)
    blank = facts.sparkSession.createDataFrame([(i,) for i in wanted], "item string")
    return blank.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STATEMENT.fields])


def apply_overrides(target: Store, cik: str, edited: DataFrame) -> DataFrame:
    """Stores the changed rows of an edited view, and its blank rows that
    were filled in, marked as overridden."""
    facts = target.read("statement")
    original = quality.choose_by_rank(facts.where(F.col("cik") == cik), tiebreak=("filing_href",))
    added = edited.alias("b").join(original.alias("a"), store._alike("a", "b", ("filing_date", "item")), "left_anti")
    added = added.where(F.coalesce(*[F.col(c).cast("string") for c in store.OVERRIDES]).isNotNull())
    rows = store.changed(original, edited)
    rows = rows.unionByName(added, allowMissingColumns=True) if "filing_href" in edited.columns else rows
    rows = written(rows.drop("is_overridden"), "overrides")
    new = store.override(facts, rows)
    target.replace("statement", new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STATEMENT.fields]))
    return rows


def companies_to_load(companies: DataFrame, number: int | None = None) -> DataFrame:
    """Companies in descending order, at most ``number`` of them."""
    out = companies.select("cik").distinct().orderBy(F.col("cik").desc())
    return out if number is None else out.limit(number)


def load_companies(target: Store, companies: DataFrame, listed: DataFrame, submissions: DataFrame, number: int | None = None) -> int:
    """Loads companies in descending order until ``number`` of them have
    loaded any value, all of them without a number; returns how many have.
    They are taken in batches of as many as are still wanted, so none is
    loaded beyond that."""
    held = lambda: target.read("statement").groupBy("cik").agg(F.count(F.lit(1)).alias("n"))
    target.create("statement", STATEMENT)
    rest, done = companies.where("cik is not null").select("cik").distinct(), 0
    while number is None or done < number:
        batch = written(companies_to_load(rest, None if number is None else number - done), "batch")
        last = batch.agg(F.min("cik")).first()[0]
        if last is None:
            break
        before = written(held(), "held")
        load(target, listed.join(batch, "cik", "left_semi"), submissions)
        grown = held().alias("a").join(before.alias("b"), "cik", "left").where(F.col("a.n") > F.coalesce("b.n", F.lit(0)))
        done += grown.count()
        rest = rest.where(F.col("cik") < last)
    return done


def report_periods(filings: DataFrame) -> DataFrame:
    """Adds ``report_period`` of a filing's own period and fiscal year end."""
    return filings.withColumn("report_period", periods.from_fpe_date(F.col("fye_date"), F.col("fpe_date")))


ITEM_ROW = "item string, item_rank int, item_value double, fiscal_period string, table_rank int, src_row string, src_column string, src_value string, src_units string"


def table_function(rules: extract.Rules = extract.RULES) -> type:
    """SQL table function: items of one HTML text by ``rules``; a third
    argument, an array of item names, keeps it to these.

    ``select f.cik, i.* from filings f, lateral statement_items(f.cik, f.html) i``
    """

    class StatementItems:
        def eval(self, cik: str, html: str, items: list[str] | None = None):
            own = rules if items is None else replace(rules, items=tuple(i for i in rules.items if i.name in items))
            if html:
                for t in extract.tables_of([html], cik or "", own):
                    for x in extract.items_of(t, own):
                        yield (*x[:5], *x[6:])

    return udtf(StatementItems, returnType=ITEM_ROW)


def register(spark: SparkSession, rules: extract.Rules = extract.RULES) -> None:
    """Makes ``statement_items`` and ``filing_pages`` known to a session."""
    from quarterloom.session import ship
    from quarterloom.sources.filings import ListingSource

    ship(spark)
    spark.udtf.register("statement_items", table_function(rules))
    spark.dataSource.register(ListingSource)
