import datetime as dt
import os

from pyspark.sql import functions as F

from quarterloom.operators import quality, report, store
from quarterloom.plans import pipeline
from tests.test_tables import TITLE, UNITS, table

D = dt.date


def submissions(spark):
    good = TITLE + UNITS + table(("Net income", "580", "643"), ("Book value per share", "51.15", "47.14"))
    rows = [("h1", [good], D(2019, 12, 31), "2019Q2"), ("h2", ["<p>nothing</p>"], D(2019, 12, 31), "2019Q2"), ("h3", [good, None], D(2019, 12, 31), "2019Q2"), ("h4", None, D(2019, 12, 31), "2019Q2")]
    return spark.createDataFrame(rows, "filing_href string, documents array<string>, fye_date date, report_period string")


def listed(spark):
    rows = [("0000000001", D(2019, 4, 18), t, h) for t, h in (("8-K", "h1"), ("8-K", "h2"), ("8-K/A", "h3"), ("8-k", "h3"), ("8-K", "h4"), ("8-K", "not landed"))]
    return spark.createDataFrame(rows, "cik string, filing_date date, filing_type string, filing_href string")


def test_load_reload_override_discard(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}/store")
    got = pipeline.load(s, listed(spark), submissions(spark))
    assert (got.filings, got.values, got.failed) == (4, 4, 0)
    assert {r.filing_href: r.is_prelim for r in s.read("ledger").collect()} == {"h1": True, "h2": False, "h3": True, "h4": False}
    r = s.read("statement").where("item = 'net income' and filing_href = 'h1'").first()
    assert (float(r.item_value), r.fiscal_period, str(r.fpe_date), r.is_overridden) == (5.8e8, "2019Q1", "2019-03-31", False)
    assert s.read("statement").schema == store.STATEMENT
    again = pipeline.load(s, listed(spark), submissions(spark))
    assert (again.filings, again.values) == (0, 0)

    view = pipeline.overrides_view(s.read("statement"), "0000000001", item="net income")
    assert view.count() == 1
    edited = pipeline.overrides_view(s.read("statement"), "0000000001").withColumn("item_value", F.when(F.col("item") == "net income", 7).otherwise(F.col("item_value")).cast("decimal(20,5)"))
    assert pipeline.apply_overrides(s, "0000000001", edited).count() == 1
    assert s.read("statement").where("is_overridden and item_value = 7").count() == 1

    pipeline.reload_between(s, "0000000001", D(2019, 4, 19), delete_filings=True)
    assert s.read("statement").count() == 1 and s.read("ledger").count() == 0
    more = pipeline.load(s, listed(spark), submissions(spark))
    assert more.filings == 3  # the filing with an override is still loaded
    pipeline.discard(s, "0000000001", D(2019, 4, 18))
    assert s.read("statement").count() == 0 and s.read("ledger").where("is_prelim").count() == 0


def test_table_function(spark):
    pipeline.register(spark)
    submissions(spark).createOrReplaceTempView("landed")
    got = spark.sql("select l.filing_href, i.item, i.item_value from landed l, lateral statement_items('', l.documents[0]) i where l.filing_href = 'h1'").collect()
    assert sorted((r.item, r.item_value) for r in got) == [("book value per share", 51.15), ("net income", 5.8e8)]
    assert pipeline.companies_to_load(listed(spark), 1).count() == 1


def test_report(spark, tiny, tmp_path):
    facts = spark.read.parquet(f"{tiny}/prelim_statement.parquet")
    cik = facts.groupBy("cik").count().orderBy(F.desc("count")).first().cik
    frames = report.quality_report(facts, spark.read.parquet(f"{tiny}/cik.parquet"), cik, quality.ITEMS)
    path = str(tmp_path / "r.html")
    assert report.write_report(frames, path) and not report.write_report(frames, path) and os.path.getsize(path) > 1000
