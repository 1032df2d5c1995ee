import datetime as dt

from pyspark.sql import functions as F

from quarterloom.functions import periods
from quarterloom.operators import quality, report, store
from quarterloom.streaming.incremental import follow
from tests.statements import frame

D = dt.date


def texts(df):
    return sorted(r[0] for r in df.select(periods.text_of(F.col("q"))).collect())


def rows(ps, vs=None):
    return [{"fiscal_period": p, "item_value": v, "filing_date": D(2018, 1, 1 + i)} for i, (p, v) in enumerate(zip(ps, vs or [1] * len(ps)))]


def test_missing(spark):
    df = frame(spark, rows(["2018Q1", "2018Q2", "2018Q4", "2018Q4", "2019Q3"]))
    assert texts(quality.missing_periods(df)) == ["2018Q3", "2019Q1", "2019Q2"]
    two = frame(spark, [*rows(["2018Q1", "2018Q4"]), {"fiscal_period": "2018Q3", "item": "total revenue"}])
    assert texts(quality.missing_periods(two).where("item = 'total revenue'")) == ["2018Q1", "2018Q2", "2018Q4"]


def test_duplicates(spark):
    df = frame(spark, rows(["2018Q2", "2018Q2", "2018Q4", "2018Q4", "2019Q3"], [1, 1.1, 2, 2.5, 3]))
    assert texts(quality.duplicate_periods(df)) == ["2018Q4"]
    zero = frame(spark, rows(["2018Q1", "2018Q1", "2018Q2", "2018Q2"], [0, 5, 0, 0]))
    assert texts(quality.duplicate_periods(zero)) == ["2018Q1"]


def test_compression(spark):
    ps = ["2009Q1", "2009Q3", "2009Q4", "2010Q2", "2010Q3", "2010Q4", "2010Q4", "2011Q2"]
    df = frame(spark, rows(ps)).withColumn("q", periods.index_of(F.col("fiscal_period")))
    assert sorted(r.period for r in quality.compress(df).collect()) == ["2009Q1", "2009Q3 to 2009Q4: 2 periods", "2010Q2 to 2010Q4: 3 periods", "2011Q2"]


def test_best_value_puts_null_ranks_last(spark):
    df = frame(spark, [{"table_rank": None, "item_rank": 0}, {"table_rank": 5, "item_rank": 2}, {"table_rank": 5, "item_rank": 1, "filing_href": "b"}, {"table_rank": 5, "item_rank": 1, "filing_href": "a"}])
    assert [r.stmt_id for r in quality.choose_by_rank(df).collect()] == [4]
    assert quality.query_prelims(df).count() == 0


def test_summary(spark):
    df = frame(spark, [*rows(["2018Q1", "2018Q4"], [1, 5_000_000_000_000]), {"item": "total revenue", "fiscal_period": "2018Q2", "item_value": 1}])
    c = spark.createDataFrame([("0009000001", "A", "AA"), ("0009000001", "B", None)], "cik string, company_name string, ticker string")
    by = {r["item"]: r for r in quality.summarize(df, c).collect()}
    assert len(by) == 6 and by["net income"].company_name == "A"
    n = by["net income"]
    assert (n["count"], n.missing, n.duplicate, n.outlier, n.start, n.end) == (2, 1, 0, 1, "2018Q1", "2018Q4")
    e = by["interest income"]
    assert (e["count"], e.missing, e.start) == (0, 2, "-")
    assert quality.summarize(df.limit(0), c).count() == 0


def test_reports(spark):
    df = frame(spark, [{"item_value": v, "filing_date": D(2018, 1, d)} for d, v in ((1, 1), (2, 2), (3, 4), (4, 9))] + [{"item": "total revenue", "item_value": 7, "filing_date": D(2018, 1, 2)}])
    d = report.describe(df).where("item = 'net income'").first()
    assert (d["count"], d.p25, d.p50, d.p75, d.max) == (4, 1.75, 3.0, 5.25, 9.0)
    f = report.pivot_filled(df, ["net income", "total revenue"]).orderBy("filing_date").collect()
    assert [r.total_revenue for r in f] == [None, 7.0, 7.0, 7.0]


def ledger(spark, rows):
    return spark.createDataFrame(rows, store.LEDGER)


def test_changes(spark):
    led = ledger(spark, [("1", D(2018, 1, 1), "8-K", "a", True), ("1", D(2018, 1, 2), "8-K", "b", False), ("1", D(2018, 1, 3), "8-K", "c", None), (None, D(2018, 1, 3), "8-K", "d", False)])
    assert sorted(r.filing_href for r in store.unvisited(led, led).collect()) == ["a", "c"]
    more = store.insert_if_absent(led, ledger(spark, [("1", D(2018, 1, 1), "8-K", "a", False), ("2", D(2018, 1, 1), "8-K", "z", True), ("2", D(2018, 1, 1), "8-K", "z", True)]))
    assert more.count() == 5
    df = frame(spark, [{"cik": "1", "filing_date": D(2018, 1, 1), "is_overridden": True}, {"cik": "1", "filing_date": D(2018, 1, 2)}, {"cik": "2", "filing_date": D(2018, 1, 2)}, {"cik": None}, {"cik": "1", "filing_date": D(2017, 1, 1), "item_value": 3}])
    assert sorted(r.stmt_id for r in store.delete_for_reload(df, "1", D(2018, 1, 1)).collect()) == [1, 3, 4, 5]
    new = df.where("stmt_id = 5").withColumn("item_value", F.lit(9).cast("decimal(20,5)"))
    got = {r.stmt_id: (float(r.item_value or 0), r.is_overridden) for r in store.override(df, new).collect()}
    assert got[5] == (9.0, True) and len(got) == 5
    assert [r.stmt_id for r in store.changed(df.where("cik = '1'"), df.where("cik = '1'").withColumn("fiscal_period", F.when(F.col("stmt_id") == 2, "2000Q1").otherwise(F.col("fiscal_period")))).collect()] == [2]
    facts, marked = store.discard(df, led, "1", D(2018, 1, 1))
    assert facts.count() == 4 and marked.where("filing_href = 'a'").first().is_prelim is False
    assert {r.cik: r.since for r in store.high_water_mark(df).collect()}["1"] == D(2018, 1, 2)
    odd = spark.createDataFrame([(float("nan"), dt.datetime(2018, 1, 1, 5))], "x double, t timestamp")
    assert store.persistable(odd).first() == (None, D(2018, 1, 1))


def test_store_and_stream(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}/store")
    s.create("ledger", store.LEDGER)
    a = ledger(spark, [("1", D(2018, 1, 1), "8-K", "a", True)] * 2 + [("2", D(2018, 1, 1), "8-K", "b", False)])
    a.write.parquet(f"{tmp_path}/landing")
    for n in (1, 2):  # replayed from the start
        follow(spark, f"{tmp_path}/landing", s, f"{tmp_path}/check{n}").awaitTermination()
    assert s.read("ledger").count() == 2
    s.replace("ledger", s.read("ledger").where("cik = '1'"))
    assert s.read("ledger").count() == 1
