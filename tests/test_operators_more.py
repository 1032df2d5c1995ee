import datetime as dt
import http.server
import os
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterloom import joins, session
from quarterloom.functions import items
from quarterloom.operators import quality, report, store, units
from quarterloom.plans import pipeline
from quarterloom.sources import filings
from tests.statements import REFS, frame, refs
from tests.test_pipeline import listed, submissions

D = dt.date


# --- joins and the shared folder ---------------------------------------------------
def test_hot_values_are_joined_in_place(spark, monkeypatch):
    rows = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 1), ("c", 2), (None, 3)], "k string, i int")
    values = spark.createDataFrame([("a", 10, 10), ("b", 20, 1)], "k string, v int, n bigint")
    want = sorted([("a", i, 10) for i in range(10)] + [("b", 1, 20)])
    assert sorted(tuple(r) for r in joins.join_values(rows, values, ["k"]).collect()) == want
    monkeypatch.setattr(joins, "HOT", 3)
    assert sorted(tuple(r) for r in joins.join_values(rows, values, ["k"]).collect()) == want
    assert joins.join_values(rows, values.limit(0), ["k"]).count() == 0


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_intermediates_are_removed(spark):
    with session.intermediates():
        path = session.written(spark.range(3), "few").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)


# --- items -------------------------------------------------------------------------
def test_spellings_of_items():
    known = items.Items({i: t for i, f, t in REFS if f == "item"})
    told = {"net income": 101, "income, net": 101, "NetInc": 101, "neti.ncome": 101, "net icnome": 101, "interest income, net": 102, "N.I.I.": 102, "int income": 103, "int. inc": 103, "PLL": 104, "prov LL": 104, "provn for loan lss.": 104, "TotRev": 105, "total revs": 105, "BV/share": 106, "bvps": 106, "book-value-per-share": 106}
    assert {t: known.find(t) for t in told} == told
    assert [known.find(t) for t in ("net interest margin", "noninterest expense", "tangible equity per share", "efficiency ratio", "", "1234", "x" * 5000)] == [0] * 7
    assert items.slips("abcd", "abdc", 2) == 1 and items.slips("abc", "xyz", 1) == 2


# --- units -------------------------------------------------------------------------
def test_each_missing_unit_is_recovered(spark):
    """A tenth of the figures hide their unit; each factor is found again."""
    names = {1.0: "in dollars", 1e3: "in thousands", 1e5: "in hundred thousands", 1e6: "in millions", 1e9: "in billions"}
    rows, want = [], {}
    for c, (f, unit) in enumerate(names.items()):
        for i in range(60):
            amount = 3.1e9 * (1 + i / 100)
            hidden = i % 10 == 0
            rows.append({"cik": str(c + 1), "src_value": f"{amount / f:.6f}", "src_units": None if hidden else unit})
            if hidden:
                want[len(rows)] = f
    got = {r.stmt_id: r for r in units.converted(frame(spark, rows), refs(spark), missing="mixture").where("q_source = 'missing'").collect()}
    assert {k: r.q_guess for k, r in got.items()} == want and not any(r.q_uncertain for r in got.values())


def test_scalings_of_stored_values(spark):
    rows = [{"src_value": "1,000", "src_units": "in thousands", "item_value": v} for v in [1_000_000] * 30 + [1_000, 1_000_000_000, 70_000_000, 0]]
    got = [r for r in units.value_scalings(frame(spark, rows), refs(spark)).orderBy("stmt_id").collect()]
    assert {r.q_guess for r in got[:30]} == {1.0} and not any(r.q_uncertain for r in got[:30])
    assert (got[30].q_guess, round(1 / got[31].q_guess)) == (1e3, 1000) and got[33].q_guess is None and got[33].q_uncertain
    assert got[32].q_guess != 1.0


# --- quality -----------------------------------------------------------------------
def _rows(ps, vs=None, **more):
    return [{"fiscal_period": p, "item_value": v, "filing_date": D(2018, 1, 1 + i), **more} for i, (p, v) in enumerate(zip(ps, vs or [1] * len(ps)))]


def test_messages_of_one_pass(spark):
    rows = _rows(["2018Q1", "2018Q2", "2018Q2", "2018Q3", "2018Q3", "2019Q1"], [1, 1, 9, 1, 9, 2e12]) + _rows(["2018Q4", "bad"], item="total revenue") + _rows(["2018Q1"], cik=None)
    got = {(r.cik, r["item"], r.msg_type): r.period for r in quality.validate(frame(spark, rows)).collect()}
    c = "0009000001"
    assert got[c, "net income", "missing"] == "2018Q4" and got[c, "net income", "duplicate"] == "2018Q2 to 2018Q3: 2 periods" and got[c, "net income", "outlier"] == "2019Q1"
    assert got[c, "total revenue", "missing"] in ("2018Q1 to 2018Q3: 3 periods", "2019Q1") and got[c, "interest income", "empty"] is None
    assert (None, "net income", "empty") not in got and (None, "total revenue", "empty") in got
    assert {k[2] for k in got if k[0] is None} == {"empty"}
    assert quality.validate(frame(spark, rows).limit(0)).count() == 0


def test_summary_is_ordered_and_counts_messages(spark):
    rows = _rows(["2018Q1", "2018Q4"]) + _rows(["2018Q2"], item="total revenue") + _rows(["2018Q1"], cik="0000000001", item="other")
    c = spark.createDataFrame([("0009000001", "A", "AA")], "cik string, company_name string, ticker string")
    got = quality.summarize(frame(spark, rows), c).collect()
    assert [(r.cik, r["item"]) for r in got] == sorted((r.cik, r["item"]) for r in got) and len(got) == 12
    by = {(r.cik, r["item"]): r for r in got}
    assert by["0009000001", "total revenue"].missing == 2 and by["0009000001", "net income"].missing == 1
    assert by["0000000001", "net income"].missing == 0 and by["0000000001", "net income"]["count"] == 0


def test_quantiles_of_large_groups(spark, monkeypatch):
    monkeypatch.setattr(report, "SMALL", 10_000)
    r = np.random.default_rng(0)
    values = {"a": r.lognormal(3, 2, 30_000), "b": np.repeat([1.0, 2.0, 5.0], 4000), "c": np.array([7.0]), None: r.normal(size=101)}
    df = spark.createDataFrame([(k, float(x)) for k, v in values.items() for x in v] + [("a", None), ("d", None)], "g string, x double")
    at = (0.0, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = {q.g: [q[f"p{k}"] for k in range(len(at))] for q in report.quantiles(df.repartition(5), "g", "x", at).collect()}
    assert set(got) == set(values)
    for k, v in values.items():
        assert np.allclose(got[k], np.quantile(v, at)), k


# --- store -------------------------------------------------------------------------
def test_a_swap_cut_short_is_finished(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}/store")
    one, two = (spark.createDataFrame([(x,)], "x int") for x in (1, 2))
    s.append("t", one)
    os.rename(f"{tmp_path}/store/t", f"{tmp_path}/store/t.old")
    assert s.read("t").first().x == 1  # only the old content was there
    two.write.parquet(f"file://{tmp_path}/store/t.new")
    os.rename(f"{tmp_path}/store/t", f"{tmp_path}/store/t.old")
    assert s.exists("t") and s.read("t").first().x == 2
    s.replace("t", s.read("t").withColumn("x", F.col("x") + 1))
    assert s.read("t").first().x == 3 and sorted(os.listdir(f"{tmp_path}/store")) == ["t"]


def test_blank_rows_are_filled_in(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}/store")
    pipeline.load(s, listed(spark), submissions(spark))
    cik, day = "0000000001", D(2020, 1, 2)
    assert pipeline.overrides_view(s.read("statement"), cik, D(2019, 4, 18)).where("item_value is null").count() == 0
    blank = pipeline.overrides_view(s.read("statement"), cik, day)
    assert blank.count() == 6 and blank.where("filing_href = 'Unknown' and item_value is null").count() == 6
    assert pipeline.overrides_view(s.read("statement"), cik, day, item="net income").count() == 1
    edited = blank.withColumn("item_value", F.when(F.col("item") == "net income", 5).cast("decimal(20,5)"))
    assert pipeline.apply_overrides(s, cik, edited).count() == 1
    assert s.read("statement").where("is_overridden and item_value = 5 and filing_date = '2020-01-02'").count() == 1


def test_loading_stops_after_so_many_companies(spark, tmp_path):
    rows = [(f"{c:010d}", D(2019, 4, 18), "8-K", h) for c, h in ((5, "h2"), (4, "h1"), (3, "h3"), (2, "h1"))]
    todo = spark.createDataFrame(rows, "cik string, filing_date date, filing_type string, filing_href string")
    companies = todo.select("cik").unionByName(spark.createDataFrame([("0000000009",), (None,)], "cik string"))
    s = store.Store(spark, f"file://{tmp_path}/store")
    assert pipeline.load_companies(s, companies, todo, submissions(spark), 2) == 2
    assert sorted(r.cik for r in s.read("statement").select("cik").distinct().collect()) == ["0000000003", "0000000004"]
    assert pipeline.load_companies(s, companies, todo, submissions(spark)) == 1


# --- reports -----------------------------------------------------------------------
def test_reports_of_all_companies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(report, "PAGE", 2)
    facts = frame(spark, _rows(["2018Q1", "2018Q2", "2018Q3"], cik="1", filing_href="<h>") + _rows(["2018Q1"], cik="2") + [{"cik": None, "item_value": 1}])
    companies = spark.createDataFrame([("1", "A & B", None, "6022", "x"), ("3", "C", "C", None, None)], "cik string, company_name string, ticker string, sic string, sic_description string")
    lines = report.report_lines(facts, companies, quality.ITEMS)
    assert {(r.cik, r.section): r["count"] for r in lines.groupBy("cik", "section").count().collect()} == {("1", "company"): 1, ("1", "values"): 3, ("1", "sources"): 3, ("1", "messages"): 5, ("2", "values"): 1, ("2", "sources"): 1, ("2", "messages"): 5}
    folder = f"{tmp_path}/reports"
    assert report.write_reports(facts, companies, folder, quality.ITEMS) == 2
    read = lambda c: "".join(open(f"{folder}/cik={c}/{f}", encoding="utf-8").read() for f in sorted(os.listdir(f"{folder}/cik={c}")) if f.startswith("part"))
    page = read(1)
    assert "A &amp; B" in page and page.count("<tr>") == 12 and page.index("<h2>company") < page.index("<h2>values") < page.index("<h2>messages") < page.index("<h2>sources")
    os.remove(next(f"{folder}/cik=2/{f}" for f in os.listdir(f"{folder}/cik=2") if f.startswith("part")))
    assert report.write_reports(facts, companies, folder, quality.ITEMS) == 2 and read(1) == page and read(2) == ""
    assert report.write_reports(facts, companies, folder, quality.ITEMS, again=True) == 2 and read(1) == page and read(2)


# --- sources -----------------------------------------------------------------------
def test_lists_are_parsed_as_xml(spark):
    one = "<filing><dateFiled>{d}</dateFiled><type>8-K</type><filingHREF>a?x=1&amp;y=2</filingHREF></filing>"
    pages = [("1", 0, f"<?xml version='1.0'?><l><companyInfo><name>n</name></companyInfo><results>{one.format(d='2019-01-02')}</results></l>"), ("1", 100, f"<r>{one.format(d='2018-01-02')}{one.format(d='bad')}</r>"), ("2", 0, f"<r>{one.format(d='2019-01-02')}<oops"), ("3", 0, ""), ("4", 0, None), ("5", 0, "<r/>"), ("6", 0, "no xml")]
    df = spark.createDataFrame(pages, "cik string, offset int, xml string")
    got = sorted((r.cik, str(r.filing_date), r.filing_href) for r in filings.filing_list(df).select("cik", "filing_date", "filing_href").collect())
    assert got == [("1", "2018-01-02", "a?x=1&y=2"), ("1", "2019-01-02", "a?x=1&y=2"), ("1", "None", "a?x=1&y=2")]
    assert filings.filing_list(df, start=D(2019, 1, 1)).count() == 1 and filings.filing_list(df, kind="10-").count() == 0
    assert [tuple(r) for r in filings.unfinished_lists(df).collect()] == [("1", 200, 100)]
    assert filings.unfinished_lists(df, start=D(2018, 6, 1)).count() == 0
    info = spark.createDataFrame([("<r><companyInfo><CIK> 7 </CIK><name>A &amp; B</name></companyInfo></r>",), ("<r><companyInfo><CIK>",), ("<r/>",)], "xml string")
    assert [tuple(r) for r in filings.company_info(info).collect()] == [("7", "Unknown", "Unknown", "A & B")]


def test_pages_are_fetched_with_retries(spark):
    asked: list[str] = []

    class Site(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            ok = "gone" not in self.path and asked.count(self.path) > 2
            self.send_response(200 if ok else 503)
            self.end_headers()
            self.wfile.write(f"<r>{self.path}</r>".encode() if ok else b"")

        def log_message(self, *_):
            pass

    site = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=site.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{site.server_port}"
    assert filings.fetch(f"{at}/a", first=0.01) == "<r>/a</r>" and asked == ["/a"] * 3
    with pytest.raises(OSError):
        filings.fetch(f"{at}/gone", attempts=4, first=0.01)
    assert asked.count("/gone") == 4
    links = spark.createDataFrame([(f"{at}/b",), (f"{at}/gone2",), (None,)], "href string")
    got = {r.href: (r.raw, r.fetch_error is not None) for r in filings.fetched(links, attempts=3, first=0.01).collect()}
    assert got == {f"{at}/b": ("<r>/b</r>", False), f"{at}/gone2": (None, True), None: (None, False)}
    spark.dataSource.register(filings.ListingSource)
    for n in (0, 100):  # the retries' waits are not worth the test's time
        asked.extend([f"/list/7/{n}/100"] * 2)
    pages = spark.read.format("filing_pages").option("url", at + "/list/{cik}/{offset}/{number}").option("ciks", "7").option("pages", "2").load().collect()
    assert sorted(r.xml for r in pages) == ["<r>/list/7/0/100</r>", "<r>/list/7/100/100</r>"]
    site.shutdown()
