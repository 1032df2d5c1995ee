"""Queries over whole tables that a capped or filtered query stands beside."""

import csv
import datetime as dt
import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from quarterloom.functions import grammar
from quarterloom.operators import report
from quarterloom.plans import named


def test_text_blocks_of_every_document(spark, tmp_path):
    docs = [
        (1, "one line"), (2, "Chiffres d’août\n\n“Café” & crème <b>x</b> &lt; y > z\n \t\n\n\nlast\nline\xa0"), (3, None), (4, ""), (5, "\n\n \n"), (6, "1,234"),
        (7, "</p><p>not a paragraph\r\n\r\nsecond\u3000\n"), (8, "a\nb\n\n&amp;#65; &copy 😀"),
    ]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for k, t in docs:
        parts = [p.strip() for p in re.split(r"\n[ \t\r]*\n", t or "")]
        want += [(k, i, p) for i, p in enumerate(filter(None, parts))]
    got = sorted(tuple(r) for r in entry.queries()["page_text_blocks"](spark, str(tmp_path)).collect())
    assert got == want
    assert len(want) == 9 and max(i for _, i, _ in want) == 2


def test_filings_of_a_range_have_no_cap(spark, tmp_path):
    day = dt.date(2010, 1, 1)
    rows = [(i, "1", day + dt.timedelta(days=i % 1096), "8-K") for i in range(2500)]
    rows += [(2500, "1", day - dt.timedelta(days=1), "8-K"), (2501, "1", dt.date(2013, 1, 1), "8-K"), (2502, None, day, "8-K/A"), (2503, "1", day, "10-Q"), (2504, "1", None, "8-K")]
    spark.createDataFrame(rows, "filing_id bigint, cik string, filing_date date, filing_type string").write.parquet(f"{tmp_path}/prelim_filing.parquet")
    got = [(r.filing_date, r.filing_id) for r in entry.queries()["filings_range"](spark, str(tmp_path)).collect()]
    assert got == sorted(got) and sorted(k for _, k in got) == [*range(2500), 2502]


def test_companies_to_load(spark, tmp_path):
    rows = [(f"{i:04d}",) for i in range(120)] * 2 + [(None,)]
    spark.createDataFrame(rows, "cik string").write.parquet(f"{tmp_path}/cik.parquet")
    got = [r.cik for r in entry.queries()["companies_to_load"](spark, str(tmp_path)).collect()]
    assert got == [f"{i:04d}" for i in range(119, 69, -1)]


def test_every_period_rule_and_exclusion_is_spelled(spark, tmp_path):
    quarters = [(y, q) for y in (2002, 2018) for q in (1, 2, 3, 4)]
    df = spark.createDataFrame(quarters, "y bigint, q bigint")
    used: set = set()
    for y, q, cells in df.select("y", "q", named._spelled_by_rule(F.col("y"), F.col("q"))).collect():
        for k, t in enumerate(cells):
            own = [x for x in grammar.SPELLINGS if x.read(tokens := grammar._heading(t), len(tokens))]
            assert own, t  # each excluded cell has a period that is not to be read
            assert grammar.names_no_quarter(tokens) == (k > 17)
            assert (grammar.parse_period(t) or (None,))[0] == (None if k > 17 else f"{y}QTD" if k in (15, 16) else f"{y}Q{q}"), t
            used.update(own)
    assert used == set(grammar.SPELLINGS)
    days = [(dt.date(y - 10, 3 * q, 1),) for y, q in quarters]
    spark.createDataFrame(days, "o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    got = {(r.y, r.q, r.k): r.period for r in entry.queries()["period_text_rules"](spark, str(tmp_path)).collect()}
    assert got == {(y, q, k): None if k > 17 else f"{y}QTD" if k in (15, 16) else f"{y}Q{q}" for y, q in quarters for k in range(24)}


def test_report_keeps_what_the_page_leaves_out(spark, tmp_path):
    path, df = f"{tmp_path}/r.html", spark.range(25).selectExpr("id", "if(id = 3, null, 'a,é') as t").orderBy("id")
    assert report.write_report({"values": df, "few": df.limit(10)}, path, rows=10)
    page = open(path, encoding="utf-8").read()
    assert "10 of 25 rows, 15 left out" in page and page.count("left out") == 1 and page.count("<tr>") == 20
    with open(f"{path}.values.csv", encoding="utf-8", newline="") as f:
        assert list(csv.reader(f)) == [["id", "t"], *[[str(i), "" if i == 3 else "a,é"] for i in range(25)]]
    assert not (tmp_path / "r.html.few.csv").exists()
    assert not report.write_report({"values": df}, path) and report.write_report({"values": df}, path, again=True)
    assert "left out" not in open(path, encoding="utf-8").read() and not (tmp_path / "r.html.values.csv").exists()
