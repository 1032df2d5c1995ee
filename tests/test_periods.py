import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quarterloom.functions import grammar, periods

TRIPLES = """2018-12-31 2018-12-31 2018Q4|2018-09-30 2018-12-31 2018Q3|2018-06-30 2018-12-31 2018Q2|2018-03-31 2018-12-31 2018Q1
2019-01-27 2019-10-28 2019Q1|2018-10-28 2018-10-28 2018Q4|2018-07-29 2018-10-30 2018Q3|2018-04-29 2018-10-30 2018Q2
2018-12-29 2019-09-30 2019Q1|2018-09-29 2018-09-29 2018Q4|2018-06-30 2018-09-30 2018Q3|2018-03-31 2018-09-30 2018Q2
2018-12-31 2019-06-30 2019Q2|2018-09-30 2019-06-30 2019Q1|2018-06-30 2018-06-30 2018Q4|2018-03-31 2018-06-30 2018Q3
2019-02-02 2019-02-02 2018Q4|2018-11-03 2019-01-31 2018Q3|2018-08-04 2019-01-31 2018Q2|2018-05-05 2019-01-31 2018Q1
2011-12-31 2011-12-31 2011Q4|2018-12-31 2018-12-31 2018Q4|2015-12-31 2015-12-31 2015Q4|2016-03-31 2017-02-28 2016Q1|2008-12-31 2009-12-31 2008Q4"""


def test_fiscal_period_of_a_period_end(spark):
    rows = [t.split() for line in TRIPLES.split("\n") for t in line.split("|")]
    df = spark.createDataFrame(rows, "fpe string, fye string, want string")
    got = df.select("want", periods.from_fpe_date(F.to_date("fye"), F.to_date("fpe")).alias("got")).collect()
    assert len(got) == 25 and all(r.want == r.got for r in got)
    late = spark.createDataFrame([("2019-01-31", "2018-12-31")], "a string, b string")
    assert late.select(periods.from_fpe_date(F.to_date("b"), F.to_date("a"))).first()[0] is None


def test_arithmetic(spark):
    cases = [(y, q, n) for y in (1999, 2000, 2018) for q in (1, 2, 3, 4) for n in (-9, -8, -5, -4, -3, -1, 0, 1, 2, 3, 4, 5, 8, 9)]
    df = spark.createDataFrame([(f"{y}Q{q}", n, 4 * y + q - 1 + n) for y, q, n in cases], "p string, n int, i int")
    got = df.select("i", periods.plus(F.col("p"), F.col("n")).alias("x"), periods.minus(periods.plus(F.col("p"), F.col("n")), F.col("p")).alias("d"), "n").collect()
    assert all(r.x == f"{r.i // 4}Q{r.i % 4 + 1}" and r.d == r.n for r in got)
    odd = spark.createDataFrame([("2019QNone",), ("2019Q5",), (None,), ("19Q1",)], "p string")
    assert [r[0] for r in odd.select(periods.index_of(F.col("p"))).collect()] == [None] * 4


def test_item_end_and_quarter_to_date(spark):
    df = spark.createDataFrame([("2019-12-31", 2), ("2019-12-31", 1), ("2020-02-29", 4), ("2019-12-31", 3)], "f string, q int")
    got = [str(r[0]) for r in df.select(periods.item_fpe(F.to_date("f"), F.col("q"))).collect()]
    assert got == ["2019-06-30", "2019-03-31", "2019-02-28", "2019-09-30"]
    q = spark.createDataFrame([("2018QTD", "2019Q1"), ("2018Q3", "2019Q1")], "p string, own string")
    assert [r[0] for r in q.select(periods.resolve_quarter_to_date(F.col("p"), F.col("own"))).collect()] == ["2018Q4", "2018Q3"]


def test_year_end_of_a_page(spark):
    d = dt.date
    rows = [(d(2018, 3, 31), "Form 10-Q", "1231", d(2018, 12, 31)), (d(2018, 11, 3), "Form 10-Q", "0131", d(2019, 1, 31)), (d(2018, 3, 31), "Form 10-K", "1231", d(2018, 3, 31)), (d(2018, 3, 31), "Form 10-Q", "0631", d(2018, 6, 30)), (d(2018, 3, 31), "Form 10-Q", "12", d(2018, 3, 31)), (d(2018, 1, 5), "Form 10-Q", "1231", d(2018, 12, 31))]
    df = spark.createDataFrame(rows, "fpe date, form string, mmdd string, want date")
    assert all(r[0] == r[1] for r in df.select("want", periods.fye_from_mmdd(F.col("fpe"), F.col("form"), F.col("mmdd"))).collect())


HEADINGS = {
    "1Q19": "2019Q1", "Q3 2018": "2018Q3", "2018 Q4": "2018Q4", "2017 First Quarter": "2017Q1", "second quarter 2018": "2018Q2", "3rd qtr 2018": "2018Q3",
    "Three months ended March 31, 2019": "2019Q1", "For the quarter ended 30 June 2015 (unaudited)": "2015Q2", "31-Mar-19": "2019Q1", "6/30/2016": "2016Q2", "2/28/2016": None,
    "2018 QTD": "2018QTD", "December 31, 2018 (1)": "2018Q4", "M a rch 31, 2019": "2019Q1", "Six months ended June 30, 2018": None, "Year ended December 31, 2018": None, "Q1 2019 vs Q1 2018": None, "% change": None, "Net income": None, "": None,
}


def test_headings_in_python_and_as_columns(spark):
    df = spark.createDataFrame([(t,) for t in HEADINGS], "t string")
    got = [r[0] for r in df.select(grammar.period_column(F.col("t"))).collect()]
    assert got == list(HEADINGS.values())
    assert [(grammar.parse_period(t) or (None,))[0] for t in HEADINGS] == list(HEADINGS.values())
    assert grammar.parse_period("2018", "Three months ended March 31,")[0] == "2018Q1"
    assert grammar.parse_period("2018", "Nine months ended September 30,") is None


def test_header_parts_and_units():
    assert all(map(grammar.is_header_part, ["Three Months Ended", "2018", "Q1 (1)", "as reported", "31", "Percent", "12/31/18"]))
    assert not any(map(grammar.is_header_part, ["Net income", "1,234", "quarterly", "Total"]))
    assert grammar.is_units("(Dollars in thousands)") and grammar.scale_of("$ in mil lions") == 1e6 and not grammar.is_units("thousands of people")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=40))
def test_parsing_never_fails(t):
    grammar.parse_period(t)
    grammar.is_header_part(t)
    grammar.is_units(t)
