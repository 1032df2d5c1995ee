from pyspark.sql import functions as F

from quarterloom.operators import units
from tests.statements import frame, refs


def read(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [(r["x"]["figure"], r["x"]["factor"]) if r["x"] else (None, None) for r in df.select(units.read_figure(F.col("t")).alias("x")).collect()]


def test_figures(spark):
    want = {
        "15,974": (15974.0, None), "$ 8.9783": (8.9783, None), "US$1.2596": (1.2596, None), "USD 4,193,657": (4193657.0, None), "11,693,155*": (11693155.0, None),
        "15.05 (b)": (15.05, None), "9.4901 (1)": (9.4901, None), "114 719": (114719.0, None), "114 719": (114719.0, None), "772,267 thsd": (772267.0, 1e3), "28,364 k": (28364.0, 1e3), "11,080K": (11080.0, 1e3),
        "4,905,584 (thousands)": (4905584.0, 1e3), "(3,131.6)": (-3131.6, None), "(6,996.1": (-6996.1, None), "-100.09": (-100.09, None), "−2,200.4": (-2200.4, None), "US$(9,407.1)": (-9407.1, None),
        "$−1,956.0": (-1956.0, None), "9,599.4 Million": (9599.4, 1e6), "1,735.0MM": (1735.0, 1e6), "11.045bn": (11.045, 1e9), "4,029c per share": (4029.0, 0.01), "4,131¢": (4131.0, 0.01), "4,856 cents": (4856.0, 0.01),
        "3,306.7 hundred thousand": (3306.7, 1e5), "(80,640) thsd": (-80640.0, 1e3), "—": (0.0, None), "$ -": (0.0, None), "１２": (12.0, None),
    }
    assert dict(zip(want, read(spark, list(want)))) == want
    assert read(spark, ["n/a", "NM", "not reported", "", None]) == [(None, None)] * 5
    assert read(spark, ["12 " * 5000 + "x"])[0][1] is None  # very long, and no failure


def test_unit_columns(spark):
    want = {"in 000's": 1e3, "($ in 000’s)": 1e3, "thsd. $": 1e3, "(dollars in thousands, except share amounts)": 1e3, "$mm": 1e6, "mn USD": 1e6, "amounts in millions unless noted": 1e6, "$bn": 1e9, "(in $100,000s)": 1e5, "in hundred thousands": 1e5, "¢": 0.01, "US cents": 0.01, "dollars and cents": 1.0, "$ per share": 1.0, "as stated": 1.0, "--": None, "n/a": None, "": None}
    df = spark.createDataFrame([(t,) for t in want], "t string")
    assert [r[0] for r in df.select(units.column_factor(F.col("t"))).collect()] == list(want.values())


def test_misconverted(spark):
    rows = [
        {"src_value": "10", "src_units": "in millions", "item_value": 10_000_000},
        {"src_value": "10", "src_units": "in millions", "item_value": 10_000},
        {"src_value": "10 thsd", "src_units": "in millions", "item_value": 10_000},  # the text goes before
        {"src_value": "10", "src_units": None, "item_value": 10_000},
        {"src_value": "10", "src_units": "n/a", "item_value": 10},
        {"item": "Book Value Per Share", "src_value": "10", "src_units": "in millions", "item_value": 10},
        {"item": "BVPS", "src_value": "1,000", "src_units": "cents per share", "item_value": 1000},
        {"src_value": "—", "src_units": None, "item_value": 0},
        {"src_value": "—", "src_units": None, "item_value": 5},
        {"src_value": "10", "item_value": 499}, {"src_value": "10", "item_value": 500}, {"src_value": "10", "item_value": -500},
        {"src_value": None, "item_value": 5}, {"src_value": "NM", "item_value": 5}, {"src_value": "5", "item_value": None}, {"cik": None, "item": None, "src_value": "1", "item_value": 1000},
    ]
    df = frame(spark, rows).withColumns({"q_item": F.lit("clash"), "q_amount": F.lit(1)})
    got = sorted(r[0] for r in units.misconverted(df, refs(spark)).collect())
    assert got == [2, 4, 7, 9, 11, 12, 16]
    assert units.misconverted(df.limit(0), refs(spark)).count() == 0


def test_mixture_assigns_missing_units(spark):
    rows = [{"src_value": f"{1000 + i}", "src_units": "in thousands", "cik": str(c)} for i in range(40) for c in (1, 2)]
    rows += [{"src_value": f"{1_000_000 + i}", "cik": "1"} for i in range(20)] + [{"src_value": "1005", "cik": "1"}] * 5 + [{"src_value": "1.2", "cik": "2"}] * 5 + [{"src_value": "7", "cik": "3"}]
    c = units.converted(frame(spark, rows), refs(spark), missing="mixture").where("q_source = 'missing'").orderBy("stmt_id").collect()
    assert [r.q_guess for r in c[:20]] == [1.0] * 20 and not any(r.q_uncertain for r in c[:20])
    assert {r.q_guess for r in c[20:25]} == {1e3} and {r.q_guess for r in c[25:30]} == {1e6}
    assert c[30].q_guess is None and c[30].q_uncertain


def test_mixture_knows_cents_and_flags_what_nothing_explains(spark):
    share = {"item": "Book Value Per Share"}
    rows = [share | {"src_value": f"{20 + i / 10}", "src_units": "$ per share", "cik": str(c)} for i in range(10) for c in (1, 2)]
    rows += [share | {"src_value": f"{20 + i / 10}", "cik": "1"} for i in range(10)] + [share | {"src_value": "2,045", "cik": "2"}] * 5 + [share | {"src_value": "204,500", "cik": "1"}, share | {"src_value": "600", "cik": "1"}]
    c = units.converted(frame(spark, rows), refs(spark), missing="mixture").where("q_source = 'missing'").orderBy("stmt_id").collect()
    assert [(r.q_guess, r.q_uncertain) for r in c[:10]] == [(1.0, False)] * 10
    assert [(r.q_guess, r.q_uncertain, round(r.q_amount, 4)) for r in c[10:15]] == [(0.01, False, 20.45)] * 5
    assert [r.q_uncertain for r in c[15:]] == [True, True]
