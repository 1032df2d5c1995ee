import datetime as dt
import random

from pyspark.sql import functions as F

from quarterloom.functions.companies import company_number
from quarterloom.operators import orphans

D = dt.date


def parents(spark, rows):
    return spark.createDataFrame(rows, "cik string, added_on date, removed_on date, tbl string")


def children(spark, rows):
    return spark.createDataFrame(rows, "id bigint, cik string, filing_date date, company string")


def found(spark, p, c, **kw):
    got = orphans.find_orphans(parents(spark, p), [(children(spark, c), "t", "id")], **kw).collect()
    return sorted((r["row_id"] for r in got), key=lambda x: (x is None, x))


def test_spellings_denote_one_company(spark):
    texts = ["0009000123", "9000123", "9000123.0", "9,000,123", "#9000123", "CIK: 0009000123 ", "０００９０００１２３", "cik=9000123\t"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,), ("",), ("n/a",)], "t string")
    got = [r[0] for r in df.select(company_number(F.col("t"))).collect()]
    assert got == [9000123] * len(texts) + [None] * 3
    long = spark.createDataFrame([("9" * 30,), ("9" * 30,), ("8" * 30,)], "t string").select(company_number(F.col("t"))).collect()
    assert long[0] == long[1] != long[2] and long[0][0] < 0


def test_cases(spark):
    p = [("1", None, None, "x"), ("2", D(2010, 1, 1), D(2012, 1, 1), "x"), ("2", D(2012, 1, 1), D(2013, 1, 1), "x"), ("3", D(2010, 1, 1), D(2010, 1, 1), "x"), (None, None, None, "x"), ("2", D(2010, 1, 1), D(2012, 1, 1), "x")]
    c = [
        (1, "0001", D(1990, 1, 1), "c"),  # in force always
        (2, "2", D(2009, 12, 31), "c"),  # a day early
        (3, "2", D(2010, 1, 1), "c"),
        (4, "2", D(2012, 1, 1), "c"),  # the second row takes over
        (5, "2", D(2013, 1, 1), "c"),  # removed that day
        (6, "3", D(2010, 1, 1), "c"),  # never in force
        (7, "4", D(2010, 1, 1), "c"),  # no parent
        (8, None, D(2010, 1, 1), "c"), (9, "n/a", D(2010, 1, 1), "c"), (10, "2", None, "c"), (11, "4", None, "c"), (7, "4", D(2010, 1, 1), "c"), (None, "4", None, "c"),
    ]
    for limit in (1000, 0):
        assert found(spark, p, c, run_limit=limit) == [2, 5, 6, 7, 7, 11, None]
    assert found(spark, [], c[:2]) == [1, 2] and found(spark, p, []) == []


def test_runs_are_compressed(spark):
    p = [("5", D(2010, 1, 1), D(2010, 2, 1), "x"), ("5", D(2010, 2, 1), D(2010, 3, 1), "x"), ("5", D(2010, 1, 5), D(2010, 1, 6), "x"), ("5", D(2011, 1, 1), None, "x")]
    assert orphans.parent_runs(parents(spark, p)).count() == 2


def test_against_brute_force(spark):
    r = random.Random(4)
    day = lambda: D(2010, 1, 1) + dt.timedelta(days=r.randint(0, 60))
    p = [(str(r.randint(1, 8)), r.choice([None, day()]), r.choice([None, day()]), "x") for _ in range(12)]
    c = [(i, str(r.randint(1, 10)), day(), "c") for i in range(400)]
    want = [i for i, k, d, _ in c if not any(a == k and (s is None or s <= d) and (e is None or d < e) for a, s, e, _ in p)]
    assert found(spark, p, c) == want == found(spark, p, c, run_limit=1)


def test_long_numbers_are_compared_by_all_digits(spark, monkeypatch):
    """Two long numbers may share a stand-in; here all of them do."""
    import datetime as dt

    from pyspark.sql import functions as F

    monkeypatch.setattr(orphans, "company_number", lambda c: F.when(F.length(c) > 12, F.lit(-5).cast("bigint")).otherwise(c.try_cast("bigint")))
    d = dt.date
    a, b = "12345678901234567890", "99999999999999"
    parents = spark.createDataFrame([(a, None, d(2020, 1, 1)), ("7", None, None)], "cik string, added_on date, removed_on date")
    rows = [(1, a, d(2019, 1, 1)), (2, a, d(2020, 1, 1)), (3, b, d(2019, 1, 1)), (4, "7", d(2019, 1, 1)), (5, "8", None), (6, "000" + a, None), (7, b, None)]
    refs = spark.createDataFrame(rows, "id bigint, cik string, filing_date date")
    assert sorted(r.row_id for r in orphans.find_orphans(parents, [(refs, "t", "id")]).collect()) == [2, 3, 5, 7]
