import datetime as dt
import random

from pyspark.sql import functions as F

from quarterloom.llm import survivor
from quarterloom.llm.survivor import surviving_records, winners
from tests.statements import frame, refs

T = dt.datetime


def found(spark, rows):
    return {(r.group_id, r.field): r.from_id for r in winners(frame(spark, rows), refs(spark)).collect()}


def test_order_of_trust(spark):
    rows = [
        {"table_rank": 1, "src_value": "a"}, {"table_rank": 0, "src_value": "NM"}, {"item": "NetIncome", "table_rank": 9, "is_overridden": True}, {"cik": "9000001.0", "table_rank": None, "src_units": "u"},
        {"item": "total revenue"}, {"cik": None}, {"cik": None}, {"item": "efficiency ratio"}, {"item": "efficiency ratio"}, {"filing_href": "other"},
    ]
    assert found(spark, rows) == {(1, "row"): 3, (1, "src_value"): 1, (1, "src_units"): 4}


def test_ties_dates_and_nulls(spark):
    rows = [{"loaded_at": T(2020, 1, 1)}, {"loaded_at": T(2021, 1, 1)}, {"loaded_at": None, "src_row": "x"}, {"loaded_at": T(2021, 1, 1), "fpe_date": dt.date(2015, 3, 31)}]
    assert found(spark, rows) == {(1, "row"): 4, (1, "src_row"): 3, (1, "fpe_date"): 4}
    assert found(spark, [{}]) == {} and winners(frame(spark, [{}]).limit(0), refs(spark)).count() == 0


def test_against_brute_force(spark):
    r = random.Random(5)
    rows = []
    for _ in range(300):
        rows.append({"cik": str(r.randint(1, 3)), "item": r.choice(["net income", "Net Income", "PLL"]), "filing_href": r.choice("abcdefgh"), "table_rank": r.choice([None, 0, 1]), "item_rank": r.choice([None, 0, 1]), "is_overridden": r.choice([None, False, True]), "loaded_at": r.choice([None, T(2020, 1, 1), T(2021, 1, 1)]), "src_value": r.choice([None, "", "n/a", "--", "5", "6"]), "src_row": r.choice([None, "Not Reported", "row"]), "item_value": r.choice([None, 1, 2])})
    groups = {}
    for i, x in enumerate(rows, 1):
        groups.setdefault((x["cik"], x["item"].lower().replace("pll", "p"), x["filing_href"]), []).append((i, x))
    want = {}
    big = 10**9
    for g in groups.values():
        if len(g) < 2:
            continue
        order = sorted(g, key=lambda t: (not t[1]["is_overridden"], big if t[1]["table_rank"] is None else t[1]["table_rank"], big if t[1]["item_rank"] is None else t[1]["item_rank"], -(t[1]["loaded_at"].timestamp() if t[1]["loaded_at"] else 0), -t[0]))
        gid = min(i for i, _ in g)
        want[gid, "row"] = order[0][0]
        for f in ("item_value", "src_value", "src_row"):
            for i, x in order:
                if x[f] is not None and str(x[f]).lower() not in ("", "n/a", "--", "nm", "not reported"):
                    want[gid, f] = i
                    break
    assert found(spark, rows) == want


def test_record(spark):
    rec = surviving_records(frame(spark, [{"table_rank": 0, "src_value": None, "item_value": 3}, {"table_rank": 1, "src_value": "5", "src_units": "NM"}]), refs(spark)).collect()
    assert len(rec) == 1 and (rec[0].group_id, rec[0].row_id, float(rec[0].item_value), rec[0].src_value, rec[0].src_units) == (1, 1, 3.0, "5", None)


def _random_rows(n):
    r = random.Random(11)
    return [{"cik": "1", "table_rank": r.choice([None, 0, 1, 2]), "item_rank": r.choice([None, 0, 3]), "is_overridden": r.choice([None, False, False, True]), "loaded_at": r.choice([None, T(2020, 1, 1), T(2021, 1, 1)]), "src_value": r.choice([None, "5", "6", "7"]), "src_row": r.choice([None] * 40 + ["row"])} for _ in range(n)]


def test_a_hot_group_is_split(spark, monkeypatch):
    rows = _random_rows(400) + [{"cik": "2"}, {"cik": "2", "src_row": "x"}]
    whole = found(spark, rows)
    monkeypatch.setattr(survivor, "HOT", 50)
    monkeypatch.setattr(survivor, "SALTS", 3)
    assert found(spark, rows) == whole and (401, "src_row") in whole


def test_votes_decide(spark, monkeypatch):
    """Other weights elect other values."""
    rows = [{"table_rank": 0, "src_value": "a"}, {"table_rank": 1, "src_value": "b"}, {"table_rank": 2, "src_value": "b"}]
    assert found(spark, rows)[1, "src_value"] == 1
    votes = {r["field"]: r.votes for r in winners(frame(spark, rows), refs(spark)).collect()}
    assert votes == {"row": 2**61 + 2**60 + 2**59, "src_value": 2**61}
    monkeypatch.setattr(survivor, "vote", lambda stronger, later: F.lit(10).cast("bigint") - stronger)
    assert found(spark, rows)[1, "src_value"] == 2
    monkeypatch.setattr(survivor, "vote", lambda stronger, later: stronger + later)
    assert found(spark, rows)[1, "row"] == 3


def test_recency_decides_within_a_source(spark):
    rows = [{"loaded_at": T(2021, 1, 1), "src_value": "a"}, {"loaded_at": T(2022, 1, 1), "src_value": "b"}, {"loaded_at": T(2020, 1, 1), "src_value": "a"}]
    assert found(spark, rows) == {(1, "row"): 2, (1, "src_value"): 2}


def test_rows_without_an_id_and_extra_columns(spark):
    df = frame(spark, [{"stmt_id": None}, {"stmt_id": 5}, {"stmt_id": 5}]).selectExpr("*", "1 as votes", "2 as source", "'x' as h1", "3 as g_item")
    assert {(r.group_id, r["field"], r.from_id) for r in winners(df, refs(spark)).collect()} == {(5, "row", 5)}
