import random

import numpy as np

from quarterloom.operators import spikes
from tests.statements import frame, refs


def series(values, **kw):
    return [{"fiscal_period": f"{2000 + i // 4}Q{i % 4 + 1}", "src_value": f"{v:.2f}", "item_value": v, **kw} for i, v in enumerate(values)]


def found(spark, rows):
    return {r.stmt_id: r.reason for r in spikes.implausible(frame(spark, rows), refs(spark)).collect()}


def test_reasons(spark):
    r = random.Random(1)
    v = [1e6 * (1 + r.gauss(0, 0.03)) for _ in range(60)]
    v[20] = 2.5e6  # a spike
    v[25] = 0
    v[30] = -v[30]
    v[35] = 3e12
    v[40:44] = [v[40]] * 4  # stuck
    v[50:53] = [v[50]] * 3  # three are no run
    got = found(spark, series(v))
    assert got == {21: "spike", 26: "sign", 31: "sign", 36: "bound", 41: "stuck", 42: "stuck", 43: "stuck", 44: "stuck"}


def test_new_level_is_the_course(spark):
    r = random.Random(2)
    v = [1e6 * (1 + r.gauss(0, 0.02)) for _ in range(20)] + [3e6 * (1 + r.gauss(0, 0.02)) for _ in range(20)]
    assert found(spark, series(v)) == {}


def test_wrong_unit_is_no_case_and_rows_of_a_quarter_are_judged_apart(spark):
    r = random.Random(3)
    v = [1e6 * (1 + r.gauss(0, 0.03)) for _ in range(30)]
    rows = series(v)
    rows[10]["item_value"] = v[10] * 1000
    rows += [dict(rows[12], src_value=f"{v[12] * 3:.2f}")]
    assert found(spark, rows) == {31: "spike"}


def test_short_series_nulls_and_empty(spark):
    rows = series([1e6, 9e6, 1e6]) + [{"cik": None}, {"item": None}, {"fiscal_period": None, "src_value": "1"}, {"item": "efficiency ratio", "src_value": "2e12"}]
    assert found(spark, rows) == {}
    assert spikes.implausible(frame(spark, rows).limit(0), refs(spark)).count() == 0


def test_medians_match_numpy():
    r = np.random.default_rng(0)
    values = [r.normal(size=n) for n in (1, 4, 9, 30)]
    before, after, near = spikes._levels(values)
    at = 0
    for v in values:
        for j in range(len(v)):
            lo, hi = v[max(0, j - 8) : j], v[j + 1 : j + 9]
            assert np.isnan(before[at]) if len(lo) < 5 else np.isclose(before[at], np.median(lo))
            assert np.isnan(after[at]) if len(hi) < 5 else np.isclose(after[at], np.median(hi))
            around = np.r_[v[max(0, j - 4) : j], v[j + 1 : j + 5]]
            assert np.isnan(near[at]) if not len(around) else np.isclose(near[at], np.median(around))
            at += 1
