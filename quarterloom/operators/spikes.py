"""Problem 5: implausible readings in quarterly series.

Per series (company and item): a Hampel filter - rolling medians and the
median absolute deviation of the residuals - gives the course and the spread
of ordinary readings; runs of quarters that repeat one amount are found by run
length; physical bounds and the sign of the series complete it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, functions as F

from quarterloom.operators.units import dollars, parsed
from quarterloom.session import written

#: Quarters on each side whose median is the level before and after.
SIDE = 8
#: Quarters on each side of the local median.
NEAR = 4
#: A side of fewer quarters has no level of its own.
LEAST = 5
#: Ordinary readings stay within 4 spreads, cases lie beyond 10.
CUT = 7.0
#: Amounts of this size are impossible.
BOUND = 1e12
#: Quarters in a row with one amount that count as stuck.
STUCK = 4
#: Share of quarters that may have the other sign in a one-signed series.
RARE = 0.2


def quarter_index(c: Column) -> Column:
    """4*year + quarter - 1 of a ``YYYYQn`` text, null if it is none."""
    ok = c.rlike(r"^[0-9]{4}Q[1-4]$")
    return F.when(ok, F.substring(c, 1, 4).cast("int") * 4 + F.substring(c, 6, 1).cast("int") - 1)


def _median(win: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Median of each row without NaN, and the number of values."""
    n = (~np.isnan(win)).sum(axis=1)
    s = np.sort(win, axis=1)  # NaN goes last
    rows = np.arange(len(win))
    a, b = s[rows, np.maximum(n - 1, 0) // 2], s[rows, np.minimum(n // 2, win.shape[1] - 1)]
    return np.where(n > 0, (a + b) / 2, np.nan), n


def _levels(values: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Before, after and local medians of all series, one after the other.

    NaN between the series keeps their windows apart.
    """
    pad = np.full(SIDE, np.nan)
    line = np.concatenate([x for v in values for x in (pad, v)] + [pad])
    own = np.concatenate([x for v in values for x in (np.zeros(SIDE, bool), np.ones(len(v), bool))] + [np.zeros(SIDE, bool)])
    at = np.flatnonzero(own)
    win = sliding_window_view(line, 2 * SIDE + 1)[at - SIDE]
    before, nb = _median(win[:, :SIDE])
    after, na = _median(win[:, SIDE + 1 :])
    near, _ = _median(np.concatenate([win[:, SIDE - NEAR : SIDE], win[:, SIDE + 1 : SIDE + 1 + NEAR]], axis=1))
    return np.where(nb >= LEAST, before, np.nan), np.where(na >= LEAST, after, np.nan), near


def _run_lengths(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Length of the run of successive quarters with one and the same amount."""
    const = lo == hi
    same = const[1:] & const[:-1] & (lo[1:] == lo[:-1])
    start = np.r_[True, ~same]
    run = np.cumsum(start) - 1
    return np.where(const, np.bincount(run)[run], 0)


def _spread(v: np.ndarray, b: np.ndarray, a: np.ndarray, n: np.ndarray) -> float:
    """Spread of the ordinary readings relative to the course."""
    if len(v) < LEAST:
        return np.nan
    c = np.where(np.isnan(n), np.median(v), n)
    with np.errstate(all="ignore"):
        r = np.abs(v - c) / np.abs(c)
        first = 1.4826 * np.nanmedian(r)
        # near a change of level the closer side is the course
        moved = np.abs(b - a) > 5 * max(first, 1e-6) * np.maximum(np.abs(a), np.abs(b))
        c = np.where(moved, np.where(np.abs(v - b) < np.abs(v - a), b, a), c)
        r = np.abs(v - c) / np.abs(c)
    r = r[np.isfinite(r)]
    if len(r) < LEAST:
        return np.nan
    mad = 1.4826 * np.median(r)
    ok = r <= max(6 * mad, 1e-9)
    return float(np.sqrt(np.mean(r[ok] ** 2)))


def _courses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        if not len(b):
            continue
        med = [np.asarray(x, float) for x in b["med"]]
        before, after, near = _levels(med)
        at = np.r_[0, np.cumsum([len(v) for v in med])]
        lengths = np.diff(at)
        signs, spreads, runs = np.zeros(len(med)), np.empty(len(med)), []
        for i, v in enumerate(med):
            s = slice(at[i], at[i + 1])
            runs.append(_run_lengths(np.asarray(b["lo"].iat[i], float), np.asarray(b["hi"].iat[i], float)))
            spreads[i] = _spread(v, before[s], after[s], near[s])
            if len(v) >= 3:
                signs[i] = 1.0 if (v > 0).sum() >= (1 - RARE) * len(v) else -1.0 if (v < 0).sum() >= (1 - RARE) * len(v) else 0.0
        yield pd.DataFrame(
            {
                "q_company": np.repeat(b["q_company"].to_numpy(), lengths),
                "q_item": np.repeat(b["q_item"].to_numpy(), lengths),
                "q": np.concatenate([np.asarray(x, int) for x in b["q"]]),
                "before": before,
                "after": after,
                "near": near,
                "spread": np.repeat(spreads, lengths),
                "sign": np.repeat(signs, lengths),
                "run": np.concatenate(runs),
            }
        )


def courses(readings: DataFrame) -> DataFrame:
    """Course, spread, sign and stuck run of each (company, item, quarter).

    Rows are first brought down to one median per quarter (a mergeable
    sketch), so a company with a third of all rows moves as little as any
    other; a series then holds one entry per quarter of the calendar.
    """
    per_quarter = readings.groupBy("q_company", "q_item", "q").agg(
        F.percentile_approx("q_amount", 0.5, 10_000).alias("med"), F.min("q_amount").alias("lo"), F.max("q_amount").alias("hi")
    )
    entry = F.sort_array(F.collect_list(F.struct("q", "med", "lo", "hi")))
    series = per_quarter.groupBy("q_company", "q_item").agg(entry.alias("e")).select("q_company", "q_item", *[F.col(f"e.{c}").alias(c) for c in ("q", "med", "lo", "hi")])
    schema = "q_company bigint, q_item bigint, q int, before double, after double, near double, spread double, sign double, run int"
    return series.mapInPandas(_courses, schema)


def readings(df: DataFrame, refs: DataFrame, key: str = "stmt_id") -> DataFrame:
    """``(key, q_company, q_item, q, q_amount)`` of the rows that are a
    reading of a series: a company number, one of the items, a quarter (from
    ``fiscal_period``, else ``fpe_date``) and an amount in dollars; where
    ``src_value`` is unreadable ``item_value`` is the amount."""
    a = parsed(df.select(key, "cik", "item", "item_value", "src_value", "src_units", "fiscal_period", "fpe_date"), refs)
    by_date = F.year("fpe_date") * 4 + F.quarter("fpe_date") - 1
    amount = F.round(F.coalesce(dollars(F.col("q_money")), F.col("item_value").cast("double")), 5)
    all_ = a.select(key, "q_company", "q_item", F.coalesce(quarter_index(F.col("fiscal_period")), by_date).alias("q"), amount.alias("q_amount"))
    # parsed once, read twice; a filter before would parse again
    return written(all_, "readings").where("q_company is not null and q_item > 0 and q is not null and q_amount is not null and not isnan(q_amount)")


def implausible(df: DataFrame, refs: DataFrame, key: str = "stmt_id", cut: float = CUT, bound: float = BOUND, stuck: int = STUCK) -> DataFrame:
    """``(key, reason)`` of the implausible readings; the first of 'bound',
    'sign', 'stuck' and 'spike' that holds.

    Series of fewer than five quarters have no course and only the bound and
    stuck rules; ties, repeated rows and several rows per quarter are judged
    row by row against the quarter's course; an empty table gives no rows.
    """
    r = readings(df, refs, key)
    j = r.join(courses(r), ["q_company", "q_item", "q"])
    a = F.col("q_amount")
    # NaN becomes null on its way out of Python; a course of zero gives no gap
    gap = F.least(*[F.try_divide(F.abs(a - F.col(c)), F.abs(F.col(c))) for c in ("before", "after", "near")])
    reason = (
        F.when(F.abs(a) >= bound, "bound")
        .when((F.col("sign") != 0) & (F.signum(a) != F.col("sign")), "sign")
        .when(F.col("run") >= stuck, "stuck")
        .when(F.col("spread").isNotNull() & (gap > cut * F.greatest(F.col("spread"), F.lit(1e-6))), "spike")
    )
    return j.withColumn("reason", reason).where("reason is not null").select(key, "reason")
