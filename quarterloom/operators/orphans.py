"""Problem 1: references to records that do not exist.

Parent keys (company number, day in force) are integers; sorted, they are
compressed into contiguous runs.  A reference is matched as-of to the run that
starts at or before its key and is an orphan when its key lies beyond the end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from quarterloom.functions.companies import company_digits, company_number

#: Days per company in the key space; day 2**19 is 1970-01-01.
BITS = 20
ZERO = 1 << (BITS - 1)
LAST = (1 << BITS) - 1

#: Runs that may be broadcast (16 bytes each); more are joined by company.
RUN_LIMIT = 1_000_000


def day(c: Column) -> Column:
    """Day number of a date within the key space; null for null."""
    return F.when(c.isNotNull(), _day(c))


def _day(c: Column) -> Column:
    return F.least(F.greatest(F.datediff(c, F.lit("1970-01-01").cast("date")).cast("bigint") + ZERO, F.lit(0)), F.lit(LAST))


def parent_runs(parents: DataFrame, key: str = "cik", since: str = "added_on", until: str = "removed_on") -> DataFrame:
    """``(company, lo, hi)``: contiguous runs of integer parent keys, ``hi``
    inclusive.  Null bounds are open; rows without a number or with an empty
    interval give none; overlapping and touching rows become one run."""
    rows = (
        parents.select(company_number(F.col(key)).alias("company"), F.col(since).alias("a"), F.col(until).alias("r"))
        .where(F.col("company").isNotNull())
        .select(
            "company",
            F.coalesce(day(F.col("a")), F.lit(0)).alias("d0"),
            F.coalesce(day(F.col("r")) - 1, F.lit(LAST)).alias("d1"),
        )
        .where("d0 <= d1")
        .distinct()
        .select("company", (F.col("company") * (1 << BITS) + F.col("d0")).alias("lo"), (F.col("company") * (1 << BITS) + F.col("d1")).alias("hi"))
    )
    w = Window.partitionBy("company").orderBy("lo", "hi")
    before = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(before.isNull() | (F.col("lo") > before + 1), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("b", before).withColumn("island", island).groupBy("company", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("company", "lo", "hi")


def _merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Touching runs of neighbouring companies become one."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo)
    lo, hi = lo[order], hi[order]
    first = np.r_[True, lo[1:] > hi[:-1] + 1]
    return lo[first], np.maximum.reduceat(hi, np.flatnonzero(first))


def references(df: DataFrame, name: str, row_id: str, cik: str = "cik", at: str = "filing_date") -> DataFrame:
    """``(tbl, row_id, company, at, k0, k1, digits)``; ``k0 = k1`` is the
    reference's key, ``digits`` those of a number too long for one.  Without a date any day in force will do: ``k0..k1`` spans them."""
    n = company_number(F.col(cik))
    base = n * (1 << BITS)
    d = day(F.col(at))
    return df.select(
        F.lit(name).alias("tbl"),
        F.col(row_id).cast("bigint").alias("row_id"),
        n.alias("company"),
        F.col(at).cast("date").alias("at"),
        (base + F.coalesce(d, F.lit(0))).alias("k0"),
        (base + F.coalesce(d, F.lit(LAST))).alias("k1"),
        F.when(n < 0, company_digits(F.col(cik))).alias("digits"),
    ).where(F.col("company").isNotNull())


def orphans(refs: DataFrame, runs: DataFrame, run_limit: int = RUN_LIMIT) -> DataFrame:
    """The references that match no run: ``(tbl, row_id, at)``.

    Rows without a company number denote nothing and are no orphans; repeated
    rows come out as often as they stand; without parents every reference is
    an orphan.  The runs are broadcast if there are at most ``run_limit`` of
    them, so the references are never moved; else both sides meet by company.
    """
    got = runs.select("lo", "hi").limit(run_limit + 1).toPandas()
    if len(got) > run_limit:
        return _orphans_by_company(refs, runs)
    shared = refs.sparkSession.sparkContext.broadcast(_merged(got["lo"].to_numpy("int64"), got["hi"].to_numpy("int64")))

    @F.pandas_udf("boolean")
    def missing(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        lo, hi = shared.value
        for k0, k1 in batches:
            a, b = k0.to_numpy("int64"), k1.to_numpy("int64")
            at = np.searchsorted(lo, b, side="right") - 1
            yield pd.Series((at < 0) | (hi[at] < a)) if len(lo) else pd.Series(np.ones(len(a), bool))

    return refs.where(missing("k0", "k1")).select("tbl", "row_id", "at")


def _long_parents(parents: DataFrame, key: str, since: str, until: str) -> DataFrame:
    """Days in force of the companies whose numbers only have a stand-in."""
    p = parents.where(company_number(F.col(key)) < 0)
    return p.select(company_digits(F.col(key)).alias("own"), F.col(since).cast("date").alias("a"), F.col(until).cast("date").alias("r")).distinct()


def _long_orphans(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """References with a stand-in, compared by all of their digits."""
    day = F.col("at")
    holds = (F.col("digits") == F.col("own")) & (day.isNull() | F.col("a").isNull() | (F.col("a") <= day)) & (day.isNull() | F.col("r").isNull() | (day < F.col("r")))
    rest = F.col("a").isNull() | F.col("r").isNull() | (F.col("a") < F.col("r"))
    return refs.where("company < 0").join(parents.where(rest), holds, "left_anti").select("tbl", "row_id", "at")


def _orphans_by_company(refs: DataFrame, runs: DataFrame) -> DataFrame:
    """As-of by window over the distinct keys of each company, of which there
    are no more than days, however many rows a company holds."""
    keys = refs.select("company", "k0", "k1").distinct()
    both = keys.select("company", F.col("k1").alias("k"), "k0", F.lit(None).cast("bigint").alias("hi")).unionByName(
        runs.select("company", F.col("lo").alias("k"), F.lit(None).cast("bigint").alias("k0"), "hi")
    )
    w = Window.partitionBy("company").orderBy("k", F.col("hi").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    lost = both.withColumn("end", F.last("hi", ignorenulls=True).over(w)).where(F.col("k0").isNotNull() & (F.col("end").isNull() | (F.col("end") < F.col("k0"))))
    lost = lost.select("company", "k0", F.col("k").alias("k1"))
    return refs.join(lost, ["company", "k0", "k1"], "left_semi").select("tbl", "row_id", "at")


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans per table and calendar quarter of the reference."""
    period = F.concat(F.year("at").cast("string"), F.lit("Q"), F.quarter("at").cast("string"))
    return found.groupBy("tbl", period.alias("period")).agg(F.count(F.lit(1)).alias("orphans"))


def find_orphans(parents: DataFrame, tables: Sequence[tuple[DataFrame, str, str]], run_limit: int = RUN_LIMIT) -> DataFrame:
    """``tables``: (frame, name, id column) of each referring table."""
    runs = parent_runs(parents)
    out = None
    for df, name, row_id in tables:
        one = references(df, name, row_id)
        out = one if out is None else out.unionByName(one)
    if runs.where("company < 0").isEmpty():  # no stand-in can be met by another's
        return orphans(out, runs, run_limit)
    exact = _long_orphans(out, _long_parents(parents, "cik", "added_on", "removed_on"))
    return orphans(out.where("company >= 0"), runs, run_limit).unionByName(exact)
