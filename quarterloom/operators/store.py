"""The store: three tables as DataFrames, their changes as rewrites.

Parquet has no updates, so each change is an expression for the new content,
written beside the old and swapped in; nothing reads the path it overwrites.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CORE = ("cik", "filing_date", "filing_type", "filing_href")
PRIMARY = (*CORE, "item")

# Open bounds of a date range.
START = dt.date(2002, 6, 1)
END = dt.date(2100, 1, 1)

OVERRIDES = ("fpe_date", "fiscal_year", "fiscal_quarter", "fiscal_period", "item_value")


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in pairs])


_S = T.StringType()
COMPANY = _fields(("cik", _S), ("sic", _S), ("sic_description", _S), ("company_name", _S), ("ticker", _S))
LEDGER = _fields(("cik", _S), ("filing_date", T.DateType()), ("filing_type", _S), ("filing_href", _S), ("is_prelim", T.BooleanType()))
STATEMENT = _fields(
    ("cik", _S), ("filing_date", T.DateType()), ("filing_type", _S), ("filing_href", _S),
    ("fpe_date", T.DateType()), ("fiscal_year", T.DecimalType(4, 0)), ("fiscal_quarter", T.DecimalType(1, 0)), ("fiscal_period", _S),
    ("item", _S), ("item_value", T.DecimalType(20, 5)), ("item_rank", T.DecimalType(2, 0)), ("table_rank", T.DecimalType(2, 0)),
    ("src_table", _S), ("src_row", _S), ("src_column", _S), ("src_value", _S), ("src_units", _S), ("is_overridden", T.BooleanType()),
)


def _alike(a: str, b: str, keys: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


def filings_between(ledger: DataFrame, start: dt.date | None = None, end: dt.date | None = None, cik: str | None = None) -> DataFrame:
    out = ledger.where(F.col("filing_date").between(start or START, end or END))
    return out if cik is None else out.where(F.col("cik") == cik)


def unvisited(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed filings but those visited and found to be no statement."""
    seen = ledger.where("is_prelim = false").select(*CORE).distinct()
    return listed.alias("a").join(seen.alias("b"), _alike("a", "b", CORE), "left_anti")


def unloaded(listed: DataFrame, facts: DataFrame) -> DataFrame:
    return listed.alias("a").join(facts.select(*CORE).distinct().alias("b"), _alike("a", "b", CORE), "left_anti")


def absent(table: DataFrame, rows: DataFrame, keys: tuple[str, ...] = CORE) -> DataFrame:
    """One row of ``rows`` for each key that the table does not hold.  The
    table's side is thinned to the batch's keys before anything moves, if the
    optimizer sees that the batch is small."""
    new = rows.dropDuplicates(list(keys))
    held = table.select(*keys).alias("a").join(rows.select(*keys).alias("b"), _alike("a", "b", keys), "left_semi")
    return new.alias("a").join(held.alias("b"), _alike("a", "b", keys), "left_anti")


def insert_if_absent(table: DataFrame, rows: DataFrame, keys: tuple[str, ...] = CORE) -> DataFrame:
    return table.unionByName(absent(table, rows, keys))


def delete_for_reload(facts: DataFrame, cik: str | int, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """Without the company's rows of the range; overridden rows stay."""
    gone = (F.col("cik") == cik) & F.col("filing_date").between(start, end or END) & ~F.coalesce("is_overridden", F.lit(False))
    return facts.where(~F.coalesce(gone, F.lit(False)))


def override(facts: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of ``rows`` replace those of the same primary key and are marked."""
    kept = facts.alias("a").join(rows.select(*PRIMARY).distinct().alias("b"), _alike("a", "b", PRIMARY), "left_anti")
    return kept.unionByName(rows.withColumn("is_overridden", F.lit(True)), allowMissingColumns=True)


def changed(original: DataFrame, edited: DataFrame, keys: tuple[str, ...] = ("filing_date", "item")) -> DataFrame:
    """Original rows with the edited columns where any of them differs; the
    keys are those of one editing session, which knows its company."""
    e = edited.select(*keys, *[F.col(c).alias(f"new_{c}") for c in OVERRIDES]).alias("b")
    j = original.alias("a").join(e, _alike("a", "b", keys)).select("a.*", *[F.col(f"b.new_{c}") for c in OVERRIDES])
    differs = reduce(Column.__or__, [~F.col(f"new_{c}").eqNullSafe(F.col(c)) for c in OVERRIDES])
    return j.where(differs).select(*[F.col(f"new_{c}").alias(c) if c in OVERRIDES else F.col(c) for c in original.columns])


def discard(facts: DataFrame, ledger: DataFrame, cik: str | int, day: dt.date) -> tuple[DataFrame, DataFrame]:
    """A filing day that holds no statement after all: its facts go, its
    ledger rows are marked."""
    hit = F.coalesce((F.col("cik") == cik) & (F.col("filing_date") == F.lit(day)), F.lit(False))
    return facts.where(~hit), ledger.withColumn("is_prelim", F.when(hit, F.lit(False)).otherwise(F.col("is_prelim")))


def high_water_mark(facts: DataFrame, start: dt.date = START) -> DataFrame:
    """Latest filing date per company, ``start`` where there is none."""
    return facts.groupBy("cik").agg(F.coalesce(F.max("filing_date"), F.lit(start)).alias("since"))


def persistable(df: DataFrame) -> DataFrame:
    """Timestamps become dates, NaN becomes null."""
    out = []
    for n, t in df.dtypes:
        c = F.col(f"`{n}`")
        out.append((F.to_date(c) if t.startswith("timestamp") else F.when(~F.isnan(c), c) if t in ("double", "float") else c).alias(n))
    return df.select(*out)


class Store:
    """Tables under one folder.

    ``replace`` writes the new content aside and swaps it in by two renames;
    whoever opens the table after a crash between them finishes the swap, so
    a table is always there as it was before or after.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _there(self, name: str) -> bool:
        return self._fs.exists(self._path(self._at(name)))

    def _rename(self, a: str, b: str) -> None:
        self._fs.rename(self._path(self._at(a)), self._path(self._at(b)))

    def _recover(self, name: str) -> None:
        """Ends a swap that was cut short: the new content if it is whole,
        else the old."""
        if self._there(name):
            return
        if self._there(f"{name}.new/_SUCCESS"):
            self._rename(f"{name}.new", name)
        elif self._there(f"{name}.old"):
            self._rename(f"{name}.old", name)

    def exists(self, name: str) -> bool:
        self._recover(name)
        return self._there(name)

    def create(self, name: str, schema: T.StructType) -> None:
        if not self.exists(name):
            self.spark.createDataFrame([], schema).write.parquet(self._at(name))

    def read(self, name: str) -> DataFrame:
        self._recover(name)
        return self.spark.read.parquet(self._at(name))

    def append(self, name: str, df: DataFrame) -> None:
        self._recover(name)
        df.write.mode("append").parquet(self._at(name))

    def replace(self, name: str, df: DataFrame) -> None:
        """``df`` may read the table it replaces."""
        self._recover(name)
        df.write.mode("overwrite").parquet(self._at(f"{name}.new"))
        self._fs.delete(self._path(self._at(f"{name}.old")), True)
        if self._there(name):
            self._rename(name, f"{name}.old")
        self._rename(f"{name}.new", name)
        self._fs.delete(self._path(self._at(f"{name}.old")), True)

    def save_companies(self, df: DataFrame) -> None:
        """The company dimension, truncated and loaded anew."""
        self.replace("company", df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in COMPANY.fields]))
