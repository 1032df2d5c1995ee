"""Table scan: every cell of every table of HTML texts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quarterloom.operators.tables import clean, split
from quarterloom.sources.html import parse


def cells(pages: DataFrame, key: str, html: str = "html", cleaned: bool = False) -> DataFrame:
    """``(key, table_no, row_no, col_no, cell)``; with ``cleaned`` the tables
    are split at their headers and cleaned first.  Tables that hold tables
    are passed over; pages without one do not reach Python."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, text in zip(b["k"], b["html"]):
                prior, n = None, 0
                for table in parse(text).walk("table"):
                    if table.has("table"):
                        continue
                    grid = table.grid()
                    parts = [grid]
                    if cleaned:
                        raw = split(grid, prior)
                        prior = raw[-1] if raw else prior
                        parts = [clean(p) for p in raw]
                    for part in parts:
                        out += [(k, n, i, j, c) for i, r in enumerate(part) for j, c in enumerate(r)]
                        n += 1
            yield pd.DataFrame(out, columns=["k", "table_no", "row_no", "col_no", "cell"])

    kind = dict(pages.dtypes)[key]
    some = pages.where(F.lower(F.col(html)).contains("<table")).select(F.col(key).alias("k"), F.col(html).alias("html"))
    return some.mapInPandas(run, f"k {kind}, table_no int, row_no int, col_no int, cell string").withColumnRenamed("k", key)


def text_blocks(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """``(key, block_no, text)``: the text parts of each page in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(k, i, t) for k, h in zip(b["k"], b["html"]) for i, t in enumerate(parse(h).texts())]
            yield pd.DataFrame(out, columns=["k", "block_no", "text"])

    kind = dict(pages.dtypes)[key]
    some = pages.where(F.col(html).isNotNull()).select(F.col(key).alias("k"), F.col(html).alias("html"))
    return some.mapInPandas(run, f"k {kind}, block_no int, text string").withColumnRenamed("k", key)
