"""Filings to item values: titles, units, tables, items.

One call per submission, since a table may borrow the header of the table
before it; submissions are independent, so no shuffle is needed until the
best value per item is chosen.  A submission that cannot be read gives a row
with ``error`` instead of failing the job.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from quarterloom.functions import periods
from quarterloom.functions.grammar import SPELLINGS, Spelling, is_units, parse_period, scale_of
from quarterloom.functions.labels import ITEMS, Item, Label, is_label
from quarterloom.functions.lexer import Phrase
from quarterloom.functions.text import KEPT
from quarterloom.functions.titles import STOPS, TITLES, Title, ends_search, title_rank
from quarterloom.operators.tables import Grid, cell_value, clean, split
from quarterloom.sources.html import Node, parse

#: Values of this size are not believed.
IMPOSSIBLE = 1e12
# How far a title is looked for.
PREVIOUS, PARENTS, TABLES = 15, 50, 2

ROW = (
    "item string, item_rank int, item_value double, fiscal_period string, table_rank int, "
    "src_table string, src_row string, src_column string, src_value string, src_units string"
)
NAMES = [p.split()[0] for p in ROW.split(", ")]


def plain(text: str | None) -> str | None:
    if not text:
        return text
    t = unicodedata.normalize("NFD", text).encode("ascii", "ignore").decode()
    return re.sub(r"\s+", " ", t)[:KEPT]


@dataclass(frozen=True)
class Rules:
    """What is looked for: items and their labels, titles, texts that end the
    search for a title, and spellings of a quarter."""

    items: tuple[Item, ...] = ITEMS
    titles: tuple[Title, ...] = TITLES
    stops: tuple[Phrase, ...] = STOPS
    spellings: tuple[Spelling, ...] = SPELLINGS


RULES = Rules()


def _around(table: Node, stop_after: str | None = None, stops: tuple[Phrase, ...] = ()) -> Iterator[str]:
    """Texts of the table and then of what stands before it, nearest first.

    The search ends before an excluded text's element, behind the second
    table met, and at the next table once ``stop_after`` was met.
    """
    left = TABLES
    for own in (True, False):
        left = TABLES
        for node in [table] if own else table.before(PARENTS, PREVIOUS):
            tabular = node.name == "table" or node.has("table")
            if left <= 0 and tabular:
                return
            texts = list(node.texts())
            if stops and any(ends_search(t, stops) for t in texts):
                return
            yield from texts
            if stop_after is not None and stop_after in texts:
                left = 0
            if tabular:
                left -= 1
                if left <= 0:
                    return


def find_title(table: Node, cik: str = "", rules: Rules = RULES) -> tuple[str, int] | None:
    """The best title of a table and its rank."""
    best: tuple[str, int] | None = None
    for text in _around(table, stops=rules.stops):
        rank = title_rank(text, cik, rules.titles)
        if rank is not None and (best is None or rank < best[1]):
            best = text, rank
    return best


def find_units(table: Node, title: str) -> tuple[str | None, float]:
    """The first text that tells units between the table and its title."""
    for text in _around(table, stop_after=title):
        if is_units(text):
            return text, scale_of(text)
    return None, 1.0


def tables_of(documents: Sequence[str], cik: str, rules: Rules = RULES) -> list[tuple[int, str, Node, Grid]]:
    """``(rank, title, node, cleaned grid)`` of the relevant tables, best
    title first and otherwise in document order."""
    out = []
    prior: Grid | None = None
    for html in documents:
        if "<table" not in html.lower():
            continue
        for table in parse(html).walk("table"):
            if table.has("table") or (title := find_title(table, cik, rules)) is None:
                continue
            for part in split(table.grid(), prior):
                out.append((title[1], title[0], table, clean(part)))
                prior = part
    return sorted(out, key=lambda t: t[0])


def period_columns(header: Sequence[str], spellings: tuple[Spelling, ...] = SPELLINGS) -> list[tuple[int, str]]:
    """Columns that tell a period, latest first; among equals the better
    rule, then the leftmost."""
    found = [(i, p) for i, c in enumerate(header) if i and (p := parse_period(c, header[0], spellings))]
    order = sorted(found, key=lambda x: (x[1][0], x[1][1]), reverse=True)
    return [(i, p[0]) for i, p in order]


def _pick(grid: Grid, wanted: Label, columns: list[tuple[int, str]]) -> tuple[str, str, str, float, str] | None:
    """Leftmost label column, latest period, topmost row with a number."""
    for label in range(min(c for c, _ in columns)):
        rows = [r for r in grid if is_label(r[label], wanted)]
        for col, period in columns:
            for r in rows:
                v = cell_value(r[col])
                if v is not None:
                    return r[label], grid[0][col], r[col], v, period
    return None


def items_of(table: tuple[int, str, Node, Grid], rules: Rules = RULES) -> Iterator[tuple]:
    rank, title, node, grid = table
    columns = period_columns(grid[0], rules.spellings) if grid else []
    if not columns:
        return
    units, scale = find_units(node, title)
    for item in rules.items:
        hits = ((n, hit) for n, label in enumerate(item.labels) if (hit := _pick(grid, label, columns)))
        n, hit = next(hits, (0, None))
        if hit is None:
            continue
        row, column, text, value, period = hit
        own = units
        if not item.per_share:
            value *= scale
            if scale == 1.0 and abs(value) < item.least:
                value, own = value * 1e3, "inferred: thousands"
        kept = value if not math.isnan(value) and abs(value) < IMPOSSIBLE else None
        yield item.name, n, kept, period, rank, plain(title), plain(row), plain(column), plain(text), plain(own)


def extract(submissions: DataFrame, key: Sequence[str] = ("submission",), rules: Rules = RULES) -> DataFrame:
    """All candidate values of each submission: ``key`` columns, the columns
    of ``ROW`` and ``error``.  Needs ``cik`` and ``documents`` (HTML texts);
    submissions without a table do not reach Python."""
    with_tables = submissions.where(F.exists("documents", lambda d: F.lower(d).contains("<table")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                own = tuple(getattr(r, k) for k in key)
                try:
                    for t in tables_of([d for d in r.documents if d is not None], r.cik or "", rules):
                        rows += [(*own, *x, None) for x in items_of(t, rules)]
                except Exception as e:  # noqa: BLE001 - one filing must not fail the rest
                    rows.append((*own, *[None] * len(NAMES), f"{type(e).__name__}: {e}"[:KEPT]))
            yield pd.DataFrame(rows, columns=[*key, *NAMES, "error"]).astype({"item_rank": "Int64", "table_rank": "Int64"})

    kinds = dict(submissions.dtypes)
    head = ", ".join(f"`{k}` {kinds[k]}" for k in key)
    return with_tables.select(*dict.fromkeys([*key, "cik", "documents"])).mapInPandas(run, f"{head}, {ROW}, error string")


def best_items(found: DataFrame, key: Sequence[str] = ("submission",)) -> DataFrame:
    """The value of least (table rank, item rank) per item of a submission."""
    last = F.lit(1 << 20)
    order = F.struct(F.coalesce("table_rank", last), F.coalesce("item_rank", last), F.col("fiscal_period"), F.col("src_row"), F.col("src_value"))
    rest = [n for n in NAMES if n != "item"]
    best = found.where("error is null").groupBy(*key, "item").agg(F.min_by(F.struct(*rest), order).alias("b"))
    return best.select(*key, "item", "b.*")


def filing_rows(best: DataFrame, report_period: Column, fye: Column) -> DataFrame:
    """Stored form: quarter-to-date headings resolved against the filing's
    own period, year and quarter split off, period end of the item."""
    period = periods.resolve_quarter_to_date(F.col("fiscal_period"), report_period)
    out = best.withColumn("fiscal_period", period)
    quarter = F.substring("fiscal_period", 6, 1).try_cast("int")
    return out.withColumns(
        {
            "fiscal_year": F.substring("fiscal_period", 1, 4).try_cast("int"),
            "fiscal_quarter": quarter,
            "fpe_date": periods.item_fpe(fye, quarter),
            "is_overridden": F.lit(False),
        }
    )


def only_current_reports(filings: DataFrame) -> DataFrame:
    """Amendments and other forms are listed but not extracted."""
    return filings.where(F.upper("filing_type") == "8-K")
