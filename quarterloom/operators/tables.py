"""From the grid of a statement's table to one header row and label columns.

Pure functions on lists of rows of ``str | None``, tested without Spark.
"""

from __future__ import annotations

import re
from itertools import groupby

from quarterloom.functions.grammar import is_header_part, is_units, parse_period
from quarterloom.functions.lexer import HYPHENS

Row = list
Grid = list

_NUMBER = re.compile(r"[$(]?\s*[\d,]+\.?\d*[)%]*")
_BARE_HYPHEN = re.compile(f"[{HYPHENS}]+")


def cell_value(text: str) -> float | None:
    """Number of a cell: hyphen zero, leading bracket negative, no digit
    None, unreadable NaN."""
    bare = re.sub(r"[$%,*]", "", text)
    if _BARE_HYPHEN.fullmatch(bare):
        return 0.0
    if not re.search(r"\d", bare):
        return None
    tight = re.sub(r"\s+", "", bare)
    m = re.match(r"\(([\d.]+)", tight)
    sign = -1.0 if m else 1.0
    m = m or re.search(r"([\d.]+)", tight)
    try:
        return sign * float(m.group(1))
    except ValueError:
        return float("nan")


def is_row_part(cell: str) -> bool:
    t = cell.lower().strip()
    if _NUMBER.fullmatch(t):
        v = cell_value(t)
        return v is not None and not (2000 <= v <= 2050 or 28 <= v <= 31)
    return bool(_BARE_HYPHEN.fullmatch(t))


def _filled(row: Row) -> list[str]:
    return [c for c in row if c]


def is_remark_row(row: Row) -> bool:
    """A row that may stand inside a header but tells no period; a blank one
    does too."""
    cells = _filled(row)
    return all(map(is_units, cells)) or all("unaudited" in c.lower() for c in cells)


def is_header_row(row: Row) -> bool:
    cells = _filled(row)
    return is_remark_row(row) or any(map(is_header_part, cells)) and not any(map(is_row_part, cells))


def has_period(row: Row) -> bool:
    first = "nan" if row[0] is None else row[0]
    return any(parse_period("nan" if c is None else c, first) for c in row[1:])


def split(grid: Grid, prior: Grid | None = None) -> list[Grid]:
    """A table for each block of header rows.  A lone header row must tell a
    period; without one in the first five rows the headers of a table before
    with as many columns are put on top."""
    rows = [r for r in grid if any(c is not None for c in r)]
    if not rows:
        return []
    heads = [is_header_row(r) for r in rows]
    if prior and not any(heads[:5]) and len(prior[0]) == len(rows[0]):
        borrowed = [r for r in prior if is_header_row(r)]
        rows = borrowed + rows
        heads = [True] * len(borrowed) + heads
    starts = [
        i
        for i, head in enumerate(heads)
        if head and (i == 0 or not heads[i - 1]) and (i + 1 == len(rows) or heads[i + 1] or has_period(rows[i]))
    ]
    return [rows[a:b] for a, b in zip(starts, [*starts[1:], len(rows)])]


def _tells(line: Row) -> bool:
    """More than one value, or one that belongs to a header."""
    values = list(dict.fromkeys(c for c in line if c is not None))
    return len(values) > 1 or bool(values) and is_header_part(values[0])


def _columns(grid: Grid) -> list[Row]:
    return [list(c) for c in zip(*grid)]


def _from_columns(columns: list[Row], height: int) -> Grid:
    return [list(r) for r in zip(*columns)] if columns else [[] for _ in range(height)]


def drop_untelling(grid: Grid) -> Grid:
    rows = [r for r in grid if _tells(r)]
    rows = _from_columns([c for c in _columns(rows) if _tells(c)], len(rows))
    rows = [r for r in rows if any(c is not None for c in r)]
    return _from_columns([c for c in _columns(rows) if any(x is not None for x in c)], len(rows))


def merge_twin_columns(grid: Grid) -> Grid:
    """Neighbouring columns that agree wherever both are filled, and in one
    row at least, are one column: a cell that spanned both."""
    out: list[Row] = []
    for col in _columns(grid):
        if out:
            last = out[-1]
            both = [a or b for a, b in zip(last, col)]
            if both == [b or a for a, b in zip(last, col)] and any(a == b for a, b in zip(last, col)):
                out[-1] = both
                continue
        out.append(col)
    return _from_columns(out, len(grid))


def join_cells(a: str, b: str, sep: str) -> str:
    return a if a.endswith(b) else a + sep + b


def merge_header_rows(grid: Grid) -> Grid:
    rows = list(grid)
    while len(rows) > 1:
        inner = rows[1][:-1]
        if not (is_header_row(inner) or not any(inner)):
            break
        if not is_remark_row(inner):
            rows[0] = [join_cells(a, b, " ") for a, b in zip(rows[0], rows[1])]
        del rows[1]
    return rows


def merge_same_header(grid: Grid) -> Grid:
    """Columns from the second on that share a header: a sign beside its
    figure, a closing bracket beside its number."""
    if not grid:
        return grid
    columns = _columns(grid)
    out = columns[:1]
    for col in columns[1:]:
        if len(out) > 1 and out[-1][0] and col[0] in ("", out[-1][0]):
            out[-1] = [join_cells(a, b, "") for a, b in zip(out[-1], col)]
        else:
            out.append(col)
    return _from_columns(out, len(grid))


def clean(grid: Grid) -> Grid:
    """One header row on top, labels in the leading columns; empty if less
    than a label and two columns is left of a wide table."""
    rows = drop_untelling(grid)
    rows = [[re.sub(r"\s+", " ", c or "") for c in r] for r in rows]
    rows = [r for r, _ in groupby(rows)]
    rows = merge_twin_columns(rows)
    top = next((i for i, r in enumerate(rows) if any(is_header_part(c) for c in r[1:])), len(rows))
    rows = merge_same_header(merge_header_rows(rows[top:]))
    wide = max(map(len, grid), default=0)
    return rows if rows and (wide <= 4 or len(rows[0]) > 2) else []
