"""Binding a value inside a Column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` evaluated once: the optimizer would paste a plain
    column expression wherever it is used, until generated code no longer
    compiles."""
    return F.element_at(F.transform(F.array(value), body), 1)
