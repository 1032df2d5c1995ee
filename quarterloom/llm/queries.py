"""Queries of the text problems (2, 3, 6, 7, 8 and 9) over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarterloom.llm import bpe, canonical, lookalike, packing, spans, survivor
from quarterloom.session import spread, table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.lookalike_cells(table(spark, d, "prelim_statement"))


def p2_plain(spark: SparkSession, d: str) -> DataFrame:
    """Every cell in its plain form."""
    cells = lookalike.plain_cells(table(spark, d, "prelim_statement"), "stmt_id", ("src_row", "src_table", "src_column"))
    return cells.select("stmt_id", "field", "plain")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.canonical_cells(spread(table(spark, d, "prelim_statement")), table(spark, d, "ref_label"))


def p3_misses(spark: SparkSession, d: str) -> DataFrame:
    return canonical.misses(spread(table(spark, d, "prelim_statement")), table(spark, d, "ref_label"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.winners(spread(table(spark, d, "prelim_statement")), table(spark, d, "ref_label")).select("group_id", "field", "from_id")


def p6_records(spark: SparkSession, d: str) -> DataFrame:
    return survivor.surviving_records(table(spark, d, "prelim_statement"), table(spark, d, "ref_label"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.token_ids(spread(table(spark, d, "documents")))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.containers(spread(table(spark, d, "documents")))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(packing.containers(spread(table(spark, d, "documents"))))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_pairs(spread(table(spark, d, "documents")))


def p9_minima(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of p9_found by the anchors taken where there are too many
    blocks for the bitmap."""
    return spans.shared_pairs(spread(table(spark, d, "documents")), block_limit=0)


def p9_classes(spark: SparkSession, d: str) -> DataFrame:
    """Class of copies and number of links of every document."""
    return spans.class_links(spread(table(spark, d, "documents")))


def p9_shared(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_of_all(spread(table(spark, d, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (p2_found, p2_plain, p3_found, p3_misses, p6_found, p6_records, p7_ids, p8_containers, p8_fill, p9_found, p9_minima, p9_classes, p9_shared)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {}
