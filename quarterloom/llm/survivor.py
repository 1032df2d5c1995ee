"""Problem 6: the best representative of each group of duplicates.

Fields are unpivoted to long rows; each filled value is voted for by its row
with source trust times recency decay, the votes of a value are summed, the
value of the largest sum wins (``max_by``) and the fields are pivoted back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quarterloom.functions.companies import company_number
from quarterloom.functions.let import let
from quarterloom.llm.canonical import with_meaning
from quarterloom.session import written

FIELDS = ("item_value", "src_value", "src_units", "src_row", "fpe_date")

# Texts that fill nothing.
PLACEHOLDERS = ("", "n/a", "--", "nm", "not reported")

#: The strongest vote is 2**BITS and each weaker one worth half of the one
#: before, so it outweighs all weaker ones together; sums fit 64 bits.
BITS = 61

#: Groups of more rows, and of more than one row in ten thousand of the whole
#: table, are ranked in salted parts first; there are at most 10,000 of them.
HOT = 10_000
SALTS = 256


def normalised(c: Column) -> Column:
    """Hash of a value as compared between rows, blanks and case apart; null
    if it fills nothing."""
    t = F.lower(F.trim(F.regexp_replace(c.cast("string"), r"\s+", " ")))
    return let(t, lambda v: F.when(v.isNotNull() & ~v.isin(*PLACEHOLDERS), F.xxhash64(v)))


def source() -> Column:
    """Trust in a row's source as one number, less is more: overridden rows
    first, then smaller table rank, then smaller item rank; nulls last."""
    rank = lambda c: F.coalesce(F.col(c).cast("int") + 1000, F.lit((1 << 20) - 1)).cast("bigint")
    own = F.when(F.coalesce("is_overridden", F.lit(False)), 0).otherwise(1).cast("bigint")
    return own * (1 << 40) + rank("table_rank") * (1 << 20) + rank("item_rank")


def vote(stronger: Column, later: Column) -> Column:
    """Source trust times recency decay, an exact integer: ``2**BITS`` halved
    for each row of a more trusted source, and halved again for each later
    row of the same source.  Below one a vote counts nothing."""
    halvings = stronger + later
    trust = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(BITS) - stronger)
    return F.when(halvings <= BITS, F.call_function("shiftright", trust, later)).otherwise(F.lit(0)).cast("bigint")


def keyed(df: DataFrame, refs: DataFrame) -> DataFrame:
    """Rows that can be duplicates - with an id, a company number and an item
    - under a 128-bit hash of their group's key; date, type and link may be
    null and then are alike.  Values are compared by hash, so little moves."""
    key = ["g_company", "g_date", "g_type", "g_href", "g_item"]
    own = ["stmt_id", "cik", "filing_date", "filing_type", "filing_href", "item", "is_overridden", "table_rank", "item_rank", "loaded_at", *FIELDS]
    rows = with_meaning(df.select(*own).where("stmt_id is not null"), refs, "item", "g_item")
    k = rows.select(
        company_number(F.col("cik")).alias("g_company"),
        F.col("filing_date").alias("g_date"),
        F.col("filing_type").alias("g_type"),
        F.col("filing_href").alias("g_href"),
        "g_item",
        "stmt_id",
        source().alias("source"),
        F.coalesce(F.unix_micros(F.col("loaded_at").cast("timestamp")), F.lit(-(1 << 62))).alias("loaded"),
        *[normalised(F.col(f)).alias(f"n_{f}") for f in FIELDS],
    ).where("g_company is not null and g_item > 0")
    null = F.lit("\u0000")
    texts = [F.coalesce(F.col(c).cast("string"), null) for c in key]
    return k.select(F.xxhash64(*texts).alias("h1"), F.xxhash64(F.lit(97), *reversed(texts)).alias("h2"), "stmt_id", "source", "loaded", *[f"n_{f}" for f in FIELDS])


def _window(*keys: str) -> Window:
    return Window.partitionBy(*keys).orderBy(F.col("source"), F.col("loaded").desc(), F.col("stmt_id").desc())


def _long(rows: DataFrame) -> DataFrame:
    """A row per filled field, and one for the row itself."""
    pairs = ", ".join(f"'{f}', n_{f}" for f in FIELDS)
    return rows.select("h1", "h2", "group_id", "stmt_id", "source", "loaded", F.expr(f"stack({len(FIELDS) + 1}, 'row', 0L, {pairs}) as (field, value)")).where("value is not null")


def _elected(long: DataFrame) -> DataFrame:
    """Votes per value, and the value of the largest sum per field.  All
    steps keep the rows of a group together, so none moves again."""
    key = ("h1", "h2", "field")
    w = _window(*key)
    sources = Window.partitionBy(*key).orderBy("source")
    ranked = long.withColumns({"nth": F.row_number().over(w), "stronger": F.rank().over(sources) - 1})
    voted = ranked.withColumn("vote", vote(F.col("stronger"), F.col("nth") - 1 - F.col("stronger")))
    sums = voted.groupBy(*key, "group_id", "value").agg(F.sum("vote").alias("votes"), F.max_by("stmt_id", "vote").alias("from_id"))
    won = sums.groupBy(*key, "group_id").agg(F.max_by("from_id", "votes").alias("from_id"), F.max("votes").alias("votes"))
    return won.select("group_id", "field", "from_id", "votes")


def winners(df: DataFrame, refs: DataFrame) -> DataFrame:
    """``(group_id, field, from_id, votes)``: for each field of each group of
    two or more rows the row that the winning value is taken from, its most
    trusted voter, and the sum of the value's votes.

    Votes halve from row to row in the order of trust, see :func:`vote`; the
    sum of a value's votes is thus the larger, the more trusted its first
    voter is, which is the lexicographic order asked for.

    A field that no row fills gives no row; ties are settled by ``stmt_id``;
    rows without an id, a company number or an item take no part; repeated
    rows count as rows of their group; a table without duplicates gives no
    rows; extra columns are ignored.
    """
    slim = written(keyed(df, refs), "duplicates")
    groups = slim.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("stmt_id").alias("group_id")).where("n > 1")
    limit = max(HOT, slim.count() // 10_000)
    hot = written(groups.where(F.col("n") > limit), "hot-groups").drop("n")
    if hot.isEmpty():
        return _elected(_long(slim.join(groups.drop("n"), ["h1", "h2"])))
    cold = slim.join(groups.where(F.col("n") <= limit).drop("n"), ["h1", "h2"])
    salted = _long(slim.join(F.broadcast(hot), ["h1", "h2"])).withColumn("salt", F.pmod(F.xxhash64("stmt_id"), F.lit(SALTS)))
    # what is not among the first of its part has no vote in the whole
    first = salted.withColumn("nth", F.row_number().over(_window("h1", "h2", "field", "salt"))).where(F.col("nth") <= BITS + 1)
    return _elected(_long(cold)).unionByName(_elected(first.drop("nth", "salt")))


def surviving_records(df: DataFrame, refs: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Pivoted back: one built record per group with ``group_id``, ``row_id``
    and for each field the value of the row it comes from, null if none.
    Values are fetched by one join on the id of the row they come from."""
    w = winners(df, refs).groupBy("group_id", "from_id").agg(F.collect_set("field").alias("won"))
    values = df.where("stmt_id is not null").select(F.col("stmt_id").alias("from_id"), *fields)
    got = w.join(values, "from_id")
    take = lambda f, c: F.first(F.when(F.array_contains("won", f), F.col(c)), ignorenulls=True)
    return got.groupBy("group_id").agg(take("row", "from_id").alias("row_id"), *[take(f, f).alias(f) for f in fields])
