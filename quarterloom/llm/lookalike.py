"""Problem 2: visually identical text written with different characters.

``plain_form`` maps one value; ``plain_forms`` is the DataFrame operator: the
distinct suspicious values are mapped, grouped in SQL under the accent- and
case-sensitive collation ``UNICODE`` (canonical equivalents and invisible
characters fall together), the smallest mapped member of each class becomes
its canonical spelling and is joined back to the cells.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from quarterloom.joins import join_values
from quarterloom.session import written

# Letters of other scripts that look like a Latin letter.
LOOKALIKES = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "ү": "y", "Ӏ": "I", "Ԍ": "G",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
    # Armenian
    "օ": "o", "Օ": "O", "ս": "u", "հ": "h", "ց": "g", "զ": "q",
    # Latin letters drawn like another one
    "ɑ": "a", "ɡ": "g", "ɩ": "i", "ᴏ": "o", "ᴄ": "c", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s",
}

#: Signs that compatibility folding would change although they look different.
KEEP = re.compile("[¹²³⁰-⁹ºª½¼¾™℠…№″′‴´¨¯¸·]")

SUSPICIOUS = r"[^\x20-\x7E]"


def _script(ch: str) -> str:
    return unicodedata.name(ch, "?").split(" ", 1)[0]


def _fold(ch: str) -> str:
    """One character without regard to its neighbours; '' if invisible."""
    o = ord(ch)
    if 0x20 <= o < 0x7F:
        return ch
    cat = unicodedata.category(ch)
    if ch.isspace() or cat in ("Zs", "Zl", "Zp") or ch in "⠀ㅤﾠᅟᅠ":
        return " "
    if cat in ("Cf", "Cc") or ch == "͏" or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF or 0x180B <= o <= 0x180F:
        return ""
    if KEEP.match(ch):
        return ch
    folded = unicodedata.normalize("NFKC", ch)
    # full-width forms, ligatures and mathematical letters show plain ones
    if folded != ch and all(0x20 < ord(x) < 0x7F for x in folded):
        return folded
    return ch


RUN = re.compile(r"(?:[^\W\d_]|[̀-ͯ])+")


def plain_form(text: str | None) -> str | None:
    """The plain form of what ``text`` shows.

    Ordinary Latin letters, digits and signs; accents precomposed; every blank
    U+0020; nothing invisible.  A word is mapped letter by letter unless it is
    a real word of another script: one without any Latin letter that holds a
    letter no Latin letter looks like, or a word of look-alikes only that
    stands next to such a word of its script.  Null stays null, '' stays ''.
    Letter case, repeated blanks, misspellings and signs such as ’ – — ¹ are
    left alone.  Idempotent.
    """
    if text is None or text.isascii() and text.isprintable():
        return text
    t = unicodedata.normalize("NFC", "".join(map(_fold, text)))
    if t.isascii():
        return t
    runs = list(RUN.finditer(t))
    kinds: list[str] = []  # '' Latin or mixed, 'real:SCRIPT', 'like:SCRIPT'
    for m in runs:
        letters = [c for c in m.group() if c.isalpha()]
        scripts = {_script(c) for c in letters}
        if not letters or "LATIN" in scripts:
            kinds.append("")
        elif all(c in LOOKALIKES for c in letters):
            kinds.append("like:" + min(scripts))
        else:
            kinds.append("real:" + min(scripts))
    out, at = [], 0
    for i, m in enumerate(runs):
        kind = kinds[i]
        around = kinds[max(0, i - 1) : i] + kinds[i + 1 : i + 2]
        foreign = kind.startswith("real") or (kind.startswith("like") and "real" + kind[4:] in around)
        word = m.group()
        if not foreign:
            word = "".join(LOOKALIKES.get(c, c) for c in word)
        out += [t[at : m.start()], word]
        at = m.end()
    return unicodedata.normalize("NFC", "".join(out) + t[at:])


def canonical_values(values: DataFrame) -> DataFrame:
    """``value`` -> ``canonical``, besides the other columns, for a frame of
    distinct non-null values; each is mapped once.

    UNICODE: accents and case count, canonical equivalents and ignorable
    characters do not; the class is formed after mapping.
    """
    rest = [c for c in values.columns if c != "value"]
    kinds = dict(values.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(mapped=[plain_form(v) for v in b["value"]])[["value", "mapped", *rest]]

    mapped = values.mapInPandas(run, ", ".join(["value string", "mapped string", *[f"`{c}` {kinds[c]}" for c in rest]]))
    member = F.min("mapped").over(Window.partitionBy(F.expr("collate(mapped, 'UNICODE')")))
    return mapped.select("value", member.alias("canonical"), *rest)


def plain_cells(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """``(key, field, value, plain)`` for every cell, nulls included."""
    pairs = ", ".join(f"'{f}', `{f}`" for f in fields)
    cells = df.select(F.col(key), F.expr(f"stack({len(fields)}, {pairs}) as (field, value)"))
    odd = F.col("value").rlike(SUSPICIOUS)
    plain = cells.where(~F.coalesce(odd, F.lit(False))).withColumn("plain", F.col("value"))
    return plain.unionByName(_odd_cells(cells.where(odd)))


def odd_cells(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """``(key, field, value, plain)`` of the cells with other than printable
    ASCII characters; all other cells are their own plain form."""
    pairs = ", ".join(f"'{f}', `{f}`" for f in fields)
    cells = df.select(F.col(key), F.expr(f"stack({len(fields)}, {pairs}) as (field, value)"))
    return _odd_cells(cells.where(F.col("value").rlike(SUSPICIOUS)))


def _odd_cells(odd: DataFrame) -> DataFrame:
    """One spelling may fill a third of all cells: hot ones are joined where
    they lie."""
    values = odd.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    canon = written(canonical_values(values), "plain-forms")
    return join_values(odd, canon, ["value"]).select(odd.columns[0], "field", "value", F.col("canonical").alias("plain"))


def lookalike_cells(df: DataFrame, key: str = "stmt_id", fields: Sequence[str] = ("src_row", "src_table", "src_column")) -> DataFrame:
    """``(key, field)`` of the cells whose characters differ from their plain
    form.  Null, empty and plain cells are no cases; repeated rows come out
    as often as they stand; an empty table gives no rows."""
    return odd_cells(df, key, fields).where(F.col("value") != F.col("plain")).select(key, "field")
