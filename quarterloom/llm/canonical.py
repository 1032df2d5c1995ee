"""Problem 3: mapping freely entered values to a canonical list.

The reference list is built into a symmetric-delete dictionary by the driver
and broadcast; its size is checked, a longer list is built and broadcast in
pieces of bounded size.  Each cell is reduced to its plain form, numbering,
notes, remarks and company names around the label are set aside, and the rest
is matched by :class:`~quarterloom.llm.fuzzy.PhraseMatcher`: weighted
Damerau-Levenshtein, ties by how often the entry is used exactly.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quarterloom.joins import join_values
from quarterloom.llm.fuzzy import PhraseMatcher, Rank, tokens
from quarterloom.llm.lookalike import plain_form
from quarterloom.session import written

#: Entries in one broadcast piece of the reference list: some 400,000 keys of
#: the dictionary, well below 100 MB.
PIECE = 5_000

# Words that make a part of a text a company's name.
CORPORATE = frozenset(
    ["corp", "corporation", "incorporated", "company", "bank", "bancorp", "bancorporation", "bancshares", "bankshares", "group", "holding", "holdings", "trust", "ltd", "llc", "plc"]
)

# Remarks around a label.
REMARKS = frozenset(
    ["unaudited", "audited", "continued", "contd", "cont", "as reported", "as restated", "restated", "as adjusted", "reported", "less", "memo", "add", "plus", "of which", "see notes", "see accompanying notes", "preliminary", "pro forma"]
)

NUMBERING = re.compile(r"^\s*(?:(?:table|exhibit|ex|schedule|note|item|annex|appendix)\b\.?\s*(?:[0-9]+(?:\.[0-9]+)*|[ivx]+\b|[a-z]\b)\s*[:.)\-–—]*|\(?[0-9]{1,3}(?:\.[0-9]+)*[.):]|[-–—•*·]+(?=\s|\w))\s*", re.I)
NOTE_MARK = re.compile(r"\(\s*(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})\s*\)|\[\s*(?:[0-9]{1,2}|[a-z])\s*\]|[*†‡§¹²³⁴-⁹]+", re.I)
BRACKET = re.compile(r"\(([^()]*)\)")
CURRENCY = re.compile(r"\s(?:US\$|USD)$")
SEPARATOR = re.compile(r"\s+[-–—/|]\s+|\s*[–—|]\s*|\s*[/:;,]\s+|\s*,\s*$")


def _words(text: str) -> str:
    return " ".join(tokens(text))


def _is_remark(part: str) -> bool:
    w = _words(part)
    return not w or w in REMARKS or w.replace(" ", "") in ("unaudited", "continued", "contd", "asreported")


def _is_company(part: str) -> bool:
    ws = tokens(part)
    return any(w in CORPORATE for w in ws) or ws in (["inc"], ["co"])


FOREIGN = re.compile(r"[^\W\d_]+")


def _drop_foreign(text: str) -> str:
    """Words written in another script are set aside."""
    return FOREIGN.sub(lambda m: m.group() if any(c < "ɐ" for c in m.group()) else " ", text)


def undecorated(text: str) -> str:
    """Without numbering, note marks, remarks in brackets and trailers."""
    t = NOTE_MARK.sub(" ", text)
    t = BRACKET.sub(lambda m: " " if _is_remark(m.group(1)) else m.group(), t)
    for _ in range(3):
        u = CURRENCY.sub("", NUMBERING.sub("", t).rstrip(" .:$;,"))
        if u == t:
            break
        t = u
    return t.strip()


class Parts(NamedTuple):
    """What a cell may stand for: its text, then its parts without remarks
    and without company names put together, and these parts."""

    texts: list[str]
    rest: list[str]


def parts_of(text: str) -> Parts:
    t = undecorated(_drop_foreign(plain_form(text) or ""))
    kept = [p for p in (undecorated(x) for x in SEPARATOR.split(t) if x) if not _is_remark(p)]
    rest = [p for p in kept if not _is_company(p)]
    texts = [t]
    for ps in (kept, rest):
        joined = ", ".join(ps)
        if ps and joined not in texts:
            texts.append(joined)
    return Parts(texts, rest)


Ask = Callable[[str], Rank | None]


def decide(parts: Parts, words: Ask, letters: Ask) -> tuple[int, float]:
    """``(ref_id, cost)`` from what the single texts mean, ``(0, inf)`` for
    nothing."""
    best = words(parts.texts[0])
    if best and best[0] <= 1.0:
        return best[2], best[0]
    tries = [best, *map(words, parts.texts[1:])]
    if len(parts.rest) > 1:  # a text in two languages means what its parts mean
        own = [words(p) for p in parts.rest]
        if all(own) and len({r[2] for r in own}) == 1:
            tries.append(max(own))
    found = min((r for r in tries if r), key=lambda r: (r[0], r[2]), default=None) or letters(parts.texts[-1])
    return (found[2], found[0]) if found else (0, float("inf"))


def _remembered(f: Callable, most: int = 300_000) -> Callable:
    """A cache, never a limit on the result; not sent along when pickled."""
    got: dict = {}

    def ask(text: str):
        if text not in got:
            if len(got) > most:
                got.clear()
            got[text] = f(text)
        return got[text]

    return ask


class Meaning:
    """The entry a cell of one field means; cached by text."""

    def __init__(self, entries: dict[int, str], weight: dict[int, float] | None = None):
        self.matcher = PhraseMatcher(entries, weight)
        self._remember()

    def _remember(self) -> None:
        words, letters = _remembered(self.matcher.by_words), _remembered(self.matcher.by_letters)
        self._find = _remembered(lambda text: (self.matcher.exact[text], 0.0) if text in self.matcher.exact else decide(parts_of(text), words, letters))

    def __getstate__(self) -> PhraseMatcher:
        return self.matcher

    def __setstate__(self, matcher: PhraseMatcher) -> None:
        self.matcher = matcher
        self._remember()

    def __call__(self, text: str | None) -> tuple[int, float]:
        """``(ref_id, cost)``, ``(0, inf)`` for a text that means no entry."""
        return (0, float("inf")) if text is None else self._find(text)


def reference_frequency(df: DataFrame, refs: DataFrame, fields: Sequence[str], short: bool) -> DataFrame:
    """``refs`` with ``uses``: how many cells are the label itself."""
    labels = refs.select("field", "label").distinct()
    counts = _cells(df, fields).join(F.broadcast(labels) if short else labels, ["field", "label"], "left_semi").groupBy("field", "label").agg(F.count(F.lit(1)).alias("uses"))
    return refs.join(counts, ["field", "label"], "left").select("ref_id", "field", "label", F.coalesce("uses", F.lit(0)).alias("uses"))


def _cells(df: DataFrame, fields: Sequence[str], *keys: str) -> DataFrame:
    """A row per filled cell: ``field``, ``label`` and any key columns."""
    pairs = ", ".join(f"'{f}', cast(`{f}` as string)" for f in fields)
    return df.select(*[F.col(k) for k in keys], F.expr(f"stack({len(fields)}, {pairs}) as (field, label)")).where("label <> ''")


def _entries(refs: DataFrame) -> DataFrame:
    return refs.where("ref_id is not null and field is not null and label is not null")


def meanings(rows: list[tuple]) -> dict[str, Meaning]:
    """Matchers by field, from rows ``(ref_id, field, label, uses)``."""
    by: dict[str, list[tuple]] = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    return {f: Meaning({r[0]: r[2] for r in own}, {r[0]: float(r[3]) for r in own}) for f, own in by.items()}


def match_cells(df: DataFrame, refs: DataFrame, key: str = "stmt_id", fields: Sequence[str] = ("item", "src_row", "src_table")) -> DataFrame:
    """``(key, field, ref_id, cost, exact)`` for each filled cell.

    ``ref_id`` is 0 for an unmatched cell.  Null and empty cells do not come
    out; repeated rows come out as often as they stand; with an empty
    reference list every cell is unmatched; entries without id, field or label
    are left out.  With a list of one piece values are matched where they
    lie, each distinct one once per worker, so a spelling that fills a third
    of the table moves nothing; with a longer one distinct values are matched
    and joined back.  Both give the same rows.
    """
    refs = _entries(refs).where(F.col("field").isin(*fields))
    short = refs.limit(PIECE + 1).count() <= PIECE
    ranked = reference_frequency(df, refs, fields, short)
    if short:
        return _match_in_place(df, meanings([tuple(r) for r in ranked.collect()]), key, fields)
    return _match_in_pieces(df, written(ranked, "references"), key, fields)


_NOBODY = Meaning({})


def _match_in_place(df: DataFrame, means: dict[str, Meaning], key: str, fields: Sequence[str]) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(means)
    names = list(fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for f in names:
                mean = shared.value.get(f, _NOBODY)
                col = b[f]
                keep = col.notna() & (col != "")
                codes, values = pd.factorize(col[keep])
                if not len(values):
                    continue
                found = [mean(v) for v in values]
                exact = [v in mean.matcher.exact for v in values]
                take = lambda xs: pd.Series(xs).take(codes).to_numpy()
                yield pd.DataFrame({key: b[key][keep].to_numpy(), "field": f, "ref_id": take([i for i, _ in found]), "cost": take([c for _, c in found]), "exact": take(exact)})

    kind = dict(df.dtypes)[key]
    schema = f"`{key}` {kind}, field string, ref_id bigint, cost double, exact boolean"
    cells = [F.col(f).cast("string").alias(f) for f in names]
    if kind != "bigint":
        return df.select(key, *cells).mapInPandas(run, schema)
    # pandas would turn a column of ids with a null into floats
    none = F.lit(-(1 << 63))
    rows = df.select(F.coalesce(F.col(key), none).alias(key), *cells).mapInPandas(run, schema)
    return rows.withColumn(key, F.nullif(F.col(key), none))


_RANK = "struct<cost:double,less:double,id:bigint>"


def answers(asked: DataFrame, ranked: DataFrame) -> DataFrame:
    """``(field, text, words, letters)``: the closest entry of each text over
    all pieces of the reference list, one piece in memory at a time."""
    spark = asked.sparkSession
    pieces = -(-ranked.count() // PIECE)
    out = None
    for i in range(pieces):
        rows = [tuple(r) for r in ranked.where(F.pmod(F.xxhash64("ref_id", "field"), F.lit(pieces)) == i).toLocalIterator()]
        shared = spark.sparkContext.broadcast(meanings(rows))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            as_dict = lambda r: None if r is None else {"cost": r[0], "less": r[1], "id": r[2]}
            for b in batches:
                known = [shared.value.get(f, _NOBODY).matcher for f in b["field"]]
                words = [as_dict(m.by_words(t)) for m, t in zip(known, b["text"])]
                letters = [as_dict(m.by_letters(t)) for m, t in zip(known, b["text"])]
                yield pd.DataFrame({"field": b["field"], "text": b["text"], "words": words, "letters": letters}, dtype=object)

        one = asked.mapInPandas(run, f"field string, text string, words {_RANK}, letters {_RANK}")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("field", "text").agg(F.min("words").alias("words"), F.min("letters").alias("letters"))


def _match_in_pieces(df: DataFrame, ranked: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    cells = _cells(df, fields, key)
    values = written(cells.groupBy("field", "label").agg(F.count(F.lit(1)).alias("n")), "values")

    @F.pandas_udf("array<string>")
    def texts(s: pd.Series) -> pd.Series:
        return pd.Series([[*p.texts, *p.rest] for p in map(parts_of, s)])

    asked = written(values.select("field", "label", F.explode(F.array_distinct(texts("label"))).alias("text")), "texts")
    found = answers(asked.select("field", "text").distinct(), ranked)
    exact = ranked.groupBy("field", "label").agg(F.min("ref_id").alias("own"))
    told = asked.join(found, ["field", "text"]).groupBy("field", "label").agg(F.collect_list(F.struct("text", "words", "letters")).alias("told"))
    whole = told.join(values, ["field", "label"]).join(exact, ["field", "label"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, costs = [], []
            for label, rows in zip(b["label"], b["told"]):
                rank = lambda r: None if r is None else (r["cost"], r["less"], int(r["id"]))
                by = {r["text"]: (rank(r["words"]), rank(r["letters"])) for r in rows}
                i, c = decide(parts_of(label), lambda t: by[t][0], lambda t: by[t][1])
                ids.append(i)
                costs.append(c)
            yield pd.DataFrame({"field": b["field"], "label": b["label"], "n": b["n"], "own": b["own"], "id": ids, "c": costs})

    decided = whole.mapInPandas(run, "field string, label string, n bigint, own double, id bigint, c double")
    own = F.col("own").isNotNull()
    result = decided.select("field", "label", "n", F.when(own, F.col("own").cast("bigint")).otherwise(F.col("id")).alias("ref_id"), F.when(own, F.lit(0.0)).otherwise(F.col("c")).alias("cost"), own.alias("exact"))
    return join_values(cells, written(result, "meanings"), ["field", "label"]).select(key, "field", "ref_id", "cost", "exact")


def with_meaning(df: DataFrame, refs: DataFrame, field: str, out: str) -> DataFrame:
    """``df`` with the entry that its column ``field`` means, 0 for none; null
    and empty cells mean none."""
    refs = _entries(refs).where(F.col("field") == field)
    short = refs.limit(PIECE + 1).count() <= PIECE
    ranked = reference_frequency(df, refs, [field], short)
    if short:
        shared = df.sparkSession.sparkContext.broadcast(meanings([tuple(r) for r in ranked.collect()]))

        @F.pandas_udf("bigint")
        def meaning(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            mean = shared.value.get(field, _NOBODY)
            for s in batches:
                codes, values = pd.factorize(s)
                ids = [mean(v)[0] for v in values]
                yield pd.Series([ids[k] if k >= 0 else 0 for k in codes], dtype="int64")

        return df.withColumn(out, meaning(F.col(field).cast("string")))
    values = df.groupBy(field).agg(F.count(F.lit(1)).alias("n"))
    keyed = written(values.where(f"`{field}` is not null").withColumn("nth", F.monotonically_increasing_id()), "spellings")
    found = _match_in_pieces(keyed, written(ranked, "references"), "nth", [field])
    told = keyed.join(found.select("nth", "ref_id"), "nth").select(field, F.col("ref_id").alias(out), "n")
    none = df.where(F.coalesce(F.col(field).cast("string"), F.lit("")) == "").withColumn(out, F.lit(0).cast("bigint"))
    return join_values(df, written(told, "told"), [field]).select(*df.columns, out).unionByName(none)


def canonical_cells(df: DataFrame, refs: DataFrame, key: str = "stmt_id", fields: Sequence[str] = ("item", "src_row", "src_table")) -> DataFrame:
    """``(key, field, ref_id)`` of the filled cells that are no label as they
    stand; ``ref_id`` 0 if the cell means no entry."""
    return match_cells(df, refs, key, fields).where(~F.col("exact")).select(key, "field", "ref_id")


def misses(df: DataFrame, refs: DataFrame, key: str = "stmt_id", fields: Sequence[str] = ("item", "src_row", "src_table")) -> DataFrame:
    """Unmatched cells per field."""
    cells = match_cells(df, refs, key, fields)
    return cells.groupBy("field").agg(
        F.count(F.lit(1)).alias("cells"),
        F.sum(F.when(F.col("ref_id") == 0, 1).otherwise(0)).alias("unmatched"),
        F.sum(F.when(F.col("exact"), 1).otherwise(0)).alias("exact"),
    )
