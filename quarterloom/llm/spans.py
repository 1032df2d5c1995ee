"""Problem 9: long exact spans shared between records.

Fixed-block anchors: every text is indexed by its non-overlapping blocks of
half the span length, and every rolling window of every text is probed
against that index - first against a bitmap of bounded size, so that only
likely hits move.  Any shared span holds a whole block of either text.  Hits
are then refined by longer windows around the anchor and extended letter by
letter to the span length.

Whole-text copies are found first and take part once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quarterloom.joins import join_values
from quarterloom.session import written

SPAN = 200

#: Texts are hashed together up to this many characters; a longer one in
#: overlapping pieces.
SEGMENT = 1 << 19

#: Bits of the bitmap per indexed block, and its largest size (64 MB).
BITS_PER_BLOCK = 32
BITMAP_LIMIT = 1 << 29

#: Blocks that a bitmap of that size still tells apart (8 bits each); beyond,
#: anchors are local minima of the window hashes, which need no bitmap.
BLOCK_LIMIT = BITMAP_LIMIT // 8

#: Ids that may be broadcast to leave texts out before they move.
ID_LIMIT = 1_000_000

#: Windows around an anchor start every STEP characters.
STEP = 20

#: Windows in more rows than this meet by their exact spans, not in pairs.
CROWD = 1_000

_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_u = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _u(32))
    x = x * _u(0xD6E8FEB86659FD93)
    return x ^ (x >> _u(32))


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers.get("b", ())) < n:
        for name, b in (("b", _BASE), ("i", _INVERSE)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p)
    return _powers["b"][:n], _powers["i"][:n]


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """``s`` with ``(s[i+w] - s[i]) * base**i`` the hash of window i."""
    c = _mix((codes.astype(np.uint64) + _u(1)) * _u(0x9E3779B97F4A7C15))
    s = np.zeros(len(c) + 1, np.uint64)
    np.cumsum(c * _power(len(c))[1], out=s[1:])
    return s


def window_hashes(s: np.ndarray, at: np.ndarray | slice, w: int) -> np.ndarray:
    b = _power(len(s))[0]
    if isinstance(at, slice):
        n = len(s) - w
        return _mix((s[w:] - s[:n]) * b[:n]) if n > 0 else np.zeros(0, np.uint64)
    return _mix((s[at + w] - s[at]) * b[at])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Segment(NamedTuple):
    """Pieces of texts hashed together: id of the text, place of the piece in
    ``codes`` (one more than pieces), place of its first letter in the text,
    and the part of it, from ``low`` to ``high``, whose windows are its own."""

    ids: np.ndarray
    start: np.ndarray
    base: np.ndarray
    low: np.ndarray
    high: np.ndarray
    codes: np.ndarray


def _segments(batches: Iterator[pa.RecordBatch], before: int, after: int, step: int = 1) -> Iterator[Segment]:
    """Short texts together, long ones in pieces that overlap by ``before``
    and ``after`` letters and begin at multiples of ``step``."""
    cut = max(step, SEGMENT // step * step)
    rows: list[tuple[int, int, int, int]] = []
    parts: list[np.ndarray] = []
    total = 0

    def whole() -> Segment:
        ids, base, low, high = (np.array(x, np.int64) for x in zip(*rows))
        return Segment(ids, np.r_[0, np.cumsum([len(x) for x in parts])], base, low, high, np.concatenate(parts))

    for b in batches:
        for k, t in zip(b.column(0).to_pylist(), b.column(1)):
            text = t.as_py()
            for lo in range(0, len(text), cut):
                a, hi = max(0, lo - before), min(len(text), lo + cut)
                c = _codes(text[a : min(len(text), hi + after)])
                if total and total + len(c) > SEGMENT:
                    yield whole()
                    rows, parts, total = [], [], 0
                rows.append((k, a, lo - a, hi - a))
                parts.append(c)
                total += len(c)
    if parts:
        yield whole()


def _rows(h: np.ndarray, doc: np.ndarray, pos: np.ndarray, block: np.ndarray | bool) -> pa.RecordBatch:
    flag = np.full(len(h), block, bool) if isinstance(block, bool) else block
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(doc), pa.array(pos.astype(np.int32)), pa.array(flag)], ["h", "doc", "pos", "block"])


ANCHOR = "h bigint, doc bigint, pos int, block boolean"


def indexed_blocks(texts: DataFrame, w: int) -> DataFrame:
    """Hash of each non-overlapping block of ``w`` characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _segments(batches, 0, w - 1, w):
            n = np.minimum(-(-t.high // w), np.diff(t.start) // w)
            doc = np.repeat(np.arange(len(t.ids)), n)
            pos = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * w
            yield _rows(window_hashes(prefix_sums(t.codes), t.start[doc] + pos, w), t.ids[doc], t.base[doc] + pos, True)

    return texts.mapInArrow(run, ANCHOR)


def _bits(h: np.ndarray, bits: int) -> list[np.ndarray]:
    shift = _u(64 - bits)
    return [h >> shift, (h * _u(0x9E3779B97F4A7C15)) >> shift, (h * _u(0xC2B2AE3D27D4EB4F)) >> shift]


def _in_bitmap(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Positions of the hashes that the bitmap may hold."""
    at = None
    for k in range(3):
        own = h if at is None else h[at]
        p = _bits(own, bits)[k]
        hit = np.flatnonzero(bitmap[(p >> _u(3)).astype(np.int64)] & (_u(1) << (p & _u(7))).astype(np.uint8))
        at = hit if at is None else at[hit]
    return at


def bitmap_of(blocks: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """A bitmap of the indexed hashes: put together in pieces by the
    executors; the driver sees its bytes, at most 64 MB, never the hashes."""
    bits = 16
    while (1 << bits) < min(BITS_PER_BLOCK * n, BITMAP_LIMIT):
        bits += 1
    piece = min(bits, 20)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Marks of a task by piece, four bytes each."""
        got = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches]
        if got:
            p = np.unique(np.concatenate([x for h in got for x in _bits(h, bits)]).astype(np.int64))
            nth = p >> piece
            cut = np.flatnonzero(np.r_[True, nth[1:] != nth[:-1]]) if len(p) else np.zeros(0, int)
            low = (p & ((1 << piece) - 1)).astype(np.uint32)
            marks = [x.tobytes() for x in np.split(low, cut[1:])] if len(p) else []
            yield pa.RecordBatch.from_arrays([pa.array(nth[cut].astype(np.int32)), pa.array(marks, pa.binary())], ["piece", "marks"])

    def build(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros(1 << piece, bool)
        for b in batches:
            for marks in b["marks"]:
                out[np.frombuffer(marks, np.uint32)] = True
        yield pd.DataFrame({"piece": [key[0]], "bytes": [np.packbits(out, bitorder="little").tobytes()]})

    marks = blocks.select("h").mapInArrow(split, "piece int, marks binary")
    pieces = marks.groupBy("piece").applyInPandas(build, "piece int, bytes binary")
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for row in pieces.toLocalIterator():
        at = row["piece"] << (piece - 3)
        bitmap[at : at + len(row["bytes"])] = np.frombuffer(row["bytes"], np.uint8)
    return bitmap, bits


def probed_windows(texts: DataFrame, bitmap: np.ndarray, bits: int, w: int) -> DataFrame:
    """Every rolling window that the bitmap may hold, but for the indexed
    blocks themselves."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _segments(batches, 0, w - 1):
            h = window_hashes(prefix_sums(t.codes), slice(None), w)
            at = _in_bitmap(shared.value, h, bits)
            doc = np.searchsorted(t.start, at, side="right") - 1
            pos = at - t.start[doc]
            ok = (at + w <= t.start[doc + 1]) & (pos < t.high[doc]) & ((pos + t.base[doc]) % w != 0)
            yield _rows(h[at[ok]], t.ids[doc[ok]], (pos + t.base[doc])[ok], False)

    return texts.mapInArrow(run, ANCHOR)


def _sliding(x: np.ndarray, t: int, f: np.ufunc) -> np.ndarray:
    """``f`` over every run of ``t`` values."""
    width, out = 1, x
    while 2 * width <= t:
        out = f(out[:-width], out[width:])
        width *= 2
    rest = t - width
    return f(out[: len(out) - rest], out[rest:]) if rest else out


def local_minima(texts: DataFrame, w: int, span: int) -> DataFrame:
    """Windows with the least hash among ``span - w + 1`` neighbours: a shared
    span holds a run of that many windows and so the same least one."""
    t = span - w + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in _segments(batches, t - 1, t + w - 2):
            s = prefix_sums(p.codes)
            for i, k in enumerate(p.ids):
                h = window_hashes(s, np.arange(p.start[i], max(p.start[i], p.start[i + 1] - w + 1)), w)
                if len(h) < t:
                    continue
                low = _sliding(h, t, np.minimum)
                wide = np.concatenate([np.zeros(t - 1, np.uint64), low, np.zeros(t - 1, np.uint64)])
                pos = np.flatnonzero(_sliding(wide, t, np.maximum) == h)
                pos = pos[(pos >= p.low[i]) & (pos < p.high[i])]
                yield _rows(h[pos], np.full(len(pos), k), p.base[i] + pos, True)

    return texts.mapInArrow(run, ANCHOR)


def _without(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on ``doc``; few ids are broadcast."""
    few = ids.limit(ID_LIMIT + 1).count() <= ID_LIMIT
    return df.join(F.broadcast(ids) if few else ids, "doc", how)


def copy_classes(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """``(doc, rep, chars, copies)`` of the texts of at least ``span`` code
    points; ``rep`` is the least id with that very text."""
    own = docs.where((F.char_length("text") >= span) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("doc"), F.unhex(F.sha2("text", 256)).alias("digest"), F.char_length("text").alias("chars"))
    own = written(own.distinct(), "digests")
    several = own.groupBy("digest").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    several = written(several.withColumn("n", F.col("copies")), "copied")
    few = several.limit(ID_LIMIT + 1).count() <= ID_LIMIT
    keys = several.select("digest")
    alone = own.join(F.broadcast(keys) if few else keys, "digest", "left_anti").select("doc", F.col("doc").alias("rep"), "chars", F.lit(1).cast("bigint").alias("copies"))
    return join_values(own, several, ["digest"]).select("doc", "rep", "chars", "copies").unionByName(alone)


def anchors(texts: DataFrame, span: int, block_limit: int = BLOCK_LIMIT) -> tuple[DataFrame, int]:
    """``(h, doc, pos, block)`` of the anchors that stand in two texts: blocks
    that a later document holds too, and windows like a block of an earlier
    one; and the most rows that share a hash."""
    w = span // 2
    blocks = written(indexed_blocks(texts, w), "blocks")
    n = blocks.count()
    if n <= block_limit:
        bitmap, bits = bitmap_of(blocks, n)
        every = blocks.unionByName(written(probed_windows(texts, bitmap, bits, w), "probes"))
    else:
        every = written(local_minima(texts, w, span), "minima")
    # a pair is found at a block of its lesser document: what comes before
    # the first indexed one or is indexed last of all brings none together
    groups = every.groupBy("h").agg(F.min(F.when(F.col("block"), F.col("doc"))).alias("a"), F.max("doc").alias("b"), F.count(F.lit(1)).alias("n")).where("a < b")
    groups = written(groups, "anchor-groups")
    found = join_values(every, groups, ["h"]).where("(block and doc < b) or doc > a").select("h", "doc", "pos", "block")
    return written(found, "found"), groups.agg(F.max("n")).first()[0] or 0


def _hashed(text: str, x: np.ndarray, v: int) -> Iterator[tuple[int, int, int]]:
    """Place and two hashes of the windows at the places ``x``, in order; a
    long text is taken piece by piece."""
    for lo in range(0, len(text), SEGMENT):
        own = x[(x >= lo) & (x < lo + SEGMENT)]
        if len(own):
            s = prefix_sums(_codes(text[lo : lo + SEGMENT + v]))
            yield from zip(own.tolist(), window_hashes(s, own - lo, v).view(np.int64).tolist(), window_hashes(s, own - lo, v - 7).view(np.int64).tolist())


def keys(texts: DataFrame, found: DataFrame, span: int) -> DataFrame:
    """Windows of ``span - STEP`` characters around each anchor, with STEP
    characters to either side: ``(h, g, doc, block, xs, left, right)``;
    ``block`` where the anchor is an indexed block.

    A span that holds the anchor holds one of them; a phrase common to many
    texts but shorter than the window brings no two of them together.  Equal
    windows of one text with equal surroundings are one row.
    """
    w, v = span // 2, span - STEP
    offsets = np.arange(0, v - w + 1, STEP)
    # an indexed block is marked by its sign: -1 - position
    places = found.groupBy("doc").agg(F.collect_set(F.when(F.col("block"), -1 - F.col("pos")).otherwise(F.col("pos"))).alias("ps"))
    wanted = _without(texts, places.select("doc"), "left_semi").join(places, "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("h", "g", "doc", "block", "xs", "left", "right")}
            for doc, text, ps in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                p = ps.values.to_numpy()
                rows: dict[tuple, list[int]] = {}
                indexed: set[tuple] = set()
                for block, own in ((True, -1 - p[p < 0]), (False, p[p >= 0])):
                    x = np.unique((own[:, None] - offsets[None, :]).ravel())
                    x = x[(x >= 0) & (x + v <= len(text))]
                    if not len(x):
                        continue
                    for q, a, c in _hashed(text, x, v):
                        key = (a, c, text[max(0, q - STEP) : q], text[q + v : q + v + STEP])
                        if block:
                            indexed.add(key)
                        rows.setdefault(key, []).append(q)
                for key, xs in rows.items():
                    for name, value in zip(out, (key[0], key[1], doc, key in indexed, xs, key[2], key[3])):
                        out[name].append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out.values(), types)], list(out))

    return wanted.select("doc", "text", "ps").mapInArrow(run, "h bigint, g bigint, doc bigint, block boolean, xs array<int>, left string, right string")


@F.pandas_udf(T.StructType([T.StructField("before", T.IntegerType()), T.StructField("after", T.IntegerType())]))
def _extension(al: pd.Series, bl: pd.Series, ar: pd.Series, br: pd.Series) -> pd.DataFrame:
    """Characters that two windows share before and after."""

    def common(x: str, y: str) -> int:
        n = 0
        for c, d in zip(x, y):
            if c != d:
                break
            n += 1
        return n

    return pd.DataFrame({"before": [common(x[::-1], y[::-1]) for x, y in zip(al, bl)], "after": [common(x, y) for x, y in zip(ar, br)]}, dtype="int32")


def _befores() -> Column:
    """How many letters before a window the spans around it may begin."""
    return F.filter(F.sequence(F.lit(0), F.lit(STEP)), lambda n: (n <= F.char_length("left")) & (STEP - n <= F.char_length("right")))


def _told_by(before: str) -> Column:
    """Tells apart the spans around windows with the same hashes."""
    return F.xxhash64(F.struct(before, F.expr(f"right(`left`, {before})"), F.expr(f"left(`right`, {STEP} - {before})")))


def exact_spans(rows: DataFrame) -> DataFrame:
    """A row for each span of ``span`` letters around the window of a row:
    ``before`` letters of it stand before the window, ``e`` tells it."""
    return rows.withColumn("before", F.explode(_befores())).withColumn("e", _told_by("before"))


def representative_pairs(k: DataFrame, crowded: bool = True) -> DataFrame:
    """``(doc_a, doc_b)``, ``doc_a < doc_b``, of different texts with a span in
    common, from :func:`keys`; each may come more than once.

    Windows are compared in pairs, found at the indexed blocks of the lesser
    document, and extended letter by letter.  A crowded window, such as a
    phrase of many texts just shorter than the span, would bring together all
    of them: there the exact spans around it meet, and only true pairs do.
    """
    few = k
    if crowded:
        crowds = written(k.groupBy("h", "g").agg(F.count(F.lit(1)).alias("crowd")).where(F.col("crowd") > CROWD).drop("crowd"), "crowds")
        crowded = not crowds.isEmpty()
        few = k.join(crowds, ["h", "g"], "left_anti") if crowded else k
    a = few.where("block").select("h", "g", F.col("doc").alias("doc_a"), F.col("left").alias("al"), F.col("right").alias("ar"))
    b = few.select("h", "g", F.col("doc").alias("doc_b"), F.col("left").alias("bl"), F.col("right").alias("br"))
    grown = a.join(b, ["h", "g"]).where("doc_a < doc_b").withColumn("e", _extension("al", "bl", "ar", "br")).where(F.col("e.before") + F.col("e.after") >= STEP)
    pairs = grown.select("doc_a", "doc_b")
    if not crowded:
        return pairs
    exact = exact_spans(k.join(crowds, ["h", "g"], "left_semi")).select("h", "g", "e", "doc", "block").distinct()
    a, b = exact.where("block").select("h", "g", "e", F.col("doc").alias("doc_a")), exact.select("h", "g", "e", F.col("doc").alias("doc_b"))
    return pairs.unionByName(a.join(b, ["h", "g", "e"]).where("doc_a < doc_b").select("doc_a", "doc_b"))


def _prepared(docs: DataFrame, span: int, block_limit: int) -> tuple[DataFrame, DataFrame, bool]:
    """Classes of copies, windows around anchors, and whether any of these may
    be crowded."""
    classes = written(copy_classes(docs, span), "classes")
    texts = docs.where((F.char_length("text") >= span) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("doc"), "text")
    texts = _without(texts, classes.where("doc <> rep").select("doc"), "left_anti")
    found, most = anchors(texts, span, block_limit)
    # the rows of a window are anchors at one of so many places in it
    places = (span - STEP - span // 2) // STEP + 1
    return classes, written(keys(texts, found, span), "keys"), most * places > CROWD


def shared_classes(docs: DataFrame, span: int = SPAN, block_limit: int = BLOCK_LIMIT) -> tuple[DataFrame, DataFrame]:
    """``(doc, rep, chars, copies)``, the class of whole copies of every text
    of at least ``span`` characters, and ``(doc_a, doc_b)``, the pairs of
    representatives of different classes that share a span.  Nothing grows
    with the square of a class."""
    classes, k, crowded = _prepared(docs, span, block_limit)
    return classes, written(representative_pairs(k, crowded).distinct(), "pairs")


def class_links(docs: DataFrame, span: int = SPAN, block_limit: int = BLOCK_LIMIT) -> DataFrame:
    """``(doc_id, class_id, copies, links)`` of every document with an id: the
    least id with the same text, how many such documents there are, and the
    number of documents that share a span with it, copies included.  A null,
    empty or shorter text is alone and has no links."""
    classes, pairs = shared_classes(docs, span, block_limit)
    size = classes.where("doc = rep").select("rep", F.col("copies").cast("bigint").alias("copies"))
    both = pairs.select(F.col("doc_a").alias("rep"), F.col("doc_b").alias("other")).unionByName(pairs.select(F.col("doc_b").alias("rep"), F.col("doc_a").alias("other")))
    links = both.join(size.select(F.col("rep").alias("other"), "copies"), "other").groupBy("rep").agg(F.sum("copies").alias("others"))
    of_class = written(size.join(links, "rep", "left").select("rep", F.coalesce("others", F.lit(0)).alias("others"), F.col("copies").alias("n")), "links")
    told = join_values(classes.select("doc", "rep", "copies"), of_class, ["rep"])
    rows = told.select(F.col("doc").alias("doc_id"), F.col("rep").alias("class_id"), F.col("copies").cast("bigint").alias("copies"), (F.col("others") + F.col("copies") - 1).cast("bigint").alias("links"))
    short = docs.where(F.col("doc_id").isNotNull() & (F.col("text").isNull() | (F.char_length("text") < span))).select("doc_id").distinct()
    return rows.unionByName(short.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("copies"), F.lit(0).cast("bigint").alias("links")))


def shared_pairs(docs: DataFrame, span: int = SPAN, block_limit: int = BLOCK_LIMIT) -> DataFrame:
    """``(doc_a, doc_b)``, ``doc_a < doc_b``: the documents with ``span`` or
    more successive characters in common, whole copies included.

    Null, empty and shorter texts share nothing, nor do texts without an id;
    repeated rows of one document count once; an empty table gives no rows;
    extra columns are ignored.  The last step writes out the classes of
    :func:`shared_classes` pair by pair.
    """
    classes, pairs = shared_classes(docs, span, block_limit)
    # every member of a class stands for its representative
    a = classes.select(F.col("rep").alias("doc_a"), F.col("doc").alias("x"))
    b = classes.select(F.col("rep").alias("doc_b"), F.col("doc").alias("y"))
    between = pairs.join(a, "doc_a").join(b, "doc_b").select("x", "y")
    many = classes.where("copies > 1")
    within = many.select("rep", F.col("doc").alias("x")).join(many.select("rep", F.col("doc").alias("y")), "rep").where("x < y").select("x", "y")
    both = between.unionByName(within)
    return both.where("x <> y").select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b"))


def _covered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Length of the union of a text's intervals."""
    for b in batches:
        out = []
        for spans in b["spans"]:
            total, end = 0, -1
            for s in sorted((x["lo"], x["hi"]) for x in spans):
                total += max(0, s[1] - max(s[0], end))
                end = max(end, s[1])
            out.append(total)
        yield pd.DataFrame({"doc": b["doc"], "shared": out})


def shared_stretches(k: DataFrame, span: int) -> DataFrame:
    """``(doc, lo, hi)``: stretches of a text that stand in another one, from
    :func:`keys`, without pairing texts.

    Rows of a window that are alike to both sides, which ``c`` tells, are put
    together first: in two texts or more, all of it is shared.  Of a window
    that has a lone row too each exact span is shared that two texts hold.
    """
    window, alike = ["h", "g", "c"], F.xxhash64("left", "right").alias("c")
    ends = (F.min("doc").alias("a"), F.max("doc").alias("b"), F.count(F.lit(1)).alias("n"))
    groups = written(k.groupBy("h", "g").agg(*ends).where("a < b").select("h", "g", "n"), "window-groups")
    around = join_values(k.select("h", "g", "doc", "left", "right"), groups, ["h", "g"]).groupBy("h", "g", "left", "right").agg(*ends)
    around = around.withColumn("some_lone", F.max(F.col("a") == F.col("b")).over(Window.partitionBy("h", "g")))
    # -1 stands for the whole of what is alike
    none = F.array().cast("array<int>")
    parts = F.concat(F.when(F.col("a") < F.col("b"), F.array(F.lit(-1))).otherwise(none), F.when(F.col("some_lone"), _befores()).otherwise(none))
    spans = around.select("h", "g", "left", "right", "a", "b", "n", F.explode(parts).alias("before"))
    whole = F.col("before") < 0
    reach = F.struct(
        F.when(whole, F.char_length("left")).otherwise(F.col("before")).alias("before"),
        F.when(whole, F.char_length("right")).otherwise(STEP - F.col("before")).alias("after"),
    )
    spans = spans.select("h", "g", alike, "a", "b", "n", whole.alias("whole"), reach.alias("reach"), F.when(whole, F.xxhash64(alike, F.lit(0))).otherwise(_told_by("before")).alias("e"))
    w = Window.partitionBy("h", "g", "e")
    found = spans.withColumns({"least": F.min("a").over(w), "most": F.max("b").over(w)}).where("whole or (a = b and least < most)")
    every = written(found.groupBy(*window).agg(F.collect_set("reach").alias("reach"), F.max("n").alias("n")), "reach")
    at = join_values(k.select("h", "g", alike, "doc", "xs"), every, window).select("doc", F.explode("xs").alias("x"), "reach").select("doc", "x", F.inline("reach"))
    return at.select("doc", (F.col("x") - F.col("before")).alias("lo"), (F.col("x") + span - STEP + F.col("after")).alias("hi")).where(F.col("hi") - F.col("lo") >= span)


def shared_characters(docs: DataFrame, span: int = SPAN, block_limit: int = BLOCK_LIMIT) -> DataFrame:
    """``(doc_id, chars, shared)``: for each text of at least ``span``
    characters how many of them also stand in another text, in stretches of
    at least ``span``.  A text with a copy is shared as a whole."""
    classes, k, _ = _prepared(docs, span, block_limit)
    spans = shared_stretches(k, span).groupBy("doc").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    rep = spans.mapInPandas(_covered, "doc bigint, shared bigint")
    # only a text without copies is asked for; it is its own representative
    out = classes.join(rep, "doc", "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("chars").cast("bigint").alias("chars"), F.when(F.col("copies") > 1, F.col("chars")).otherwise(F.coalesce("shared", F.lit(0))).cast("bigint").alias("shared"))


def shared_of_all(docs: DataFrame, span: int = SPAN, block_limit: int = BLOCK_LIMIT) -> DataFrame:
    """``(doc_id, chars, shared)`` of every document: as
    :func:`shared_characters`, and 0 shared characters for a null, empty or
    shorter text.  A document without an id gives no row; ``chars`` of a null
    text is null.  Repeated rows of one document with the same text count once."""
    short = docs.where(F.col("doc_id").isNotNull() & (F.col("text").isNull() | (F.char_length("text") < span)))
    rest = short.select("doc_id", "text").distinct().select("doc_id", F.char_length("text").cast("bigint").alias("chars"), F.lit(0).cast("bigint").alias("shared"))
    return shared_characters(docs, span, block_limit).unionByName(rest)
