"""Problem 8: filling fixed-capacity containers.

Sum-of-squares packing: a document goes where the squared counts of open
containers per residual gap become smallest, which keeps gaps of every size
in stock.  In mixed order the rule wastes a bounded number of containers
however many documents come, if the sizes can be packed well at all; the
smallest tenth comes last and fills what is open.  For other sizes documents
come largest first.  Only sizes matter, so shards of a bounded number of documents are
packed independently; a shard leaves about one container unfilled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quarterloom.llm.bpe import token_counts

CAPACITY = 2048

#: Documents in a shard; sizes and places of a shard fit in any worker.
SHARD = 100_000

#: Tasks at most, each packs one shard after another.
TASKS = 20_000

#: Shares of the documents, the smallest, that come last, largest first; for
#: them a container is opened only where no open one has room.  The second
#: share is tried where the first leaves more than SLACK of the room unused.
LAST = (0.1, 1.0)
SLACK = 0.001


def placing_order(sizes: np.ndarray, last: float) -> tuple[np.ndarray, int]:
    """Positions in mixed order, the smallest share of them last and by size,
    and the number of those that come before."""
    by_size = np.argsort(-sizes, kind="stable")
    before = len(sizes) - int(len(sizes) * last)
    mixed = np.random.default_rng(0).permutation(by_size[:before])
    return np.concatenate([mixed, by_size[before:]]), before


def pack(sizes: np.ndarray, capacity: int = CAPACITY, lasts: tuple[float, ...] = LAST) -> np.ndarray:
    """Container number of each size in ``1..capacity``: the run of
    :func:`sum_of_squares` that needs the fewest."""
    least = -(-int(sizes.sum()) // capacity)
    best: np.ndarray | None = None
    for last in lasts:
        place = sum_of_squares(sizes, capacity, last)
        if best is None or place.max(initial=-1) < best.max(initial=-1):
            best = place
        if best.max(initial=-1) + 1 <= least * (1 + SLACK) + 1:
            break
    return best


def sum_of_squares(sizes: np.ndarray, capacity: int, last: float) -> np.ndarray:
    """Container number of each size, every one chosen by sum of squares.

    ``open_[g]`` counts the containers with room ``g``.  Putting size s into a
    container with gap g changes the sum of squares by
    ``2*open_[g-s] - 2*open_[g] + 2`` (full containers do not count); a new
    container acts as one with gap ``capacity`` that was not counted.  Ties
    go to the smallest gap.
    """
    place = np.empty(len(sizes), np.int64)
    order, before = placing_order(sizes, last)
    open_ = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    for nth, i in enumerate(order):
        s = int(sizes[i])
        here = open_[s:capacity]  # gaps s .. capacity-1
        gap = 0
        if len(here):
            change = 2 * open_[: capacity - s] - 2 * here + 2
            change[0] = 1 - 2 * here[0]  # a filled container leaves the count
            change[here == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            fresh = 2 * int(open_[capacity - s]) + 1 if s < capacity else 0
            if here[best] and (nth >= before or change[best] <= fresh):
                gap = s + best
        if gap:
            c = stacks[gap].pop()
            open_[gap] -= 1
            left = gap - s
        else:
            c = used
            used += 1
            left = capacity - s
        place[i] = c
        if left:
            stacks[left].append(c)
            open_[left] += 1
    return place


def _pack_shard(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
    b = b.sort_values(["doc_id", "tokens"], kind="stable", ignore_index=True)
    cap = int(b["capacity"].iat[0])
    tokens = b["tokens"].to_numpy()
    full, rest = tokens // cap, tokens % cap
    # whole containers of texts that alone are longer than one
    nth = np.repeat(np.arange(len(b)), full)
    piece = np.arange(len(nth)) - np.repeat(np.cumsum(full) - full, full)
    parts = [pd.DataFrame({"row": nth, "piece": piece, "tokens": cap, "container": np.arange(len(nth))})]
    body = np.flatnonzero(rest > 0)
    place = pack(rest[body], cap) + len(nth)
    parts.append(pd.DataFrame({"row": body, "piece": full[body], "tokens": rest[body], "container": place}))
    empty = np.flatnonzero(tokens == 0)  # takes no room: any container will do
    parts.append(pd.DataFrame({"row": empty, "piece": 0, "tokens": 0, "container": 0}))
    out = pd.concat(parts, ignore_index=True)
    base = int(key[0]) << 32
    return pd.DataFrame(
        {
            "doc_id": b["doc_id"].to_numpy()[out["row"]],
            "piece": out["piece"].to_numpy("int32"),
            "tokens": out["tokens"].to_numpy("int64"),
            "container": out["container"].to_numpy("int64") + base,
        }
    )


def containers(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``(doc_id, piece, tokens, container)``: every document with its
    container; a text longer than a container is cut into whole containers
    and a rest that is packed like a document.

    Null and empty texts have no tokens and lie in the first container of
    their shard; repeated rows are packed each; an empty table gives no rows.
    """
    shards = max(1, -(-docs.count() // shard))
    counts = token_counts(docs, vocabulary=vocabulary)
    # pandas would turn a column of ids with a null into floats
    none = F.lit(-(1 << 63))
    keyed = counts.select(F.coalesce("doc_id", none).alias("doc_id"), "tokens", F.lit(capacity).alias("capacity"), F.pmod(F.xxhash64("doc_id", "tokens"), F.lit(shards)).cast("int").alias("shard"))
    packed = keyed.repartition(min(shards, TASKS), "shard").groupBy("shard").applyInPandas(_pack_shard, "doc_id bigint, piece int, tokens bigint, container bigint")
    return packed.withColumn("doc_id", F.nullif("doc_id", none))


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Containers used, tokens and the share of room that is filled."""
    t = packed.where("tokens > 0")
    return t.agg(
        F.countDistinct("container").alias("containers"),
        F.sum("tokens").alias("tokens"),
        F.round(F.sum("tokens") / (F.countDistinct("container") * F.lit(capacity)), 5).alias("filled"),
    )
