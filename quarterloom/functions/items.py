"""The items of the statements and what a free spelling of one means.

A spelling means an entry if its letters are the entry's but for a slip or
two, or if each of its words stands for words of the entry: the word itself,
a shortening of it, a word one slip off, or the initials of words in a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: Items whose figure is per share.
PER_SHARE = ("book value per share",)

#: A list of items is kept in memory by every worker up to this length.
MOST = 100_000

# Words of an entry that a spelling may leave out.
SMALL = frozenset(["of", "the", "and", "for", "to", "per"])

_LETTERS = re.compile(r"[^\W\d_]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


def slips(a: str, b: str, most: int) -> int:
    """Letters left out, added, changed or swapped with their neighbour;
    ``most + 1`` if there are more than ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            least = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                least = min(least, before[j - 2] + 1)
            row.append(least)
        before, last = last, row
    return min(last[-1], most + 1)


def _shortens(short: str, word: str) -> bool:
    """The letters of ``short`` come in ``word`` in that order, the first one
    first; a plural of such a shortening will do."""
    if not short or short[0] != word[0] or len(short) < 2:
        return False
    rest = iter(word)
    return all(c in rest for c in short) or short.endswith("s") and len(short) > 3 and word.startswith(short[:-1])


def words(text: str) -> list[str]:
    """Lower-case words; single letters in a row are one."""
    parts = _LETTERS.findall((text if any(c.isspace() for c in text) else _HUMP.sub(" ", text)).lower())
    out: list[str] = []
    joined = False
    for p in parts:
        if len(p) == 1 and joined:
            out[-1] += p
        else:
            out.append(p)
        joined = len(p) == 1
    return out


class Items:
    """What spellings mean among ``entries`` (id -> label)."""

    def __init__(self, entries: dict[int, str]):
        self.entries = {i: words(t) for i, t in sorted(entries.items())}
        self.flat = {i: "".join(w) for i, w in self.entries.items()}
        self.by_letters: dict[str, int] = {}
        for i, t in self.flat.items():
            self.by_letters.setdefault(t, i)
        self.find = lru_cache(200_000)(self._find)

    def _find(self, text: str) -> int:
        """Id of the entry, 0 for none; the closest, then the least id."""
        spelled = words(text)
        letters = "".join(spelled)
        if not letters:
            return 0
        if letters in self.by_letters:
            return self.by_letters[letters]
        told = [(c, i) for i, w in self.entries.items() if (c := self._cover(tuple(spelled), tuple(w))) is not None]
        if told:
            return min(told)[1]
        most = 2 if len(letters) >= 8 else 1
        close = [(n, i) for i, t in self.flat.items() if len(letters) > 3 and (n := slips(letters, t, most)) <= most]
        return min(close)[1] if close else 0

    def _cover(self, spelled: tuple[str, ...], entry: tuple[str, ...]) -> float | None:
        """Least cost at which each spelled word stands for words of the entry
        and none but small words are left over."""
        if not spelled:
            return 0.0 if all(w in SMALL for w in entry) else None
        first, rest = spelled[0], spelled[1:]
        best: float | None = None
        for a, word in enumerate(entry):
            if first == word:
                cost = 0.0
            elif _shortens(first, word) or slips(first, word, 1) == 1 and len(word) > 3:
                cost = 1.0
            else:
                continue
            left = self._cover(rest, entry[:a] + entry[a + 1 :])
            if left is not None and (best is None or cost + left < best):
                best = cost + left
        for bare in (entry, tuple(w for w in entry if w not in SMALL)):
            for a in range(len(bare) - len(first) + 1):
                if len(first) > 1 and "".join(w[0] for w in bare[a : a + len(first)]) == first:
                    left = self._cover(rest, bare[:a] + bare[a + len(first) :])
                    if left is not None and (best is None or 1.0 + left < best):
                        best = 1.0 + left
        return best


def item_entries(refs: DataFrame) -> dict[int, str]:
    """The ``item`` entries of the reference list, which every worker keeps in
    memory; its length is checked."""
    rows = refs.where(F.col("field") == "item").select("ref_id", "label").limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"a list of items is expected to hold at most {MOST:,} entries")
    return {r[0]: r[1] for r in rows if r[1] is not None}


def item_meaning(c: Column, entries: dict[int, str]) -> Column:
    """The entry a spelling means, 0 if none, null for null.  Each distinct
    spelling of a batch is matched once."""

    @F.pandas_udf("bigint")
    def meaning(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Items(entries)
        for s in batches:
            codes, values = pd.factorize(s)
            ids = [known.find(v) for v in values]
            yield pd.Series([ids[k] if k >= 0 else None for k in codes], dtype="Int64")

    return meaning(c)
