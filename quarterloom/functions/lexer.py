"""Words, figures and signs of a text, and phrases found among them.

Statements are read by tokens, not by patterns: a text is cut into lower-case
words, runs of digits and signs; words that markup has torn apart are joined
again where that gives a word of the vocabulary.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, functions as F

_PIECE = re.compile(r"[a-z]+|[0-9]+|[^\sa-z0-9]")

#: Pieces that may make up one torn word.
FRAGMENTS = 12

# Signs that look like a hyphen, signs that stand for an apostrophe.
HYPHENS = "—\x97\x96–-"
APOSTROPHES = "'\x92’"


class Token(NamedTuple):
    """``glued``: no blank stands before it."""

    text: str
    glued: bool

    @property
    def word(self) -> bool:
        return self.text.isalpha() and self.text.isascii()

    @property
    def digits(self) -> bool:
        return self.text.isdigit() and self.text.isascii()


#: Characters that nothing is seen of.
_UNSEEN = dict.fromkeys([0xAD, 0x34F, *range(0x200B, 0x2010), 0x2060, 0xFEFF])


def lex(text: str, vocabulary: frozenset[str] = frozenset()) -> list[Token]:
    t = text.translate(_UNSEEN).lower()
    out, end = [], -1
    for m in _PIECE.finditer(t):
        out.append(Token(m.group(), m.start() == end))
        end = m.end()
    return mend(out, vocabulary) if vocabulary else out


def mend(tokens: Sequence[Token], vocabulary: frozenset[str]) -> list[Token]:
    """Joins neighbouring words to words of the vocabulary, so that as few
    pieces as possible are left that are none.  Words that all stand in the
    vocabulary are not joined."""
    out: list[Token] = []
    i = 0
    while i < len(tokens):
        j = i
        while j < len(tokens) and tokens[j].word:
            j += 1
        if j == i:
            out.append(tokens[i])
            i += 1
            continue
        run = tokens[i:j]
        known = [x.text in vocabulary for x in run]
        if len(run) == 1 or all(known):
            out.extend(run)
        else:
            for a, b in _pieces(run, known, vocabulary):
                out.append(Token("".join(x.text for x in run[a:b]), run[a].glued))
        i = j
    return out


@lru_cache(64)
def _longest(vocabulary: frozenset[str]) -> int:
    return max(map(len, vocabulary), default=0)


def _pieces(run: Sequence[Token], known: Sequence[bool], vocabulary: frozenset[str]) -> list[tuple[int, int]]:
    """Cuts of a run: unknown pieces as few as can be, then pieces at all."""
    n = len(run)
    longest = _longest(vocabulary)
    best = [(0, 0)] + [(n + 1, 0)] * n
    back = [0] * (n + 1)
    for i in range(n):
        unknown, pieces = best[i]
        word = ""
        for k in range(1, min(FRAGMENTS, n - i) + 1):
            word += run[i + k - 1].text
            if k > 1 and len(word) > longest:
                break
            if k == 1:
                cost = (unknown + (not known[i]), pieces + 1)
            elif word in vocabulary and not all(known[i : i + k]):
                cost = (unknown, pieces + 1)
            else:
                continue
            if cost < best[i + k]:
                best[i + k], back[i + k] = cost, i
    cuts, end = [], n
    while end:
        cuts.append((back[end], end))
        end = back[end]
    return cuts[::-1]


def without_notes(tokens: Sequence[Token]) -> list[Token]:
    """Without footnote marks at the end: stars and one or two characters in
    brackets."""
    out = list(tokens)
    while out:
        if out[-1].text == "*":
            out.pop()
            continue
        opened = next((n for n in (3, 4) if len(out) >= n and out[-n].text == "("), 0)
        inner = "".join(x.text for x in out[1 - opened : -1]) if opened else ""
        if out[-1].text != ")" or not 0 < len(inner) <= 2:
            break
        del out[-opened:]
    return out


def without_remarks(tokens: Sequence[Token]) -> list[Token]:
    """Without the word "unaudited" and brackets around it."""
    out: list[Token] = []
    for x in tokens:
        if x.text == ")" and len(out) > 1 and out[-1].text == "unaudited" and out[-2].text == "(":
            del out[-2:]
        else:
            out.append(x)
    return [x for x in out if x.text != "unaudited"]


def words_of(tokens: Sequence[Token]) -> list[str]:
    """Words in order; a run of digits is ``#``, signs are passed over."""
    return [x.text if x.word else "#" for x in tokens if x.word or x.digits]


Need = tuple[frozenset[str], ...]


@dataclass(frozen=True)
class Phrase:
    """Required words in order, others that may stand between and around.

    ``place``: 'start' of the text, its 'end', the 'whole' of it, or anywhere
    ('in').  At the start other words of the phrase may come first; at the
    end, and in the whole, nothing else may follow.
    """

    need: Need
    fill: frozenset[str] = frozenset()
    place: str = "start"
    never: frozenset[str] = frozenset()

    def _run(self, words: Sequence[str], i: int) -> int | None:
        for own in self.need:
            while i < len(words) and words[i] not in own:
                if words[i] not in self.fill:
                    return None
                i += 1
            if i == len(words):
                return None
            i += 1
        return i

    def found(self, words: Sequence[str]) -> bool:
        if self.never and not self.never.isdisjoint(words):
            return False
        starts = (0,) if self.place in ("start", "whole") else [i for i, w in enumerate(words) if w in self.need[0]]
        closed = self.place in ("end", "whole")
        after = self.fill | self.need[-1]
        for i in starts:
            end = self._run(words, i)
            if end is not None and (not closed or all(w in after for w in words[end:])):
                return True
        return False

    @property
    def vocabulary(self) -> frozenset[str]:
        return frozenset().union(*self.need) | self.fill | self.never


def phrase(*need: str, fill: str = "", place: str = "start", never: str = "") -> Phrase:
    """Each of ``need`` lists the words that may stand at one place."""
    return Phrase(tuple(frozenset(n.split()) for n in need), frozenset(fill.split()), place, frozenset(never.split()))


def by_value(f: Callable[[str], object], kind: str) -> Callable[[Column], Column]:
    """``f`` as a Column function: each distinct value of a batch is read
    once; null stays null."""

    def run(s: pd.Series) -> pd.Series:
        codes, values = pd.factorize(s)
        got = [f(v) for v in values]
        return pd.Series([got[k] if k >= 0 else None for k in codes], dtype=object)

    return lambda c: F.pandas_udf(run, kind)(c)


remember = lru_cache(200_000)
