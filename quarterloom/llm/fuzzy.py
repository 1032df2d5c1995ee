"""Bounded fuzzy matching of short phrases against a reference list.

Pure Python on purpose: the matcher is built once by the driver, broadcast,
and applied to the *distinct* values of each Arrow batch.

* :class:`SymmetricDelete` - dictionary of delete-variants; a lookup costs a
  few dozen hash probes, independent of the number of words.
* :func:`weighted_dl` - Damerau-Levenshtein with cheaper transpositions and
  neighbouring-key substitutions.
* :class:`PhraseMatcher` - tokens are resolved to vocabulary words (equal,
  plural, abbreviation, misspelling), then a phrase is assigned to the entry
  whose words it covers at the least cost; run-together or spaced-out
  spellings are compared without blanks.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

# Words that carry no meaning of their own inside a label.
STOPWORDS = frozenset(["of", "the", "and", "for", "to", "from", "on", "at", "in", "by", "a", "per"])

# Rows of a keyboard; neighbours are likely slips.
KEY_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")

def _neighbours() -> dict[str, str]:
    out: dict[str, set[str]] = {}
    for r, row in enumerate(KEY_ROWS):
        for i, ch in enumerate(row):
            near = set(row[max(0, i - 1) : i + 2])
            if r + 1 < len(KEY_ROWS):
                near |= set(KEY_ROWS[r + 1][max(0, i - 1) : i + 1])
            if r:
                near |= set(KEY_ROWS[r - 1][i : i + 2])
            out[ch] = near - {ch}
    return out


NEAR = _neighbours()

#: Letters of a word that the dictionary deletes from: 79 keys at most.
PREFIX = 12


def weighted_dl(a: str, b: str, limit: float = 3.0) -> float:
    """Optimal-string-alignment distance; above ``limit`` returns ``inf``."""
    if a == b:
        return 0.0
    if abs(len(a) - len(b)) > limit:
        return float("inf")
    prev2: list[float] = []
    prev = [float(j) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        cur = [float(i)]
        for j, y in enumerate(b, 1):
            if x == y:
                cost = prev[j - 1]
            else:
                cost = prev[j - 1] + (0.8 if y in NEAR.get(x, "") else 1.0)
            # a doubled letter or a lost double is the cheapest slip
            drop = prev[j] + (0.7 if i > 1 and a[i - 2] == x else 1.0)
            add = cur[j - 1] + (0.7 if j > 1 and b[j - 2] == y else 1.0)
            cost = min(cost, drop, add)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and x != y:
                cost = min(cost, prev2[j - 2] + 0.7)
            cur.append(cost)
        if min(cur) > limit:
            return float("inf")
        prev2, prev = prev, cur
    return prev[-1] if prev[-1] <= limit else float("inf")


def deletes(word: str, k: int) -> set[str]:
    """``word`` and everything left after deleting up to ``k`` letters."""
    out, layer = {word}, {word}
    for _ in range(k):
        layer = {w[:i] + w[i + 1 :] for w in layer for i in range(len(w))}
        out |= layer
    return out


class SymmetricDelete:
    """Delete-variant dictionary: ``lookup`` returns words within ``k`` edits.

    Both sides delete up to ``k`` letters of their first ``PREFIX``, so every
    pair within ``k`` insertions, deletions, substitutions or transpositions
    meets in a bucket - what is left after the common part of two prefixes
    costs no more deletions than the words differ by;
    :func:`weighted_dl` then decides.
    """

    def __init__(self, words: Iterable[str], k: int):
        self.k = k
        self.words = sorted(set(words))
        self.index: dict[str, list[int]] = {}
        self.longest = max(map(len, self.words), default=0)
        for n, w in enumerate(self.words):
            for v in deletes(w[:PREFIX], k):
                self.index.setdefault(v, []).append(n)

    def lookup(self, word: str, k: int | None = None) -> dict[str, float]:
        k = self.k if k is None else min(k, self.k)
        if len(word) > self.longest + k:
            return {}  # nothing is as long, however long the word
        seen = {self.words[n] for v in deletes(word[:PREFIX], k) for n in self.index.get(v, ())}
        found = {w: weighted_dl(word, w, float(k)) for w in seen}
        return {w: c for w, c in found.items() if c <= k}


def is_subsequence(short: str, long: str) -> bool:
    it = iter(long)
    return all(ch in it for ch in short)


CAMEL = re.compile(r"(?<=[a-zà-ÿ])(?=[A-Z])")
WORD = re.compile(r"[^\W\d_]+")
VOWEL = re.compile(r"[aeiou]")


def tokens(text: str) -> list[str]:
    """Lower-case words; camel case is split, single letters are joined.

    ``+`` and ``&`` read as "and", an apostrophe inside a word is dropped.
    """
    t = text
    for apostrophe in ("'", "’"):
        t = t.replace(apostrophe, "")
    t = t.replace("&", " and ").replace("+", " and ")
    if not any(ch.isspace() for ch in t):  # an identifier such as NetIncome
        t = CAMEL.sub(" ", t)
    words = WORD.findall(t.lower())
    out: list[str] = []
    run = ""
    for w in words:
        if len(w) == 1:
            run += w
            continue
        if run:
            out.append(run)
            run = ""
        out.append(w)
    if run:
        out.append(run)
    return out


def squash(text: str) -> str:
    """Letters only, lower case."""
    return "".join(WORD.findall(text.lower().replace("&", "and").replace("+", "and")))


#: How close a match is: cost, less the frequency of the entry, its id.
Rank = tuple[float, float, int]

#: What a token costs that is the initials of words in a row.
INITIALS = 0.4


class PhraseMatcher:
    """Match phrases to ``entries`` (id -> label).

    ``weight`` gives the reference frequency of an entry; among equally close
    entries the more frequent one wins, then the smaller id.  A phrase matches
    when all of its words belong to the entry and nothing but stopwords of
    the entry is missing; the summed word cost must stay within ``slack``
    for each word.  What an entry costs does not depend on the others, so a
    long list may be worked through in pieces and the least rank taken.
    """

    def __init__(self, entries: dict[int, str], weight: dict[int, float] | None = None):
        self.entries = dict(entries)
        self.weight = weight or {}
        self.exact: dict[str, int] = {}
        for i in sorted(self.entries):
            self.exact.setdefault(self.entries[i], i)
        self.words = {i: tokens(t) for i, t in self.entries.items()}
        vocab = {w for ws in self.words.values() for w in ws}
        self.slips = SymmetricDelete(vocab, 2)
        self.squashed: dict[str, list[int]] = {}
        self.holders: dict[str, list[int]] = {}
        self.runs: dict[str, list[tuple[int, tuple[str, ...]]]] = {}
        for i in sorted(self.entries):
            self.squashed.setdefault(squash(self.entries[i]), []).append(i)
            for w in set(self.words[i]):
                self.holders.setdefault(w, []).append(i)
            for run in sorted(self._runs(self.words[i])):
                self.runs.setdefault("".join(w[0] for w in run), []).append((i, run))
        self.flat = SymmetricDelete(self.squashed, 2)
        self.lengths = sorted({len(x) for x in self.squashed})
        # words by their first letter and each letter that comes later
        self.shapes: dict[str, list[str]] = {}
        for w in sorted(vocab - STOPWORDS):
            for c in sorted(set(w[1:])):
                self.shapes.setdefault(w[0] + c, []).append(w)
        self._token: dict[str, dict[str, float]] = {}

    @staticmethod
    def _runs(ws: list[str]) -> set[tuple[str, ...]]:
        """Two or more words in a row, with and without stopwords."""
        content = [w for w in ws if w not in STOPWORDS]
        return {tuple(x[a:b]) for x in (ws, content) for a in range(len(x)) for b in range(a + 2, min(len(x), a + 8) + 1)}

    # -- words ---------------------------------------------------------
    def word_costs(self, t: str) -> dict[str, float]:
        """Vocabulary words that token ``t`` may stand for, with costs."""
        hit = self._token.get(t)
        if hit is not None:
            return hit
        if len(self._token) > 500_000:  # a cache, never a limit on the result
            self._token.clear()
        out: dict[str, float] = {}
        if t in self.holders:
            out[t] = 0.0
        k = 0 if len(t) < 3 else 1 if len(t) <= 5 else 2
        if k:
            for w, c in self.slips.lookup(t, k).items():
                # short words change meaning with every letter
                if len(w) <= 3 and (w in STOPWORDS) != (t in STOPWORDS) and c >= 1:
                    continue
                if t in STOPWORDS and w not in STOPWORDS:
                    continue
                out[w] = min(out.get(w, 9.0), 0.05 if w.rstrip("es") == t.rstrip("es") else c)
        if len(t) >= 2 and t not in STOPWORDS:
            for w in self.shapes.get(t[:2], ()):
                if len(t) < len(w) and (c := self._shortening(t, w)) is not None:
                    out[w] = min(out.get(w, 9.0), c)
        self._token[t] = out
        return out

    @staticmethod
    def _shortening(t: str, w: str) -> float | None:
        if w.startswith(t):
            return 0.2
        if t.endswith("s") and len(t) > 3 and w.startswith(t[:-1]):
            return 0.25
        if is_subsequence(t, w) and (len(t) <= 5 or len(w) - len(t) >= 3 or VOWEL.sub("", t) == VOWEL.sub("", w)):
            return 0.4
        return None

    # -- phrases -------------------------------------------------------
    def _score(self, ws: list[str], entry: int) -> float:
        left = list(self.words[entry])
        cost = 0.0
        for w in sorted(ws, key=len, reverse=True):
            best, at = 9.0, -1
            costs = self.word_costs(w)
            for j, v in enumerate(left):
                c = costs.get(v, 9.0)
                if c < best:
                    best, at = c, j
            if at >= 0:
                cost += best
                del left[at]
            elif run := next((r for i, r in self.runs.get(w, ()) if i == entry and all(r.count(x) <= left.count(x) for x in r)), None):
                cost += INITIALS
                for x in run:
                    left.remove(x)
            elif w in STOPWORDS:
                cost += 0.3
            else:
                return float("inf")
        for v in left:
            if v not in STOPWORDS:
                return float("inf")
            cost += 0.3
        return cost

    def _rank(self, found: dict[int, float]) -> Rank | None:
        return min(((round(c, 6), -self.weight.get(i, 0.0), i) for i, c in found.items()), default=None)

    def by_words(self, text: str) -> Rank | None:
        """The closest entry, word by word."""
        if text in self.exact:
            return self._rank({self.exact[text]: 0.0})
        flat = squash(text)
        if not flat:
            return None
        if flat in self.squashed:
            return self._rank(dict.fromkeys(self.squashed[flat], 0.0))
        ws = tokens(text)
        near: dict[int, float] = {}
        cands: set[int] | None = None
        for w in ws:
            if w in STOPWORDS:
                continue
            own = {i for v in self.word_costs(w) for i in self.holders[v]} | {i for i, _ in self.runs.get(w, ())}
            cands = own if cands is None else cands & own
            if not cands:
                break
        for i in cands or ():
            c = self._score(ws, i)
            if c <= 0.8 * len(ws) + 0.7 and c < 5:
                near[i] = c
        return self._rank(near)

    def by_letters(self, text: str) -> Rank | None:
        """The closest entry as one run-together spelling."""
        flat = squash(text)
        if not any(abs(len(flat) - n) <= 2 for n in self.lengths):
            return None
        k = 2 if len(flat) >= 8 else 1
        return self._rank({i: c + 0.5 for s, c in self.flat.lookup(flat, k).items() for i in self.squashed[s]})
