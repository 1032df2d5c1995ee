"""Problem 7: encoding the whole corpus with a public byte-level BPE.

Pre-tokens are merged with a rank queue: a hierarchical bitmap over the merge
ranks whose set bits name non-empty buckets; a bucket holds the linked-list
positions of pairs with that rank, find-first-set gives the next rank, and
entries that an earlier merge made stale are skipped.  A pre-token of n bytes
costs O(n) queue steps whatever its length.  Words repeat, so their ids are
kept per worker.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

#: Where the public vocabularies lie; a parameter, they are never copied.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"

# Fixed value: the public pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Ranks in one word of the lower bitmap.
WORD_BITS = 8
WORD_MASK = (1 << WORD_BITS) - 1

#: Remembered spellings per worker; a full memory is emptied.
REMEMBERED = 400_000


class Encoder:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        ranks = self.ranks
        self.single = [ranks[bytes([i])] for i in range(256)]
        #: (left id << 20 | right id) -> rank of their merge
        self.pair = {ranks[t[:i]] << 20 | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        #: ranks of one bitmap word; the upper level has a bit per word
        self.low = [0] * ((max(ranks.values()) >> WORD_BITS) + 1)
        self.words: dict[str, tuple[int, ...]] = {}
        self.first: dict[str, tuple[int, ...]] = {}
        self.spaced: dict[str, tuple[int, ...]] = {}

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one pre-token."""
        whole = self.ranks.get(word)
        if whole is not None:
            return (whole,)
        single, rank_of = self.single, self.pair.get
        ids = [single[b] for b in word]
        n = len(ids)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        # The rank queue: buckets[rank] holds positions, low[rank // 256] has
        # a bit per rank with a bucket, high a bit per word of low in use.
        low, high, buckets = self.low, 0, {}
        fresh = [(r, i) for i in range(n - 1) if (r := rank_of(ids[i] << 20 | ids[i + 1])) is not None]
        while True:
            for r, i in fresh:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    w = r >> WORD_BITS
                    low[w] |= 1 << (r & WORD_MASK)
                    high |= 1 << w
            if not high:
                break
            # find first set, twice: the smallest rank
            w = (high & -high).bit_length() - 1
            v = low[w]
            bit = v & -v
            rank = w << WORD_BITS | bit.bit_length() - 1
            v ^= bit
            low[w] = v
            if not v:
                high ^= 1 << w
            positions = buckets.pop(rank)
            if len(positions) > 1:
                positions.sort()  # equal ranks merge from left to right
            fresh = []
            for i in positions:
                j = after[i]
                # stale: the left token is gone, or the pair is another one now
                if ids[i] < 0 or j >= n or rank_of(ids[i] << 20 | ids[j]) != rank:
                    continue
                ids[i], ids[j] = rank, -1
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                    r = rank_of(rank << 20 | ids[k])
                    if r is not None:
                        fresh.append((r, i))
                h = before[i]
                if h >= 0:
                    r = rank_of(ids[h] << 20 | rank)
                    if r is not None:
                        fresh.append((r, h))
        return tuple([x for x in ids if x >= 0])

    def word(self, w: str) -> tuple[int, ...]:
        got = self.words.get(w)
        if got is None:
            got = self.merge(w.encode("utf-8"))
            if len(w) <= 64:
                if len(self.words) >= REMEMBERED:
                    self.words.clear()
                self.words[w] = got
        return got

    def piece(self, piece: str) -> tuple[int, ...]:
        """Ids of a part of a text that begins and ends between pre-tokens."""
        known, word = self.words.get, self.word
        split = SPLIT_ASCII if piece.isascii() else SPLIT
        return tuple(chain.from_iterable([known(w) or word(w) for w in split(piece)]))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text, without special tokens; [] for empty and null.

        A blank between two visible characters always begins a pre-token, so
        the text is cut there and its parts are remembered; a part that is
        empty or ends in something else stays joined to its neighbours.
        """
        if not text:
            return []
        parts = text.split(" ")
        spaced = self.spaced
        out = list(map(spaced.get, parts))
        out[0] = self.first.get(parts[0])
        if None in out:
            self._fill(parts, out)
        return list(chain.from_iterable(out))

    def _fill(self, parts: list[str], out: list) -> None:
        n, done = len(parts), 0
        known, word, join = self.words.get, self.word, chain.from_iterable

        def safe(i: int) -> bool:
            """Whether the cut before part i lies between two pre-tokens."""
            if i == 0 or i == n:
                return True
            a, b = parts[i - 1], parts[i]
            return a != "" and b != "" and ("!" <= a[-1] <= "~" or a[-1].isalnum()) and ("!" <= b[0] <= "~" or b[0].isalnum())

        for i in [k for k, x in enumerate(out) if x is None]:
            if i < done:
                continue
            if safe(i) and safe(i + 1):
                p = parts[i]
                t = " " + p if i else p
                split = SPLIT_ASCII if t.isascii() else SPLIT
                got = out[i] = tuple(join([known(w) or word(w) for w in split(t)]))
                if (len(p) <= 5 or len(p) <= 32 and not DIGIT(p)) and p and ("!" <= p[0] <= "~" or p[0].isalnum()) and ("!" <= p[-1] <= "~" or p[-1].isalnum()):
                    memory = self.spaced if i else self.first
                    if len(memory) >= REMEMBERED:
                        memory.clear()
                    memory[p] = got
                continue
            # back to the last safe cut, then on to the next one
            lo, hi = i, i + 1
            while not safe(lo):
                lo -= 1
            while not safe(hi):
                hi += 1
            joined = " ".join(parts[lo:hi])
            out[lo] = self.piece(" " + joined if lo else joined)
            out[lo + 1 : hi] = [()] * (hi - lo - 1)
            done = hi


SPLIT = regex.compile(PATTERN).findall
#: The same pattern where only ASCII can occur.
SPLIT_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII).findall
DIGIT = re.compile(r"[0-9]").search


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(path)


def vocabulary_path(folder: str = TOKENIZERS, name: str = VOCABULARY) -> str:
    return os.path.join(folder, name)


def shipped_vocabulary(df: DataFrame, vocabulary: str | None) -> str:
    """Sends the vocabulary file to the executors; their copy goes by its
    name."""
    path = vocabulary or vocabulary_path()
    if (df.sparkSession.sparkContext.applicationId, path) not in _sent:
        df.sparkSession.sparkContext.addFile(path)
        _sent.add((df.sparkSession.sparkContext.applicationId, path))
    return os.path.basename(path)


_sent: set[tuple[str, str]] = set()


def token_ids(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``(key, ids)``: the token ids of every text, in place, no shuffle.

    Null and empty texts give an empty list; ids of repeated rows repeat; an
    empty table gives no rows; whole texts of any length are encoded.
    """
    name = shipped_vocabulary(df, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(SparkFiles.get(name)).encode
        for b in batches:
            # a few texts at a time: an Arrow batch may hold very long ones
            keys, texts = b.column(0), b.column(1)
            for at in range(0, b.num_rows, 512):
                lists = [enc(t) for t in texts.slice(at, 512).to_pylist()]
                lens = np.fromiter(map(len, lists), np.int32, len(lists))
                flat = np.fromiter(chain.from_iterable(lists), np.int32, int(lens.sum()))
                offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([keys.slice(at, 512), ids], ["k", "ids"])

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key).alias("k"), F.col(text)).mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``(key, tokens)`` only."""
    name = shipped_vocabulary(df, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(SparkFiles.get(name)).encode
        for b in batches:
            counts = [len(enc(t.as_py())) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64())], ["k", "tokens"])

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key).alias("k"), F.col(text)).mapInArrow(run, f"k {kind}, tokens bigint").withColumnRenamed("k", key)
