import base64
import random
import string

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from quarterloom.llm.bpe import PATTERN, encoder, token_counts, token_ids, vocabulary_path
from quarterloom.llm.packing import containers, fill, pack


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary_path(), "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_random_texts(reference):
    r = random.Random(1)
    letters = string.printable + "éñ日本　 ​\x1c\x85😀ﬁ²  \n\n'"
    enc = encoder(vocabulary_path()).encode
    for _ in range(3000):
        t = "".join(r.choice(letters) for _ in range(r.randint(0, 50)))
        assert enc(t) == reference(t), repr(t)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(t):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary_path(), "rb"))} if not _cache else None
    if ranks:
        _cache.append(tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary)
    assert encoder(vocabulary_path()).encode(t) == _cache[0](t)


_cache: list = []


def test_very_long_pre_tokens(reference):
    enc = encoder(vocabulary_path()).encode
    for t in ("ab" * 30_000, "a" * 50_000, "x1" * 1000, " " * 20_000 + "x", "é" * 5000):
        assert enc(t) == reference(t)


def test_operator(spark, reference):
    data = [(1, "Net income rose."), (2, ""), (3, None), (1, "Net income rose."), (4, "<|endoftext|> 12,345\n\n x"), (None, "a")]
    df = spark.createDataFrame(data, "doc_id bigint, text string").selectExpr("*", "'z' as ids", "1 as k")
    got = sorted(((r.doc_id or 0), r.ids) for r in token_ids(df).collect())
    assert got == sorted(((k or 0), reference(t or "")) for k, t in data)
    assert sorted(r.tokens for r in token_counts(df).collect()) == sorted(len(reference(t or "")) for _, t in data)
    assert token_ids(df.limit(0)).count() == 0


def check(sizes, place, cap):
    room = np.zeros(place.max() + 1 if len(place) else 0, int)
    np.add.at(room, place, sizes)
    assert (room <= cap).all() and (room > 0).all()
    return len(room)


def best_fit_decreasing(sizes, cap):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [g for g in rooms if g >= s]
        if fits:
            rooms[rooms.index(min(fits))] -= s
        else:
            rooms.append(cap - s)
    return len(rooms)


def test_packing_is_valid_and_tight():
    r = np.random.default_rng(0)
    for low, high, n in ((1, 2049, 3000), (100, 900, 3000), (1000, 1100, 500), (1, 2, 50)):
        s = r.integers(low, high, n)
        assert check(s, pack(s), 2048) <= 1.01 * best_fit_decreasing(s.tolist(), 2048) + 2
    s = r.lognormal(6, 0.8, 6000).astype(int) % 2048 + 1
    pure = check(s, pack(s, 2048, (0.0,)), 2048)
    assert check(s, pack(s), 2048) <= pure <= 1.01 * s.sum() / 2048 + 2 and check(s, pack(s), 2048) <= 1.003 * s.sum() / 2048 + 2
    assert len(pack(np.array([], int))) == 0 and pack(np.array([2048, 2048])).tolist() == [0, 1]


def test_small_packing_against_brute_force():
    r = random.Random(3)

    def best(sizes, cap):
        sizes = sorted(sizes, reverse=True)
        most = len(sizes)

        def go(i, bins):
            nonlocal most
            if len(bins) >= most:
                return
            if i == len(sizes):
                most = len(bins)
                return
            for k in range(len(bins)):
                if bins[k] + sizes[i] <= cap:
                    go(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
            go(i + 1, [*bins, sizes[i]])

        go(0, [])
        return most

    for _ in range(40):
        s = np.array([r.randint(1, 12) for _ in range(8)])
        assert check(s, pack(s, 12), 12) <= best(s.tolist(), 12) + 1


def test_containers(spark):
    text = "word " * 5000
    data = [(i, "Net income rose. " * (i % 40)) for i in range(200)] + [(500, text), (501, None), (502, ""), (503, text), (None, "a b")]
    df = spark.createDataFrame(data, "doc_id bigint, text string").selectExpr("*", "0 as shard", "'x' as tokens")
    for shard in (100_000, 30):
        got = containers(df, shard=shard).toPandas()
        assert set(got.doc_id.dropna()) == {k for k, _ in data if k is not None} and got.doc_id.isna().sum() == 1
        room = got.groupby("container").tokens.sum()
        assert (room <= 2048).all()
        long = got[got.doc_id == 500]
        assert len(long) > 1 and sorted(long.piece) == list(range(len(long))) and (long.tokens == 2048).sum() == len(long) - 1
        assert (got[~got.doc_id.isin([500, 503])].groupby("doc_id").size() == 1).all()
        assert got[got.doc_id == 501].tokens.tolist() == [0]
    f = fill(containers(df)).first()
    assert f.filled > 0.9 and containers(df.limit(0)).count() == 0
