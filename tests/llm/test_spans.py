import random

import numpy as np

from quarterloom.llm import spans
from quarterloom.llm.queries import p9_shared
from quarterloom.llm.spans import prefix_sums, shared_characters, shared_pairs, window_hashes

SPAN = 200


def windows(t, n=SPAN):
    return {t[i : i + n] for i in range(len(t) - n + 1)}


def brute(docs):
    w = {k: windows(t) for k, t in docs if t}
    ks = sorted(w)
    return sorted((a, b) for i, a in enumerate(ks) for b in ks[i + 1 :] if w[a] & w[b])


def brute_shared(docs):
    out = {}
    w = {k: windows(t) for k, t in docs if t and len(t) >= SPAN}
    for k, t in docs:
        if k not in w:
            continue
        other = set().union(*[v for j, v in w.items() if j != k])
        cover = np.zeros(len(t), bool)
        for i in range(len(t) - SPAN + 1):
            if t[i : i + SPAN] in other:
                cover[i : i + SPAN] = True
        out[k] = int(cover.sum())
    return out


def corpus(seed):
    r = random.Random(seed)
    word = lambda n: "".join(r.choice("abcdefghij éß😀\n") for _ in range(n))
    shared = [word(n) for n in (200, 199, 201, 260, 450, 150, 1200)]
    docs = []
    for i in range(60):
        t = word(r.randint(0, 300))
        for _ in range(r.randint(0, 3)):
            t += r.choice(shared) + word(r.randint(0, 120))
        docs.append((i, t))
    docs += [(100, shared[6]), (101, shared[6]), (102, shared[0]), (103, shared[1]), (104, None), (105, ""), (106, " " * 400), (107, "x" + " " * 230), (108, "ab" * 150), (109, "ba" * 150), (110, shared[6])]
    phrase = word(190)  # known to many, too short to count
    docs += [(200 + i, word(80) + phrase + word(80)) for i in range(30)]
    return docs


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as h", "'x' as doc")


def test_pairs_and_coverage_against_brute_force(spark):
    docs = corpus(1)
    df = frame(spark, docs)
    want = brute(docs)
    assert len(want) > 100
    assert sorted((r.doc_a, r.doc_b) for r in shared_pairs(df).collect()) == want
    # the way beyond the bitmap's bound
    assert sorted((r.doc_a, r.doc_b) for r in shared_pairs(df, block_limit=0).collect()) == want
    assert {r.doc_id: r.shared for r in shared_characters(df).collect()} == brute_shared(docs)


def test_long_texts_are_cut_and_crowds_meet_by_exact_spans(spark, monkeypatch):
    docs = corpus(4)
    want, df = brute(docs), frame(spark, docs)
    monkeypatch.setattr(spans, "SEGMENT", 300)  # most texts are longer
    monkeypatch.setattr(spans, "CROWD", 3)
    for limit in (spans.BLOCK_LIMIT, 0):
        assert sorted((r.doc_a, r.doc_b) for r in shared_pairs(df, block_limit=limit).collect()) == want
        assert {r.doc_id: r.shared for r in shared_characters(df, block_limit=limit).collect()} == brute_shared(docs)


def test_classes_and_links(spark):
    docs = corpus(1)
    links = {k: 0 for k, _ in docs}
    for a, b in brute(docs):
        links[a] += 1
        links[b] += 1
    got = {r.doc_id: r for r in spans.class_links(frame(spark, docs)).collect()}
    assert {k: r.links for k, r in got.items()} == links
    text = dict(docs)
    for k, r in got.items():
        same = [j for j, t in docs if t == text[k]] if len(text[k] or "") >= SPAN else [k]
        assert (r.class_id, r.copies) == (min(same), len(same))


def test_edges(spark):
    r = random.Random(2)
    t = "".join(r.choice("abcdef") for _ in range(300))
    twice = [(1, t), (1, t), (2, t), (None, t), (3, t[:200]), (4, t[:199]), (5, None)]
    assert sorted((r.doc_a, r.doc_b) for r in shared_pairs(frame(spark, twice)).collect()) == [(1, 2), (1, 3), (2, 3)]
    assert shared_pairs(frame(spark, twice).limit(0)).count() == 0 == shared_characters(frame(spark, twice).limit(0)).count()
    long = [(1, t * 2000), (2, "z" * 600_000 + t[:250]), (3, t[::-1])]
    assert [(r.doc_a, r.doc_b) for r in shared_pairs(frame(spark, long)).collect()] == [(1, 2)]


def test_every_document_has_its_shared_characters(spark, tmp_path):
    r = random.Random(3)
    t = "".join(r.choice("abcdef") for _ in range(300))
    docs = [(1, t), (2, t), (3, "x" + t[:250]), (4, t[:199]), (5, None), (6, ""), (7, t[::-1]), (8, "short"), (9, "short")]
    want = {k: (len(x) if x is not None else None, {1: 300, 2: 300, 3: 250}.get(k, 0)) for k, x in docs}
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = p9_shared(spark, str(tmp_path)).collect()
    assert len(got) == len(docs) and {r.doc_id: (r.chars, r.shared) for r in got} == want
    twice = frame(spark, [(1, "ab"), (1, "ab"), (None, "cd"), (2, None)])
    assert sorted((r.doc_id, r.chars, r.shared) for r in spans.shared_of_all(twice).collect()) == [(1, 2, 0), (2, None, 0)]


def test_hashes_do_not_depend_on_the_place():
    c = np.frombuffer(("abc" * 50).encode("utf-32-le"), np.uint32)
    h = window_hashes(prefix_sums(c), slice(None), 30)
    assert len(set(h[::3].tolist())) == 1 and len(set(h.tolist())) == 3
    assert (window_hashes(prefix_sums(c), np.arange(len(h)), 30) == h).all()


def test_sliding():
    x = np.random.default_rng(0).integers(0, 100, 50).astype(np.uint64)
    for t in (1, 2, 7, 50):
        assert spans._sliding(x, t, np.minimum).tolist() == [x[i : i + t].min() for i in range(51 - t)]
