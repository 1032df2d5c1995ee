import itertools
import random

from quarterloom.llm.fuzzy import SymmetricDelete, squash, tokens, weighted_dl
from quarterloom.llm import canonical
from quarterloom.llm.canonical import Meaning, canonical_cells, match_cells, misses
from tests.statements import REFS, frame, refs


def test_lookup_equals_brute_force():
    r = random.Random(0)
    words = ["".join(r.choice("abcd") for _ in range(r.randint(3, 7))) for _ in range(60)]
    index = SymmetricDelete(words, 2)
    for _ in range(200):
        w = "".join(r.choice("abcd") for _ in range(r.randint(2, 8)))
        want = {x: weighted_dl(w, x, 2.0) for x in set(words) if weighted_dl(w, x, 2.0) <= 2}
        got = index.lookup(w)
        # plain edits cost at most 1 each: everything within two edits is found
        assert {x: c for x, c in want.items() if x in got} == got
        assert {x for x in set(words) if edits(w, x) <= 2} <= set(got)


def edits(a, b):
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i, j in itertools.product(range(len(a)), range(len(b))):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
        if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_weights():
    assert weighted_dl("incmoe", "income") < weighted_dl("inxome", "income") < weighted_dl("inzome", "income") == 1.0
    assert weighted_dl("", "") == 0 and weighted_dl("abcdef", "a") == float("inf")


def test_tokens():
    assert tokens("NetInterestIncome") == ["net", "interest", "income"] and tokens("N.I.I.") == ["nii"] and squash("B o o k") == "book"


def of(field):
    return Meaning({i: t for i, f, t in REFS if f == field})


def test_items():
    m = of("item")
    for t, i in {"net income": 101, "income, net": 101, "NetInc": 101, "net.ncome": 101, "interest income, net": 102, "N.I.I.": 102, "int. inc": 103, "PLL": 104, "provn for loan lss.": 104, "total revs": 105, "BV/share": 106, "bvps": 106, "book-value-per-share": 106}.items():
        assert m(t)[0] == i, t
    for t in ["net interest margin", "noninterest expense", "tangible equity per share", "efficiency ratio", "", "1234", "x" * 50_000, ". " * 50_000]:
        assert m(t)[0] == 0, t
    assert m(None)[0] == 0


def test_decorated_labels():
    row, tab = of("src_row"), of("src_table")
    for t in ["– Net income (1)", "Memo: Net incme ....", "N e t  i n c o m e ¹:", "Net income $", "Net іncоme", "Net income / Чистая прибыль", "Ｎｅｔ　ｉｎｃｏｍｅ　（１）"]:
        assert row(t)[0] == 107, t
    assert row("Чистая прибыль")[0] == 0 and row("Total interest expense")[0] == 0
    for t in ["Consolidated balance sheets (continued)", "Table 5: Consolidated balance sheets - UNAUDITED", "Upper Garquay National Corp — consol. balance sheets (a), as reported", "Consolidated balance sheets, Ebbhallow Bankshares, Inc.", "Exhibit 99.3 Consolidatedbalance sheets"]:
        assert tab(t)[0] == 146, t
    assert tab("Résumé of qtrly results")[0] == 161 and tab("Segment results, Harford Trust Co")[0] == 0


def test_cells(spark):
    df = frame(spark, [{"item": "NET INCOME", "src_row": "Net income", "src_table": ""}, {"item": None, "src_row": "other", "src_table": "Consolidated  balance sheets"}, {"item": "net income"}, {"item": "NET INCOME", "src_row": "Net income", "src_table": ""}])
    got = sorted(tuple(r) for r in canonical_cells(df, refs(spark)).collect())
    assert got == [(1, "item", 101), (2, "src_row", 0), (2, "src_table", 146), (4, "item", 101)]
    assert canonical_cells(df.limit(0), refs(spark)).count() == 0
    assert {r.ref_id for r in canonical_cells(df, refs(spark).limit(0)).collect()} == {0}
    by = {r["field"]: (r.cells, r.unmatched, r.exact) for r in misses(df, refs(spark)).collect()}
    assert by == {"item": (3, 0, 1), "src_row": (3, 1, 2), "src_table": (1, 0, 0)}
    null_id = df.withColumn("stmt_id", df["stmt_id"].cast("string").substr(1, 0).try_cast("bigint"))
    assert {r.stmt_id for r in canonical_cells(null_id, refs(spark)).collect()} == {None}


def test_a_long_reference_list_in_pieces(spark, monkeypatch):
    """Repeated rows, null keys and nulls give the same rows either way."""
    items = ("NET INCOME", "tot. rev", "efficiency ratio", "net interest incm", "net income", "N.I.I.", "", None, "netincmoe", "PLL / total")
    tables = ("Table 5: Consolidated balance sheets - UNAUDITED", "Upper Garquay Corp — consol. balance sheets", None, "Résumé of qtrly results", "Consolidatedbalanceshets")
    rows = [{"item": t, "src_table": tables[n % len(tables)], "src_row": "Net incme / Net income (1)", "stmt_id": n if n % 3 else None} for n, t in enumerate(items)] * 2
    df = frame(spark, rows)
    ordered = lambda: sorted(((r.stmt_id or 0, r["field"], r.ref_id, round(r.cost, 6), r.exact) for r in match_cells(df, refs(spark)).collect()))
    meant = lambda: sorted((str(r["item"]), r.m) for r in canonical.with_meaning(df, refs(spark), "item", "m").collect())
    whole, spelled = ordered(), meant()
    assert len(whole) == 2 * (8 + 8 + 10) and len(spelled) == 20
    monkeypatch.setattr(canonical, "PIECE", 1)
    assert ordered() == whole and meant() == spelled


def test_hot_values_are_joined_in_place(spark, monkeypatch):
    from quarterloom import joins

    monkeypatch.setattr(joins, "HOT", 3)
    rows = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 1), ("c", 2)], "k string, i int")
    values = spark.createDataFrame([("a", 10, 10), ("b", 20, 1)], "k string, v int, n bigint")
    got = sorted(tuple(r) for r in joins.join_values(rows, values, ["k"]).collect())
    assert got == sorted([("a", i, 10) for i in range(10)] + [("b", 1, 20)])


def test_prefix_dictionary_finds_every_long_word():
    r = random.Random(4)
    words = ["".join(r.choice("abc") for _ in range(r.randint(13, 20))) for _ in range(40)]
    index = SymmetricDelete(words, 2)
    for w in words:
        for _ in range(20):
            x = list(w)
            for _ in range(2):
                at = r.randrange(len(x))
                x[at : at + 1] = r.choice([[], ["a", x[at]], ["b"], [x[at]]])
            if edits("".join(x), w) <= 2:
                assert w in index.lookup("".join(x))
