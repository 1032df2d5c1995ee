from quarterloom.functions import labels, lexer, titles
from quarterloom.operators import extract
from quarterloom.plans import pipeline


def rank(t, cik=""):
    return titles.title_rank(t, cik)


def test_ranks_of_titles():
    best = ["Consolidated statements of income (unaudited)", "Quarterly consolidated statement of operations", "CONDENSED CONSOLIDATED STATEMENTS OF COMPREHENSIVE INCOME", "Con soli dated state ments of income"]
    assert [rank(t) for t in best] == [0] * 4
    assert rank("Example Bank consolidated statements of income (1)") == 1
    order = ["Consolidated statements of income", "Consolidated income statements", "Consolidated financial highlights", "Consolidated balance sheets", "Supplemental operating results by quarter", "Statements of operations", "Summary of business results", "Earnings summary", "Balance sheet", "Capital ratios", "Earnings"]
    got = [rank(t) for t in order]
    assert None not in got and got == sorted(got) and len(set(got)) == len(got)
    assert [rank(t) for t in ("Net income", "Contents", "", "Segment", "statements")] == [None] * 5


def test_titles_of_companies():
    assert rank("Statement of income - reported basis", "0000019617") < rank("Statement of income - reported basis")
    assert rank("Quarterly results summary", "0000750556") is None
    assert rank("Reconciliation of total revenue", "0001390777") is not None and rank("Reconciliation of total revenue") is None


def test_search_ends():
    assert all(map(titles.ends_search, ["Business segment results", "Segment results", "Non-GAAP financial measures (unaudited)", "Parent - subsidiaries"]))
    assert not any(map(titles.ends_search, ["Consolidated results", "Non-GAAP financial measures are shown below", "", "Subsidiaries"]))


LABELS = {
    "Net income": ("net income", 0), "Net income (loss)": ("net income", 0), "Net (loss)": ("net income", 0), "Net income available to common shareholders (1)": ("net income", 0),
    "Net income attributable to Example Corp": ("net income", 1), "Net interest income": ("net interest income", 0), "Net interest income after provision for credit losses": ("net interest income", 0),
    "Net interest income - FTE": ("net interest income", 2), "Total interest income": ("interest income", 0), "Total interest and dividend income": ("interest income", 0),
    "Provision for loan and lease losses": ("provision for loan losses", 0), "(Recovery of) provision for credit losses": ("provision for loan losses", 0), "Provision for losses on covered loans": ("provision for loan losses", 0),
    "Reversal for credit losses": ("provision for loan losses", 1), "Loan loss provision": ("provision for loan losses", 2), "Total net revenue": ("total revenue", 0), "Net revenues": ("total revenue", 1),
    "Book value per common share": ("book value per share", 0), "Tangible data (book value per share)": ("book value per share", 1),
    "Net income before taxes": None, "Net interest margin": None, "Net income attributable to noncontrolling interests": None, "Provision for income taxes": None, "Tangible book value": None, "Revenue": None, "": None,
}


def test_labels_of_rows():
    for text, want in LABELS.items():
        hits = [(i.name, n) for i in labels.ITEMS for n, label in enumerate(i.labels) if labels.is_label(text, label)]
        assert (hits[0] if hits else None) == want, text


def test_torn_words_are_mended():
    v = frozenset(["net", "income", "balance", "balances", "sheets", "in"])
    text = lambda t: " ".join(x.text for x in lexer.lex(t, v))
    assert text("Net in come") == "net income" and text("b a l a n c e s h e e t s") == "balance sheets"
    assert text("in balance") == "in balance" and text("x y z") == "x y z" and text("in​come") == "income"


def test_rules_as_arguments(spark):
    page = "<p>My own table</p><table><tr><td></td><td>Q1 2019</td><td>Q1 2018</td></tr><tr><td>Net income</td><td>9,000,000</td><td>8</td></tr><tr><td>Total revenue</td><td>7,000,000</td><td>6</td></tr></table>"
    rules = extract.Rules(titles=(titles.title("my", "own", "table"),))
    assert extract.tables_of([page], "") == [] and len(extract.tables_of([page], "", rules)) == 1
    pipeline.register(spark, rules)
    df = spark.createDataFrame([("1", page), ("2", None)], "cik string, html string")
    df.createOrReplaceTempView("pages_with_rules")
    got = {(r.cik, r.item, r.item_value) for r in spark.sql("select p.cik, i.item, i.item_value from pages_with_rules p, lateral statement_items(p.cik, p.html) i").collect()}
    assert got == {("1", "net income", 9e6), ("1", "total revenue", 7e6)}
    one = spark.sql("select i.item from pages_with_rules p, lateral statement_items(p.cik, p.html, array('net income')) i").collect()
    assert [r.item for r in one] == ["net income"]
    pipeline.register(spark)
