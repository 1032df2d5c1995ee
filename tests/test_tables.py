import math

from pyspark.sql import functions as F

from quarterloom.functions import text
from quarterloom.operators import extract, tables
from quarterloom.sources import filings, html


def grid(s):
    return next(html.parse(s).walk("table")).grid()


def test_grid_spans_hidden_rows_and_unclosed_cells():
    assert grid("<table><tr><td>a<td>b<tr><td colspan=2>c</table>") == [["a", "b"], ["c", "c"]]
    assert grid("<table><thead><tr><th>a</th><th>b</th></tr></thead><tr style='visibility:hidden'><td>x<td>y</tr><tr><td>only</td></tr></table>") == [["a", "b"], ["only", "only"]]
    assert grid("<table><tr><td rowspan=2>a</td><td>b</td><td>d</td></tr><tr><td>c</td><td>e</td></tr></table>") == [["a", "b", "d"], ["a", "c", "e"]]
    assert grid("<table><tr><td> x&nbsp;&amp;\n y </td><td></td><td>N/A</td></tr></table>") == [["x & y", None, None]]
    assert grid("<table></table>") == [] and grid("<table><tr></tr></table>") == []
    assert next(html.parse("<table><tr><td><table><tr><td>in</table></td></tr></table>").walk("table")).has("table")


def test_cell_values():
    for t, v in {"(1,234)": -1234.0, "(1,234": -1234.0, "—": 0.0, "$-": 0.0, "n/a": None, "": None, "-5": 5.0, "$ 12.5 %": 12.5, "*3": 3.0}.items():
        assert tables.cell_value(t) == v
    assert math.isnan(tables.cell_value("1.2.3"))


def test_cell_values_as_columns(spark):
    ts = ["(1,234)", "(1,234", "—", "$-", "n/a", "", "-5", "$ 12.5 %", "1.2.3", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in ts], "t string").select(text.item_value(F.col("t"))).collect()]
    assert got[:8] == [-1234.0, -1234.0, 0.0, 0.0, None, None, 5.0, 12.5] and math.isnan(got[8]) and got[9] is None


def test_row_parts():
    assert all(map(tables.is_row_part, ["1,234", "$ 5", "12%", "–", "(3)"])) and not any(map(tables.is_row_part, ["2018", "31", "Net income", "Q1", ""]))


def test_sanitize(spark):
    df = spark.createDataFrame([("Résumé  of\n“x” café",), ("a" * 3000,), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(text.sanitize(F.col("t"))).collect()]
    assert got == ["Resume of x cafe", "a" * 1024, "", None]


Q = "Three months ended March 31, 2019"


def test_split_at_headers_and_borrow():
    rows = [["", Q, "x"], ["Net income", "1", "2"], ["", "Three months ended June 30, 2019", None], ["Net income", "3", "4"]]
    assert len(tables.split(rows)) == 2
    more = [["Total revenue", "5", "6"], ["Net revenue", "7", "8"]]
    assert tables.split(more) == [] and tables.split(more, rows[:2]) == [[rows[0], *more]]
    assert tables.split([[None, None]]) == []


def test_clean():
    raw = [["Statements of income"] * 5, [None, "Three months ended", "Three months ended", "Three months ended", "Three months ended"], ["(in thousands)", None, None, None, None], [None, "March 31, 2019", "March 31, 2019", "March 31, 2018", "March 31, 2018"], [None] * 5, ["Net income", "$", "(580", "$", "643"], [None, None, ")", None, None], ["Total revenue", None, "10", None, "20"], ["Total revenue", None, "10", None, "20"]]
    got = tables.clean(raw)
    assert got[0] == ["", "Three months ended March 31, 2019", "Three months ended March 31, 2018"]
    assert got[1] == ["Net income", "$(580", "$643"] and got[-1] == ["Total revenue", "10", "20"] and got.count(got[-1]) == 1
    assert tables.clean([["a", "b", "c", "d", "e"]] * 2) == []


TITLE, UNITS = "<p>CONSOLIDATED STATEMENTS OF INCOME (unaudited)</p>", "<p>(in millions, except per share data)</p>"


def table(*rows, head=f"<tr><td></td><td>{Q}</td><td>Three months ended March 31, 2018</td></tr>"):
    rows = (*rows, ("Other items", "77", "78"))  # a lone label would be no label column
    return f"<table>{head}{''.join('<tr>' + ''.join(f'<td>{c}</td>' for c in r) + '</tr>' for r in rows)}</table>"


def items(*docs, cik=""):
    return {(x[0], t[0]): x for t in extract.tables_of(docs, cik) for x in extract.items_of(t)}


def test_mini_filing():
    t = table(("Total interest income", "1,987", "1,668"), ("Net interest income", "1,544", "1,441"), ("Provision for credit losses", "153", "28"), ("Net income", "580", "643"), ("Book value per share", "51.15", "47.14"))
    got = {k[0]: (v[2], v[3], v[4], v[9]) for k, v in items(TITLE + UNITS + t).items()}
    u = "(in millions, except per share data)"
    assert got == {"interest income": (1.987e9, "2019Q1", 0, u), "net interest income": (1.544e9, "2019Q1", 0, u), "provision for loan losses": (1.53e8, "2019Q1", 0, u), "net income": (5.8e8, "2019Q1", 0, u), "book value per share": (51.15, "2019Q1", 0, u)}


def test_units_are_inferred_and_impossible_values_dropped():
    got = items(TITLE + table(("Net income", "(1,234)", "5"), ("Total revenue", "5,000,000", "5")))
    assert got["net income", 0][2] == -1234000.0 and got["net income", 0][9] == "inferred: thousands"
    assert got["total revenue", 0][2] == 5e6 and got["total revenue", 0][9] is None
    big = items(TITLE + "<p>(in billions)</p>" + table(("Total revenue", "5,000", "5")))
    assert big["total revenue", 0][2] is None


def test_search_stops_and_budgets():
    t = table(("Net income", "580", "643"))
    assert items(TITLE + "<p>Business segment data</p>" + t) == {}
    assert items("<p>nothing</p>" + t) == {}
    assert items(TITLE + "<table><tr><td>1</td></tr></table>" * 2 + t) == {}
    nested = f"{TITLE}<table><tr><td>{t}</td></tr></table>"
    assert len(items(nested)) <= 1  # the outer table is no candidate


def test_periods_of_columns_and_longer_columns_are_ignored():
    head = "<tr><td></td><td>Nine months ended September 30, 2019</td><td>Three months ended September 30, 2019</td></tr>"
    got = items(TITLE + UNITS + table(("Net income", "900", "300"), head=head))
    assert got["net income", 0][2:4] == (3e8, "2019Q3")
    qtd = "<tr><td></td><td>2018 QTD</td><td>Other</td></tr>"
    assert items(TITLE + UNITS + table(("Net income", "900", "300"), head=qtd))["net income", 0][3] == "2018QTD"


def test_continuation_borrows_headers():
    more = table(("Total revenue", "7", "8"), ("Net interest income", "9", "1"), head="")
    got = items(TITLE + UNITS + table(("Net income", "1", "2")) + "<p>Consolidated statements of income, continued</p>" + more)
    assert got["total revenue", 0][3] == "2019Q1"


def test_company_specific_titles():
    t = "<p>Quarterly results summary</p>" + UNITS + table(("Net income", "1", "2"))
    assert items(t) and items(t, cik="0000750556") == {}


def sgml(body, kind="EX-99", name="a.htm"):
    return f"<SEC-DOCUMENT>n-1.txt : 1\n<SEC-HEADER>\nCENTRAL INDEX KEY:\t\t0000000042\n</SEC-HEADER>\n<DOCUMENT>\n<TYPE>{kind}\n<FILENAME>{name}\n<TEXT>\n{body}\n</TEXT>\n</DOCUMENT>\n"


def test_submissions_end_to_end(spark):
    t = TITLE + UNITS + table(("Net income", "580", "643"), ("Net income", "1", "1"))
    low = "<p>Earnings summary</p>" + UNITS + table(("Net income", "99", "98"))
    raw = [(1, sgml(low + t)), (2, sgml(t, "GRAPHIC")), (3, sgml(t, name="a.txt")), (4, "no submission"), (5, None), (6, sgml("<p>x</p>"))]
    p = filings.parse_submissions(spark.createDataFrame(raw, "submission int, raw string"))
    by = {r.submission: r for r in p.collect()}
    assert by[1].cik == "0000000042" and by[1].number == "n-1.txt : 1" and [len(by[i].documents or []) for i in (1, 2, 3, 4, 6)] == [1, 0, 0, 0, 1]
    found = extract.extract(p)
    assert {(r.item, r.table_rank > 0) for r in found.collect()} == {("net income", False), ("net income", True)}
    best = extract.best_items(found).collect()
    assert [(r.submission, r.item_value, r.table_rank) for r in best] == [(1, 5.8e8, 0)]
    f = extract.filing_rows(extract.best_items(found), F.lit("2019Q2"), F.lit("2019-12-31").cast("date")).first()
    assert (f.fiscal_year, f.fiscal_quarter, str(f.fpe_date), f.is_overridden) == (2019, 1, "2019-03-31", False)


def test_sources(spark, tmp_path):
    (tmp_path / "cik.csv").write_text('cik,sic,sic_description,company_name,ticker\n0000000042,6022,"BANKS, STATE","A, Inc.",\n')
    assert filings.companies(spark, str(tmp_path / "cik.csv")).first().company_name == "A, Inc."
    (tmp_path / "s.txt").write_text(sgml("x"))
    assert filings.submissions(spark, str(tmp_path / "s.txt")).first().cik == "0000000042"
    pages = spark.createDataFrame([("<r><filing><dateFiled>2019-01-02</dateFiled><type>8-K</type><filingHREF>h</filingHREF></filing><filing><dateFiled>2019-01-02</dateFiled><type>10-Q</type><filingHREF>h</filingHREF><XBRLREF>x</XBRLREF></filing></r>",), (None,), ("<r/>",)], "xml string")
    assert [r.filing_type for r in filings.filing_list(pages).collect()] == ["8-K"] and filings.filing_list(pages, require_xbrl=True).count() == 0
    assert filings.filing_list(pages, kind="10-", require_xbrl=True).count() == 1
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages/1.xml").write_text("<r/>")
    spark.dataSource.register(filings.ListingSource)
    assert spark.read.format("filing_pages").option("path", str(tmp_path / "pages")).load().first().xml == "<r/>"
    assert filings.listing_requests(spark.createDataFrame([("1",)], "cik string"), pages=3).count() == 3
    land = spark.createDataFrame([("<div>Period of Report</div> <div>2018-11-03</div><a href='a.txt'><a href='b.txt'>",), ("<p>",)], "html string")
    assert [r.error for r in filings.landing_facts(land).collect()] == ["no submission link"] * 2
