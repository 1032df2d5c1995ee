"""Sources: filing lists (XML), submissions (SGML text), landing pages, CSV.

Pages are read where they were landed or fetched by the executors, with
retries; `listing_requests` and `unfinished_lists` say which pages to fetch.
"""

from __future__ import annotations

import datetime as dt
import glob
import time
import urllib.request
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quarterloom.functions import periods
from quarterloom.operators.store import COMPANY


def companies(spark: SparkSession, path: str) -> DataFrame:
    """Company dimension from CSV, every column text."""
    return spark.read.csv(path, header=True, schema=COMPANY, quote='"', escape='"')


def submissions(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed submission file, parsed."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("raw"))
    return parse_submissions(raw)


def between_tags(c: Column, tag: str) -> Column:
    """Contents of each ``<tag>...</tag>``, case-sensitive, not nested."""
    return F.regexp_extract_all(c, F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))


def parse_submissions(raw: DataFrame, text: str = "raw") -> DataFrame:
    """``raw`` with ``number``, ``cik``, and ``documents``: the HTML texts of
    its documents that are no graphics.  Missing parts are null or empty."""
    c = F.col(text)
    header = F.get(between_tags(c, "SEC-HEADER"), F.lit(0))
    some = lambda x: F.when(x != "", x)
    docs = between_tags(c, "DOCUMENT")
    kind = lambda d: F.trim(F.regexp_extract(d, "<TYPE>([^\\n]+)", 1))
    name = lambda d: F.trim(F.regexp_extract(d, "<FILENAME>([^\\n]+)", 1))
    wanted = F.filter(docs, lambda d: (kind(d) != "GRAPHIC") & name(d).rlike("\\.html?$"))
    texts = F.flatten(F.transform(wanted, lambda d: between_tags(d, "TEXT")))
    return raw.withColumns(
        {
            "number": some(F.trim(F.regexp_extract(c, "<SEC-DOCUMENT>([^\\n]+)", 1))),
            "cik": some(F.regexp_extract(header, "CENTRAL INDEX KEY:\\s+([0-9]+)", 1)),
            "documents": texts,
        }
    )


_FILING = "array<struct<dateFiled:string,type:string,filingHREF:string,XBRLREF:string>>"
_INFO = "struct<CIK:string,SIC:string,SICDescription:string,name:string>"
_PAGE = f"filing {_FILING}, results struct<filing:{_FILING}>, companyInfo {_INFO}, bad string"


def _parsed(pages: DataFrame, xml: str) -> DataFrame:
    """``pages`` with their XML parsed as ``page``; a page that is no XML is
    dropped, as one that holds nothing."""
    page = F.from_xml(F.col(xml), _PAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    return pages.withColumn("page", page).where("page is not null and page.bad is null").drop(xml)


def filing_list(pages: DataFrame, xml: str = "xml", kind: str = "8-", require_xbrl: bool = False, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Filings of XML list pages, ``filing_date, filing_type, filing_href``,
    besides the page's other columns.  ``kind`` is a form or what it begins
    with, ``require_xbrl`` keeps filings with an XBRL link.

    Pages are parsed as XML, so entities are resolved; filings stand below the
    root or its ``results``; a page that is no XML gives none.
    """
    p = _parsed(pages, xml)
    keep = [c for c in pages.columns if c != xml]
    none = F.array().cast(_FILING)
    rows = p.select(*keep, F.inline(F.concat(F.coalesce("page.filing", none), F.coalesce("page.results.filing", none))))
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    out = rows.select(*keep, blank("dateFiled").try_cast("date").alias("filing_date"), blank("type").alias("filing_type"), blank("filingHREF").alias("filing_href"), F.col("XBRLREF").alias("xbrl"))
    out = out.where(F.col("filing_type").startswith(kind))
    if require_xbrl:
        out = out.where("xbrl is not null")
    if start:
        out = out.where(F.col("filing_date") >= F.lit(start))
    if end:
        out = out.where(F.col("filing_date") <= F.lit(end))
    return out.drop("xbrl")


def unfinished_lists(pages: DataFrame, xml: str = "xml", cik: str = "cik", offset: str = "offset", per_page: int = 100, start: dt.date | None = None) -> DataFrame:
    """``(cik, offset, number)``: the next page to fetch of each company whose
    last page held filings; lists are newest first, so one that has come to a
    filing before ``start`` is at its end."""
    f = filing_list(pages.select(cik, offset, xml), xml, kind="")
    last = f.groupBy(cik).agg(F.max(offset).alias("at"), F.min("filing_date").alias("oldest"))
    seen = pages.groupBy(cik).agg(F.max(offset).alias("asked"))
    more = last.join(seen, cik).where("at = asked")
    more = more if start is None else more.where(F.coalesce(F.col("oldest") >= F.lit(start), F.lit(True)))
    return more.select(cik, (F.col("at") + per_page).alias("offset"), F.lit(per_page).alias("number"))


def company_info(pages: DataFrame, xml: str = "xml") -> DataFrame:
    """Company facts of XML pages; name and number are required."""
    x = lambda t: F.nullif(F.trim(F.col(f"page.companyInfo.{t}")), F.lit(""))
    none = F.lit("Unknown")
    out = _parsed(pages, xml).select(x("CIK").alias("cik"), F.coalesce(x("SIC"), none).alias("sic"), F.coalesce(x("SICDescription"), none).alias("sic_description"), x("name").alias("company_name"))
    return out.dropna(subset=["cik", "company_name"])


# --- landing pages --------------------------------------------------------------------
def _table(c: Column, summary: str) -> Column:
    """Markup of the tables with that summary."""
    return F.array_join(F.regexp_extract_all(c, F.lit(rf"""(?is)<table[^>]*summary\s*=\s*["']{summary}["'][^>]*>(.*?)</table>"""), F.lit(1)), " ")


def _labelled(table: Column, label: str, ending: str, after: bool = True) -> Column:
    """Links with ``ending`` in their address in the rows that have a cell with
    ``label`` before them, or behind them."""
    rows = F.filter(F.split(table, "(?i)<tr[^>]*>"), lambda r: r.contains(label))
    beside = lambda r: F.substring_index(r, label, -1) if after else F.substring_index(r, label, 1)
    found = F.flatten(F.transform(rows, lambda r: F.regexp_extract_all(beside(r), F.lit(rf"""(?i)<a[^>]*href\s*=\s*["']([^"']*\{ending}[^"']*)["']"""), F.lit(1))))
    return F.array_distinct(found)


def _one_of(label: str, *paths: Column) -> tuple[Column, Column]:
    """The link of the first path with exactly one, and why there is none:
    then the last path tells."""
    single = F.coalesce(*[F.when(F.size(p) == 1, p[0]) for p in paths])
    last = F.size(paths[-1])
    error = F.when(single.isNotNull(), None).when(last == 0, f"no {label} link").otherwise(f"more than one {label} link")
    return single, error


def landing_facts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Period end, fiscal year end, fiscal period and links of filing landing
    pages: ``href`` of the submission's text, in the row that says so, and
    ``xbrl_href`` of the XBRL instance, by its description or else by its
    type.  ``error`` and ``xbrl_error`` say where there is not exactly one."""
    c = F.col(html)
    fpe = F.regexp_extract(c, r"Period of Report</div>\s*<div[^>]*>\s*([0-9]{4}-[0-9]{2}-[0-9]{2})", 1).try_cast("date")
    form = F.trim(F.regexp_extract(c, r"""(?s)id=["']formName["'][^>]*>\s*<strong>(.*?)</strong>""", 1))
    mmdd = F.regexp_extract(c, r"Fiscal Year End:\s*<strong>\s*([0-9]+)", 1)
    documents, data = _table(c, "Document Format Files"), _table(c, "Data Files")
    href, error = _one_of("submission", _labelled(documents, "submission", ".txt"))
    xbrl, xbrl_error = _one_of("XBRL", _labelled(data, "INSTANCE", ".xml"), _labelled(data, "EX-101.INS", ".xml", after=False))
    out = pages.withColumns({"fpe_date": fpe, "form": form, "mmdd": mmdd, "href": href, "error": error, "xbrl_href": xbrl, "xbrl_error": xbrl_error})
    out = out.withColumn("fye_date", periods.fye_from_mmdd(F.col("fpe_date"), F.col("form"), F.col("mmdd")))
    return out.withColumn("fiscal_period", periods.from_fpe_date(F.col("fye_date"), F.col("fpe_date"))).drop("form", "mmdd")


# How often a page is asked for, and the seconds between.
ATTEMPTS, FIRST_WAIT, LONGEST_WAIT = 7, 1.0, 10.0


def fetch(url: str, attempts: int = ATTEMPTS, first: float = FIRST_WAIT, longest: float = LONGEST_WAIT) -> str:
    """The text at an address; failures are tried again after growing waits,
    the last one is raised."""
    for n in range(attempts):
        try:
            with urllib.request.urlopen(url) as page:
                return page.read().decode("utf-8", errors="replace")
        except OSError:
            if n + 1 == attempts:
                raise
            time.sleep(min(longest, first * 2**n))
    raise ValueError("at least one attempt is needed")


def fetched(links: DataFrame, column: str = "href", attempts: int = ATTEMPTS, first: float = FIRST_WAIT) -> DataFrame:
    """``links`` with ``raw``, the text at each address, and ``fetch_error``
    where it cannot be had; executors fetch in parallel."""

    @F.pandas_udf("raw string, fetch_error string")
    def get(s: pd.Series) -> pd.DataFrame:
        got = []
        for url in s:
            try:
                got.append((None if url is None else fetch(url, attempts, first), None))
            except (OSError, ValueError) as e:  # one address must not fail the rest
                got.append((None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(got, columns=["raw", "fetch_error"], dtype=object)

    return links.withColumn("got", get(column)).select("*", "got.raw", "got.fetch_error").drop("got")


class ListingReader(DataSourceReader):
    """One input partition per page of a company's filing list: a landed file,
    or a page to fetch."""

    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        o = self.options
        if "url" in o:
            per_page = int(o.get("number", 100))
            offsets = range(0, per_page * int(o.get("pages", 1)), per_page)
            return [InputPartition(o["url"].format(cik=c.strip(), offset=n, number=per_page)) for c in o["ciks"].split(",") for n in offsets]
        return [InputPartition(p) for p in sorted(glob.glob(f"{o['path']}/*.xml"))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        at = partition.value
        if "url" in self.options:
            yield at, fetch(at)
            return
        with open(at, encoding="utf-8", errors="replace") as f:
            yield at, f.read()


class ListingSource(DataSource):
    """``spark.read.format("filing_pages")``: list pages as text, landed in
    the folder ``path``, or fetched from ``url``, an address with ``{cik}``,
    ``{offset}`` and ``{number}``, for the companies ``ciks``."""

    @classmethod
    def name(cls) -> str:
        return "filing_pages"

    def schema(self) -> str:
        return "page string, xml string"

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options)


def listing_requests(ciks: DataFrame, per_page: int = 100, pages: int = 1) -> DataFrame:
    """``(cik, offset, number)`` of the list pages to fetch."""
    return ciks.select("cik", F.explode(F.sequence(F.lit(0), F.lit(per_page * (pages - 1)), F.lit(per_page))).alias("offset"), F.lit(per_page).alias("number"))
