"""Titles of tables that may hold the items, and texts that end the search."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column

from quarterloom.functions.lexer import HYPHENS, Phrase, by_value, lex, phrase, without_notes, without_remarks, words_of


@dataclass(frozen=True)
class Title:
    """One rank of titles: any of its phrases.  ``only`` and ``never`` name
    companies it is kept to or kept from."""

    phrases: tuple[Phrase, ...]
    only: frozenset[str] = frozenset()
    never: frozenset[str] = frozenset()


def title(*need: str, fill: str = "", place: str = "start", only: str = "", never: str = "") -> Title:
    return Title((phrase(*need, fill=fill, place=place),), frozenset(only.split()), frozenset(never.split()))


def _ranked() -> tuple[Title, ...]:
    """Best first.  Whole statements come before summaries, summaries before
    single figures; what stands at the start before what stands at the end."""
    # Words of titles, and companies with titles of their own.
    statement, report = "statement statements", "statement statements report reports"
    figures, data = "results metrics highlight highlights summary information data", "highlight highlights information results data"
    outcome, income, periodic = "income earnings loss operations", "income earnings", "quarterly condensed comparative"
    select = "select selected"
    one, two, three, four = "0000019617", "0000750556", "0001393612", "0001390777"
    out: list[Title] = []

    def both(*need: str, fill: str = "", places: tuple[str, ...] = ("start", "end")) -> None:
        out.extend(title(*need, fill=fill, place=p) for p in places)

    # consolidated statements
    both("consolidated", report, "of", outcome, fill=f"{periodic} the company s net comprehensive")
    both("consolidated", income, report, fill=f"{periodic} net information")
    both("consolidated", figures, fill=f"{periodic} {select} key financial operating earnings capital and other")
    out.append(title("financial", "statistical", "summary", "consolidated", fill="and", place="in"))
    both("consolidated", "balance", "sheet sheets", fill=periodic)
    both("consolidated", f"results {statement}", "of", "operation operations condition", fill="financial")
    out.append(title(statement, "of", "income", fill="loss", only=one))
    out.append(title(statement, "of", "income", "reported", "basis", only=one))
    # summaries
    lead = "key condensed summary supplemental additional #"
    both(lead, "financial operating statement", data, fill="quarterly income", places=("start", "in"))
    both("financial operating statement key", f"{data} metrics", fill=f"{select} quarterly income by quarter continued", places=("whole",))
    both(f"results {statement}", "of", "operation operations", fill="quarterly", places=("start", "in"))
    out.append(title("ratios data", fill=f"{select} key performance financial and"))
    both("summary", "of", "business", "results", places=("start", "in"))
    out.append(title("statistical financial", "summary", fill="statistical financial and", place="in"))
    # statements of one period
    brief = "quarterly summary condensed"
    out.append(title(brief, statement, "of", "income", fill=brief))
    out.append(title(brief, "income", f"{statement} data", fill=brief, never=two))
    out.append(title("quarterly", "performance results", "summary", never=two))
    out.append(title(statement, "of", "condition", fill=f"{brief} financial", never=two))
    out.append(title("earnings revenue", "summary", never=three))
    out.append(title("highlights", fill="financial"))
    out.append(title(statement, "of", income))
    out.append(title("income", f"{statement} data summary", never=two))
    out.append(title("balance", "sheet", fill="selected ending"))
    # single figures
    out.append(title("net", "interest", "income", "and", "net", "interest", "margin"))
    out.append(title("interest", "and", "dividend", "income"))
    out.append(title("reconciliation", "of", "total", "revenue", only=four))
    out.append(title("gaap", "basis"))
    out.append(title("per", "share", "related", "information"))
    out.append(title("income", "trend", "analysis", fill="statement"))
    out.append(title("financial", "statistics"))
    out.append(title("shareholders stockholders", "equity", fill="selected information for common"))
    out.append(title("allowance", "for", "credit", "losses"))
    out.append(Title((phrase("other", "data", "and", "ratios"), phrase("financial", "ratios"))))
    out.append(title("capital", "measures information ratios"))
    out.append(title("eop per", "share", "data", fill="eop per common"))
    out.append(title("efficiency", "ratio", fill="operating"))
    out.append(title("earnings"))
    return tuple(out)


#: In order of preference.
TITLES = _ranked()

#: Texts at which the search for a title ends.
STOPS = (
    phrase("non", "gaap", "financial", "measures", fill="definitions and reconciliation of gaap to", place="whole"),
    phrase("business", "segment segments", place="in"),
    phrase("segment", "results", place="in"),
    phrase("impact", "of", "restatement", "on", "prior", "period", "balances", place="whole"),
)

VOCABULARY = frozenset(["unaudited", "continued"]).union(*(p.vocabulary for t in TITLES for p in t.phrases), *(p.vocabulary for p in STOPS)) - {"s", "#"}


def title_words(text: str) -> list[str]:
    bare = "".join(c for c in text if c not in "'\x92’")
    return words_of(without_notes(without_remarks(lex(bare, VOCABULARY))))


@lru_cache(4096)
def titles_for(cik: str = "", titles: tuple[Title, ...] = TITLES) -> tuple[Title, ...]:
    """Titles that hold for a company; a rank is the place in this list."""
    return tuple(t for t in titles if (not t.only or cik in t.only) and cik not in t.never)


@lru_cache(100_000)
def title_rank(text: str, cik: str = "", titles: tuple[Title, ...] = TITLES) -> int | None:
    words = title_words(text)
    return next((i for i, t in enumerate(titles_for(cik, titles)) if any(p.found(words) for p in t.phrases)), None)


@lru_cache(100_000)
def ends_search(text: str, stops: tuple[Phrase, ...] = STOPS) -> bool:
    words = title_words(text)
    if any(p.found(words) for p in stops):
        return True
    t = [x.text for x in lex(text)]
    return any(a in HYPHENS and b == "subsidiaries" for a, b in zip(t, t[1:]))


def title_rank_column(c: Column, cik: str = "") -> Column:
    return by_value(lambda v: title_rank(v, cik), "bigint")(c)
