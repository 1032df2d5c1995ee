"""The six items and the labels of their rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from quarterloom.functions.lexer import Phrase, lex, phrase, without_notes, words_of

#: Any of these phrases; the labels of an item come best first.
Label = tuple[Phrase, ...]


@dataclass(frozen=True)
class Item:
    """An item, the size below which a value without units is in thousands,
    and its row labels."""

    name: str
    least: float
    labels: tuple[Label, ...]

    @property
    def per_share(self) -> bool:
        return "per share" in self.name


def _items() -> tuple[Item, ...]:
    # Names of the items, words of their labels, and sizes.
    profit, basis, taxed = "income earnings profit loss", "gaap non", "fte taxable equivalent gaap non"
    sector = "direct finance loan and"
    back = "reversal recovery recapture reduction benefit credit negative"
    losses = "loss losses"
    # what may stand between a provision and the losses it is for
    around = f"less total {back} of in provision allowance for portfolio possible loan and lease covered non"
    return (
        Item("net income", 1e4, (
            (phrase("net", profit, fill=f"{profit} expense available for to common shareholders stockholders from operations #", place="end"),),
            (phrase("net", profit, "attributable", "to", fill="loss expense", never="noncontrolling"),),
        )),
        Item("net interest income", 1e5, (
            (phrase("net", "interest", "income revenue", fill=f"{sector} dividend loss expense other financing income after {back} of provision for lease losses {basis}", place="whole"),),
            (phrase("net", "interest", place="end"),),
            (phrase("net", "interest", "income", fill=taxed, place="whole"),),
        )),
        Item("interest income", 1e5, (
            (phrase("interest", "income revenue", fill=f"total {sector} fee dividend including other financing income", place="whole"),),
            (phrase("interest", "and", "dividend dividends", place="in"),),
            (phrase("interest", "income", fill=f"total {taxed}", place="whole"),),
        )),
        Item("provision for loan losses", 1e4, (
            (phrase("provision", "for", "credit loan", losses, fill=around), phrase("provision", "for", losses, "on", "credit loans", fill=around)),
            (phrase("recovery reversal", "of for", "credit", "losses"), phrase("recovery reversal", "of for", losses, "on", "credit loans", fill="covered non")),
            (phrase("loss", "provision", fill="loan", place="whole"),),
        )),
        Item("total revenue", 1e5, (
            (phrase("total", "revenue revenues", fill="net consolidated gaap"),),
            (phrase("net", "revenue revenues"),),
        )),
        Item("book value per share", 1, (
            (phrase("book", "value", fill=f"total common shareholders stockholders equity per outstanding share shares of stock at period end quarter basic dollars {basis}", place="whole"),),
            (phrase("book", "value", "per", "share", fill="common", place="in"),),
        )),
    )


ITEMS = _items()

VOCABULARY = frozenset().union(*(p.vocabulary for i in ITEMS for label in i.labels for p in label)) - {"#"}


@lru_cache(200_000)
def label_words(text: str) -> tuple[str, ...]:
    bare = "".join(c for c in text if c not in "'\x92’")
    return tuple(words_of(without_notes(lex(bare, VOCABULARY))))


def is_label(text: str, label: Label) -> bool:
    words = label_words(text)
    return any(p.found(words) for p in label)
