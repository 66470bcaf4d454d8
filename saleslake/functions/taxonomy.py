"""Broad category of a product label, as one expression without join or UDF."""

import csv
import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, functions as F

from saleslake.functions.fixed_values import OTHER
from saleslake.functions.text import strip

# The rule files of the package; callers may hand in others (``sources.rules``).
EXACT_FILE = Path(__file__).parent.parent / "rules" / "exact.csv"
KEYWORD_FILE = EXACT_FILE.with_name("keywords.csv")


def _lines(path: Path) -> list[dict[str, str]]:
    with open(path, encoding="utf-8", newline="") as file:
        return list(csv.DictReader(line for line in file if not line.startswith("#")))


def _exact() -> dict[str, str]:
    return {r["label"]: r["category"] for r in _lines(EXACT_FILE)}


def _keywords() -> dict[str, list[str]]:
    words: dict[str, list[str]] = {}
    for r in sorted(_lines(KEYWORD_FILE), key=lambda r: int(r["priority"])):
        words.setdefault(r["category"], []).append(r["keyword"])
    return words


@dataclass(frozen=True)
class Taxonomy:
    """Exact labels, and keywords by category in order of precedence; those of the
    package unless given. Rule tables of any size are joined (``operators.classify``)."""

    exact: dict[str, str] = field(default_factory=_exact)
    keywords: dict[str, list[str]] = field(default_factory=_keywords)


def exact_category(label: Column, rules: Taxonomy) -> Column:
    """Category of a label listed as it stands, otherwise null."""
    labels_of: dict[str, list[str]] = {}
    for name, category in rules.exact.items():
        labels_of.setdefault(category, []).append(name)
    return F.coalesce(
        F.lit(None).cast("string"),
        *[F.when(label.isin(names), F.lit(category)) for category, names in labels_of.items()],
    )


def keyword_category(text: Column, rules: Taxonomy) -> Column:
    """First category with a keyword somewhere in the text, otherwise null."""
    return F.coalesce(
        F.lit(None).cast("string"),
        *[
            F.when(text.rlike("|".join(map(re.escape, words))), F.lit(category))
            for category, words in rules.keywords.items()
            if words
        ],
    )


def broad_category(label: Column, rules: Taxonomy | None = None) -> Column:
    """Exact label first, then keywords in order of precedence, then Other."""
    rules = rules or Taxonomy()
    text = F.upper(strip(label))
    return F.coalesce(exact_category(text, rules), keyword_category(text, rules), F.lit(OTHER))


def listed_category(label: Column, rules: Taxonomy | None = None) -> Column:
    """Exact labels only, as they stand in the silver table; anything else is Other."""
    return F.coalesce(exact_category(label, rules or Taxonomy()), F.lit(OTHER))
