"""Keyword and category expressions (STR4, STR6, STR7, NUM3, J5).

The keyword lists are small (tens of words), so the "headline x keyword" theta join of the
reference is a fixed set of ``contains`` expressions evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import TIER_POINTS

# Asset type of a quote -> mention category it sets (D17: the explicit mapping).
DEFAULT_TYPE_TO_CATEGORY = {"index": "equities", "commodity": "commodities", "bond": "bonds",
                            "volatility": "volatility", "currency": "forex", "crypto": "crypto"}


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keyword_points(text: str | Column, tiers: Mapping[str, Sequence[str]],
                   points: Mapping[str, int] = TIER_POINTS, low: Column | None = None) -> Column:
    """STR4: sum of tier points over distinct keywords contained in lower(text); NULL -> 0.  ``low``: the lower-cased
    text as a column reference, where it is at hand."""
    low = F.lower(_c(text)) if low is None else low
    terms = []
    for tier, words in tiers.items():
        pts = points.get(tier, 0)
        for kw in dict.fromkeys(words):
            terms.append(F.when(F.contains(low, F.lit(kw.lower())), F.lit(pts)).otherwise(F.lit(0)))
    if not terms:
        return F.lit(0).cast("double")
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.when(_c(text).isNull(), F.lit(0)).otherwise(total).cast("double")


def price_stress(change_percent: str | Column) -> Column:
    """NUM3: abs(change%) > 2 -> min(abs/2, 5), else 0; NULL -> 0."""
    a = F.abs(_c(change_percent))
    return F.when(a > 2, F.least(a / 2, F.lit(5.0))).otherwise(F.lit(0.0))


def mentions(text: str | Column, words: Sequence[str], low: Column | None = None) -> Column:
    """STR6: 1 if any word (case-insensitive) is contained in the text, else 0 (NULL -> 0)."""
    low = F.lower(_c(text)) if low is None else low
    cond = None
    for w in dict.fromkeys(words):
        e = F.contains(low, F.lit(w.lower()))
        cond = e if cond is None else (cond | e)
    if cond is None:
        return F.lit(0)
    return F.when(_c(text).isNotNull() & cond, F.lit(1)).otherwise(F.lit(0))


def mention_columns(text: str | Column, categories: Mapping[str, Sequence[str]],
                    type_col: str | Column | None = None,
                    type_to_category: Mapping[str, str] = DEFAULT_TYPE_TO_CATEGORY, low: Column | None = None) -> list[Column]:
    """STR6 + STR7: one ``mentions_<category>`` int column per category; a row whose asset type
    maps to the category is flagged too."""
    cols = []
    for cat, words in categories.items():
        m = mentions(text, words, low)
        if type_col is not None:
            types = [t for t, c in type_to_category.items() if c == cat]
            if types:
                m = F.when(_c(type_col).isin(types), F.lit(1)).otherwise(m)
        cols.append(m.cast("int").alias(f"mentions_{cat}"))
    return cols
