"""Text search: all terms must occur, and a saturating rank."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_match(document_words: Column, terms: list[str]) -> Column:
    """Whether every term is among the words; never for a query without terms."""
    return F.lit(bool(terms)) & F.forall(F.array(*map(F.lit, terms)), lambda t: F.array_contains(document_words, t)) if terms else F.lit(False)


def text_rank(document_words: Column, terms: list[str]) -> Column:
    """0.1 * mean over the terms of tf / (tf + 1): between 0 and 0.1, so that it nudges a vector score and doesn't rule it."""
    tf = lambda t: F.size(F.filter(document_words, lambda w: w == t))
    total = sum((tf(t) / (tf(t) + 1) for t in terms), F.lit(0.0))
    return 0.1 * total / max(1, len(terms))
