"""Text functions (T2, T3): tokenising and query text, as JVM expressions.

The analyzer is approximated by: lower-case, maximal runs of Unicode letters
and digits, minus the English stop words below.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The analyzer's default English stop words (33 words), in the
# public library's order.
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
]

TOKEN_PATTERN = r"[\p{L}\p{N}]+"


def raw_tokens(text: Column) -> Column:
    """Lower-cased letter/digit runs (no stop-word removal)."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def tokenize(text: Column, stop_words: list[str] | None = STOP_WORDS) -> Column:
    """Array of index terms of a text, in order."""
    toks = raw_tokens(text)
    if not stop_words:
        return toks
    return F.filter(toks, lambda t: ~t.isin(list(stop_words)))   # one hash set, not a list search


def query_text(kind: str, keep_description_label: bool = True) -> Column:
    """Short queries use the title, long ones the description.  Its
    `Description:` label is kept, so that `description` is a query term, unless
    `keep_description_label` is false."""
    if kind == "short":
        return F.col("title")
    if kind == "long":
        label = F.regexp_replace(F.col("description"), r"^\s*Description:", "")
        return F.col("description") if keep_description_label else label
    raise ValueError(f"unknown query kind {kind!r}")
