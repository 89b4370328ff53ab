"""Text columns: missing values, tokens, adjacent pairs, combined texts.

Everything here is a row-local built-in expression, so it adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paperloom.functions.wordlists import BRACKET_MARKS, INFIX_MARKS, MISSING_TEXTS

# Fixed value: a vector token is a run of two or more letters, digits or underscores.
WORD_PATTERN = r"([\p{L}\p{N}_]{2,})"
# Whitespace as a Unicode-aware `strip` sees it, written out so that every regex dialect agrees.
SPACE_CLASS = r"\p{Z}\t\n\x0B\f\r\x1C-\x1F\x85"


def _class_body(marks) -> str:
    return "".join("\\" + m if m.isascii() else m for m in marks)


_SPLIT_MARKS = _class_body(INFIX_MARKS + BRACKET_MARKS)
INFIX_TOKEN_PATTERN = f"([^{SPACE_CLASS}{_SPLIT_MARKS}]+|[{_SPLIT_MARKS}])"


def blank_if_missing(col: Column) -> Column:
    """Null, empty and the usual missing-value spellings become the empty string."""
    return F.when(col.isNull() | col.isin(*MISSING_TEXTS), F.lit("")).otherwise(col)


def strip_text(col: Column) -> Column:
    """Remove Unicode whitespace from both ends."""
    return F.regexp_replace(col, f"^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$", "")


def combined_text(title: Column, abstract: Column) -> Column:
    """Title, one space, abstract; missing parts count as empty."""
    return F.concat(blank_if_missing(title), F.lit(" "), blank_if_missing(abstract))


def query_text(title: Column, abstract: Column) -> Column:
    """The stripped search text of a query entry."""
    empty = F.lit("")
    return strip_text(F.concat(F.coalesce(title, empty), F.lit(" "), F.coalesce(abstract, empty)))


def vector_tokens(text: Column) -> Column:
    """Lower-cased word tokens of a text, in order, as an array."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD_PATTERN), F.lit(1))


def infix_tokens(text: Column) -> Column:
    """Lower-cased tokens split at whitespace and punctuation; hyphen and slash stay inside words."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(INFIX_TOKEN_PATTERN), F.lit(1))


def keep_tokens(tokens: Column, words) -> Column:
    """Drop every token that is in the word list; a hash-set probe per token, no join."""
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(*words))


def adjacent_pairs(tokens: str) -> Column:
    """Generator of (first, second) for each token and its follower; the last row has a null second."""
    follower = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))
    return F.inline(F.arrays_zip(F.col(tokens).alias("first"), follower.alias("second")))
