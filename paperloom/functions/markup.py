"""Fragments of saved HTML pages.

Pages are cut down by built-in regular expressions on the JVM; only the small
fragments that hold a title, names or an abstract pass through Python, where
character references are decoded.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from paperloom.functions.text import strip_text


def without_comments(page: Column) -> Column:
    return F.regexp_replace(page, r"(?s)<!--.*?-->", "")


def class_pattern(tag: str, name: str) -> str:
    """Start tag whose class list holds `name`."""
    return rf"""<{tag}\b[^>]*\bclass\s*=\s*["'](?:[^"'>]*\s)?{name}(?:\s[^"'>]*)?["'][^>]*>"""


def inner(page: Column, start: str, end: str) -> Column:
    """Markup between the first `start` and the next `end` (or the end of the page); null without `start`."""
    found = F.regexp_extract_all(page, F.lit(rf"(?is){start}(.*?)(?:{end}|\z)"), F.lit(1))
    return F.get(found, F.lit(0))


_DIV_TAG = re.compile(r"<(/?)div\b[^>]*>", re.IGNORECASE)


def _until_closed(rest: str) -> str:
    """Markup up to the end tag that belongs to a block opened just before."""
    depth = 1
    for tag in _DIV_TAG.finditer(rest):
        depth += -1 if tag.group(1) else 1
        if not depth:
            return rest[: tag.start()]
    return rest


@F.pandas_udf(StringType())
def _balanced(rests: pd.Series) -> pd.Series:
    return rests.map(_until_closed, na_action="ignore")


def inner_div(page: Column, start: str) -> Column:
    """Markup inside the first block that `start` opens, with the blocks nested in it; null without one.

    Only markup with nested blocks goes through Python.
    """
    rest = F.get(F.regexp_extract_all(page, F.lit(rf"(?is){start}(.*)"), F.lit(1)), F.lit(0))
    plain = F.regexp_extract(rest, r"(?is)^(.*?)(?:</div\b[^>]*>|\z)", 1)
    nested = plain.rlike(r"(?i)<div\b")
    return F.when(nested, _balanced(F.when(nested, rest))).otherwise(plain)


def plain_markup(fragment: Column) -> Column:
    """Fragment without tags, character references still encoded."""
    return F.regexp_replace(fragment, r"(?s)<[^>]*>", "")


@F.pandas_udf(StringType())
def _decoded(fragments: pd.Series) -> pd.Series:
    return fragments.map(html.unescape, na_action="ignore")


def decoded(fragment: Column) -> Column:
    """Character references replaced by their characters."""
    return _decoded(fragment)


def text_of(fragment: Column) -> Column:
    """Visible text of a fragment, stripped."""
    return strip_text(decoded(plain_markup(fragment)))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in a start tag, '' when absent."""
    return F.regexp_extract(tag, rf"""(?is)(?<![\w-]){name}\s*=\s*["']?([^"'\s>]*)""", 1)
