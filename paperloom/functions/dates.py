"""Dates of citation exports and of preprint pages, as `dd/MM/yyyy` strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paperloom.functions.wordlists import MONTH_NUMBERS, SEASON_STARTS

# Fixed value: day, three-letter month, four-digit year, with one whitespace character between them.
DATELINE_PATTERN = r"(?U)(\d{1,2}\s\w{3}\s\d{4})"
MISSING_DATE = "N/A"


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def _parts(date: Column):
    parts = F.split(date, " ", -1)
    month = F.element_at(F.split(F.get(parts, F.lit(1)), "-", -1), -1)
    return parts, month


def citation_date(date: Column) -> Column:
    """`2025 Jan-Dec 14` and the like; null when the month is unknown.

    A month range counts as its last month, a season as its first day, and a
    day is taken only when the text has exactly three parts.
    """
    parts, named_month = _parts(date)
    month = F.coalesce(named_month, F.lit("Jan"))
    day = F.when(F.size(parts) == 3, F.get(parts, F.lit(2))).otherwise(F.lit("1"))
    padded = F.when(F.length(day) < 2, F.lpad(day, 2, "0")).otherwise(day)
    year = F.get(parts, F.lit(0))
    season = F.element_at(_lookup(SEASON_STARTS), month)
    number = F.element_at(_lookup(MONTH_NUMBERS), month)
    # concat is null when the month number is, which marks the record as undatable
    return F.coalesce(F.concat(season, F.lit("/"), year), F.concat(padded, F.lit("/"), number, F.lit("/"), year))


def citation_date_unpadded(date: Column) -> Column:
    """Variant without seasons and without padding of a given day; the default day is `01`."""
    parts, named_month = _parts(date)
    day = F.when(F.size(parts) == 3, F.get(parts, F.lit(2))).otherwise(F.lit("01"))
    number = F.element_at(_lookup(MONTH_NUMBERS), F.coalesce(named_month, F.lit("Jan")))
    return F.concat(day, F.lit("/"), number, F.lit("/"), F.get(parts, F.lit(0)))


def citation_date_ymd(date: Column) -> Column:
    """Variant `yyyy/MM/dd`: null without a month, the day may be empty, no seasons."""
    parts, month = _parts(date)
    day = F.when(F.size(parts) == 3, F.get(parts, F.lit(2))).otherwise(F.lit(""))
    return F.concat(F.get(parts, F.lit(0)), F.lit("/"), F.element_at(_lookup(MONTH_NUMBERS), month), F.lit("/"), day)


def dateline_date(text: Column) -> Column:
    """First date in a dateline; `N/A` without one, null when it is no calendar date."""
    found = F.regexp_extract(text, DATELINE_PATTERN, 1)
    spaced = F.regexp_replace(found, r"[\s\p{Z}]", " ")
    parsed = F.try_to_timestamp(F.initcap(spaced), F.lit("d MMM yyyy"))
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(found == "", F.lit(MISSING_DATE))
        .otherwise(F.date_format(parsed, "dd/MM/yyyy"))
    )


def published_on(date: Column) -> Column:
    """The `dd/MM/yyyy` string as a date; null for `N/A` and for anything else."""
    return F.try_to_timestamp(date, F.lit("dd/MM/yyyy")).cast("date")
