"""Article records: required fields, rejects, column order, unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Column order of the two article tables.
PREPRINT_COLUMNS = ("DOI", "Title", "Authors", "Abstract", "Section", "Date")
JOURNAL_COLUMNS = ("DOI", "Title", "Authors", "Abstract", "Journal", "Date")


def computed_once(rows: DataFrame, keep, columns: list[Column]) -> DataFrame:
    """`keep` plus the given columns, each evaluated once per row.

    A filter on plain projected columns is pushed below the projection together
    with a copy of their expressions, which repeats costly extracts. A one-row
    generator stops that and adds neither rows nor a shuffle.
    """
    return rows.select(*keep, F.inline(F.array(F.struct(*columns))))


def first_missing(required) -> Column:
    """Name of the first required field that is null or empty, in the given order; null when complete."""
    return F.coalesce(*[F.when(F.col(f).isNull() | (F.col(f) == ""), F.lit(f)) for f in required])


def complete_records(records: DataFrame, required) -> DataFrame:
    """Records in which every required field has a value."""
    return records.where(first_missing(required).isNull())


def rejected_records(records: DataFrame, required, keep=("path",)) -> DataFrame:
    """(keep..., missing_field) of the incomplete records."""
    return records.select(*keep, first_missing(required).alias("missing_field")).where(
        F.col("missing_field").isNotNull()
    )


def project_corpus(articles: DataFrame, columns=PREPRINT_COLUMNS, keep=()) -> DataFrame:
    """The article table in its fixed column order."""
    return articles.select(*keep, *columns)


def union_sections(sections: list[DataFrame]) -> DataFrame:
    """Append the articles of all sections; an article listed in two sections stays twice."""
    return reduce(lambda a, b: a.unionByName(b), sections)
