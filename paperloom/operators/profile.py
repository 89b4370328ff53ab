"""Profile of an article table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def group_counts(articles: DataFrame, by: str = "Section") -> DataFrame:
    """Articles per section."""
    return articles.groupBy(by).agg(F.count(F.lit(1)).alias("n_articles"))


def null_counts(articles: DataFrame, columns=None) -> DataFrame:
    """One row: nulls per column, and texts `N/A` per column, in one pass."""
    columns = list(columns or articles.columns)
    return articles.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns],
        *[F.count_if(F.col(c).cast("string") == "N/A").alias(f"{c}_na") for c in columns],
    )


def shape(articles: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return articles.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(articles.columns)).cast("bigint").alias("n_columns"))


def sample_rows(articles: DataFrame, id_col: str, n: int = 10, seed: int = 0) -> DataFrame:
    """n rows in a random-looking order that depends on the seed and the id only, so it repeats on any layout."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return articles.orderBy(order, id_col).limit(n)
