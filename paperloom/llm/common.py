"""What several operators share: inputs, ranges over a global order, rules for nulls."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAX_RANGES = 4096  # boundaries become an expression, so their number has a fixed limit


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo `divisor`; null without an id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def check_kept(keep: tuple[str, ...], added: tuple[str, ...]) -> None:
    """Columns that a result is to carry must not have the names of its own columns."""
    clash = sorted({c.lower() for c in keep} & {c.lower() for c in added})
    if clash:
        raise ValueError(f"rename the columns {clash} first: the result has columns of its own by these names")


def shuffle_width(spark: SparkSession) -> int:
    """How many tasks a shuffle has; a fixed limit holds for lists kept by the driver."""
    return max(1, min(MAX_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def range_bounds(rows: DataFrame, key: str, parts: int) -> list[int]:
    """Ascending boundaries that split a bigint column into about `parts` even ranges.

    The sketch is merged across tasks and has at most `parts - 1` values; it
    only balances work, results never depend on where the boundaries fall.
    """
    if parts < 2:
        return []
    wanted = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx(key, wanted, max(10_000, 20 * parts)).alias("b")).first()["b"]
    return sorted(set(found or []))


def range_of(key: Column, bounds: list[int]) -> Column:
    """Number of boundaries at or below the key, as a balanced tree of comparisons; null keys are in range 0."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key >= F.lit(bounds[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(bounds)).cast("int")


def range_number(key: int | None, bounds: list[int]) -> int:
    """`range_of` for a value that the driver holds."""
    return 0 if key is None else bisect_right(bounds, key)


def by_rows(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """The same rows in pieces of at most `size`, so that work arrays stay small."""
    for batch in batches:
        for start in range(0, len(batch), size):
            yield batch.iloc[start : start + size]
