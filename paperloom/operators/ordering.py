"""Consecutive numbers over a global order, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from paperloom.session import materialise


def numbered(rows: DataFrame, order_col: str, name: str, parts: int | None = None) -> DataFrame:
    """Add 0-based numbers in ascending order of a unique column.

    Rows are range-partitioned and sorted, so each range numbers itself and
    only the range sizes (one row per partition) are added up centrally. With
    `parts`, the tasks that the size of the rows takes, there are no fewer
    ranges than these, unless Spark joins small ones.
    """
    ordered = rows.repartitionByRange(order_col).sortWithinPartitions(order_col)
    # high bits: range number, low 33 bits: place in the range; written before use, so both stay fixed
    placed = materialise(ordered.withColumn("__place", F.monotonically_increasing_id()), "numbered", parts)
    split = placed.withColumns(
        {"__range": F.shiftright("__place", 33), "__within": F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    sizes = split.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    joined = split.join(F.broadcast(offsets), "__range")
    return joined.withColumn(name, F.col("__offset") + F.col("__within")).select(*rows.columns, name)


def with_row_index(articles: DataFrame, order_col: str) -> DataFrame:
    """Row position of each article in the declared order, the identity under which results are shown."""
    return numbered(articles, order_col, "doc_idx")
