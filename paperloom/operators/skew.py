"""Joins that stay balanced when one key holds a large share of the rows.

Frequent keys are found by counting. With `T` rows in all, at most `m` keys can
have `T / m` rows or more, so the table of frequent keys has a proven bound and
may be broadcast; every other key has fewer than `T / m` rows and is safe to
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from paperloom.session import materialise

MAX_FREQUENT_KEYS = 50_000
SHORT_KEY_BYTES = 64
SALTS = 64
UNBOUNDED = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
MAX_BROADCAST_BYTES = 64 << 20
MAX_SHORT_KEYS = MAX_BROADCAST_BYTES // 128  # a short key takes no more than that when hashed


def key_counts(rows: DataFrame, key: str) -> DataFrame:
    """Rows per key; partial counts are combined before the shuffle."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def frequent_keys(counts: DataFrame, key: str, max_keys: int = MAX_FREQUENT_KEYS) -> DataFrame:
    """Keys with at least 1/max_keys of all rows: never more than `max_keys` of them."""
    total = counts.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).scalar()
    return counts.where(F.col("n_rows") * max_keys >= total).select(key, "n_rows")


def frequent_rows(table: DataFrame, key: str, size: str, max_keys: int = MAX_FREQUENT_KEYS, max_short_keys: int | None = None) -> Column:
    """Whether a key of a table that knows its number of rows, `size`, has at least 1/max_keys of all rows.

    Keys of up to SHORT_KEY_BYTES may be more, `max_short_keys`.
    """
    total = table.agg(F.coalesce(F.sum(size), F.lit(0))).scalar()
    frequent = F.col(size) * max_keys >= total
    if max_short_keys is None:
        return frequent
    return frequent | ((F.col(size) * max_short_keys >= total) & (F.octet_length(key) <= SHORT_KEY_BYTES))


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    how: str = "inner",
    counts: DataFrame | None = None,
    max_keys: int = MAX_FREQUENT_KEYS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    parts: int | None = None,
    size: str | None = None,
    null_keys: bool = True,
    max_short_keys: int | None = None,
) -> DataFrame:
    """Join `rows` to `table` (one row per key) without sending a frequent key to one task.

    Rows of frequent keys meet a bounded broadcast table where they are; only
    the remaining rows are shuffled. Where the table holds texts or lists, those
    of the frequent keys are measured; beyond `max_bytes` their rows are dealt
    over SALTS tasks for each key instead. `rows` is read more than once, so
    pass a written table. `how` is `inner` or `left`. The rows that are shuffled
    go to `parts` tasks, where the caller knows how many their size takes; each
    then holds its share of the table. `size` names a column of the table that
    is the number of rows of the key, so that nothing has to be counted or
    looked up for the frequent keys; of these, keys of up to SHORT_KEY_BYTES
    may be more, `max_short_keys`. Without `null_keys` no row lacks its key.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if size is None:
        if counts is None:
            counts = key_counts(rows.where(F.col(key).isNotNull()), key)
        hot = frequent_keys(counts, key, max_keys).select(key)
        hot_table = hot.join(table, key, how)
    else:
        hot_table = table.where(frequent_rows(table, key, size, max_keys, max_short_keys))
        hot = hot_table.select(key)
    if any(isinstance(f.dataType, UNBOUNDED) for f in table.schema if f.name != key):
        # a bound of the number of keys is none of the bytes where values are long
        hot_table = materialise(hot_table, "frequent-values")
        lengths = [F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)) for c in hot_table.columns]
        hot_bytes = hot_table.agg(F.coalesce(F.sum(sum(lengths, F.lit(0))), F.lit(0)).alias("bytes")).first()["bytes"]
    else:
        hot_bytes = 0
    if hot_bytes <= max_bytes:
        hot_rows = rows.join(F.broadcast(hot_table), key, "inner")
    else:
        salted = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
        copies = hot_table.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        hot_rows = salted.join(copies, [key, "__salt"], "inner").drop("__salt")
    named = rows.where(F.col(key).isNotNull()) if null_keys else rows
    cold = named.join(F.broadcast(hot), key, "left_anti")
    if parts is not None:
        # a share of the table, of one row a key, is small and hashed: neither side is sorted
        cold, table = cold.repartition(parts, key), table.repartition(parts, key).hint("shuffle_hash")
    cold_rows = cold.join(table, key, how)
    joined = hot_rows.unionByName(cold_rows)
    if how == "inner" or not null_keys:
        return joined
    # rows without a key match nothing and would otherwise all be shuffled to one place
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in table.schema if f.name != key}
    return joined.unionByName(rows.where(F.col(key).isNull()).withColumns(nothing))
