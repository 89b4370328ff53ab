"""Histogram sort: exact byte counts below candidate boundaries, refined until the shards are even."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paperloom.llm.common import MAX_RANGES, shuffle_width
from paperloom.session import materialise

FIRST_BITS = 12  # candidates of the first round: 4096 equal steps over the span of the keys
ROUND_BITS = 6  # each later round puts 64 candidates into every bracket that is still too wide
HEADER_BYTES = 8


def row_size(text: Column) -> Column:
    """Bytes a document takes in a shard: its UTF-8 text (null: none) and a header of eight bytes."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(HEADER_BYTES)


def _counts(rows: DataFrame, key: Column, low: int, shift: int, open_bins: list[int] | None, parent_shift: int) -> dict:
    """Bytes in each bin of width 2**shift, only in the open bins of the round before.

    The bins are partly added up in every task; what comes back has at most
    2**FIRST_BITS rows, or 2**ROUND_BITS for each boundary searched.
    """
    offset = key - F.lit(low)
    if open_bins is not None:
        rows = rows.where(F.shiftrightunsigned(offset, parent_shift).isin(open_bins))
    binned = rows.groupBy(F.shiftrightunsigned(offset, shift).alias("bin")).agg(F.sum("size").alias("bytes"))
    return {r["bin"]: r["bytes"] for r in binned.collect()}


def _search(rows: DataFrame, key: Column, low: int, high: int, targets: dict, base: int, allowed: int) -> dict:
    """For each target the candidate boundary nearest to it, with its bracket: {target: (key, below, bytes at the key)}.

    A search ends when the bytes below are within `allowed` of the target, or
    when the bracket is one key wide.
    """
    parent_shift = max(1, (high - low).bit_length())
    shift = max(0, parent_shift - FIRST_BITS)
    found: dict = {}
    place, below, open_bins = dict.fromkeys(targets, 0), {0: base}, None
    pending = dict(targets)
    while pending:
        counted = _counts(rows, key, low, shift, open_bins, parent_shift)
        by_parent: dict[int, list[int]] = {}
        for number in sorted(counted):
            by_parent.setdefault(number >> (parent_shift - shift), []).append(number)
        still, next_below = {}, {}
        for name, target in pending.items():
            running = below[place[name]]
            chosen, chosen_below = place[name] << (parent_shift - shift), running
            for number in by_parent.get(place[name], []):
                if running > target:
                    break
                chosen, chosen_below = number, running
                running += counted[number]
            inside = counted.get(chosen, 0)
            over = chosen_below + inside - target
            if 0 <= over <= allowed and over < target - chosen_below:
                found[name] = (low + ((chosen + 1) << shift), chosen_below + inside, 0)
            elif target - chosen_below <= allowed or shift == 0:
                found[name] = (low + (chosen << shift), chosen_below, inside if shift == 0 else 0)
            else:
                still[name], place[name], next_below[chosen] = target, chosen, chosen_below
        pending, below, open_bins = still, next_below, sorted(next_below)
        parent_shift, shift = shift, max(0, shift - ROUND_BITS)
    return found


def splitters(rows: DataFrame, parts: int, share: float) -> list[tuple[int, int]]:
    """`parts - 1` boundaries (key, tie) with even bytes between them, ascending; `share` of all bytes is the tolerance.

    `rows` has key, tie (unique within a key) and size. Keys are searched
    first; where the bytes of one key reach beyond the tolerance and beyond
    the largest row, the search goes on among the ties of that key.
    """
    span = rows.agg(
        F.min("key").alias("lo"), F.max("key").alias("hi"), F.sum("size").alias("bytes"), F.max("size").alias("largest")
    ).first()
    if span["bytes"] is None or parts < 2:
        return []
    total, lowest = span["bytes"], -(1 << 63)
    allowed = max(1, int(total * share))
    targets = {i: total * i // parts for i in range(1, parts)}
    out: dict[int, tuple[int, int]] = {}
    inside: dict[int, list[int]] = {}
    placed = _search(rows, F.col("key"), span["lo"], span["hi"], targets, 0, allowed)
    for i, (key, below, at_key) in placed.items():
        gap = targets[i] - below
        if gap > allowed and at_key > span["largest"]:
            inside.setdefault(key, []).append(i)
        else:
            out[i] = (key + 1 if gap > allowed and at_key - gap < gap else key, lowest)
    for key, members in inside.items():  # keys with many rows: fewer than the boundaries
        own = rows.where(F.col("key") == F.lit(key))
        ties = own.agg(F.min("tie").alias("lo"), F.max("tie").alias("hi")).first()
        fine = _search(
            own, F.col("tie"), ties["lo"], ties["hi"], {i: targets[i] for i in members}, placed[members[0]][1], allowed
        )
        for i, (tie, below, at_tie) in fine.items():
            gap = targets[i] - below
            out[i] = (key, tie + 1 if gap > allowed and at_tie - gap < gap else tie)
    return sorted(out.values())


def _above(bounds: list[tuple[int, int]]) -> Column:
    """Number of boundaries at or below (key, tie), as a balanced tree of comparisons."""
    key, tie = F.col("key"), F.col("tie")

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        at_key, at_tie = bounds[mid]
        reached = (key > F.lit(at_key)) | ((key == F.lit(at_key)) & (tie >= F.lit(at_tie)))
        return F.when(reached, tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(bounds)).cast("int")


def histogram_shards(
    docs: DataFrame,
    shards: int,
    key_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = 0.001,
    columns: dict[str, Column] | None = None,
) -> DataFrame:
    """Sort documents into `shards` ranges of the key with nearly equal bytes; exchange each row once.

    Returns the columns of `docs` (or the given expressions over them), with
    size, shard and slot: the place in the shard, gapless from 0, in key
    order. A shard is off its share by `tolerance` of a share or by half the
    largest document, whichever is more, at either end.

    A null key sorts first. Rows with the same key, also identical rows, are
    separate and stay in one order fixed when the keys are first written, so a
    key that holds a third of all rows is cut where the bytes require it. Null
    and empty texts count as the header only. An empty table gives no rows.
    Columns that clash with the added ones are not carried; name them through
    `columns`.
    """
    spark = docs.sparkSession
    added = ("size", "shard", "slot")
    kept = columns or {c: F.col(f"`{c}`") for c in docs.columns if c not in added}
    lowest = F.lit(-(1 << 62))
    keyed = docs.select(
        F.coalesce(F.col(key_col).cast("long"), lowest).alias("key"),
        row_size(F.col(text_col)).alias("size"),
        F.struct(*[e.alias(n) for n, e in kept.items()]).alias("row"),
    )
    # written before use: the ties are then the same in every round and after a lost executor
    rows = materialise(keyed.withColumn("tie", F.monotonically_increasing_id()), "shard-keys")
    sub = max(1, min(MAX_RANGES, shuffle_width(spark)) // shards)  # ranges in a shard: tasks of the exchange
    share = min(tolerance / shards, 0.25 / (shards * sub))
    bounds = splitters(rows.select("key", "tie", "size"), shards * sub, share)
    placed = rows.withColumn("range", _above(bounds))
    counts = {r["range"]: r["count"] for r in placed.groupBy("range").count().collect()}  # one row per range
    start, offsets = 0, []
    for number in range(shards * sub):
        if number % sub == 0:
            start = 0
        offsets.append(start)
        start += counts.get(number, 0)
    slot = F.row_number().over(W.partitionBy("range").orderBy("key", "tie")) - 1
    first = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("range") + 1)
    return placed.withColumn("slot", slot.cast("long") + first).select(
        "row.*", "size", F.floor(F.col("range") / sub).cast("int").alias("shard"), "slot"
    )
