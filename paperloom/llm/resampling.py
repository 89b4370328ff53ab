"""Importance resampling towards a target: bucket gains, perturbed scores, ranks by a distributed radix sort."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paperloom.session import materialise

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
DIGIT_BITS = 12  # a pass counts at most 4096 digits in each block
BLOCK_ROWS = 1 << 18  # rows of a block at most: what one group of a pass holds
PIECE_BYTES = 1 << 20

#: A-Z become a-z; digits, a-z and all bytes of other code points stay; every other byte parts words.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text in order, about a megabyte of text at a time."""
    start = 0
    while start < len(text):
        end = start + PIECE_BYTES
        # a cut only falls where a word ends
        while end < len(text) and _FOLD[text[end]] != 32:
            end += 1
        yield text[start:end].translate(_FOLD).split()
        start = end


def feature_buckets(text: bytes | None, max_words: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(new words, buckets of the features that end in them), piece by piece."""
    before: list[bytes] = []
    for words in word_pieces(text or b""):
        joined = before + words
        features = list(words)
        for n in range(2, max_words + 1):
            first = max(0, len(before) - n + 1)
            features += [b" ".join(joined[i : i + n]) for i in range(first, len(joined) - n + 1)]
        yield len(words), np.fromiter(map(crc32, features), "uint32", len(features)) % np.uint32(buckets)
        before = joined[max(0, len(joined) - max_words + 1) :] if max_words > 1 else []


def bucket_counts(texts: DataFrame, text_col: str, max_words: int, buckets: int) -> np.ndarray:
    """Features in each bucket over all texts: one array per task, added up by Spark; `buckets` numbers come back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, "int64")
        for batch in batches:
            for text in batch.column(0):
                for _, found in feature_buckets(text.as_py(), max_words, buckets):
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    counted = texts.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, "int64")
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of smoothed shares), by bucket."""
    extra = len(source)
    s_all, t_all = float(source.sum()) + extra, float(target.sum()) + extra
    pairs = zip(source.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in pairs], "int64")


def noise(seed: int, doc_id: int | None) -> int:
    """A Gumbel variate in thousandths, floored, fixed by the seed and the id; a null id counts as the empty string."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored_documents(docs: DataFrame, id_col: str, text_col: str, gains: np.ndarray, max_words: int, seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every text."""
    names = ["doc_id", "n_words", "n_features", "weight", "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                n_words = n_features = weight = 0
                for new, found in feature_buckets(text.as_py(), max_words, len(gains)):
                    n_words += new
                    n_features += len(found)
                    weight += int(gains[found].sum())
                out.append((doc_id, n_words, n_features, weight, weight + noise(seed, doc_id)))
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    asked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return asked.mapInArrow(score, ", ".join(f"{n} long" for n in names))


def _digit(high: Column, low: Column, low_bits: int, shift: int, width: int) -> Column:
    """`width` bits from bit `shift` upwards of the number whose last `low_bits` bits are `low`, the others `high`."""
    if shift >= low_bits:
        bits = F.shiftright(high, shift - low_bits)
    elif shift + width <= low_bits:
        bits = F.shiftrightunsigned(low, shift)
    else:
        kept = F.shiftrightunsigned(low, shift).bitwiseAND(F.lit((1 << (low_bits - shift)) - 1))
        bits = kept.bitwiseOR(F.shiftleft(high, low_bits - shift))
    return bits.bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def radix_ranked(rows: DataFrame, score: str, ident: str, rank: str) -> DataFrame:
    """Add 1-based ranks by falling `score`, then rising `ident` (bigint; nulls last), by least digits first.

    Each pass is one stable counting sort. Rows have global positions, and a
    block is a run of positions, so blocks are even whatever the keys are.
    Digits are counted in each block; running sums of the counts (over digits,
    then over blocks within a digit) give the first destination of every
    (block, digit), and a row's place among its like in the block gives its own.
    The exchange of the next pass takes it there. Each pass is written to the
    shared folder. Rows equal in both keys are ranked in the order they were read.
    """
    placed = materialise(rows.withColumn("__pos", F.monotonically_increasing_id()), "radix-rows")
    span = placed.agg(
        F.count(F.lit(1)).alias("n"), F.min(score).alias("lo"), F.max(score).alias("hi"),
        F.min(ident).alias("first"), F.max(ident).alias("last"),
    ).first()
    if not span["n"]:
        return placed.drop("__pos").withColumn(rank, F.lit(0).cast("long"))
    # the bits in which two ids may differ; all others are alike in every id
    low_bits = 0 if span["first"] is None else ((span["first"] ^ span["last"]) & ((1 << 64) - 1)).bit_length()
    low = F.coalesce(F.col(ident), F.lit(0).cast("long"))
    if low_bits == 64:  # both signs: unsigned order after the sign is turned over
        low = low.bitwiseXOR(F.lit(-(1 << 63)))
    high = (F.lit(span["hi"]) - F.col(score)) * 2 + F.col(ident).isNull().cast("long")
    total = low_bits + (2 * (span["hi"] - span["lo"]) + 1).bit_length()
    passes = -(-total // DIGIT_BITS)
    width = -(-total // passes)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block_rows = max(1024, min(BLOCK_ROWS, -(-span["n"] // tasks)))
    block = lambda pos: F.floor(pos / F.lit(block_rows)).cast("long").alias("__block")
    # positions of the first pass have gaps, but no two rows share one, so no block is over its size
    placed = placed.select("*", F.expr(f"__pos div {block_rows}").alias("__block"))
    for number in range(passes):
        digits = placed.withColumn("__digit", _digit(high, low, low_bits, number * width, width))
        counts = digits.groupBy("__digit", "__block").agg(F.count(F.lit(1)).alias("__n"))
        of_digit = W.partitionBy("__digit").orderBy("__block")
        in_digit = F.sum("__n").over(of_digit) - F.col("__n")
        # one row for each digit: at most 2**width of them
        sums = counts.groupBy("__digit").agg(F.sum("__n").alias("__all"))
        smaller = sums.select("__digit", (F.sum("__all").over(W.orderBy("__digit")) - F.col("__all")).alias("__smaller"))
        starts = counts.withColumn("__in", in_digit).join(F.broadcast(smaller), "__digit")
        starts = starts.select("__digit", "__block", (F.col("__smaller") + F.col("__in")).alias("__start"))
        alike = W.partitionBy("__block", "__digit").orderBy("__pos")
        ordered = digits.withColumn("__nth", F.row_number().over(alike)).join(starts, ["__block", "__digit"])
        moved = ordered.withColumn("__to", F.col("__start") + F.col("__nth") - 1)
        moved = moved.select(*rows.columns, F.col("__to").alias("__pos"), block(F.col("__to")))
        placed = materialise(moved, "radix-pass")
    return placed.select(*rows.columns, (F.col("__pos") + 1).alias(rank))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    max_words: int = 1,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Draw `percent` of the documents with at least `min_words` words, likelier the more they resemble `target`.

    Words are runs of ASCII letters and digits and of code points above 127,
    ASCII letters in lower case. Features are the runs of 1 to `max_words`
    words, hashed into buckets by crc32; a bucket's gain is the floored
    1000-fold logarithm of its smoothed share in `target` over that in `docs`.
    A score is the sum of gains and a Gumbel variate fixed by seed and id; the
    highest scores are drawn, which samples without replacement by weight.

    Returns doc_id, n_words, n_features, weight, score and rank (from 1; null if
    not drawn) for every row. Null and empty texts have no words and weight 0.
    Ties go to the smaller id, null ids come last; rows equal in id and score
    are ranked in any order. Repeated rows are documents of their own. Empty
    tables give no rows, an empty target gives gains against even shares. Other
    columns are not read.
    """
    gains = bucket_gains(
        bucket_counts(docs, text_col, max_words, buckets), bucket_counts(target, target_text_col, max_words, buckets)
    )
    scored = materialise(scored_documents(docs, id_col, text_col, gains, max_words, seed), "scored")
    able = scored.where(F.col("n_words") >= min_words)
    ranked = radix_ranked(able, "score", "doc_id", "rank")
    n_drawn = percent * able.count() // 100
    drawn = ranked.withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest)
