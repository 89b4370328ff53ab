"""Terms of documents: tokens, adjacent pairs and their counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from paperloom.functions.text import adjacent_pairs, vector_tokens
from paperloom.session import even_labels, materialise_placed

FEATURES = ("unigram", "bigram")
PART_BYTES = 8 << 20  # text of one part; its counts take some fifteen times as much memory


def check_feature(feature: str) -> None:
    if feature not in FEATURES:
        raise ValueError(f"feature must be one of {FEATURES}, not {feature!r}")


def by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Documents spread by id.

    The raw text is the smallest form a document ever has here, so this is the
    cheapest place for the one shuffle: all per-document grouping below reuses
    this partitioning and adds none. The texts are measured first, so that what
    one task counts does not grow with the corpus, unless `parts` is given.
    """
    rows = docs.select(F.col(id_col), F.col(text_col))
    return rows.repartition(parts or text_parts(rows, text_col), id_col)


def text_parts(docs: DataFrame, text_col: str = "text") -> int:
    """Parts of at most PART_BYTES of text on average, and no fewer than cores unless shuffles have fewer."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("bytes")).first()["bytes"] or 0
    cores = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(1, cores, math.ceil(size / PART_BYTES))


def token_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per token: id, 0-based position, term."""
    return docs.select(id_col, F.posexplode(vector_tokens(F.col(text_col))).alias("pos", "term"))


def terms(
    docs: DataFrame, feature: str, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per occurrence of a unigram, or of an adjacent pair joined by a space; `keep` names columns kept before the id."""
    check_feature(feature)
    ids = [*keep, id_col]
    if feature == "unigram":
        return docs.select(*ids, F.explode(vector_tokens(F.col(text_col))).alias("term"))
    tokens = docs.select(*ids, vector_tokens(F.col(text_col)).alias("tokens"))
    pairs = tokens.select(*ids, adjacent_pairs("tokens")).where(F.col("second").isNotNull())
    return pairs.select(*ids, F.concat_ws(" ", "first", "second").alias("term"))


def term_counts(
    docs: DataFrame, feature: str, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None
) -> DataFrame:
    """Term frequency: (id, term, tf)."""
    spread = by_document(docs, id_col, text_col, parts)
    return terms(spread, feature, id_col, text_col).groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def placed_counts(docs: DataFrame, feature: str, parts: int, path: str) -> DataFrame:
    """As `term_counts`, written to `path`: (part, doc_id, term, tf), where `part` tells the documents that are dealt alike.

    Spark knows of the written rows that a part is a partition, so sums by part
    and joins by part and anything else move nothing.
    """
    labels = F.array(*[F.lit(label) for label in even_labels(docs.sparkSession, parts)])
    part = F.get(labels, F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int")).alias("part")
    spread = docs.select(part, "doc_id", "text").repartition(parts, "part")
    counts = terms(spread, feature, keep=("part",)).groupBy("part", "doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    return materialise_placed(counts, path, "part", parts)


def term_presence(docs: DataFrame, feature: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Binary weight: one row per (id, term)."""
    spread = by_document(docs, id_col, text_col)
    return terms(spread, feature, id_col, text_col).distinct().withColumn("weight", F.lit(1))


def feature_counts(docs: DataFrame, features: Sequence[str], buckets: int, parts: int = 1) -> DataFrame:
    """Term frequencies of several features: (doc_id, feature, term, tf) from (doc_id, text).

    A text is moved and tokenised once: each token gives its unigram and, with
    its follower, its pair. Documents are spread by id into `buckets` parts, or
    a multiple of them that is no less than `parts`, and counted there: each
    part belongs to one bucket.
    """
    for feature in features:
        check_feature(feature)
    spread = docs.select("doc_id", "text").repartition(buckets * math.ceil(parts / buckets), "doc_id")
    pairs = spread.select("doc_id", vector_tokens(F.col("text")).alias("tokens")).select("doc_id", adjacent_pairs("tokens"))
    made = {"unigram": F.col("first"), "bigram": F.concat(F.col("first"), F.lit(" "), F.col("second"))}
    # counted by the number of the feature, which is shorter than its name
    offered = [part for i, f in enumerate(features) for part in (F.lit(i), made[f])]
    occurrences = pairs.select("doc_id", F.stack(F.lit(len(features)), *offered).alias("number", "term"))
    there = occurrences.where(F.col("term").isNotNull())  # the last token has no follower
    counts = there.groupBy("doc_id", "number", "term").agg(F.count(F.lit(1)).alias("tf"))
    name = F.get(F.array(*[F.lit(f) for f in features]), F.col("number"))
    return counts.select("doc_id", name.alias("feature"), "term", "tf")
