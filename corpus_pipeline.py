"""From documents to packed training sequences: language, toxicity, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of documents; other columns of the input are not carried.
Stages lower how much text goes to a Python worker at a time, unless the
session says it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.llm.common import id_remainder, read
from paperloom.llm.language import ENOUGH_GRAMS, UNDETERMINED, identify_languages, ordinary_cosine, train_languages
from paperloom.llm.near_duplicates import near_duplicate_classes
from paperloom.llm.packing import pack_sequences
from paperloom.llm.passages import remove_repeated_passages
from paperloom.llm.toxicity import score_toxicity, train_toxicity
from paperloom.session import fresh_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 1
# Spark fills up to 64 MB of rows for a Python worker at a time, which executor and worker both hold several times over.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1024", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage with BATCHES for what the session leaves open; they must still hold when its result is written."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in BATCHES.items():
            if spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; the others go.

    Texts without a letter have no language. A longer text goes too if it is
    much further from every language than the labelled texts are from their
    own: noise, or a language that was never learned. Texts too short to tell
    stay.
    """
    usable = id_remainder(F.col("doc_id"), 4) != 2
    model = train_languages(docs, usable)
    least = ordinary_cosine(docs, usable, model)
    found = identify_languages(docs, model, keep=COLUMNS)
    known = (F.col("lang_pred") != UNDETERMINED) & ((F.col("score") >= least) | (F.col("grams") < ENOUGH_GRAMS))
    return found.where(known).select(*COLUMNS)


@in_small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or score stays below one half."""
    model = train_toxicity(docs, read(spark, sf_dir, "labels"), id_remainder(F.col("doc_id"), 5) != 0)
    return score_toxicity(docs, model, keep=COLUMNS).where(F.col("predicted") == 0).select(*COLUMNS)


@in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the least id; of identical rows one."""
    own = docs.select(*COLUMNS).withColumn("text_key", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    standing = near_duplicate_classes(docs).where("keeps").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
    return own.join(standing.distinct(), same, "left_semi").dropDuplicates(["doc_id", "text_key"]).select(*COLUMNS)


@in_small_batches
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that start earlier; documents that consist of nothing else go."""
    cut = remove_repeated_passages(docs, keep=("lang", "source"), as_written=True)
    left = cut.where((F.col("n_removed") == 0) | (F.col("kept_text") != ""))
    text = F.col("kept_text")
    return left.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


@in_small_batches
def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their ids and their places in sequences of 2048."""
    return pack_sequences(docs, TOKENIZER, END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("language", keep_known_languages),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("passages", cut_repeated_passages),
    ("packing", pack_documents),
]

#: Trained scores, similarity classes and tokenizers cannot be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    opened = [key for key in BATCHES if spark.conf.get(key, None) is None]
    try:
        for name, stage in STAGES:
            path = fresh_path(spark, f"pipeline-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    finally:
        for key in opened:
            spark.conf.unset(key)
    return docs
