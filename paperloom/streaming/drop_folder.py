"""Citation exports and queries as they arrive in a folder.

The record extract is row-local and stateless, so the batch code runs
unchanged on a file stream; there is no watermark and no state to keep.
Queries are answered batch by batch against one version of an index.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from paperloom.plans.search import search_texts
from paperloom.session import fresh_path, scratch
from paperloom.sources import index_store
from paperloom.sources.citations import write_query_outcomes
from paperloom.sources.nbib import nbib_articles


def arriving_files(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """(path, text), one row per new file."""
    reader = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def collect_exports(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append the complete records of all files that are new since the last run, then stop."""
    articles = nbib_articles(arriving_files(spark, folder))
    writer = articles.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(out)


FOUND_SCHEMA = "query_id string, rank int, doc_id bigint, score double, batch bigint"
REJECTED_SCHEMA = "query_id string, reason string, batch bigint"


def pinned_version(spark: SparkSession, base: str, corpus: str, out: str) -> index_store.Manifest:
    """The version that `out` is answered from: the newest when it was begun, the same after every restart."""
    path = f"{out}/_snapshot"
    try:
        row = spark.read.schema("corpus string, version string").json(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    if row is not None:
        return index_store.manifest_by_id(spark, base, row["corpus"], row["version"])
    manifest = index_store.read_manifest(spark, base, corpus)
    if manifest is None:
        raise ValueError(f"corpus {corpus!r} has no index to search")
    spark.createDataFrame([(corpus, manifest.id)], "corpus string, version string").coalesce(1).write.json(path)
    return manifest


def answer_arrivals(
    files: DataFrame, base: str, corpus: str, out: str, checkpoint: str, key: str = "path", mode: str = "compat", **options
) -> StreamingQuery:
    """Answer a stream of citation files (path, text) as queries: `out`/found and `out`/rejected, then stop.

    All batches ask the same version of the index, see `pinned_version`. A
    batch writes its answers to folders of its own number; one that fails and
    is run again after a restart writes them anew, so that every file is
    answered exactly once. `options` are those of `search_texts`. Read the
    answers with `read_answers`.
    """
    spark = files.sparkSession
    manifest = pinned_version(spark, base, corpus, out)

    def answer(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        with scratch(own, "arrivals"):
            accepted, rejected = write_query_outcomes(batch, fresh_path(own, "outcomes"), (key,), mode)
            asked = accepted.select(F.col(key).cast("string").alias("query_id"), "text")
            found = search_texts(own, asked, base, corpus, manifest=manifest, **options)
            found.write.mode("overwrite").parquet(f"{out}/found/batch={number}")
            refused = rejected.select(F.col(key).cast("string").alias("query_id"), "reason")
            refused.write.mode("overwrite").parquet(f"{out}/rejected/batch={number}")

    writer = files.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_answers(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(found, rejected) of all batches that `answer_arrivals` has finished or begun to write."""
    found = spark.read.schema(FOUND_SCHEMA).parquet(f"{out}/found")
    return found, spark.read.schema(REJECTED_SCHEMA).parquet(f"{out}/rejected")
