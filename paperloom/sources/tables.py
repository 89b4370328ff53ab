"""Article tables: Parquet for anything large, delimited text for exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from paperloom.functions.dates import published_on
from paperloom.operators.records import JOURNAL_COLUMNS, PREPRINT_COLUMNS
from paperloom.session import remove_path
from paperloom.sources.splits import Quotes, split_lines, split_records

CORPORA = {"arxiv": PREPRINT_COLUMNS, "pubmed": JOURNAL_COLUMNS}
MAX_ROWS_PER_FILE = 1_000_000

_DIALECT = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def article_schema(columns=PREPRINT_COLUMNS) -> T.StructType:
    """All columns are text; types are declared, never inferred."""
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def write_articles(articles: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The article table as Parquet: splittable, and read by column."""
    articles.write.mode(mode).parquet(path)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """An article table written as Parquet, with the publication date added as a date."""
    return spark.read.parquet(path).withColumn("pub_date", published_on(F.col("Date")))


def write_delimited(articles: DataFrame, path: str, separator: str = "\t", mode: str = "errorifexists") -> None:
    """Delimited text with a header; refuses to write a table without articles.

    Quoted texts may hold line breaks, and most readers take such a file as one
    task: the number of rows per file is bounded. Rows are counted while they
    are written; what an empty table has left behind is removed.
    """
    counted = Observation()
    observed = articles.observe(counted, F.count(F.lit(1)).alias("n"))
    writer = observed.write.mode(mode).options(**_DIALECT).option("sep", separator)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("maxRecordsPerFile", MAX_ROWS_PER_FILE).csv(path)
    if not counted.get["n"]:
        remove_path(articles.sparkSession, path)
        raise ValueError("no articles to write")


def read_delimited(
    spark: SparkSession, path: str, columns=PREPRINT_COLUMNS, separator: str = "\t", splits: bool = False
) -> DataFrame:
    """Delimited text with a header and possibly quoted line breaks; an empty field is missing, hence null.

    With `splits` a large file is read by many tasks, see `read_split_delimited`.
    """
    if splits:
        return read_split_delimited(spark, path, columns, separator)
    reader = spark.read.schema(article_schema(columns)).options(**_DIALECT)
    return reader.option("sep", separator).option("multiLine", True).csv(path)


def read_split_delimited(spark: SparkSession, path: str, columns=PREPRINT_COLUMNS, separator: str = "\t") -> DataFrame:
    """As `read_delimited`, for files too large for one task: every split is cut into records on its own.

    A line begins a record if an even number of quotes precede it in the file,
    so quotes must come in pairs, as they do wherever a field that has one is
    quoted. A file of another kind needs the plain reader. Lines may end in a
    line feed with or without a carriage return.
    """
    records = split_records(split_lines(spark, path), Quotes())
    header = (F.col("block") == 0) & (F.col("number") == 0)
    text = F.regexp_replace("text", "\r$", "")
    rows = records.where(~header).select(text.alias("text")).where(F.col("text") != "")
    options = {"sep": separator, "quote": '"', "escape": '"', "multiLine": "true"}
    parsed = rows.select(F.from_csv("text", F.lit(article_schema(columns).simpleString()[7:-1].replace(":", " ")), options).alias("row"))
    return parsed.select("row.*")


def write_raw(articles: DataFrame, path: str) -> None:
    """Raw article table: tab-separated."""
    write_delimited(articles, path, "\t")


def read_raw(spark: SparkSession, path: str, columns=PREPRINT_COLUMNS, splits: bool = False) -> DataFrame:
    """Raw article table with the publication date added as a date."""
    return read_delimited(spark, path, columns, "\t", splits).withColumn("pub_date", published_on(F.col("Date")))


def write_normalized(articles: DataFrame, path: str) -> None:
    """Normalised article table: comma-separated."""
    write_delimited(articles, path, ",")


def read_normalized(spark: SparkSession, path: str, columns=PREPRINT_COLUMNS, splits: bool = False) -> DataFrame:
    return read_delimited(spark, path, columns, ",", splits)
