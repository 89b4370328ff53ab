"""MEDLINE/NBIB citation records.

A record is one row of text, so extraction is row-local: no explode, no
shuffle, whatever the number of records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.functions.dates import citation_date
from paperloom.functions.text import SPACE_CLASS, strip_text
from paperloom.operators.records import complete_records, computed_once

# A tagged line, the tag that begins a record, and the tag that fills each field.
TAGGED_LINE = r"^([A-Z]{2,4})[^\S\n]*-[^\S\n]*([^\n]*)"
RECORD_TAG = "PMID"
BLOCK_BREAK = r"\n(?=[A-Z]{2,4}[^\S\n]*-)"
FIELD_TAGS = {"Title": "TI", "Authors": "AU", "Abstract": "AB", "Journal": "JT", "Date": "DP", "DOI": "LID"}
REQUIRED = tuple(FIELD_TAGS)
COLUMNS = ("DOI", "Title", "Authors", "Abstract", "Journal", "Date")


def read_nbib(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """(path, record_no, text), one row for each record of saved exports.

    A file may hold one record or many, with any line ends. One that is too
    large to be read whole is cut at the tag that begins a record
    (`whole_files=False`), so that it is read in parallel; its record numbers
    then ascend within each part of the file that one task reads.
    """
    if whole_files:
        rows = spark.read.text(path, wholetext=True)
        return split_records(rows.select(F.input_file_name().alias("path"), F.col("value").alias("text")))
    rows = spark.read.text(path, lineSep=f"\n{RECORD_TAG}-")
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return rows.select(
        F.col("_metadata.file_path").alias("path"),
        (F.col("_metadata.file_block_start") + in_part).alias("record_no"),
        F.col("value").alias("text"),
    ).where(strip_text(F.col("text")) != "")


def split_records(texts: DataFrame, keep=("path",), text_col: str = "text") -> DataFrame:
    """(keep..., record_no, text): texts cut before each record tag that follows a blank line; row-local."""
    lines = F.regexp_replace(F.col(text_col), "\r\n?", "\n")
    records = F.split(lines, rf"\n[^\S\n]*\n\s*(?={RECORD_TAG}[^\S\n]*-)", -1)
    return texts.select(*keep, F.posexplode(records).alias("record_no", "text"))


def _blocks(text: Column) -> Column:
    """Stripped non-blank lines, cut before every tagged line: a tag with its continuation lines."""
    lines = F.regexp_replace(strip_text(F.regexp_replace(text, "\r\n?", "\n")), f"[{SPACE_CLASS}]*\n[{SPACE_CLASS}]*", "\n")
    return F.split(lines, BLOCK_BREAK, -1)


def _first(values: Column) -> Column:
    return F.get(values, F.lit(0))


def nbib_records(texts: DataFrame, keep=("path",), text_col: str = "text") -> DataFrame:
    """One row per record text with the six fields, null where a field never occurs.

    - DOI: first word of the last LID line marked `[doi]`, else the whole first LID line
    - Title, Journal: first line of that tag; Date: last one; Authors: all AU lines in order
    - Abstract: the first AB block, then the continuation lines of any further AB block
    """
    blocks = texts.select(*keep, _blocks(F.col(text_col)).alias("blocks"))

    def parsed(block):
        value = F.regexp_extract(block, TAGGED_LINE, 2)
        return F.struct(
            F.regexp_extract(block, TAGGED_LINE, 1).alias("tag"),
            value.alias("raw"),
            strip_text(value).alias("value"),
            F.regexp_extract(block, r"^[^\n]*(?s:\n(.*))?$", 1).alias("rest"),
            F.contains(F.regexp_extract(block, r"^([^\n]*)", 1), F.lit("[doi]")).alias("is_doi"),
        )

    tagged = blocks.select(*keep, F.transform("blocks", parsed).alias("b"))

    def of(field):
        return F.filter("b", lambda x: x["tag"] == FIELD_TAGS[field])

    parts = tagged.select(
        *keep, *[of(f).alias(f"{f}_lines") for f in ("Title", "Authors", "Abstract", "Journal", "Date", "DOI")]
    )
    marked = F.filter("DOI_lines", lambda x: x["is_doi"])
    doi = F.when(F.size(marked) > 0, F.get(F.split(F.element_at(marked, -1)["raw"], " ", -1), F.lit(0)))
    first_abstract = _first(F.col("Abstract_lines"))["value"]
    later_lines = F.filter(F.transform("Abstract_lines", lambda x: F.replace(x["rest"], F.lit("\n"), F.lit(" "))), lambda r: r != "")
    fields = [
        F.coalesce(doi, _first(F.col("DOI_lines"))["value"]).alias("DOI"),
        _first(F.col("Title_lines"))["value"].alias("Title"),
        F.when(
            F.size("Authors_lines") > 0, F.array_join(F.transform("Authors_lines", lambda x: x["value"]), ", ")
        ).alias("Authors"),
        F.when(
            first_abstract.isNotNull(), F.array_join(F.concat(F.array(first_abstract), later_lines), " ")
        ).alias("Abstract"),
        _first(F.col("Journal_lines"))["value"].alias("Journal"),
        F.when(F.size("Date_lines") > 0, F.element_at("Date_lines", -1)["raw"]).alias("raw_date"),
    ]
    return computed_once(parts, keep, fields).withColumn("Date", citation_date(F.col("raw_date")))


def nbib_articles(texts: DataFrame, keep=("path",), text_col: str = "text") -> DataFrame:
    """Complete records in export column order."""
    return complete_records(nbib_records(texts, keep, text_col), REQUIRED).select(*keep, *COLUMNS)
