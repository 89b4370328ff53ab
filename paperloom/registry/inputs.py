"""Article tables, citation texts and saved pages, derived by Spark from the given tables.

`documents` plays the collected articles: `doc_id` the identifier, `source` the
section or journal, the first line of `text` the title and the other lines the
abstract. `pages` plays the saved listing pages and `benchmark` the queries.
Every row of a table takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.functions.links import DOI_PREFIX
from paperloom.session import fresh_path, spread

# Month and season names of citation dates.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
SEASONS = ("Spring", "Summer", "Fall", "Winter")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spread(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows are costly to parse."""
    return spread(table(spark, sf_dir, name), key)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `documents`, for row-local work that shuffles nothing by itself."""
    return _spread(spark, sf_dir, "documents", "doc_id").select("doc_id", "text")


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def title() -> Column:
    return F.substring_index("text", "\n", 1)


def abstract() -> Column:
    return F.expr("substr(text, length(substring_index(text, '\n', 1)) + 2)")


def _pick(names: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), index.cast("int"))


def citation_dates() -> Column:
    """A date as citation exports spell it; the form depends on the language, some months are unknown."""
    n = F.col("n_chars")
    year = (1990 + n % 35).cast("string")
    month, later, day = _pick(MONTHS, n % 12), _pick(MONTHS, (n + 5) % 12), (n % 28 + 1).cast("string")
    blank = F.lit(" ")
    return (
        F.when(n % 11 == 0, F.concat(year, F.lit(" Foo")))
        .when(F.col("lang") == "es", year)
        .when(F.col("lang") == "de", F.concat(year, blank, _pick(SEASONS, n % 4)))
        .when(F.col("lang") == "fr", F.concat(year, blank, month, F.lit("-"), later, blank, day))
        .otherwise(F.concat(year, blank, month, blank, day))
    )


def datelines(n: Column) -> Column:
    """A dateline as preprint pages show it; some have no date, some an impossible one."""
    date = F.concat_ws(" ", (n % 31 + 1).cast("string"), _pick(MONTHS, n % 12), (1990 + n % 35).cast("string"))
    return F.when(n % 13 == 0, F.lit("[Submitted recently]")).otherwise(
        F.concat(F.lit("[Submitted on "), date, F.lit(" (v1), last revised 1 Jan 2030 (v2)]"))
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id plus the six columns of a preprint table; some authors are null, some abstracts and dates `N/A`."""
    n = F.col("n_chars")
    date = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), n.cast("int")), "dd/MM/yyyy")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit(DOI_PREFIX), F.col("doc_id").cast("string")).alias("DOI"),
        title().alias("Title"),
        F.when(F.col("lang") != "fr", F.concat_ws(", ", "source", "lang")).alias("Authors"),
        F.when(abstract() == "", F.lit("N/A")).otherwise(abstract()).alias("Abstract"),
        F.col("source").alias("Section"),
        F.when(F.col("lang") == "es", F.lit("N/A")).otherwise(date).alias("Date"),
    )


def nbib_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): one citation record per document, its abstract wrapped over the document's own lines."""
    is_de, is_es = F.col("lang") == "de", F.col("lang") == "es"
    parts = [
        F.concat(F.lit("PMID- "), F.col("doc_id").cast("string")),
        F.concat(F.lit("TI  - "), title()),
        F.concat(F.lit("LID - S"), F.col("doc_id").cast("string"), F.lit(" [pii]")),
        F.when(~is_de, F.concat(F.lit("LID - 10.5555/"), F.col("doc_id").cast("string"), F.lit(" [doi]"))),
        F.concat(F.lit("AB  - "), F.replace(abstract(), F.lit("\n"), F.lit("\n      "))),
        F.lit("FAU - Full, Name"),
        F.concat(F.lit("AU  - "), F.col("lang")),
        F.concat(F.lit("AU  - "), F.col("source")),
        F.concat(F.lit("DP  - "), citation_dates()),
        F.when(~is_es | (F.col("n_chars") % 2 == 0), F.concat(F.lit("JT  - "), F.col("source"))),
        F.lit("AB  - Second block\n      and its continuation"),
    ]
    return _spread(spark, sf_dir, "documents", "doc_id").select("doc_id", F.concat_ws("\n", *parts).alias("text"))


def nbib_bulk_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_no, text): exports of up to 20 records each, every second one with the line ends of another system."""
    records = nbib_texts(spark, sf_dir).withColumn("file_no", F.floor(F.col("doc_id") / 20))
    placed = F.array_sort(F.collect_list(F.struct("doc_id", "text")))
    text = F.array_join(F.transform(placed, lambda r: r["text"]), "\n\n")
    dos = F.when(F.col("file_no") % 2 == 1, F.replace("text", F.lit("\n"), F.lit("\r\n"))).otherwise(F.col("text"))
    return records.groupBy("file_no").agg(text.alias("text")).select("file_no", dos.alias("text"))


def ris_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, path, text): one RIS file per document, with wrapped lines and, for some, a second title."""
    return _spread(spark, sf_dir, "documents", "doc_id").select("doc_id", _path().alias("path"), _ris().alias("text"))


def _ris() -> Column:
    parts = [
        F.lit("TY  - JOUR"),
        F.concat(F.lit("AU  - "), F.col("source")),
        F.concat(F.lit("TI  - "), title()),
        F.when(F.col("lang") == "fr", F.concat(F.lit("T1  - Second title of "), F.col("source"))),
        F.when(F.col("n_chars") % 3 == 0, F.lit("N1  - A note")),
        F.concat(F.lit("AB  - "), F.replace(abstract(), F.lit("\n"), F.lit("\n      "))),
        F.lit("ER  - "),
    ]
    return F.concat_ws("\n", *parts)


def ris_bulk_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder of RIS exports of many records each; a record's ID is its document's."""
    number = F.concat(F.lit("ID  - "), F.col("doc_id").cast("string"))
    rows = _spread(spark, sf_dir, "documents", "doc_id").select(F.concat_ws("\n", number, _ris()).alias("value"))
    path = fresh_path(spark, "ris-bulk")
    rows.write.text(path)
    return path


def bib_bulk_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder of BibTeX exports of many entries each."""
    path = fresh_path(spark, "bib-bulk")
    bib_texts(spark, sf_dir).select("text").write.text(path)
    return path


def _bib() -> Column:
    def braced(text: Column) -> Column:
        return F.translate(text, "{}", "()")

    parts = [
        F.concat(F.lit("@Article{key"), F.col("doc_id").cast("string"), F.lit(",")),
        F.concat(F.lit("  Title = {The {W}hole of "), braced(title()), F.lit("},")),
        F.lit('  author = "A. Author and {B. \\"Author}",'),
        F.lit("  month = jan, year = 2024,"),
        F.when(
            F.col("lang").isin("en", "de"), F.concat(F.lit("  abstract = {"), braced(abstract()), F.lit("},"))
        ).when(F.col("lang") == "fr", F.concat(F.lit("  note = {"), braced(abstract()), F.lit("},"))),
        F.lit("}\n\n@misc{second, title = {Not used}}"),
    ]
    return F.concat_ws("\n", *parts)


def _path() -> Column:
    n = F.col("n_chars")
    ending = F.when(n % 4 == 0, F.lit(".RIS")).when(n % 4 == 1, F.lit(".txt")).otherwise(F.lit(".bib"))
    return F.concat(F.lit("/saved/"), F.col("source"), F.lit("/v1."), F.col("doc_id").cast("string"), ending)


def bib_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): one BibTeX file of two entries per document."""
    return _spread(spark, sf_dir, "documents", "doc_id").select("doc_id", _bib().alias("text"))


def _as_files(rows: DataFrame) -> DataFrame:
    n = F.col("n_chars")
    text = F.when(n % 4 == 0, _ris()).when(n % 4 == 1, F.col("text")).otherwise(_bib())
    return rows.select("doc_id", _path().alias("path"), text.alias("text"))


def citation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, path, text): a BibTeX, RIS or foreign file per document."""
    return _as_files(_spread(spark, sf_dir, "documents", "doc_id"))


def query_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, path, text): a citation file per query text."""
    rows = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("doc_id"),
        "text",
        F.lit("en").alias("lang"),
        F.lit("asked").alias("source"),
        F.length("text").cast("bigint").alias("n_chars"),
    )
    return _as_files(rows)


def _paragraphs() -> Column:
    return F.regexp_extract_all("html", F.lit("<p>([^<]*)</p>"), F.lit(1))


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, section_no, page_no, lang, paragraphs): twelve saved listing pages per section, an entry per paragraph."""
    pages = _spread(spark, sf_dir, "pages", "page_id")
    return pages.select(
        "page_id",
        F.floor(F.col("page_id") / 12).alias("section_no"),
        (F.col("page_id") % 12).alias("page_no"),
        "html",
        _paragraphs().alias("paragraphs"),
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html): listing pages in the usual markup; every fourth entry lacks its full-text link."""

    def entry(paragraph, i):
        number = F.concat_ws(".", F.col("page_id").cast("string"), i.cast("string"))
        full_text = F.when(
            i % 4 != 3, F.concat(F.lit('[<a href="https://arxiv.org/html/'), number, F.lit('v1" title="View HTML">html</a>]'))
        ).otherwise(F.lit(""))
        return F.concat(
            F.lit("<dt><a name='item'>[1]</a> <a href =\"/abs/"), number, F.lit('" title="Abstract" id="x">arXiv</a> '),
            full_text,
            F.lit("</dt>\n<dd><div class='meta'><div class='list-title mathjax'><span class='descriptor'>Title:</span>\n  "),
            paragraph,
            F.lit("\n</div><div class='list-authors'><a href=\"/a\">Ana &amp; Bo</a>, <a href=\"/b\">C. "),
            i.cast("string"),
            F.lit("</a></div></div></dd>\n"),
        )

    url = F.concat(
        F.lit("https://arxiv.org/list/s"), F.col("section_no").cast("string"),
        F.lit("/recent?skip="), (F.col("page_no") * 50).cast("string"), F.lit("&show=50"),
    )
    html = F.concat(
        F.lit("<html><body><!-- <dl id='articles'><dt>hidden</dt></dl> --><dl id='articles'>\n"),
        F.array_join(F.transform("paragraphs", entry), ""),
        F.lit("</dl></body></html>"),
    )
    return listed(spark, sf_dir).select("page_id", url.alias("url"), html.alias("html"))


def detail_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(url, html) of abstract pages and of full-text pages, one of each per listed entry; some are not saved."""
    entries = listed(spark, sf_dir).select("page_id", F.posexplode(_paragraphs()).alias("i", "paragraph"))
    number = F.concat_ws(".", F.col("page_id").cast("string"), F.col("i").cast("string"))
    n = F.length("paragraph")
    dateline = datelines(n)
    abstract_pages = entries.where(n > 20).select(
        F.concat(F.lit("https://arxiv.org/abs/"), number).alias("url"),
        F.concat(F.lit('<html><div class="dateline">\n  '), dateline, F.lit("</div></html>")).alias("html"),
    )
    paragraph = F.concat(F.lit('<p id="p1" class="ltx_p">\nOn <em>'), F.col("paragraph"), F.lit("</em>\nin full </p>"))
    full_text_pages = entries.select(
        F.concat(F.lit("https://arxiv.org/html/"), number, F.lit("v1")).alias("url"),
        F.concat(
            F.lit('<html><p class="ltx_p">Before</p><div class="ltx_abstract"><h6>Abstract</h6>'),
            F.when(n % 7 == 0, F.lit("")).otherwise(paragraph),
            F.lit('</div><p class="ltx_p">After</p></html>'),
        ).alias("html"),
    )
    return abstract_pages, full_text_pages
