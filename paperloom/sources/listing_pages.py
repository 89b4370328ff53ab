"""Articles from saved listing pages and from the pages they link to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paperloom.functions.dates import dateline_date
from paperloom.functions.links import absolute_link, doi_from_url, listing_page_no, section_of
from paperloom.functions.markup import (
    attribute,
    class_pattern,
    decoded,
    inner,
    inner_div,
    plain_markup,
    text_of,
    without_comments,
)
from paperloom.functions.text import strip_text
from paperloom.operators.records import computed_once
from paperloom.operators.skew import lookup_join
from paperloom.session import materialise

# Name and address of each section that is collected.
SECTIONS = {
    "Computation and Language": "https://arxiv.org/list/cs.CL/recent",
    "Computer Vision and Pattern Recognition": "https://arxiv.org/list/cs.CV/recent",
    "Cryptography and Security": "https://arxiv.org/list/cs.CR/recent",
}
MISSING_ABSTRACT = "N/A"

_LIST_START = r"""<dl\b[^>]*\bid\s*=\s*["']?articles\b["']?[^>]*>"""
_TITLE_DIV = class_pattern("div", "list-title")
_AUTHORS_DIV = class_pattern("div", "list-authors")
_DATE_DIV = class_pattern("div", "dateline")
_ABSTRACT_DIV = class_pattern("div", "ltx_abstract")
_ABSTRACT_P = class_pattern("p", "ltx_p")


def _titled_link(entry, title: str):
    """href of the first link with that title attribute; null without one."""
    links = F.regexp_extract_all(entry, F.lit(r"(?is)(<a\b[^>]*>)"), F.lit(1))
    marked = F.filter(links, lambda a: a.rlike(rf"""(?<![\w-])(?i:title)\s*=\s*["']{title}["']"""))
    link = F.get(marked, F.lit(0))
    return F.when(link.isNotNull(), F.replace(attribute(link, "href"), F.lit("&amp;"), F.lit("&")))


def section_names(sections: dict[str, str] = SECTIONS):
    """Section name of a section address, as an expression over `section_url`."""
    table = F.create_map(*[F.lit(x) for name, url in sections.items() for x in (url, name)])
    return F.element_at(table, F.col("section_url"))


def _pieces(page_id: str):
    """The article list of each page, cut before every heading; the first piece holds no entry."""
    body = inner(without_comments(F.col("html")), _LIST_START, "</dl>")
    return [
        F.col(page_id).alias("page_id"),
        section_of(F.col("url")).alias("section_url"),
        listing_page_no(F.col("url")).alias("page_no"),
        F.split(body, r"(?i)<dt\b", -1).alias("pieces"),
    ]


def page_sizes(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """(section_url, page_no, n_entries) of every saved listing page."""
    cut = pages.select(*_pieces(page_id))
    return cut.select("section_url", "page_no", F.greatest(F.size("pieces") - 1, F.lit(0)).alias("n_entries"))


def listing_entries(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """One row per list entry of the saved listing pages (page_id, url, html).

    An entry takes the first description after its own heading, even when the
    next heading stands in between.
    """
    cut = pages.select(*_pieces(page_id))
    described = r"(?i)<dd\b"

    def entry(piece, place):
        rest = F.slice("pieces", place + 2, F.size("pieces"))
        own = piece.rlike(described)
        holder = F.when(own, piece).otherwise(F.get(F.filter(rest, lambda p: p.rlike(described)), F.lit(0)))
        return F.struct(piece.alias("piece"), holder.alias("holder"))

    # paired up inside the array, so that a page is not copied into each of its entries
    numbered = F.posexplode(F.transform("pieces", entry)).alias("entry_no", "entry")
    entries = cut.select("page_id", "section_url", "page_no", numbered)
    heading = F.regexp_extract("entry.piece", r"(?is)^(.*?)(?:<dd\b|\z)", 1)
    description = F.regexp_extract("entry.holder", r"(?is)(<dd\b.*?)(?:</dd>|\z)", 1)
    return entries.where(F.col("entry_no") > 0).select(
        "page_id",
        "section_url",
        "page_no",
        "entry_no",
        heading.alias("heading"),
        F.when(F.col("entry.holder").isNotNull(), description).alias("description"),
    )


_PLACE = ("page_id", "section_url", "page_no", "entry_no")
# what an entry must have, and what its reject says
_NEEDED = {
    "abs_path": "no link to the abstract page",
    "html_url": "no link to the full text",
    "description": "no description",
    "title_markup": "no title",
}


def _parsed_entries(pages: DataFrame, page_id: str) -> DataFrame:
    entries = listing_entries(pages, page_id)
    found = [
        F.col("description"),
        _titled_link(F.col("heading"), "Abstract").alias("abs_path"),
        _titled_link(F.col("heading"), "View HTML").alias("html_url"),
        inner_div(F.col("description"), _TITLE_DIV).alias("title_markup"),
        F.regexp_extract_all("description", F.lit(rf"(?is){_AUTHORS_DIV}(.*?)(?:</div>|\z)"), F.lit(1)).alias("name_divs"),
    ]
    return computed_once(entries, _PLACE, found)


def _lacks() -> Column:
    """Why an entry is dropped; null for a complete one."""
    return F.coalesce(*[F.when(F.col(name).isNull(), F.lit(reason)) for name, reason in _NEEDED.items()])


def rejected_entries(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """(page_id, section_url, page_no, entry_no, reason) of the listed entries that are no articles."""
    return _parsed_entries(pages, page_id).select(*_PLACE, _lacks().alias("reason")).where(F.col("reason").isNotNull())


def rejected_listings(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """(page_id, url, reason) of listing pages whose address holds no readable page number."""
    lost = pages.where(listing_page_no(F.col("url")).isNull())
    return lost.select(F.col(page_id).alias("page_id"), "url", F.lit("no page number in the address").alias("reason"))


def listing_articles(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Articles named on listing pages; an entry without both links, a description and a title is dropped."""
    complete = _parsed_entries(pages, page_id).where(_lacks().isNull())
    anchors = F.regexp_extract_all(F.array_join("name_divs", " "), F.lit(r"(?is)<a\b[^>]*>(.*?)</a>"), F.lit(1))
    names = F.array_join(F.transform(anchors, lambda a: strip_text(plain_markup(a))), ", ")
    title = strip_text(F.replace(decoded(plain_markup(F.col("title_markup"))), F.lit("Title:"), F.lit("")))
    return complete.select(
        *_PLACE,
        "abs_path",
        "html_url",
        doi_from_url(F.col("abs_path")).alias("DOI"),
        title.alias("Title"),
        decoded(names).alias("Authors"),
    )


def _saved(pages: DataFrame) -> list[str]:
    """The column that tells the order of saving, if the pages have it."""
    return [name for name in ("page_id",) if name in pages.columns]


def abstract_page_dates(pages: DataFrame) -> DataFrame:
    """(url, Date) of saved abstract pages; a page without dateline or with an impossible date is dropped."""
    dateline = inner_div(without_comments(F.col("html")), _DATE_DIV)
    dated = pages.select("url", *_saved(pages), dateline_date(strip_text(plain_markup(dateline))).alias("Date"))
    return dated.where(F.col("Date").isNotNull())


def full_text_abstracts(pages: DataFrame) -> DataFrame:
    """(url, Abstract) of saved full-text pages; `N/A` when the page has no abstract paragraph."""
    block = inner_div(without_comments(F.col("html")), _ABSTRACT_DIV)
    cut = pages.select("url", *_saved(pages), inner(block, _ABSTRACT_P, "</p>").alias("paragraph"))
    text = F.regexp_replace(text_of(F.col("paragraph")), "\n", " ")
    return cut.select("url", *_saved(pages), F.coalesce(text, F.lit(MISSING_ABSTRACT)).alias("Abstract"))


def _one_per_url(details: DataFrame, value: str) -> DataFrame:
    """Saved more than once, a page counts as its last copy; copies collapse before the shuffle.

    The order of saving is `page_id`. Without it a found value goes before
    `N/A`, then the greater one.
    """
    order = F.struct(*_saved(details)) if _saved(details) else F.struct(F.col(value) != MISSING_ABSTRACT, F.col(value))
    return details.groupBy("url").agg(F.max_by(value, order).alias(value))


def article_details(articles: DataFrame, abstract_pages: DataFrame, full_text_pages: DataFrame) -> DataFrame:
    """Add Date and Abstract from the linked pages; an article that lacks one of its pages is dropped.

    An article that is listed very often stays where it is: see `lookup_join`.
    """
    articles = materialise(articles.withColumn("abs_url", absolute_link(F.col("abs_path"))), "listed-articles")
    dates = _one_per_url(abstract_page_dates(abstract_pages), "Date").withColumnRenamed("url", "abs_url")
    texts = _one_per_url(full_text_abstracts(full_text_pages), "Abstract").withColumnRenamed("url", "html_url")
    dated = materialise(lookup_join(articles, dates, "abs_url", max_keys=5_000), "dated-articles")
    return lookup_join(dated, texts, "html_url", max_keys=5_000)


def _near(page_no: Column, max_pages: int | None) -> Column:
    readable = page_no >= 0
    return readable if max_pages is None else readable & (page_no < max_pages)


def single_copies(listings: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Listing pages, the last copy of each that was saved more than once; with `max_pages` only so many of a section."""
    near = listings.where(_near(listing_page_no(F.col("url")), max_pages))
    place = [section_of(F.col("url")), listing_page_no(F.col("url"))]
    last = near.groupBy(*place).agg(F.max("page_id").alias("page_id")).select("page_id")
    return near.join(last, "page_id", "left_semi")


def unbroken_pages(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """(section_url, page_no) that a reader turning pages from 0 would reach.

    `pages` has (section_url, page_no, n_entries). Reading stops at a missing
    page, at a page without entries and, if asked for, after `max_pages`. One
    row for each page is left before the window runs.
    """
    filled = (
        pages.where((F.col("n_entries") > 0) & _near(F.col("page_no"), max_pages))
        .select("section_url", "page_no")
        .distinct()
    )
    place = F.row_number().over(W.partitionBy("section_url").orderBy("page_no"))
    return filled.withColumn("place", place).where(F.col("place") == F.col("page_no") + 1).drop("place")


def within_reach(articles: DataFrame, pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Articles on listing pages that page turning reaches."""
    reached = unbroken_pages(page_sizes(pages), max_pages)
    return articles.join(reached, ["section_url", "page_no"], "left_semi")


def cap_per_section(articles: DataFrame, n: int, section: str = "section_url") -> DataFrame:
    """The first n valid articles of each section in page and entry order; each task keeps only n before the shuffle."""
    order = W.partitionBy(section).orderBy("page_no", "entry_no", "page_id")
    return articles.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def cap_overall(records: DataFrame, order: str | tuple[str, ...], n: int) -> DataFrame:
    """The first n records overall, in the order of columns that together are unique."""
    return records.orderBy(*([order] if isinstance(order, str) else order)).limit(n)
