"""Article identifiers and page numbers held in links."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Prefix of preprint DOIs, host of relative abstract links, entries per listing page.
DOI_PREFIX = "10.48550/arXiv."
ABSTRACT_HOST = "https://arxiv.org"
PAGE_SIZE = 50


def doi_from_url(url: Column) -> Column:
    """DOI of the article behind an abstract link: prefix plus last path segment."""
    return F.concat(F.lit(DOI_PREFIX), F.element_at(F.split(url, "/", -1), -1))


def listing_url(section_url: Column, page_no: Column, page_size: int = PAGE_SIZE) -> Column:
    """Address of the n-th listing page of a section."""
    skip = (page_no * page_size).cast("string")
    return F.concat(section_url, F.lit("?skip="), skip, F.lit(f"&show={page_size}"))


def listing_page_no(url: Column, page_size: int = PAGE_SIZE) -> Column:
    """Page number held in the `skip` parameter; 0 without one, null when it is no number of up to 11 digits."""
    skip = F.regexp_extract(url, r"[?&]skip=([0-9]{1,11})(?:&|#|$)", 1)
    number = F.when(skip != "", skip.cast("long")).when(~url.rlike(r"[?&]skip="), F.lit(0).cast("long"))
    return F.floor(number / page_size).cast("int")


def section_of(url: Column) -> Column:
    """The section address: a listing address without its query string."""
    return F.regexp_replace(url, r"[?#].*$", "")


def absolute_link(path: Column) -> Column:
    """Abstract links are relative to the preprint host."""
    return F.concat(F.lit(ABSTRACT_HOST), path)
