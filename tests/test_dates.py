import pytest
from pyspark.sql import functions as F

from paperloom.functions import dates, links


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2017", "01/01/2017"),
        ("2025 Jan-Dec 14", "14/12/2025"),
        ("2025 Oct 3", "03/10/2025"),
        ("2025 Mar", "01/03/2025"),
        ("2024 Fall", "22/09/2024"),
        ("2024 Spring-Summer", "21/06/2024"),
        ("2025 Jan 12-Feb 3", "01/01/2025"),
        ("2025 Jan 12-15", "12-15/01/2025"),
        ("2025 Foo", None),
        (None, None),
    ],
)
def test_citation_date(spark, raw, expected):
    assert one(spark, dates.citation_date, raw) == expected


@pytest.mark.parametrize(
    "raw, unpadded, ymd",
    [("2017", "01/01/2017", None), ("2025 Oct 3", "3/10/2025", "2025/10/3"), ("2025 Jan-Dec", "01/12/2025", "2025/12/"),
     ("2024 Fall", None, None)],
)
def test_older_variants(spark, raw, unpadded, ymd):
    assert one(spark, dates.citation_date_unpadded, raw) == unpadded
    assert one(spark, dates.citation_date_ymd, raw) == ymd


@pytest.mark.parametrize(
    "line, expected",
    [
        ("[Submitted on 3 Oct 2025 (v1), last revised 9 Nov 2025]", "03/10/2025"),
        ("[Submitted on 13 oct 2025]", "13/10/2025"),
        ("[Submitted]", "N/A"),
        ("[Submitted on 31 Feb 2025]", None),
        ("[Submitted on 3 Okt 2025]", None),
        (None, None),
    ],
)
def test_dateline_date(spark, line, expected):
    assert one(spark, dates.dateline_date, line) == expected


def test_links(spark):
    assert one(spark, links.doi_from_url, "/abs/2510.05090") == "10.48550/arXiv.2510.05090"
    assert one(spark, links.listing_page_no, "https://arxiv.org/list/cs.CL/recent?skip=150&show=50") == 3
    assert one(spark, links.listing_page_no, "https://arxiv.org/list/cs.CL/recent") == 0
    assert one(spark, links.listing_page_no, "https://arxiv.org/list/cs.CL/recent?skip=10000000000&show=50") == 200_000_000
    assert one(spark, links.listing_page_no, "https://arxiv.org/list/cs.CL/recent?skip=many") is None
    url = links.listing_url(F.col("v"), F.lit(2))
    assert one(spark, lambda c: url, "https://arxiv.org/list/cs.CL/recent").endswith("/recent?skip=100&show=50")
