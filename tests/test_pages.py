import pytest

from paperloom.plans.build_corpus import journal_corpus, preprint_corpus
from paperloom.sources import listing_pages as L
from paperloom.sources.listing_pages import SECTIONS

SECTION = "Cryptography and Security"
BASE = SECTIONS[SECTION]


def entry(n, full_text=True, abstract=True, dd=True, title="Title: A &lt;b&gt; &amp; C"):
    links = f'<a href="/abs/{n}" title="Abstract">x</a>' if abstract else ""
    links += f"<a title='View HTML' href='https://arxiv.org/html/{n}v1'>html</a>" if full_text else ""
    body = (
        f"<dd><div class='meta'><div class=\"list-title mathjax\"><span>{title}</span> {n}</div>"
        f'<div class="list-authors"><a href="/a">Ana Í</a>, <a href="/b">B &amp; Sons</a></div></div></dd>'
        if dd
        else ""
    )
    return f"<dt>[1] {links}</dt>{body}"


def listing(spark, *pages):
    rows = [
        (i, f"{BASE}?skip={no * 50}&show=50", f"<html><dl id='articles'>{''.join(entries)}</dl><dt>outside</dt></html>")
        for i, (no, entries) in enumerate(pages)
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def details(spark, ids, date="3 Oct 2025", text="An\nabstract &amp; more"):
    abs_pages = [(f"https://arxiv.org/abs/{n}", f'<div class="dateline">[Submitted on {date}]</div>') for n in ids]
    full = [
        (f"https://arxiv.org/html/{n}v1", f'<div class="ltx_abstract"><p class="ltx_p"> {text} </p></div>') for n in ids
    ]
    schema = "url string, html string"
    return spark.createDataFrame(abs_pages, schema), spark.createDataFrame(full, schema)


def test_listing_articles(spark):
    pages = listing(spark, (0, [entry("1.1"), entry("1.2", full_text=False), entry("1.3", abstract=False)]))
    (row,) = L.listing_articles(pages).collect()
    assert (row.DOI, row.Title, row.Authors) == ("10.48550/arXiv.1.1", "A <b> & C 1.1", "Ana Í, B & Sons")
    assert (row.abs_path, row.html_url, row.page_no) == ("/abs/1.1", "https://arxiv.org/html/1.1v1", 0)


def test_heading_without_own_description_takes_the_next_one(spark):
    pages = listing(spark, (0, [entry("1.1", dd=False), entry("1.2")]))
    assert [r.Title for r in L.listing_articles(pages).orderBy("entry_no").collect()] == ["A <b> & C 1.2"] * 2
    assert L.listing_articles(listing(spark, (0, [entry("1.1", dd=False)]))).count() == 0


def test_full_text_page_without_abstract_and_abstract_page_without_date(spark):
    schema = "url string, html string"
    full = spark.createDataFrame([("u", '<p class="ltx_p">x</p><div class="ltx_abstract"></div>')], schema)
    assert L.full_text_abstracts(full).first().Abstract == "N/A"
    pages = spark.createDataFrame(
        [("a", '<div class="dateline">none</div>'), ("b", "<div>3 Oct 2025</div>"), ("c", '<div class="dateline">31 Feb 2025</div>')],
        schema,
    )
    assert {tuple(r) for r in L.abstract_page_dates(pages).collect()} == {("a", "N/A")}


def test_reading_stops_at_a_gap_an_empty_page_and_the_limit(spark):
    sizes = [("s", n, 5) for n in range(12)] + [("gap", 0, 5), ("gap", 2, 5)] + [("empty", 0, 5), ("empty", 1, 0), ("empty", 2, 5)]
    rows = spark.createDataFrame(sizes, "section_url string, page_no int, n_entries int")
    reached = {(r.section_url, r.page_no) for r in L.unbroken_pages(rows, 10).collect()}
    assert reached == {("s", n) for n in range(10)} | {("gap", 0), ("empty", 0)}
    assert L.unbroken_pages(rows).where("section_url = 's'").count() == 12


def test_preprint_corpus_counts_only_complete_articles(spark):
    ids = [f"1.{n}" for n in range(1, 8)]
    pages = listing(spark, (0, [entry(n) for n in ids[:4]]), (1, [entry(n) for n in ids[4:]]))
    abs_pages, full = details(spark, [n for n in ids if n != "1.2"])
    got = preprint_corpus(pages, abs_pages, full, per_section=3)
    assert got.columns == ["DOI", "Title", "Authors", "Abstract", "Section", "Date"]
    rows = sorted(got.collect())
    assert [r.DOI for r in rows] == ["10.48550/arXiv.1.1", "10.48550/arXiv.1.3", "10.48550/arXiv.1.4"]
    assert {(r.Section, r.Date, r.Abstract) for r in rows} == {(SECTION, "03/10/2025", "An abstract & more")}


def test_an_article_listed_very_often_is_kept_every_time(spark):
    pages = listing(spark, (0, [entry("1.1")] * 300 + [entry("1.2"), entry("1.3")]))
    got = L.article_details(L.listing_articles(pages), *details(spark, ["1.1", "1.2"]))
    assert got.count() == 301


@pytest.mark.parametrize("n", [1, 3])
def test_journal_corpus_is_capped_in_order(spark, n):
    record = "TI  - T\nAU  - A\nAB  - B\nJT  - J\nDP  - 2020\nLID - 10.1/{} [doi]"
    rows = [(f"f{i}", record.format(i)) for i in range(5)] + [("e", "TI  - only")]
    exports = spark.createDataFrame(rows, "path string, text string")
    assert [r.DOI for r in journal_corpus(exports, n=n).collect()] == [f"10.1/{i}" for i in range(n)]


def test_a_page_saved_twice_counts_once(spark):
    pages = listing(spark, (0, [entry("1.1")]), (0, [entry("1.1"), entry("1.2")]), (1, [entry("1.3")]), (10, [entry("1.4")]))
    ids = [f"1.{n}" for n in range(1, 5)]
    got = preprint_corpus(pages, *details(spark, ids), max_pages=10)
    assert sorted(r.DOI for r in got.collect()) == [f"10.48550/arXiv.1.{n}" for n in (1, 2, 3)]


def test_nothing_is_cut_without_a_limit(spark):
    pages = listing(spark, *[(n, [entry(f"1.{n}")]) for n in range(12)])
    ids = [f"1.{n}" for n in range(12)]
    assert preprint_corpus(pages, *details(spark, ids)).count() == 12
    assert preprint_corpus(pages, *details(spark, ids), max_pages=10).count() == 10
    record = "TI  - T\nAU  - A\nAB  - B\nJT  - J\nDP  - 2020\nLID - 10.1/{} [doi]"
    rows = [(f"f{i:03}", record.format(i)) for i in range(301)]
    assert journal_corpus(spark.createDataFrame(rows, "path string, text string")).count() == 301


def test_a_page_without_skip_is_the_first_and_an_unreadable_one_is_named(spark):
    html = f"<dl id='articles'>{entry('1.1')}</dl>"
    pages = spark.createDataFrame([(0, BASE, html), (1, f"{BASE}?skip=x", html)], "page_id long, url string, html string")
    assert preprint_corpus(pages, *details(spark, ["1.1"])).count() == 1
    assert [(r.page_id, r.reason) for r in L.rejected_listings(pages).collect()] == [(1, "no page number in the address")]


def test_blocks_within_blocks(spark):
    schema = "url string, html string"
    full = '<div class="ltx_abstract"><div class="t"><h6>Abstract</h6></div><p class="ltx_p">In <b>full</b></p></div><p class="ltx_p">no</p>'
    assert L.full_text_abstracts(spark.createDataFrame([("u", full)], schema)).first().Abstract == "In full"
    dated = '<div class="dateline"><div>[v2]</div>[Submitted on 3 Oct 2025]</div>'
    assert L.abstract_page_dates(spark.createDataFrame([("u", dated)], schema)).first().Date == "03/10/2025"
    pages = listing(spark, (0, [entry("1.1", title="Title: <div>A</div> B")]))
    assert L.listing_articles(pages).first().Title.split() == ["A", "B", "1.1"]


def test_the_last_copy_of_a_page_counts(spark):
    schema = "page_id long, url string, html string"
    page = '<div class="dateline">[Submitted on {}]</div>'
    rows = [(1, "https://arxiv.org/abs/1.1", page.format("30 Jan 2025")), (2, "https://arxiv.org/abs/1.1", page.format("1 Feb 2025"))]
    articles = L.listing_articles(listing(spark, (0, [entry("1.1")])))
    _, full = details(spark, ["1.1"])
    assert L.article_details(articles, spark.createDataFrame(rows, schema), full).first().Date == "01/02/2025"


def test_only_the_attribute_itself_counts(spark):
    link = '<a data-title="Abstract" href="/abs/9">x</a><a title="Abstract" data-href="/no" href="/abs/1?a=1&amp;b=2">x</a>'
    html = f"<dl id='articles'><dt>{link}<a title='View HTML' href='h'>h</a></dt><dd><div class='list-title'>T</div></dd></dl>"
    pages = spark.createDataFrame([(0, BASE, html)], "page_id long, url string, html string")
    assert L.listing_articles(pages).first().abs_path == "/abs/1?a=1&b=2"


def test_why_an_entry_is_no_article(spark):
    pages = listing(spark, (0, [entry("1.1", abstract=False), entry("1.2", full_text=False), entry("1.3"), entry("1.4", dd=False)]))
    found = {r.entry_no: r.reason for r in L.rejected_entries(pages).collect()}
    assert found == {1: "no link to the abstract page", 2: "no link to the full text", 4: "no description"}
