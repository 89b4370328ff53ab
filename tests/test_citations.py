import pytest
from paperloom.operators.records import rejected_records
from paperloom.sources import bibtex, citations, nbib, ris

RECORD = """PMID- 1
LID - S0140 [pii]
LID - 10.1000/xyz [doi]
TI  - A wrapped title
      that is cut
AB  - First line
      second line

      third line
FAU - Doe, Jane
AU  - Doe J
AU  - Roe R
DP  - 2025 Oct 3
JT  - The Journal
"""


def parse(spark, text):
    return nbib.nbib_records(spark.createDataFrame([("f", text)], "path string, text string")).first()


def test_nbib_record(spark):
    r = parse(spark, RECORD)
    assert (r.DOI, r.Title, r.Authors) == ("10.1000/xyz", "A wrapped title", "Doe J, Roe R")
    assert (r.Abstract, r.Journal, r.Date) == ("First line second line third line", "The Journal", "03/10/2025")


def test_nbib_line_ends_do_not_matter(spark):
    assert parse(spark, RECORD.replace("\n", "\r\n")) == parse(spark, RECORD)


@pytest.mark.parametrize(
    "lids, doi",
    [
        (["S1 [pii]", "10.1/a [doi]"], "10.1/a"),
        (["10.1/a [doi]", "S1 [pii]"], "10.1/a"),
        (["10.1/a [doi]", "10.1/b [doi]"], "10.1/b"),
        (["S1 [pii]", "S2 [pii]"], "S1 [pii]"),
        ([], None),
    ],
)
def test_nbib_doi(spark, lids, doi):
    assert parse(spark, "\n".join(f"LID - {v}" for v in lids) or "PMID- 1").DOI == doi


def test_nbib_line_that_looks_tagged_ends_the_abstract(spark):
    assert parse(spark, "AB  - One\n  DNA-based two\n  three\nTI  - T").Abstract == "One"


def test_nbib_second_abstract_gives_its_continuation_only(spark):
    assert parse(spark, "AB  - One\n  two\nTI  - T\nAB  - Lost\n  three").Abstract == "One two three"


def test_nbib_last_date_and_first_journal_win(spark):
    r = parse(spark, "DP  - 2001\nDP  - 2002\nJT  - A\nJT  - B")
    assert (r.Date, r.Journal) == ("01/01/2002", "A")


def test_nbib_long_abstract_is_kept_whole(spark):
    lines = [f"line {i}" for i in range(20_000)]
    assert parse(spark, "AB  - start\n      " + "\n      ".join(lines)).Abstract == "start " + " ".join(lines)


@pytest.mark.parametrize(
    "tag, field", [("TI", "Title"), ("AU", "Authors"), ("AB", "Abstract"), ("JT", "Journal"), ("DP", "Date"), ("LID", "DOI")]
)
def test_nbib_incomplete_record_is_rejected_by_field(spark, tag, field):
    text = "\n".join(line for line in RECORD.split("\n") if not line.startswith(tag))
    texts = spark.createDataFrame([("f", text), ("g", RECORD)], "path string, text string")
    assert [r.path for r in nbib.nbib_articles(texts).collect()] == ["g"]
    rejected = rejected_records(nbib.nbib_records(texts), nbib.REQUIRED).collect()
    assert [tuple(r) for r in rejected] == [("f", field)]


def test_nbib_unknown_month_is_rejected_as_undated(spark):
    texts = spark.createDataFrame([("f", RECORD.replace("Oct", "Foo"))], "path string, text string")
    assert [tuple(r) for r in rejected_records(nbib.nbib_records(texts), nbib.REQUIRED).collect()] == [("f", "Date")]


def test_nbib_files_and_bulk_export(spark, tmp_path):
    (tmp_path / "bulk.txt").write_text(RECORD.replace("\n\n", "\n") + "\n" + RECORD.replace("\n\n", "\n").replace("xyz", "abc"))
    whole = nbib.read_nbib(spark, str(tmp_path))
    assert whole.count() == 2
    split = nbib.nbib_articles(nbib.read_nbib(spark, str(tmp_path), whole_files=False))
    assert sorted(r.DOI for r in split.collect()) == ["10.1000/abc", "10.1000/xyz"]


RIS = """TY  - MISC
TI  - Reconstructing trees with Metric
      Learning
T1  - Last title
N1  - A note
AB  - An abstract that
      is wrapped
ER  - 
TY  - MISC
TI  - Second record
ER  - 
"""


def test_ris_compat_reads_one_entry_and_cuts_wrapped_lines(spark):
    texts = spark.createDataFrame([("f", RIS)], "path string, text string")
    (row,) = ris.ris_records(texts).collect()
    assert row.fields == {"title": "Second record", "abstract": "A note"}


def test_ris_full_splits_records_and_joins_lines(spark):
    texts = spark.createDataFrame([("f", RIS.replace("N1  - A note\n", ""))], "path string, text string")
    rows = ris.ris_records(texts, mode="full").orderBy("entry_no").collect()
    assert [r.fields for r in rows] == [
        {"title": "Last title", "abstract": "An abstract that is wrapped"},
        {"title": "Second record", "abstract": ""},
    ]


def test_ris_without_fields_gives_empty_texts(spark):
    texts = spark.createDataFrame([("f", "TY  - JOUR\nTI  -\n")], "path string, text string")
    assert ris.ris_records(texts).first().fields == {"title": "", "abstract": ""}


@pytest.mark.parametrize(
    "text, expected",
    [
        ("@ARTICLE{Li2025-rc,\n title = {shows {CD248} in cells},\n year = 2025\n}",
         {"title": "shows {CD248} in cells", "year": "2025", "ENTRYTYPE": "article", "ID": "Li2025-rc"}),
        ('@misc{k, title={"You": An Analysis}, url={https://x.org/a_b}, }',
         {"title": '"You": An Analysis', "url": "https://x.org/a_b", "ENTRYTYPE": "misc", "ID": "k"}),
        ("@article{2025,\n abstract = {Line one\n   line two},\n month = oct # \" 3\"}",
         {"abstract": "Line one\nline two", "month": "October 3", "ENTRYTYPE": "article", "ID": "2025"}),
        ('@string{nat = "Nature"} @comment{not @book{here}} @online{skipped, title={x}} @book{b, publisher = nat}',
         {"publisher": "Nature", "ENTRYTYPE": "book", "ID": "b"}),
        ('@misc{k, title = "Quoted {"}braces{"} kept"}',
         {"title": 'Quoted {"}braces{"} kept', "ENTRYTYPE": "misc", "ID": "k"}),
        ("no entry at all", None),
        ("@misc{broken, title = {never closed", None),
    ],
)
def test_bibtex_first_entry(spark, text, expected):
    texts = spark.createDataFrame([("f", text)], "path string, text string")
    rows = bibtex.bib_records(texts).collect()
    assert [r.fields for r in rows] == ([] if expected is None else [expected])


def test_bibtex_reads_all_entries_in_order(spark):
    texts = spark.createDataFrame([("f", "@misc{a, title={A}}\n@misc{b, title={B}}"), ("g", "")], "path string, text string")
    assert [(r.path, r.entry_no, r.fields["ID"]) for r in bibtex.bib_entries(texts).collect()] == [("f", 0, "a"), ("f", 1, "b")]


@pytest.mark.parametrize(
    "path, ext, supported",
    [("/a/x.BIB", ".bib", True), ("/a/x.v2.ris", ".ris", True), ("/a.bib/x", "", False), ("/a/.bib", "", False),
     ("/a/x.nbib", ".nbib", False)],
)
def test_dispatch(spark, path, ext, supported):
    row = citations.dispatch(spark.createDataFrame([(path, "")], "path string, text string")).first()
    assert (row.extension, row.supported) == (ext, supported)


def entries(spark, *maps):
    return spark.createDataFrame([(str(i), m) for i, m in enumerate(maps)], "path string, fields map<string,string>")


def test_query_text_falls_back_on_absence_not_on_emptiness(spark):
    rows = entries(
        spark,
        {"title": "T", "abstract": "A", "note": "N"},
        {"title": "T", "note": "N"},
        {"title": "T", "abstract": "", "note": "N"},
        {"note": "  "},
        {},
    )
    assert [tuple(r) for r in citations.query_texts(rows).orderBy("path").collect()] == [("0", "T A"), ("1", "T N"), ("2", "T")]


def test_display_text(spark):
    rows = entries(spark, {"title": "T", "note": "N"}, {"year": "2020"})
    assert [r.text for r in citations.display_text(rows, "Abstract").orderBy("path").collect()] == [
        "N", "'Abstract' no encontrado en el archivo.",
    ]
    assert [r.text for r in citations.display_text(rows, "Title").orderBy("path").collect()] == [
        "T", "'Title' no encontrado en el archivo.",
    ]


def test_files_become_query_entries(spark, tmp_path):
    (tmp_path / "a.BIB").write_text("@misc{a, title={Bib title}}")
    (tmp_path / "b.ris").write_text("TI  - Ris title\n")
    (tmp_path / "c.pdf").write_text("x")
    entries = citations.read_entries(spark, str(tmp_path))
    assert sorted(r.text for r in citations.query_texts(entries).collect()) == ["Bib title", "Ris title"]
    files = citations.list_files(spark, str(tmp_path))
    assert citations.dispatch(files).where("supported").count() == 2
    (rejected,) = citations.rejected_files(files).collect()
    assert rejected.reason == "unsupported extension: .pdf" and rejected.path.endswith("c.pdf")


@pytest.mark.parametrize("name", ["A.bib", "B.ris", "C.bib"])
def test_wrapped_and_nested_sources(spark, tmp_path, name):
    texts = {
        "A.bib": "@ARTICLE{x,\n  title = {Graph\n    networks},\n  abstract = {About {DNA} graphs}\n}\n",
        "B.ris": "TY  - JOUR\r\nTI  - Graph networks\r\nAB  - About {DNA} graphs\r\nER  - \r\n",
        "C.bib": '@misc{x, title = "Graph networks", note = {About {DNA} graphs}}',
    }
    (tmp_path / name).write_bytes(texts[name].encode())
    (row,) = citations.query_texts(citations.read_entries(spark, str(tmp_path))).collect()
    assert row.text.split() == ["Graph", "networks", "About", "{DNA}", "graphs"]


def test_many_records_in_one_export_with_any_line_ends(spark, tmp_path):
    one = "PMID- {0}\nTI  - T{0}\nAU  - A\nAB  - first\n\n      still the abstract\nJT  - J\nDP  - 2020\nLID - 10.1/{0} [doi]\n"
    text = "\n\n".join(one.format(i) for i in range(5))
    for name, content in (("unix", text), ("dos", text.replace("\n", "\r\n"))):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "bulk.nbib").write_bytes(content.encode())
        for whole in (True, False):
            found = nbib.nbib_records(nbib.read_nbib(spark, str(folder), whole), keep=("path", "record_no"))
            rows = found.orderBy("record_no").collect()
            assert [(r.DOI, r.Title, r.Abstract) for r in rows] == [
                (f"10.1/{i}", f"T{i}", "first still the abstract") for i in range(5)
            ]


def test_files_that_give_no_query_are_named(spark):
    rows = [
        ("a.bib", "@article{k, title={A}}"), ("b.bib", "no entry"), ("c.bib", "@article{k, title={ }}"), ("d.txt", "x"),
        ("e.ris", "TY  - JOUR\nER  - \n"),
    ]
    files = spark.createDataFrame(rows, "path string, text string")
    found = {r.path: r.reason for r in citations.rejected_queries(files).collect()}
    assert found == {
        "b.bib": "no entry", "c.bib": "no text", "d.txt": "unsupported extension: .txt", "e.ris": "no text"
    }
