"""Files read in splits give what the readers of whole files give, wherever the splits fall."""

import random

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from paperloom.operators.records import PREPRINT_COLUMNS
from paperloom.sources.bibtex import bib_entries, read_bibtex, read_bulk_bibtex
from paperloom.sources.ris import bulk_ris_records, read_bulk_ris, read_ris, ris_records
from paperloom.sources.splits import Braces, Quotes, split_lines
from paperloom.sources.tables import read_delimited, write_delimited
from paperloom.sources import bibtex


@pytest.fixture(params=[101, 100_000])
def tiny_splits(spark, request):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    kept = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, str(request.param))
    yield request.param
    for k, v in kept.items():
        spark.conf.set(k, v)


PIECES = ["word", " ", "\n", "\n\n", "\t", ",", '"', '""', "\r\n", "é中", "N/A", "x" * 50, "'", "\\", "#"]


def table(spark, n, seed):
    rng = random.Random(seed)
    field = lambda: "".join(rng.choices(PIECES, k=rng.randint(0, 6)))
    rows = [tuple([f"10.1/{i}", *[field() for _ in range(5)]]) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in PREPRINT_COLUMNS))


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("separator", ["\t", ","])
def test_quoted_text_equals_the_whole_file_reader(spark, tmp_path, tiny_splits, separator):
    path = str(tmp_path / "table")
    write_delimited(table(spark, 25, 3).coalesce(2), path, separator)
    if tiny_splits < 1000:
        assert split_lines(spark, path).rdd.getNumPartitions() > 8  # files of about a kilobyte each
    assert as_set(read_delimited(spark, path, separator=separator, splits=True)) == as_set(read_delimited(spark, path, separator=separator))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_foreign_line_ends_and_an_open_last_line(spark, tmp_path, tiny_splits, end):
    rows = ["\t".join(PREPRINT_COLUMNS), '1\t"a\nb"\t\t"say ""x"""\ts\td', "2\tt\ta\tb\ts\td", "", '3\t"\n\n"\ta\tb\ts\t"d"']
    (tmp_path / "t.tsv").write_text(end.join(rows), newline="")
    found = as_set(read_delimited(spark, str(tmp_path), splits=True))
    assert found == as_set(read_delimited(spark, str(tmp_path)))
    assert [r[0] for r in found] == ["1", "2", "3"] and found[0][3] == 'say "x"'


def test_a_field_over_many_splits_and_an_empty_table(spark, tmp_path, tiny_splits):
    long_text = "\n".join(f"line {i} of \"one\" field" for i in range(60))
    rows = [("1", long_text, "a", "b", "c", "d"), ("2", "t", "a", long_text, "c", "d")]
    path = str(tmp_path / "table")
    write_delimited(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in PREPRINT_COLUMNS)).coalesce(1), path)
    assert as_set(read_delimited(spark, path, splits=True)) == rows
    (tmp_path / "head.tsv").write_text("\t".join(PREPRINT_COLUMNS) + "\n")
    assert read_delimited(spark, str(tmp_path / "head.tsv"), splits=True).count() == 0


def test_an_empty_table_is_not_written(spark, tmp_path):
    with pytest.raises(ValueError, match="no articles"):
        write_delimited(table(spark, 3, 1).where("DOI = 'none'"), str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()


BORDERS = [Quotes(), Braces(bibtex._BEGINNING, bibtex._SURE)]
LINES = st.lists(st.sampled_from(["", "{", "}}", "a{b}", '"', 'x "y" "', "@misc{k,", " @odd{k,", "@article{", "}{", "@odd{x}"]), max_size=12)


@pytest.mark.parametrize("borders", BORDERS)
@settings(max_examples=150, deadline=None)
@given(LINES, st.integers(0, 12), st.integers(0, 3))
def test_effects_of_two_parts_are_those_of_the_whole(borders, lines, cut, state):
    if isinstance(borders, Quotes):
        state %= 2
    array = pa.array(lines, pa.string())
    first, then = array[:cut], array[cut:]
    joined = borders.join(borders.summarise(first), borders.summarise(then))
    whole = borders.summarise(array)
    assert borders.apply(joined, state) == borders.apply(whole, state)
    middle = borders.apply(borders.summarise(first), state)
    flags = [*borders.starts(first, state), *borders.starts(then, middle)]
    assert flags == list(borders.starts(array, state))


BIB = """junk before } the first entry
@string{me = "A. Author"}
@article{one,
  title = {The {W}hole
@odd{not an entry} of it},
  author = me # " and B",
  month = jan
}
% a comment line with nothing
@unheard{two, title = {skipped}}
@misc{three, title = "A {"}quoted{"} one", note={x
y}}
@string{me = "C. Changed"}
@book{four, author = me, title={é中}}

@comment{@misc{five, title={hidden}}}
@article{broken, title = {never ends,
@misc{six, author = me,
 title={after
the broken one}}
"""


def test_bibtex_in_splits(spark, tmp_path, tiny_splits):
    for i in range(3):
        (tmp_path / f"{i}.bib").write_text(BIB.replace("one,", f"one{i},") * (i + 1), newline="")
    (tmp_path / "none.bib").write_text("nothing here\n")
    found = read_bulk_bibtex(spark, str(tmp_path)).collect()
    by_file = {}
    for r in sorted(found, key=lambda r: (r["path"], r["entry_no"])):
        by_file.setdefault(r["path"].rsplit("/", 1)[-1], []).append(r["fields"])
    assert set(by_file) == {"0.bib", "1.bib", "2.bib"}
    for name, entries in by_file.items():
        n = int(name[0])
        assert [e["ID"] for e in entries] == [f"one{n}", "three", "four", "six"] * (n + 1)
        assert entries[0]["author"] == "A. Author and B" and entries[0]["month"] == "January"
        assert entries[0]["title"] == "The {W}hole\n@odd{not an entry} of it"
        assert entries[2]["author"] == entries[3]["author"] == "C. Changed" and entries[3]["title"] == "after\nthe broken one"
    whole = bib_entries(read_bibtex(spark, str(tmp_path), "0.bib")).collect()
    # the reader of whole files looks for further entries inside the broken one, and finds the same
    assert [r["fields"] for r in sorted(whole, key=lambda r: r["entry_no"])] == by_file["0.bib"]


RIS = "TI  - First {0}\nTY  - JOUR\nAB  - one\n      two\nER  - \n\nTY  - JOUR\nT1  - Second\nN1  - note\nER  -\nTI  - Open"


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ris_in_splits(spark, tmp_path, tiny_splits, end):
    for i in range(4):
        (tmp_path / f"{i}.ris").write_text(RIS.format(i).replace("\n", end), newline="")
    keep = ("path", "entry_no")
    bulk = bulk_ris_records(read_bulk_ris(spark, str(tmp_path))).select(*keep, "fields").collect()
    whole = ris_records(read_ris(spark, str(tmp_path)), mode="full").select(*keep, "fields").collect()
    order = lambda rows: [(r["path"].rsplit("/", 1)[-1], r["fields"]) for r in sorted(rows, key=lambda r: (r["path"], r["entry_no"]))]
    assert order(bulk) == order(whole) and len(bulk) == 12
