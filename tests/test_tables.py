import datetime

import pytest
from pyspark.sql import functions as F

from paperloom.operators import profile
from paperloom.sources import tables
from paperloom.streaming.drop_folder import collect_exports

ROWS = [
    ("10.1/a", 'A "quoted"\ttitle', "Doe, J", "Line one\nline two", "cs.CL", "03/10/2025"),
    ("10.1/b", " padded ", None, "N/A", "cs.CL", "N/A"),
    ("10.1/c", "Ünïcode, comma", "X", None, "cs.CV", "31/12/2024"),
]


def articles(spark):
    return spark.createDataFrame(ROWS, tables.article_schema())


def test_raw_round_trip(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.write_raw(articles(spark), path)
    got = tables.read_raw(spark, path).orderBy("DOI")
    assert [tuple(r)[:6] for r in got.collect()] == ROWS
    assert [r.pub_date for r in got.collect()] == [datetime.date(2025, 10, 3), None, datetime.date(2024, 12, 31)]


def test_normalized_round_trip(spark, tmp_path):
    path = str(tmp_path / "normal")
    tables.write_normalized(articles(spark), path)
    assert sorted(map(tuple, tables.read_normalized(spark, path).collect())) == ROWS


def test_empty_table_is_not_written(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.write_raw(articles(spark).where("false"), str(tmp_path / "raw"))
    assert not (tmp_path / "raw").exists()


def test_profile(spark):
    df = articles(spark)
    assert {tuple(r) for r in profile.group_counts(df).collect()} == {("cs.CL", 2), ("cs.CV", 1)}
    nulls = profile.null_counts(df).first()
    assert (nulls.Authors_nulls, nulls.Abstract_nulls, nulls.Abstract_na, nulls.Date_na) == (1, 1, 1, 1)
    assert tuple(profile.shape(df).first()) == (3, 6)


def test_sample_repeats_on_any_layout(spark):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    samples = [{r.doc_id for r in profile.sample_rows(df.repartition(n), "doc_id").collect()} for n in (1, 7)]
    assert samples[0] == samples[1] and len(samples[0]) == 10
    assert {r.doc_id for r in profile.sample_rows(df, "doc_id", seed=1).collect()} != samples[0]
    assert df.where(F.col("doc_id").isin(*samples[0])).count() == 10


def test_exports_are_collected_once_as_they_arrive(spark, tmp_path):
    inbox, out, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    inbox.mkdir()
    record = "TI  - T\nAU  - A\nAB  - B\n      more\nJT  - J\nDP  - 2020\nLID - 10.1/{} [doi]"
    for round_no in (1, 2):
        (inbox / f"{round_no}.nbib").write_text(record.format(round_no))
        (inbox / f"{round_no}.bad").write_text("TI  - only a title")
        collect_exports(spark, str(inbox), out, marks).awaitTermination(120)
        got = spark.read.parquet(out)
        assert sorted(r.DOI for r in got.collect()) == [f"10.1/{i}" for i in range(1, round_no + 1)]
        assert {r.Abstract for r in got.collect()} == {"B more"}


def test_article_table_as_parquet(spark, tmp_path):
    from paperloom.sources.tables import read_articles, write_articles

    rows = [("1", "T", "A", "line\nbreak", "S", "03/10/2025")]
    articles = spark.createDataFrame(rows, "DOI string, Title string, Authors string, Abstract string, Section string, Date string")
    write_articles(articles, str(tmp_path / "articles"))
    (row,) = read_articles(spark, str(tmp_path / "articles")).collect()
    assert row.Abstract == "line\nbreak" and str(row.pub_date) == "2025-10-03"
