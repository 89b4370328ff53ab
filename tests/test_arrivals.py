"""Queries that arrive in a folder, outcomes of one parse, and rows that plans used to lose."""

import pytest
from pyspark.sql import functions as F

from paperloom.operators import skew
from paperloom.plans.build_corpus import normalized_corpus
from paperloom.plans.build_index import index_articles
from paperloom.plans.search import search_files
from paperloom.session import materialise
from paperloom.sources import citations
from paperloom.streaming import drop_folder

SCHEMA = "doc_id long, Title string, Abstract string"
ARTICLES = [(1, "Graph networks", "They learn graphs"), (2, "Cell biology", None), (3, "Deep learning", "of the cell")]
FILES = [
    ("/in/a.bib", "@misc{a, title={Cell biology}, note={the}}"),
    ("/in/b.RIS", "TI  - graph networks\nER  - \n"),
    ("/in/c.txt", "x"),
    ("/in/d.bib", "nothing"),
    ("/in/e.bib", "@misc{a, title={ }}"),
    ("/in/f.ris", ""),
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("mode", ["compat", "full"])
def test_outcomes_of_one_parse(spark, tmp_path, mode):
    files = spark.createDataFrame(FILES, "path string, text string")
    judged = citations.query_outcomes(files, mode=mode)
    plan = plan_of(judged)
    # each kind of file is parsed in one place of the plan
    assert plan.count("MapInPandas") == 1 and sum("T[I1]" in line for line in plan.splitlines()) == 1
    accepted, rejected = citations.write_query_outcomes(files, str(tmp_path / "out"), mode=mode)
    assert {r.path: r.text for r in accepted.collect()} == {"/in/a.bib": "Cell biology the", "/in/b.RIS": "graph networks"}
    empty = "no text" if mode == "compat" else "no entry"
    assert {r.path: r.reason for r in rejected.collect()} == {
        "/in/c.txt": "unsupported extension: .txt", "/in/d.bib": "no entry", "/in/e.bib": "no text", "/in/f.ris": empty,
    }
    assert "outcome=" in plan_of(accepted) or "PartitionFilters: [isnotnull(outcome" in plan_of(accepted)


def answers(spark, out):
    found, rejected = drop_folder.read_answers(spark, out)
    rows = sorted((r.query_id, r["rank"], r.doc_id, r.score) for r in found.collect())
    return rows, sorted((r.query_id, r.reason) for r in rejected.collect())


def test_arriving_queries_are_answered_once(spark, tmp_path, monkeypatch):
    base, inbox, out, marks = (str(tmp_path / n) for n in ("index", "inbox", "out", "marks"))
    index_articles(spark.createDataFrame(ARTICLES, SCHEMA), base, "c")
    files = spark.createDataFrame(FILES, "path string, text string").coalesce(1)

    def run():
        arriving = spark.readStream.schema("path string, text string").option("maxFilesPerTrigger", 1).parquet(inbox)
        return drop_folder.answer_arrivals(arriving, base, "c", out, marks, k=2)

    files.where("path < '/in/b'").write.mode("append").parquet(inbox)
    run().awaitTermination(120)
    # another version, published meanwhile, is not asked by this stream
    index_articles(spark.createDataFrame([(9, "Cell graph biology networks", "x")], SCHEMA), base, "c")
    files.where("path > '/in/b'").write.mode("append").parquet(inbox)

    # the second batch has written its answers when the job dies, before the batch is marked as done
    plain = drop_folder.write_query_outcomes
    monkeypatch.setattr(drop_folder, "write_query_outcomes", lambda *a, **k: fail_after(plain(*a, **k), out, spark))
    broken = run()
    with pytest.raises(Exception, match="power cut"):
        broken.awaitTermination(120)
    monkeypatch.undo()
    run().awaitTermination(120)
    run().awaitTermination(120)  # nothing new

    wanted = spark.createDataFrame(FILES, "path string, text string")
    fresh = str(tmp_path / "fresh")
    index_articles(spark.createDataFrame(ARTICLES, SCHEMA), fresh, "c")
    expected = sorted((r.query_id, r["rank"], r.doc_id, r.score) for r in search_files(spark, wanted, fresh, "c", k=2).collect())
    rows, refused = answers(spark, out)
    assert rows == expected
    assert [path for path, _ in refused] == ["/in/c.txt", "/in/d.bib", "/in/e.bib", "/in/f.ris"]


def fail_after(outcomes, out, spark):
    """Leave half of a batch's answers behind, then fail."""
    accepted, _ = outcomes
    half = accepted.select(F.col("path").alias("query_id"), F.lit(1).alias("rank"), F.lit(7).cast("long").alias("doc_id"), F.lit(0.5).alias("score"))
    half.write.mode("overwrite").parquet(f"{out}/found/batch=1")
    raise RuntimeError("power cut")


def test_a_stream_needs_an_index(spark, tmp_path):
    arriving = spark.readStream.schema("path string, text string").parquet(str(tmp_path))
    with pytest.raises(ValueError, match="no index"):
        drop_folder.answer_arrivals(arriving, str(tmp_path / "none"), "c", str(tmp_path / "o"), str(tmp_path / "m"))


def test_articles_without_an_id_keep_their_texts(spark):
    articles = spark.createDataFrame([(None, "Two networks", "a"), (None, "Networks", None), (1, "x", "N/A"), (1, "y", "z")], SCHEMA)
    lemmas = spark.createDataFrame([("networks", "network")], "token string, lemma string")
    found = normalized_corpus(articles, lemmas=lemmas)
    assert found.columns == articles.columns
    assert sorted((r.doc_id or 0, r.Title) for r in found.collect()) == [(0, "network"), (0, "two network"), (1, "x"), (1, "y")]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("max_bytes", [-1, 1 << 20])
def test_long_values_of_frequent_keys_are_dealt(spark, how, max_bytes):
    rows = [(i, "hot" if i % 3 else f"k{i % 30}") for i in range(300)] + [(900, "absent"), (901, None)]
    left = materialise(spark.createDataFrame(rows, "id long, key string"), "rows")
    right = spark.createDataFrame([("hot", "long " * 50)] + [(f"k{i}", str(i)) for i in range(25)], "key string, v string")
    got = skew.lookup_join(left, right, "key", how, max_keys=3, max_bytes=max_bytes)
    want = left.join(right, "key", how).select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
