"""What index builds, compactions and searches do once only, and what they leave on the disks."""

import os
import time

import pytest
from pyspark.sql import functions as F

from paperloom.operators import similarity, skew, weights
from paperloom.plans import build_index as plans
from paperloom.plans.search import search
from paperloom.session import OPEN_KEY, PLACED_KEY, TIDY_KEY, even_labels, materialise, materialise_placed
from paperloom.sources import index_store as store
from test_search import DOCS, QUERIES, as_lists, assert_same, brute_force, frames


def test_a_compaction_copies_frequencies_and_norms(spark, tmp_path, monkeypatch):
    """The documents stay the same: nothing is counted or weighed again (F1)."""
    docs, queries = frames(spark)
    base = str(tmp_path)
    plans.build_index(docs.where("doc_id % 3 = 0"), base, "thirds", buckets=2)
    for rest in (1, 2):
        plans.append_index(docs.where(F.col("doc_id") % 3 == rest), base, "thirds", buckets=2, term_parts=rest)
    before = store.read_manifest(spark, base, "thirds")
    terms = lambda m: sorted(map(tuple, store.version_terms(spark, base, "thirds", m).select("feature", "term", "df").collect()))
    norms = lambda m: sorted(tuple(r) for s in m.segments for r in store.segment_norms(spark, base, "thirds", m, s).collect())
    monkeypatch.setattr(plans, "_with_idf", lambda *a: pytest.fail("weighed again"))
    after = plans.compact_index(spark, base, "thirds")
    assert len(before.segments) == 3 and len(after.segments) == 1
    assert terms(after) == terms(before) and norms(after) == norms(before)
    for feature, weighting in (("unigram", "tfidf"), ("bigram", "freq")):
        found = as_lists(search(spark, queries, base, "thirds", feature, weighting))
        assert_same(found, brute_force(DOCS, QUERIES, feature, weighting))


def test_norms_are_looked_up_for_sums(spark, tmp_path):
    """Products are added up before the norm of their document is looked up, once for a pair (F1 to F6)."""
    docs, queries = frames(spark)
    plans.build_index(docs, str(tmp_path), "c", ["unigram"], buckets=2)
    segment = store.load_tables(spark, str(tmp_path), "c", "unigram").segments[0]
    index = store.load_tables(spark, str(tmp_path), "c", "unigram")
    vectors = similarity.query_vectors(queries, index.terms, "unigram", "tfidf")
    found = similarity.best_matches(
        vectors, segment.postings, "tfidf", index.terms, norms=segment.norms, term_part=store.term_part(F.col("term"), 1)
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    lookup = plan.index("ShuffledHashJoin [doc_id#")
    assert "HashAggregate(keys=[query_id#" in plan[lookup:] and "HashAggregate(keys=[query_id#" not in plan[:lookup]


def shuffle_files(spark):
    disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = disks.getAllFiles().mkString("\n").split("\n")
    return {n for n in names if "shuffle_" in n}


def test_what_is_written_leaves_no_shuffle_files(spark, tmp_path):
    """Tables that are written once keep no shuffle files, the session's own settings stay, and files are sorted by term (F7, F8)."""
    kept = {k: spark.conf.get(k, None) for k in (OPEN_KEY, TIDY_KEY)}
    before = shuffle_files(spark)
    table = materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sums")
    for _ in range(100):  # removed by a message to the executors
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and table.count() == 7
    docs, _ = frames(spark)
    plans.build_index(docs, str(tmp_path), "c", buckets=2, term_parts=3)
    assert {k: spark.conf.get(k, None) for k in kept} == kept
    files = store.segment_postings(spark, str(tmp_path), "c", store.read_manifest(spark, str(tmp_path), "c").segments[0])
    per_file = files.withColumn("f", F.input_file_name()).groupBy("f").agg(F.collect_list("term").alias("terms"))
    assert all(r["terms"] == sorted(r["terms"]) for r in per_file.collect())


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("max_keys, short", [(1, None), (3, None), (1, 50), (10_000, None)])
def test_a_table_that_knows_its_keys_is_not_counted(spark, how, max_keys, short):
    """Keys that come with their number of rows are joined as before, without a count of them (F2 to F7)."""
    rows = [(f"k{i % (1 + i % 9)}", i) for i in range(200)]
    left = spark.createDataFrame(rows, "key string, n long")
    right = left.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("key <> 'k3'")
    got = skew.lookup_join(left, right, "key", how, max_keys=max_keys, parts=3, size="df", null_keys=False, max_short_keys=short)
    want = left.join(right, "key", how)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


@pytest.mark.parametrize("parts", [1, 7, 130])
def test_labels_fill_each_partition_once(spark, parts):
    labels = even_labels(spark, parts)
    rows = spark.createDataFrame([(x,) for x in labels], "part int").repartition(parts, "part")
    where = rows.select("part", F.spark_partition_id().alias("p")).collect()
    assert sorted(r.p for r in where) == list(range(parts)) and [r.part for r in sorted(where, key=lambda r: r.p)] == labels


def test_postings_stay_where_they_were_counted(spark, monkeypatch):
    """The idf comes to the postings: neither they nor the sums of a search are moved by document (F8)."""
    rows = [(i, f"common pair{i % 9} only{i} " + "often " * (i % 4)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    written, found = [], []
    place = lambda df, *a: written.append(df) or materialise_placed(df, *a)
    monkeypatch.setattr(plans, "materialise_placed", place)
    for max_keys, short in ((50_000, 500_000), (3, 3)):
        monkeypatch.setattr(weights, "MAX_SHORT_KEYS", short)
        monkeypatch.setattr(weights, "frequent_rows", lambda *a, **k: skew.frequent_rows(*a, **k, max_keys=max_keys))
        postings, terms = plans.feature_tables(docs, "bigram", buckets=3)
        found.append(sorted(map(tuple, postings.drop("part").collect())))
    assert found[0] == found[1]
    spark.conf.set(PLACED_KEY, "false")
    try:
        plan = written[-1]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(PLACED_KEY)
    moves = [line for line in plan.split("\n") if "Exchange hashpartitioning(" in line]
    assert moves and all("hashpartitioning(part#" in m or "hashpartitioning(term#" in m for m in moves) and ", 3)" in "".join(moves)
    assert sum("hashpartitioning(part#" in m for m in moves) == 1  # the answers
    length = postings.groupBy("doc_id").agg(F.sum((F.col("tf") * F.col("idf") / F.col("norm_tfidf")) ** 2).alias("s"))
    assert length.where("abs(s - 1) > 1e-12").count() == 0
    vectors = similarity.query_vectors(docs.select(F.col("doc_id").alias("query_id"), "text").limit(5), terms, "bigram", "tfidf")
    scores = similarity.cosine_scores(vectors, postings, "tfidf", terms)
    assert "hashpartitioning(query_id" not in scores._jdf.queryExecution().executedPlan().toString().split("Window")[0]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("paperloom_") and "counts" in t.name]


def test_texts_are_gone_when_norms_are_computed(spark, tmp_path, monkeypatch):
    """The normalised texts of articles do not lie on the disks beside the shuffles of the idf join (F7)."""
    schema = "doc_id long, Title string, Abstract string"
    articles = spark.createDataFrame([(0, "Neural networks", "Other"), (1, "Network studies", None)], schema)
    written, seen = [], []
    monkeypatch.setattr(plans, "materialise", lambda df, label, *a: written.append(materialise(df, label, *a)) or written[-1])
    publish = plans._publish
    texts = lambda: [os.path.exists(f.removeprefix("file://")) for df in written for f in df.inputFiles()]
    count = plans._write_segment
    monkeypatch.setattr(plans, "_write_segment", lambda *a: (seen.append(all(texts())), count(*a))[1])
    monkeypatch.setattr(plans, "_publish", lambda *a: (seen.append(any(texts())), publish(*a))[1])
    plans.index_articles(articles, str(tmp_path), "c")
    assert len(written) == 1 and seen == [True, False]
