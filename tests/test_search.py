import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperloom.operators import grams, ordering, similarity, skew, weights
from paperloom.plans.build_index import build_index, feature_tables, index_articles
from paperloom.plans.search import search, search_files, search_tables
from paperloom.session import materialise
from paperloom.sources import index_store

WORD = re.compile(r"(?u)\b\w\w+\b")


def corpus(n=60, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    # one word is in every text and one text fills a third of the corpus
    texts = ["common " + " ".join(rng.choices(words, weights=range(40, 0, -1), k=rng.randint(1, 30))) for _ in range(n)]
    return [(i, "common copy of one text" if i % 3 == 0 else t) for i, t in enumerate(texts)] + [(n, ""), (n + 1, None)]


def terms_of(text, feature):
    tokens = WORD.findall((text or "").lower())
    return tokens if feature == "unigram" else [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]


def brute_force(docs, queries, feature, weighting, k=10):
    counts = {i: Counter(terms_of(t, feature)) for i, t in docs}
    df = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items()}

    def vector(c):
        v = {t: {"freq": n, "binary": 1, "tfidf": n * idf[t]}[weighting] for t, n in c.items() if t in df}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / length for t, x in v.items()}

    vectors = {i: vector(c) for i, c in counts.items()}
    out = {}
    for q, text in queries:
        if not text.strip():
            continue
        v = vector(Counter(terms_of(text, feature)))
        scores = [(round(sum(x * d.get(t, 0) for t, x in v.items()), 9), i) for i, d in vectors.items()]
        out[q] = [(i, s) for s, i in sorted(scores, reverse=True)[:k]]
    return out


def as_lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.doc_id, r.score))
    return out


def assert_same(got, expected):
    assert got.keys() == expected.keys()
    for q, rows in expected.items():
        assert [i for i, _ in got[q]] == [i for i, _ in rows]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in rows], abs=2e-9)


DOCS = corpus()
QUERIES = [(0, "common w1 w2 w3"), (1, DOCS[4][1]), (2, "unknown words only"), (3, "   "), (4, "w39"), (5, "copy of one text copy")]


def frames(spark):
    return (
        spark.createDataFrame(DOCS, "doc_id long, text string"),
        spark.createDataFrame(QUERIES, "query_id long, text string"),
    )


@pytest.mark.parametrize("feature", grams.FEATURES)
@pytest.mark.parametrize("weighting", weights.WEIGHTINGS)
def test_search_equals_brute_force(spark, feature, weighting):
    docs, queries = frames(spark)
    postings, terms = feature_tables(docs, feature)
    got = search_tables(queries, postings, terms, docs, feature, weighting)
    assert_same(as_lists(got), brute_force(DOCS, QUERIES, feature, weighting))


@pytest.mark.parametrize("limit, per_group", [(1_000, 1), (1, 1), (1, 7), (1, 1_000_000)])
def test_large_query_batches_give_the_same_scores(spark, limit, per_group):
    docs, queries = frames(spark)
    postings, terms = feature_tables(docs, "unigram")
    vectors = similarity.query_vectors(queries, terms, "unigram", "tfidf")
    small = similarity.cosine_scores(vectors, postings, "tfidf", terms)
    best = similarity.best_matches(vectors, postings, "tfidf", terms)
    vectors = similarity.query_vectors(queries, terms, "unigram", "tfidf", max_broadcast_bytes=limit)
    limits = {"max_broadcast_bytes": limit, "postings_per_group": per_group}
    large = similarity.cosine_scores(vectors, postings, "tfidf", terms, **limits)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    assert as_lists(best) == as_lists(similarity.best_matches(vectors, postings, "tfidf", terms, **limits))


def test_a_text_finds_itself_and_scores_stay_in_range(spark):
    docs, _ = frames(spark)
    postings, terms = feature_tables(docs, "unigram")
    queries = docs.where("length(text) > 0").select(F.col("doc_id").alias("query_id"), "text")
    vectors = similarity.query_vectors(queries, terms, "unigram", "tfidf")
    scores = similarity.cosine_scores(vectors, postings, "tfidf", terms)
    assert scores.where("score < 0 or score > 1").count() == 0
    own = scores.where("query_id = doc_id")
    assert own.count() == queries.count() and own.where("score < 0.999999999").count() == 0


def test_layout_does_not_change_the_result(spark):
    docs, queries = frames(spark)
    results = []
    for n in (1, 5):
        postings, terms = feature_tables(docs.repartition(n), "bigram")
        results.append(as_lists(search_tables(queries.repartition(n), postings, terms, docs, "bigram", "tfidf")))
    assert_same(results[0], results[1])


def test_stored_index(spark, tmp_path):
    docs, queries = frames(spark)
    base = str(tmp_path)
    build_index(docs, base, "arxiv")
    for weighting in weights.WEIGHTINGS:
        got = search(spark, queries, base, "arxiv", "bigram", weighting)
        assert_same(as_lists(got), brute_force(DOCS, QUERIES, "bigram", weighting))
    assert search(spark, queries, base, "pubmed").columns == ["query_id", "rank", "doc_id", "score"]
    assert search(spark, queries, base, "pubmed").count() == 0
    one = index_store.load_index(spark, base, "arxiv", "unigram", "tfidf")
    assert one.count() == sum(len(set(terms_of(t, "unigram"))) for _, t in DOCS)
    lengths = one.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("s"))
    assert lengths.where("abs(s - 1) > 1e-12").count() == 0
    for key in (("pubmed", "unigram", "tfidf"), ("arxiv", "trigram", "tfidf"), ("arxiv", "unigram", "bm25")):
        assert index_store.load_index(spark, base, *key).count() == 0
    assert index_store.load_index(spark, str(tmp_path / "none"), "arxiv", "unigram", "freq").count() == 0


def test_loading_prunes_partitions_and_columns(spark, tmp_path):
    docs, _ = frames(spark)
    build_index(docs, str(tmp_path), "arxiv")
    plan = index_store.load_index(spark, str(tmp_path), "arxiv", "bigram", "freq")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(feature" in plan
    assert "norm_" not in plan and "idf" not in plan


def test_empty_corpus_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        build_index(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path), "arxiv")


def test_articles_to_files_and_back(spark, tmp_path):
    articles = spark.createDataFrame(
        [(1, "Graph of the networks", "They learn graphs"), (2, "Cell biology", None), (3, "N/A", "Deep graph networks and the cell")],
        "doc_id long, Title string, Abstract string",
    )
    index_articles(articles, str(tmp_path), "arxiv")
    files = spark.createDataFrame(
        [("a.bib", "@misc{a, title={Cell biology}, note={the}}"), ("b.ris", "TI  - graph networks\n"), ("c.txt", "x")],
        "path string, text string",
    )
    got = search_files(spark, files, str(tmp_path), "arxiv", k=2)
    best = {r.query_id: (r.doc_id, r.score) for r in got.where("rank = 1").collect()}
    assert best["a.bib"] == (2, 1.0) and best["b.ris"][0] == 3  # 0.650 against 0.605: its other words are commoner
    assert got.count() == 4
    binary = search_files(spark, files, str(tmp_path), "arxiv", feature="bigram", weighting="binary")
    assert binary.where("query_id = 'a.bib' and rank = 1").first().score == 1.0


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("max_keys", [1, 2, 1000])
def test_lookup_join_equals_a_plain_join(spark, how, max_keys):
    rows = [(i, "hot" if i % 3 else f"k{i % 30}") for i in range(300)] + [(900, "absent"), (901, None)]
    left = materialise(spark.createDataFrame(rows, "id long, key string"), "rows")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(25)], "key string, v long")
    got = skew.lookup_join(left, right, "key", how, max_keys=max_keys)
    want = left.join(right, "key", how).select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_frequent_keys_are_bounded(spark):
    counts = spark.createDataFrame([(f"k{i}", 10) for i in range(50)] + [("hot", 500)], "key string, n_rows long")
    for m in (1, 2, 10, 100):
        assert skew.frequent_keys(counts, "key", m).count() <= m
    assert [r.key for r in skew.frequent_keys(counts, "key", 2).collect()] == ["hot"]


@pytest.mark.parametrize("partitions", [1, 4])
def test_numbering_follows_code_point_order(spark, partitions):
    words = ["b", "a", "é", "z", "10", "_x", "𝛼", "ﬁ"] + [f"w{i}" for i in range(200)]
    df = spark.createDataFrame([(w,) for w in words], "term string").repartition(partitions)
    got = {r.term: r.n for r in ordering.numbered(df, "term", "n").collect()}
    assert got == {w: i for i, w in enumerate(sorted(words))}


def test_ranking_format(spark):
    best = spark.createDataFrame([(1, 1, 7, 0.1234567)], "query_id long, rank int, doc_id long, score double")
    assert similarity.format_ranking(best).first().score_text == "0.123457"
