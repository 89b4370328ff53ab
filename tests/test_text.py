import pytest
from pyspark.sql import functions as F

from paperloom.functions import text as X
from paperloom.functions.wordlists import CORPUS_CATEGORIES, QUERY_CATEGORIES, stop_words
from paperloom.operators import grams, normalize


def one(spark, expr, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(expr).first()[0]


@pytest.mark.parametrize(
    "text, tokens",
    [
        ("state-of-the-art A b2 naïve", ["state", "of", "the", "art", "b2", "naïve"]),
        ("x y z", []),
        ("", []),
        (None, []),
        ("snake_case, GPT-4o!", ["snake_case", "gpt", "4o"]),
    ],
)
def test_vector_tokens(spark, text, tokens):
    assert one(spark, X.vector_tokens(F.col("t")), t=text) == tokens


def test_infix_tokens_split_at_marks_but_keep_hyphens(spark):
    got = one(spark, X.infix_tokens(F.col("t")), t="A state-of-the-art (and/or) method: it's “new”, v1.2")
    assert got == [
        "a", "state-of-the-art", "(", "and/or", ")", "method", ":", "it", "'", "s", "“", "new", "”", ",", "v1", ".", "2",
    ]


def test_combined_text_treats_missing_spellings_as_empty(spark):
    expr = X.combined_text(F.col("a"), F.col("b"))
    assert one(spark, expr, a="T", b="N/A") == "T "
    assert one(spark, expr, a=None, b="nan") == " "
    assert one(spark, expr, a="T", b="A") == "T A"


def test_bigrams_are_adjacent_pairs_only_and_cross_the_title_boundary(spark):
    docs = spark.createDataFrame([(1, "deep nets learn nets"), (2, "one"), (3, "")], "doc_id long, text string")
    got = sorted(tuple(r) for r in grams.terms(docs, "bigram").collect())
    assert got == [(1, "deep nets"), (1, "learn nets"), (1, "nets learn")]


def test_one_long_text_is_counted_whole(spark):
    docs = spark.createDataFrame([(1, "alpha beta " * 200_000)], "doc_id long, text string")
    counts = {r.term: r.tf for r in grams.term_counts(docs, "bigram").collect()}
    assert counts == {"alpha beta": 200_000, "beta alpha": 199_999}


def test_conjunctions_are_kept_on_the_corpus_side_only(spark):
    text = "Unified and Scalable methods of this graph"
    corpus = one(spark, normalize.normalized(F.col("t"), stop_words(normalize.categories("corpus", compat=True))), t=text)
    query = one(spark, normalize.normalized(F.col("t"), stop_words(normalize.categories("query", compat=True))), t=text)
    assert corpus == "unified and scalable methods graph"
    assert query == "unified scalable methods graph"
    assert set(stop_words(QUERY_CATEGORIES)) - set(stop_words(CORPUS_CATEGORIES)) == {"and", "but", "nor", "or", "plus", "yet"}
    assert normalize.categories("corpus") == normalize.categories("query")


def test_tokenizer_hook_replaces_lists(spark):
    df = spark.createDataFrame([("The Title", "An Abstract")], "Title string, Abstract string")
    got = normalize.normalize_columns(df, tokenizer=lambda c: F.upper(c)).first()
    assert tuple(got) == ("THE TITLE", "AN ABSTRACT")


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_lemmas_replace_words_in_place(spark, limit):
    docs = spark.createDataFrame([(1, "Graphs, graphs of studies"), (2, "the"), (3, None)], "doc_id long, text string")
    lemmas = spark.createDataFrame([("graphs", "graph"), ("studies", "study")], "token string, lemma string")
    tokens = normalize.kept_tokens(grams.by_document(docs))
    got = normalize.rebuild_text(normalize.lemmatize(tokens, lemmas, max_broadcast_bytes=limit))
    assert {tuple(r) for r in got.collect()} == {(1, "graph , graph study"), (2, ""), (3, "")}


def test_suffix_lemmas_need_the_base_form(spark):
    words = ["graph", "graphs", "study", "studies", "make", "making", "trained", "as", "bus", "classes", "class"]
    vocabulary = spark.createDataFrame([(w,) for w in words], "token string")
    got = {r.token: r.lemma for r in normalize.suffix_lemmas(vocabulary).collect()}
    assert got == {"graphs": "graph", "studies": "study", "making": "make", "classes": "class"}
