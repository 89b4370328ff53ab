"""Build the index of a corpus: both features, all three weightings."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.functions.text import combined_text
from paperloom.functions.wordlists import stop_words
from paperloom.operators.grams import FEATURES, PART_BYTES, feature_counts, placed_counts, text_parts
from paperloom.operators.normalize import categories, normalize_documents
from paperloom.operators.records import union_sections
from paperloom.operators.skew import MAX_BROADCAST_BYTES, MAX_SHORT_KEYS, lookup_join
from paperloom.operators.weights import (
    WEIGHTINGS, document_count, document_norms, smooth_idf, term_table, with_idf_in_place, with_norms,
)
from paperloom.plans.build_corpus import normalized_corpus
from paperloom.session import fresh_path, materialise, materialise_placed, remove_path, scratch, shuffles_of
from paperloom.sources import index_store as store

KEY_MARK = "\x01"  # between a term and its feature's name; neither holds it


def corpus_texts(articles: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text) from an article table: title and abstract in one text."""
    return articles.select(F.col(id_col).alias("doc_id"), combined_text(F.col("Title"), F.col("Abstract")).alias("text"))


def feature_tables(
    docs: DataFrame, feature: str, buckets: int | None = None, weightings=WEIGHTINGS
) -> tuple[DataFrame, DataFrame]:
    """(postings, terms) of one feature from (doc_id, text), with the norms of the given weightings.

    Counts and terms are written once, as tokenising must not be repeated. The
    texts are dealt to `buckets` parts, and no posting is moved after that:
    the idf, which only tf-idf needs, comes to its part, and the weighed
    postings replace the counts. `part` is the first column of the postings.
    """
    spark = docs.sparkSession
    buckets = buckets or text_parts(docs)
    path = fresh_path(spark, f"counts-{feature}")
    counts = placed_counts(docs, feature, buckets, path)
    n_docs = document_count(docs)
    terms = materialise(term_table(counts, n_docs), f"terms-{feature}", buckets)
    if "tfidf" in weightings:
        weighed = with_norms(with_idf_in_place(counts, terms, n_docs, buckets), weightings)
        postings = materialise_placed(weighed, fresh_path(spark, f"postings-{feature}"), "part", buckets)
        remove_path(spark, path)
        return postings, terms
    return with_norms(counts.withColumn("idf", F.lit(None).cast("double")), weightings), terms


def _write_segment(docs: DataFrame, base: str, corpus: str, features, buckets, term_parts) -> store.SegmentInfo:
    """Counts of (doc_id, text) as a new segment; texts are moved and tokenised once for all features."""
    spark = docs.sparkSession
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if not size["n"]:
        raise ValueError(f"corpus {corpus!r} has no documents")
    layout = store.layout_for(spark, size["bytes"] or 0, buckets, term_parts)
    segment = store.SegmentInfo(store.new_id(), layout.buckets, layout.term_parts, size["n"])
    with store.removed_on_failure(spark, store.segment_folder(base, corpus, segment.id)):
        store.write_segment_docs(docs, base, corpus, segment.id)
        parts = math.ceil((size["bytes"] or 0) / PART_BYTES)
        counts = feature_counts(docs, features, layout.buckets, max(1, parts))
        with shuffles_of(spark, parts):
            store.write_segment_counts(counts, base, corpus, segment.id, layout)
    return segment


def _publish(
    spark: SparkSession, base: str, corpus: str, segments, features, lemmas: DataFrame | None, norms: DataFrame | None = None
) -> store.Manifest:
    """Idf and norms over all segments, then the manifest.

    Document frequencies of the segments are added up; the norms are read off
    their counts. No text is needed and no posting is written again. `norms`
    are those of the only segment, if they are known already.
    """
    before = store.read_manifest(spark, base, corpus)
    version, n_docs = store.new_id(), sum(s.n_docs for s in segments)
    parts = max(s.term_parts for s in segments)
    manifest = store.Manifest(
        (before.version if before else 0) + 1, version, tuple(segments), tuple(features), parts, lemmas is not None
    )
    with store.removed_on_failure(spark, store.version_folder(base, corpus, version)):
        if len(segments) > 1:
            counted = union_sections([store.segment_terms(spark, base, corpus, s) for s in segments])
            merged = counted.groupBy("feature", "term").agg(F.sum("df").alias("df"))
            with shuffles_of(spark, sum(s.buckets for s in segments)):
                store.write_terms(merged, store.version_folder(base, corpus, version), parts)
        terms = store.version_terms(spark, base, corpus, manifest)
        if norms is not None:
            store.write_norms(norms, base, corpus, version, segments[0])
        for segment in segments if norms is None else ():
            weighed = _with_idf(store.segment_postings(spark, base, corpus, segment), terms, n_docs, segment.buckets)
            with shuffles_of(spark, segment.buckets):
                store.write_norms(document_norms(weighed, ("feature", "doc_id")), base, corpus, version, segment)
        if lemmas is not None:
            store.write_lemmas(lemmas, base, corpus, version)
        store.publish(spark, base, corpus, manifest)
    return manifest


def _with_idf(postings: DataFrame, terms: DataFrame, n_docs: int, parts: int) -> DataFrame:
    """(doc_id, feature, tf, idf) of postings.

    Most terms are in one document only: what finds no idf is such a term. If
    the others are measured to be small, they go to the postings, which stay
    with their documents. Otherwise frequent ones meet a bounded broadcast and
    the rest a shuffle, to which terms of one document send nothing.
    """
    shared = terms.where("df > 1")
    size = shared.agg(F.coalesce(F.sum(F.octet_length("term") + 96), F.lit(0)).alias("bytes")).first()["bytes"]
    if size <= MAX_BROADCAST_BYTES:
        known = postings.join(F.broadcast(shared.select("feature", "term", "idf")), ["feature", "term"], "left")
        return known.withColumn("idf", F.coalesce("idf", smooth_idf(F.lit(1), F.lit(n_docs))))
    # one string as the key and counts instead of doubles: rows of half the size
    key = F.concat("term", F.lit(KEY_MARK), "feature").alias("key")
    found = lookup_join(
        postings.select("doc_id", "tf", key), shared.select(key, "df"), "key", "left",
        parts=parts, size="df", null_keys=False, max_short_keys=MAX_SHORT_KEYS,
    )
    idf = smooth_idf(F.coalesce("df", F.lit(1)), F.lit(n_docs))
    return found.select("doc_id", F.substring_index("key", KEY_MARK, -1).alias("feature"), "tf", idf.alias("idf"))


def build_index(
    docs: DataFrame,
    base: str,
    corpus: str,
    features=FEATURES,
    buckets: int | None = None,
    term_parts: int | None = None,
    lemmas: DataFrame | None = None,
) -> store.Manifest:
    """Index (doc_id, text) as a new version under `base`; raises when there is no document.

    The version replaces an earlier one as a whole, lemma table included, once
    it is complete; a build that fails leaves the earlier one in place.
    `buckets` of documents and `term_parts` follow from the size of the texts
    unless given. `docs` is read twice, so pass a written table.
    """
    spark = docs.sparkSession
    with scratch(spark, "build-index"):
        segment = _write_segment(docs, base, corpus, features, buckets, term_parts)
        return _publish_only(spark, base, corpus, segment, features, lemmas)


def _publish_only(spark: SparkSession, base: str, corpus: str, segment: store.SegmentInfo, features, lemmas) -> store.Manifest:
    """A version of one new segment, which goes if that fails."""
    with store.removed_on_failure(spark, store.segment_folder(base, corpus, segment.id)):
        return _publish(spark, base, corpus, [segment], features, lemmas)


def append_index(
    docs: DataFrame, base: str, corpus: str, buckets: int | None = None, term_parts: int | None = None
) -> store.Manifest:
    """Add documents (doc_id, text) to an index as a segment of their own; searches then see all of them.

    Only the new texts are tokenised; they must be normalised like the others
    (`append_articles` does that). Raises if there is no index, or if an id is
    already there or comes twice.
    """
    spark = docs.sparkSession
    manifest = store.read_manifest(spark, base, corpus)
    if manifest is None:
        raise ValueError(f"corpus {corpus!r} has no index to add to")
    twice = docs.groupBy("doc_id").count().where("count > 1").select("doc_id")
    for segment in manifest.segments:
        there = store.segment_docs(spark, base, corpus, segment)
        twice = twice.unionByName(docs.select("doc_id").join(there, "doc_id", "left_semi"))
    clash = twice.first()
    if clash is not None:
        raise ValueError(f"document {clash['doc_id']} would be in corpus {corpus!r} twice")
    with scratch(spark, "append-index"):
        new = _write_segment(docs, base, corpus, manifest.features, buckets, term_parts)
        with store.removed_on_failure(spark, store.segment_folder(base, corpus, new.id)):
            lemmas = store.load_lemmas(spark, base, corpus, manifest)
            return _publish(spark, base, corpus, [*manifest.segments, new], manifest.features, lemmas)


def compact_index(
    spark: SparkSession, base: str, corpus: str, buckets: int | None = None, term_parts: int | None = None
) -> store.Manifest:
    """Merge all segments into one; counts are dealt anew, no text is needed.

    The documents stay the same, and with them document frequencies and norms:
    these are copied from the version that is merged. An index of one segment
    is left as it is.
    """
    manifest = store.read_manifest(spark, base, corpus)
    if manifest is None:
        raise ValueError(f"corpus {corpus!r} has no index to compact")
    if len(manifest.segments) == 1:
        return manifest
    rows = [store.segment_postings(spark, base, corpus, s) for s in manifest.segments]
    docs = [store.segment_docs(spark, base, corpus, s) for s in manifest.segments]
    counts, whole = union_sections(rows), union_sections(docs)
    # the merged segment holds more than any of them: its buckets follow from the terms, which are about its texts once a feature
    size = counts.agg(F.sum(F.octet_length("term")).alias("bytes")).first()["bytes"] or 0
    grown = store.layout_for(spark, size // max(1, len(manifest.features)))
    layout = store.Layout(
        buckets or max(grown.buckets, *(s.buckets for s in manifest.segments)),
        term_parts or max(grown.term_parts, *(s.term_parts for s in manifest.segments)),
    )
    merged = store.SegmentInfo(store.new_id(), layout.buckets, layout.term_parts, manifest.n_docs)
    with scratch(spark, "compact-index"), store.removed_on_failure(spark, store.segment_folder(base, corpus, merged.id)):
        store.write_segment_docs(whole, base, corpus, merged.id)
        dealt = counts.select("doc_id", "feature", "term", "tf").repartition(layout.buckets, "doc_id")
        with shuffles_of(spark, layout.buckets):
            terms = store.version_terms(spark, base, corpus, manifest)
            store.write_segment_counts(dealt, base, corpus, merged.id, layout, terms)
        lemmas = store.load_lemmas(spark, base, corpus, manifest)
        norms = union_sections([store.segment_norms(spark, base, corpus, manifest, s) for s in manifest.segments])
        return _publish(spark, base, corpus, [merged], manifest.features, lemmas, norms)


def _article_texts(articles: DataFrame, id_col: str, compat: bool, tokenizer, lemmas: DataFrame | None) -> DataFrame:
    """(doc_id, text): normalised title and abstract of an article table."""
    if lemmas is None:
        return corpus_texts(normalized_corpus(articles, compat, tokenizer), id_col)
    stop = stop_words(categories("corpus", compat))
    found = normalize_documents(corpus_texts(articles, id_col), lemmas, stop)
    return found.select("doc_id", F.col("normalized").alias("text"))


def index_articles(
    articles: DataFrame,
    base: str,
    corpus: str,
    id_col: str = "doc_id",
    compat: bool = False,
    tokenizer=None,
    lemmas: DataFrame | None = None,
) -> store.Manifest:
    """From an article table to its stored index: normalise, combine title and abstract, weigh.

    The normalised texts are written once, and removed once they are counted.
    A lemma table (token, lemma) is stored with the version, and searches apply
    it to their queries.
    """
    spark = articles.sparkSession
    with scratch(spark, "index-articles"):
        texts = materialise(_article_texts(articles, id_col, compat, tokenizer, lemmas), "texts")
        segment = _write_segment(texts, base, corpus, FEATURES, None, None)
    with scratch(spark, "index-articles"):
        return _publish_only(spark, base, corpus, segment, FEATURES, lemmas)


def append_articles(
    articles: DataFrame, base: str, corpus: str, id_col: str = "doc_id", compat: bool = False, tokenizer=None
) -> store.Manifest:
    """Add articles to a stored index, with the lemma table that it was built with."""
    spark = articles.sparkSession
    with scratch(spark, "append-articles"):
        lemmas = store.load_lemmas(spark, base, corpus)
        texts = materialise(_article_texts(articles, id_col, compat, tokenizer, lemmas), "texts")
        return append_index(texts, base, corpus)
