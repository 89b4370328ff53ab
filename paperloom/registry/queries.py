"""Every operator as a query over the given tables: name -> f(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.functions import dates, links
from paperloom.functions.wordlists import stop_words
from paperloom.operators import grams, normalize, ordering, profile, records, similarity, weights
from paperloom.plans import build_corpus, build_index, search
from paperloom.registry import inputs
from paperloom.session import fresh_path, materialise
from paperloom.sources import bibtex, citations, index_store, listing_pages, nbib, ris, tables
from paperloom.streaming import drop_folder

CORPUS = "documents"
# Sums of doubles differ in their last digits with the order of the rows; six digits do not show it.
DIGITS = 6


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, DIGITS) for name in names})


# ---- terms and weights


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grams.token_positions(inputs.documents(spark, sf_dir))


def bigrams(spark, sf_dir):
    return grams.terms(inputs.documents(spark, sf_dir), "bigram")


def _counts(feature):
    return lambda spark, sf_dir: grams.term_counts(inputs.documents(spark, sf_dir), feature)


def _presence(feature):
    return lambda spark, sf_dir: grams.term_presence(inputs.documents(spark, sf_dir), feature)


def _tfidf(feature):
    def run(spark, sf_dir):
        postings, _ = build_index.feature_tables(inputs.documents(spark, sf_dir), feature)
        return _rounded(postings.select("doc_id", "term", weights.unit_weight("tfidf").alias("weight")), "weight")

    return run


def vocabulary(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    parts = grams.text_parts(docs)
    return weights.vocabulary(grams.term_counts(docs, "unigram", parts=parts), parts)


def doc_freq(spark, sf_dir):
    return _rounded(_unigram_terms(inputs.documents(spark, sf_dir)), "idf")


def _unigram_terms(docs: DataFrame) -> DataFrame:
    parts = grams.text_parts(docs)
    return weights.term_table(grams.term_counts(docs, "unigram", parts=parts), weights.document_count(docs), parts)


def doc_norms(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    parts = grams.text_parts(docs)
    counts = materialise(grams.term_counts(docs, "unigram", parts=parts), "counts")
    terms = materialise(weights.term_table(counts, weights.document_count(docs)), "terms", parts)
    return _rounded(weights.document_norms(weights.with_idf(counts, terms, parts)), "norm_freq", "norm_binary", "norm_tfidf")


# ---- search


def query_vectors(spark, sf_dir):
    terms = _unigram_terms(inputs.documents(spark, sf_dir))
    vectors = similarity.query_vectors(inputs.queries(spark, sf_dir), terms, "unigram", "tfidf")
    return _rounded(vectors.drop("idf"), "weight")


def cosine_scores(spark, sf_dir):
    """Every query against every document with a term in common."""
    docs, queries = inputs.documents(spark, sf_dir), inputs.queries(spark, sf_dir)
    postings, terms = build_index.feature_tables(docs, "unigram", weightings=("tfidf",))
    vectors = similarity.query_vectors(queries, terms, "unigram", "tfidf")
    return _rounded(similarity.cosine_scores(vectors, postings, "tfidf", terms), "score")


def _search(spark, sf_dir, feature, weighting, padded=False):
    docs = inputs.documents(spark, sf_dir)
    postings, terms = build_index.feature_tables(docs, feature, weightings=(weighting,))
    queries = inputs.queries(spark, sf_dir)
    return search.search_tables(queries, postings, terms, docs, feature, weighting, padded=padded)


def top10_similar(spark, sf_dir):
    return _search(spark, sf_dir, "unigram", "tfidf")


def topk_padded(spark, sf_dir):
    return _search(spark, sf_dir, "bigram", "freq", padded=True)


def topk_ranked(spark, sf_dir):
    return similarity.format_ranking(_search(spark, sf_dir, "unigram", "binary"))


def load_index(spark, sf_dir):
    base = fresh_path(spark, "index")
    build_index.build_index(inputs.documents(spark, sf_dir), base, CORPUS, ["bigram"])
    return index_store.load_index(spark, base, CORPUS, "bigram", "freq")


def search_variants(spark, sf_dir):
    base = fresh_path(spark, "index")
    build_index.build_index(inputs.documents(spark, sf_dir), base, CORPUS)
    return _variants(spark, sf_dir, base)


def _variants(spark, sf_dir, base):
    queries = inputs.queries(spark, sf_dir)
    found = [
        search.search(spark, queries, base, CORPUS, feature, weighting).select(
            F.lit(feature).alias("feature"), F.lit(weighting).alias("weighting"), "*"
        )
        for feature in grams.FEATURES
        for weighting in weights.WEIGHTINGS
    ]
    return records.union_sections(found)


def search_segments(spark, sf_dir):
    """As `search_variants`, from an index of one half of the documents to which the other half was added."""
    base = fresh_path(spark, "index")
    docs = inputs.documents(spark, sf_dir)
    build_index.build_index(docs.where("doc_id % 2 = 0"), base, CORPUS)
    build_index.append_index(docs.where("doc_id % 2 <> 0"), base, CORPUS, term_parts=4)
    return _variants(spark, sf_dir, base)


def search_compacted(spark, sf_dir):
    """As `search_variants`, from an index that grew by a third at a time and was then made one segment again."""
    base = fresh_path(spark, "index")
    docs = inputs.documents(spark, sf_dir)
    build_index.build_index(docs.where("doc_id % 3 = 0"), base, CORPUS)
    for rest in (1, 2):
        build_index.append_index(docs.where(F.col("doc_id") % 3 == rest), base, CORPUS)
    build_index.compact_index(spark, base, CORPUS)
    return _variants(spark, sf_dir, base)


# ---- normalisation


def normalize_docs(spark, sf_dir):
    return normalize.normalize_documents(inputs.spread_documents(spark, sf_dir))


def normalize_compat(spark, sf_dir):
    """Title and abstract of the article table, with coordinating conjunctions kept."""
    stop = stop_words(normalize.categories("corpus", compat=True))
    articles = normalize.normalize_columns(inputs.articles(spark, sf_dir), stop=stop)
    return articles.select("doc_id", "Title", "Abstract")


def lemma_join(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    tokens = normalize.kept_tokens(grams.by_document(docs)).where(F.col("token").isNotNull())
    vocabulary = materialise(tokens.select("token").distinct(), "vocabulary")
    return normalize.normalize_documents(docs, normalize.suffix_lemmas(vocabulary))


def doc_index(spark, sf_dir):
    return ordering.with_row_index(inputs.documents(spark, sf_dir).select("doc_id"), "doc_id")


# ---- citation records


def nbib_records(spark, sf_dir):
    return nbib.nbib_records(inputs.nbib_texts(spark, sf_dir), keep=("doc_id",)).drop("raw_date")


def complete_records(spark, sf_dir):
    return nbib.nbib_articles(inputs.nbib_texts(spark, sf_dir), keep=("doc_id",))


def rejects(spark, sf_dir):
    found = nbib.nbib_records(inputs.nbib_texts(spark, sf_dir), keep=("doc_id",))
    return records.rejected_records(found, nbib.REQUIRED, keep=("doc_id",))


def nbib_bulk(spark, sf_dir):
    """Exports of many records each."""
    keep = ("file_no", "record_no")
    records = nbib.split_records(inputs.nbib_bulk_texts(spark, sf_dir), ("file_no",))
    return nbib.nbib_records(records, keep).drop("raw_date")


def journal_all(spark, sf_dir):
    """The journal table without a limit."""
    return build_corpus.journal_corpus(inputs.nbib_texts(spark, sf_dir), "doc_id")


def cap_global(spark, sf_dir):
    return listing_pages.cap_overall(complete_records(spark, sf_dir), "doc_id", 300)


def _titled(entries: DataFrame) -> DataFrame:
    fields = F.col("fields")
    return entries.select("doc_id", fields["title"].alias("title"), fields["abstract"].alias("abstract"))


def ris_records(spark, sf_dir):
    return _titled(ris.ris_records(inputs.ris_texts(spark, sf_dir), keep=("doc_id",)))


def ris_full(spark, sf_dir):
    return _titled(ris.ris_records(inputs.ris_texts(spark, sf_dir), keep=("doc_id",), mode="full"))


def ris_bulk(spark, sf_dir):
    """As `ris_full`, from files of many records that are read in splits."""
    found = ris.read_bulk_ris(spark, inputs.ris_bulk_folder(spark, sf_dir))
    number = F.regexp_extract("text", r"(?m)^ID  - (\d+)", 1).cast("long").alias("doc_id")
    return _titled(ris.bulk_ris_records(found.select(number, "text"), keep=("doc_id",)))


BIB_FIELDS = ("ENTRYTYPE", "ID", "title", "author", "abstract", "note", "month", "year")


def bib_records(spark, sf_dir):
    entries = bibtex.bib_records(inputs.bib_texts(spark, sf_dir), keep=("doc_id",))
    return entries.select("doc_id", *[F.col("fields")[name].alias(name) for name in BIB_FIELDS])


def bib_bulk(spark, sf_dir):
    """As `bib_records`, from files of many entries that are read in splits; the key tells the document."""
    entries = bibtex.read_bulk_bibtex(spark, inputs.bib_bulk_folder(spark, sf_dir))
    key = F.regexp_extract(F.col("fields")["ID"], r"^key(\d+)$", 1)
    fields = [F.col("fields")[name].alias(name) for name in BIB_FIELDS]
    return entries.where(key != "").select(key.cast("long").alias("doc_id"), *fields)


def dispatch_ext(spark, sf_dir):
    return citations.dispatch(inputs.citation_files(spark, sf_dir)).select("doc_id", "extension", "supported")


def rejected_files(spark, sf_dir):
    return citations.rejected_files(inputs.citation_files(spark, sf_dir))


def query_rejects(spark, sf_dir):
    return citations.rejected_queries(inputs.citation_files(spark, sf_dir))


def query_text(spark, sf_dir):
    keep = ("doc_id",)
    return citations.query_texts(citations.query_entries(inputs.citation_files(spark, sf_dir), keep), keep)


def display_text(spark, sf_dir):
    keep = ("doc_id",)
    entries = citations.query_entries(inputs.citation_files(spark, sf_dir), keep)
    return citations.display_text(entries, "Abstract", keep)


def search_files(spark, sf_dir):
    """Article table to stored index, then query texts saved as citation files: the whole way."""
    base = fresh_path(spark, "index")
    build_index.index_articles(inputs.articles(spark, sf_dir), base, CORPUS)
    return search.search_files(spark, inputs.query_files(spark, sf_dir), base, CORPUS, key="doc_id")


def search_lemmas(spark, sf_dir):
    """As `search_files`, with the words of both sides replaced by their lemmas."""
    base = fresh_path(spark, "index")
    articles = inputs.articles(spark, sf_dir)
    tokens = normalize.kept_tokens(build_index.corpus_texts(articles)).where(F.col("token").isNotNull())
    lemmas = normalize.suffix_lemmas(materialise(tokens.select("token").distinct(), "vocabulary"))
    build_index.index_articles(articles, base, CORPUS, lemmas=materialise(lemmas, "lemmas"))
    return search.search_files(spark, inputs.query_files(spark, sf_dir), base, CORPUS, key="doc_id")


def search_reindexed(spark, sf_dir):
    """As `search_files`, after the corpus was first indexed with lemmas: the new version has nothing of the old one."""
    base = fresh_path(spark, "index")
    articles = inputs.articles(spark, sf_dir)
    tokens = normalize.kept_tokens(build_index.corpus_texts(articles)).where(F.col("token").isNotNull())
    lemmas = normalize.suffix_lemmas(materialise(tokens.select("token").distinct(), "vocabulary"))
    build_index.index_articles(articles, base, CORPUS, lemmas=materialise(lemmas, "lemmas"))
    build_index.index_articles(articles, base, CORPUS)
    return search.search_files(spark, inputs.query_files(spark, sf_dir), base, CORPUS, key="doc_id")


def search_arrivals(spark, sf_dir):
    """As `search_files`, with the query files arriving in a folder, a few at a time."""
    base, inbox, out = (fresh_path(spark, name) for name in ("index", "inbox", "answers"))
    build_index.index_articles(inputs.articles(spark, sf_dir), base, CORPUS)
    rows = inputs.query_files(spark, sf_dir)
    rows.repartition(3, "doc_id").write.parquet(inbox)
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(inbox)
    drop_folder.answer_arrivals(arriving, base, CORPUS, out, fresh_path(spark, "marks"), key="doc_id").awaitTermination()
    found, _ = drop_folder.read_answers(spark, out)
    return found.select(F.col("query_id").cast("long").alias("query_id"), "rank", "doc_id", "score")


def parse_pubdate(spark, sf_dir):
    raw = inputs.table(spark, sf_dir, "documents").select("doc_id", inputs.citation_dates().alias("raw"))
    return raw.select(
        "doc_id",
        dates.citation_date(F.col("raw")).alias("padded"),
        dates.citation_date_unpadded(F.col("raw")).alias("unpadded"),
        dates.citation_date_ymd(F.col("raw")).alias("ymd"),
    )


def arxiv_date(spark, sf_dir):
    lines = inputs.table(spark, sf_dir, "documents").select("doc_id", inputs.datelines(F.col("n_chars")).alias("line"))
    return lines.select("doc_id", dates.dateline_date(F.col("line")).alias("Date"))


# ---- saved pages


def doi_from_url(spark, sf_dir):
    return inputs.table(spark, sf_dir, "pages").select("page_id", links.doi_from_url(F.col("url")).alias("DOI"))


def listing_articles(spark, sf_dir):
    found = listing_pages.listing_articles(inputs.listing_pages(spark, sf_dir))
    return found.select("page_id", "section_url", "page_no", "entry_no", "DOI", "Title", "Authors")


def page_rejects(spark, sf_dir):
    return listing_pages.rejected_entries(inputs.listing_pages(spark, sf_dir)).select("page_id", "entry_no", "reason")


def preprint_all(spark, sf_dir):
    """The preprint table of all sections and pages, without a limit."""
    pages = inputs.listing_pages(spark, sf_dir)
    return build_corpus.preprint_corpus(pages, *inputs.detail_pages(spark, sf_dir), sections=None)


def page_details(spark, sf_dir):
    abstract_pages, full_text_pages = inputs.detail_pages(spark, sf_dir)
    dated = listing_pages.abstract_page_dates(abstract_pages).withColumnRenamed("Date", "found")
    texts = listing_pages.full_text_abstracts(full_text_pages).withColumnRenamed("Abstract", "found")
    return dated.unionByName(texts)


def article_details(spark, sf_dir):
    found = listing_pages.listing_articles(inputs.listing_pages(spark, sf_dir))
    detailed = listing_pages.article_details(found, *inputs.detail_pages(spark, sf_dir))
    return detailed.select("page_id", "entry_no", "DOI", "Title", "Authors", "Abstract", "Date")


def cap_per_section(spark, sf_dir):
    pages = inputs.listing_pages(spark, sf_dir)
    reached = listing_pages.within_reach(listing_pages.listing_articles(pages), pages, max_pages=10)
    detailed = listing_pages.article_details(reached, *inputs.detail_pages(spark, sf_dir))
    return listing_pages.cap_per_section(detailed, 30).select("section_url", "place", "DOI")


# ---- article tables


def project_corpus(spark, sf_dir):
    return records.project_corpus(inputs.articles(spark, sf_dir))


def union_sections(spark, sf_dir):
    """Articles by language as sections, the English ones listed a second time."""
    docs = inputs.table(spark, sf_dir, "documents").select(
        "lang", "doc_id", inputs.title().alias("Title")
    )
    return records.union_sections([docs, docs.where(F.col("lang") == "en").withColumn("lang", F.lit("cross"))])


def read_raw(spark, sf_dir):
    path = fresh_path(spark, "raw")
    tables.write_raw(records.project_corpus(inputs.articles(spark, sf_dir)), path)
    return tables.read_raw(spark, path)


def read_raw_splits(spark, sf_dir):
    """As `read_raw`, each file read by many tasks."""
    path = fresh_path(spark, "raw")
    tables.write_raw(records.project_corpus(inputs.articles(spark, sf_dir)), path)
    return tables.read_raw(spark, path, splits=True)


def read_normalized(spark, sf_dir):
    path = fresh_path(spark, "normalized")
    articles = records.project_corpus(inputs.articles(spark, sf_dir))
    tables.write_normalized(normalize.normalize_columns(articles), path)
    return tables.read_normalized(spark, path)


def section_counts(spark, sf_dir):
    return profile.group_counts(inputs.articles(spark, sf_dir))


def null_counts(spark, sf_dir):
    return profile.null_counts(records.project_corpus(inputs.articles(spark, sf_dir)))


def corpus_shape(spark, sf_dir):
    return profile.shape(records.project_corpus(inputs.articles(spark, sf_dir)))


def sample_docs(spark, sf_dir):
    return profile.sample_rows(inputs.documents(spark, sf_dir), "doc_id")


QUERIES = {
    "top10_similar": top10_similar,
    "tokens": tokens,
    "bigrams": bigrams,
    "tf_unigram": _counts("unigram"),
    "tf_bigram": _counts("bigram"),
    "binary_unigram": _presence("unigram"),
    "binary_bigram": _presence("bigram"),
    "tfidf_unigram": _tfidf("unigram"),
    "tfidf_bigram": _tfidf("bigram"),
    "vocabulary": vocabulary,
    "doc_freq": doc_freq,
    "doc_norms": doc_norms,
    "query_vectors": query_vectors,
    "cosine_scores": cosine_scores,
    "topk_padded": topk_padded,
    "topk_ranked": topk_ranked,
    "load_index": load_index,
    "search_variants": search_variants,
    "search_segments": search_segments,
    "search_compacted": search_compacted,
    "search_files": search_files,
    "search_reindexed": search_reindexed,
    "search_arrivals": search_arrivals,
    "search_lemmas": search_lemmas,
    "normalize_docs": normalize_docs,
    "normalize_compat": normalize_compat,
    "lemma_join": lemma_join,
    "doc_index": doc_index,
    "nbib_records": nbib_records,
    "complete_records": complete_records,
    "rejects": rejects,
    "nbib_bulk": nbib_bulk,
    "journal_all": journal_all,
    "cap_global": cap_global,
    "ris_records": ris_records,
    "ris_full": ris_full,
    "ris_bulk": ris_bulk,
    "bib_records": bib_records,
    "bib_bulk": bib_bulk,
    "dispatch_ext": dispatch_ext,
    "rejected_files": rejected_files,
    "query_rejects": query_rejects,
    "query_text": query_text,
    "display_text": display_text,
    "parse_pubdate": parse_pubdate,
    "arxiv_date": arxiv_date,
    "doi_from_url": doi_from_url,
    "listing_articles": listing_articles,
    "page_rejects": page_rejects,
    "preprint_all": preprint_all,
    "page_details": page_details,
    "article_details": article_details,
    "cap_per_section": cap_per_section,
    "project_corpus": project_corpus,
    "union_sections": union_sections,
    "read_raw": read_raw,
    "read_raw_splits": read_raw_splits,
    "read_normalized": read_normalized,
    "section_counts": section_counts,
    "null_counts": null_counts,
    "corpus_shape": corpus_shape,
    "sample_docs": sample_docs,
}
