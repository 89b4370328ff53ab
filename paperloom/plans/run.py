"""From saved exports and pages to searchable indexes, as one job.

    python -m paperloom.plans.run --index INDEX [--exports FOLDER] [--listings TABLE --abstracts TABLE --full-texts TABLE]
                                  [--corpus-out FOLDER] [--append] [--keep-versions N]

Exports are NBIB files of any number of records. Saved pages are Parquet tables:
(page_id, url, html) of listings, (url, html) of the two kinds of detail page.
Corpora are named `pubmed` and `arxiv`.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.operators.ordering import with_row_index
from paperloom.plans.build_corpus import journal_corpus, preprint_corpus
from paperloom.plans.build_index import append_articles, index_articles
from paperloom.session import materialise, scratch
from paperloom.sources.index_store import Manifest, drop_old_versions, read_manifest
from paperloom.sources.nbib import read_nbib
from paperloom.sources.tables import write_articles


def index_corpus(
    articles: DataFrame, base: str, corpus: str, out: str | None = None, append: bool = False, keep_versions: int | None = None
) -> Manifest:
    """Number an article table, keep it under `out` if asked to, and index it.

    The first article of a DOI stands for it. Numbers follow the DOI; those of
    added articles go on behind the ones that are there.
    """
    spark = articles.sparkSession
    with scratch(spark, "index-corpus"):
        single = materialise(articles.dropDuplicates(["DOI"]), "articles")
        numbered = with_row_index(single, "DOI").withColumnRenamed("doc_idx", "doc_id")
        manifest = read_manifest(spark, base, corpus) if append else None
        if manifest is not None:
            numbered = numbered.withColumn("doc_id", F.col("doc_id") + F.lit(manifest.n_docs))
        numbered = materialise(numbered, "numbered")
        if out is not None:
            write_articles(numbered, f"{out}/{corpus}.parquet", "append" if append else "overwrite")
        build = append_articles if manifest is not None else index_articles
        done = build(numbered, base, corpus)
    if keep_versions:
        drop_old_versions(spark, base, corpus, keep_versions)
    return done


def run(spark: SparkSession, options: argparse.Namespace) -> dict[str, Manifest]:
    """Index every corpus that paths are given for."""
    done = {}
    rest = {"base": options.index, "out": options.corpus_out, "append": options.append, "keep_versions": options.keep_versions}
    if options.exports:
        done["pubmed"] = index_corpus(journal_corpus(read_nbib(spark, options.exports)), corpus="pubmed", **rest)
    if options.listings:
        pages = [spark.read.parquet(p) for p in (options.listings, options.abstracts, options.full_texts)]
        done["arxiv"] = index_corpus(preprint_corpus(*pages, sections=None), corpus="arxiv", **rest)
    return done


def parsed(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Index saved exports and pages")
    parser.add_argument("--index", required=True)
    for name in ("exports", "listings", "abstracts", "full-texts", "corpus-out"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--append", action="store_true")
    parser.add_argument("--keep-versions", type=int)
    options = parser.parse_args(arguments)
    pages = (options.listings, options.abstracts, options.full_texts)
    if any(pages) and not all(pages):
        parser.error("listings, abstracts and full texts go together")
    if not (options.exports or options.listings):
        parser.error("nothing to index: give exports or listings")
    return options


if __name__ == "__main__":
    session = SparkSession.builder.appName("paperloom-index").getOrCreate()
    for corpus, manifest in run(session, parsed()).items():
        print(f"{corpus}: version {manifest.version}, {manifest.n_docs} documents in {len(manifest.segments)} segments")
