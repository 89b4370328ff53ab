"""Document frequencies, inverse document frequencies, unit-length weights, vocabulary order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paperloom.operators.exact import exact_sum
from paperloom.operators.ordering import numbered
from paperloom.operators.skew import MAX_SHORT_KEYS, frequent_rows, lookup_join
from paperloom.session import materialise

WEIGHTINGS = ("freq", "binary", "tfidf")


def check_weighting(weighting: str) -> None:
    if weighting not in WEIGHTINGS:
        raise ValueError(f"weighting must be one of {WEIGHTINGS}, not {weighting!r}")


def document_count(docs: DataFrame) -> Column:
    """Number of documents, also those without terms, as a scalar subquery."""
    return docs.agg(F.count(F.lit(1))).scalar()


def smooth_idf(df: Column, n_docs: Column) -> Column:
    """ln((1 + N) / (1 + df)) + 1."""
    return F.log((n_docs + F.lit(1.0)) / (df + F.lit(1.0))) + F.lit(1.0)


def document_frequencies(counts: DataFrame, parts: int | None = None) -> DataFrame:
    """(term, df) from (doc_id, term, tf), combined before the shuffle.

    The terms of a corpus grow with it: with `parts`, the tasks that its size
    takes, the table is written at once by no fewer tasks than these.
    """
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df if parts is None else materialise(df, "frequencies", parts)


def term_table(counts: DataFrame, n_docs: Column, parts: int | None = None) -> DataFrame:
    """(term, df, idf) from (doc_id, term, tf); `parts` as for `document_frequencies`."""
    return document_frequencies(counts, parts).withColumn("idf", smooth_idf(F.col("df"), n_docs))


def with_idf(counts: DataFrame, term_df: DataFrame, parts: int | None = None) -> DataFrame:
    """Add `idf` to the postings; frequent terms meet a bounded broadcast, rare ones a shuffle.

    The document frequency is itself the number of postings of a term, so no
    extra count is needed. Both inputs are read twice: pass written tables.
    `parts` is the number of tasks that the rare ones are dealt to.
    """
    sizes = term_df.select("term", F.col("df").alias("n_rows"))
    return lookup_join(counts, term_df.select("term", "idf"), "term", "inner", counts=sizes, parts=parts)


def with_idf_in_place(counts: DataFrame, term_df: DataFrame, n_docs: Column, parts: int) -> DataFrame:
    """Add `idf` to postings of `placed_counts`, which are not moved.

    Terms go to their frequencies once for each part that has them, and the
    answers come back to the part. Frequent terms meet a bounded broadcast
    there instead, and terms of one document are what finds no answer. Write the
    result with `materialise_placed`, for which Spark joins within parts.
    """
    shared = term_df.where("df > 1").select("term", "df")
    often = shared.where(frequent_rows(term_df, "term", "df", max_short_keys=MAX_SHORT_KEYS))
    asked = counts.select("part", "term").distinct().join(F.broadcast(often.select("term")), "term", "left_anti")
    known = asked.repartition(parts, "term").join(shared.repartition(parts, "term").hint("shuffle_hash"), "term")
    answers = known.select("part", "term", F.col("df").alias("__df")).repartition(parts, "part")
    frequent = F.broadcast(often.select("term", F.col("df").alias("__often")))
    found = counts.join(frequent, "term", "left").join(answers.hint("shuffle_hash"), ["part", "term"], "left")
    idf = smooth_idf(F.coalesce("__often", "__df", F.lit(1)), n_docs)
    return found.select("part", "doc_id", "term", "tf", idf.alias("idf"))


def raw_weight(weighting: str) -> Column:
    """Weight of a posting before scaling: its count, 1, or count times idf."""
    check_weighting(weighting)
    tf = F.col("tf").cast("double")
    return {"freq": tf, "binary": F.lit(1.0), "tfidf": tf * F.col("idf")}[weighting]


def unit_weight(weighting: str) -> Column:
    """Weight of a posting scaled so that its document has length 1."""
    return raw_weight(weighting) / F.col(f"norm_{weighting}")


def with_norms(counts_idf: DataFrame, weightings=WEIGHTINGS) -> DataFrame:
    """Add the row length of the document under each of the weightings to its postings (part, doc_id, term, tf, idf).

    The postings of a part lie together already and are not moved; a document's
    are bounded by its own text, and the window spills. Norms repeat within a
    document and idf values within a frequency, so the columns shrink to almost
    nothing in Parquet, which three columns of scaled weights would not.
    """
    doc = W.partitionBy("doc_id", "part")

    def norm(weighting):
        return F.sqrt(exact_sum(raw_weight(weighting) * raw_weight(weighting), doc)).alias(f"norm_{weighting}")

    return counts_idf.select("part", "doc_id", "term", "tf", "idf", *[norm(w) for w in weightings])


def document_norms(counts_idf: DataFrame, by=("doc_id",)) -> DataFrame:
    """Row length per document under each weighting; partial sums are combined before the shuffle."""
    # squares of counts are whole numbers, which add up exactly as they are
    squares = {
        "freq": F.sum(F.col("tf") * F.col("tf")).cast("double"),
        "binary": F.count(F.lit(1)).cast("double"),
        "tfidf": exact_sum(raw_weight("tfidf") * raw_weight("tfidf")),
    }
    return counts_idf.groupBy(*by).agg(*[F.sqrt(squares[w]).alias(f"norm_{w}") for w in WEIGHTINGS])


def vocabulary(counts: DataFrame, parts: int | None = None) -> DataFrame:
    """(term, term_idx, df): distinct terms numbered in code-point order; `parts` as for `document_frequencies`."""
    return numbered(document_frequencies(counts, parts), "term", "term_idx", parts).select("term", "term_idx", "df")
