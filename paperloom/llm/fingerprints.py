"""I-Match fingerprints over randomised subsets of a lexicon, in built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paperloom.llm.common import range_bounds, range_of, shuffle_width

MIN_IDF = 1.0  # ln(documents / document frequency): terms of more than 37 % of the documents are left out
MAX_IDF = 7.0  # and terms of fewer than one in 1097; this bounds the lexicon, see `lexicon`
DEPTH = 4  # the lexicon as a whole, in 16 and in 256 random parts: two quarterings from one to the next
HEX_DIGITS = 4
EMPTY_PART = "0" * HEX_DIGITS


def terms(text: Column) -> Column:
    """Distinct terms of a text: lower-case runs of letters and digits; an empty or null text has the empty term."""
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))


def lexicon(docs: DataFrame, text_col: str, min_idf: float = MIN_IDF, max_idf: float = MAX_IDF) -> DataFrame:
    """Hashes of terms, counted over all documents, and whether their idf lies in the band: `term`, `known`.

    Terms below the band, the common ones, are not `known`; terms above it, the
    rare ones, are not listed. A term is listed only if at least one in
    exp(max_idf) documents has it, so there are at most exp(max_idf) x (mean
    distinct terms of a document) terms however large the corpus is. Counts are
    combined before the shuffle.
    """
    found = docs.select(F.explode(terms(F.col(text_col))).alias("t")).where(F.col("t") != "")
    counts = found.select(F.xxhash64("t").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n_docs = docs.count()
    low, high = n_docs * math.exp(-max_idf), n_docs * math.exp(-min_idf)
    known = (F.col("df") <= high) | (F.col("df") < 3)
    return counts.where(F.col("df") >= low).select("term", known.alias("known"))


def fingerprint(sorted_terms: Column) -> Column:
    """Hashes of the sorted terms in each subset of the lexicon, as an array of hexadecimal strings.

    A term's hash decides at random which quarter of the lexicon it is in,
    which quarter of that, and so on; every sixteenth and every 256th is a
    subset with a hash of its own, and so is the whole. Parts without a term give zeros.
    """
    level, parts = F.array(sorted_terms), F.array(sorted_terms)
    for depth in range(1, DEPTH + 1):
        level = F.flatten(F.transform(level, _quarters(64 - 2 * depth)))
        parts = F.concat(parts, level) if depth % 2 == 0 else parts
    return F.transform(
        parts,
        lambda a: F.when(F.size(a) == 0, F.lit(EMPTY_PART)).otherwise(
            F.lower(F.right(F.lpad(F.hex(F.xxhash64(a)), 16, "0"), F.lit(HEX_DIGITS)))
        ),
    )


def _quarters(shift: int):
    def split(part: Column) -> Column:
        def only(quarter: int) -> Column:
            return F.filter(part, lambda t: F.shiftrightunsigned(t, shift).bitwiseAND(F.lit(3)) == quarter)

        return F.array(*[only(q) for q in range(4)])

    return split


def likeness(left: Column, right: Column) -> Column:
    """Share of subsets with equal hashes among those that either fingerprint has terms in; 1 for equal fingerprints."""
    used = F.zip_with(left, right, lambda a, b: ((a != EMPTY_PART) | (b != EMPTY_PART)).cast("int"))
    same = F.zip_with(left, right, lambda a, b: ((a == b) & (a != EMPTY_PART)).cast("int"))
    total = F.aggregate(used, F.lit(0), lambda s, x: s + x)
    return F.when(left == right, F.lit(1.0)).otherwise(F.aggregate(same, F.lit(0), lambda s, x: s + x) / total)


def ordered_pairs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every document with the text that follows it in ascending id order, the first after the last.

    Columns: at and place (together a key), id, text, next_text, guest.
    Documents are dealt to ranges of ids once. The first document of a range
    also visits the range before it, as a guest behind all others, so that
    each range is complete in itself. Null ids come first, equal ids are
    ordered by text.
    """
    base = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    bounds = range_bounds(base, "id", shuffle_width(docs.sparkSession))
    base = base.withColumns({"part": range_of(F.col("id"), bounds), "tie": F.xxhash64("text")})
    least = base.groupBy("part").agg(F.min(F.struct("id", "tie")).alias("first")).orderBy("part").collect()
    # one row for each range: its least document, and the range that this document visits
    visit = {row["part"]: (row["first"], least[at - 1]["part"]) for at, row in enumerate(least)}
    table = [visit.get(part) for part in range(len(bounds) + 1)]
    of_part = lambda values, kind: F.element_at(
        F.array(*[F.lit(v).cast(kind) for v in values]), F.col("part") + 1
    )
    first_id = of_part([t and t[0]["id"] for t in table], "long")
    first_tie = of_part([t and t[0]["tie"] for t in table], "long")
    host = of_part([t and t[1] for t in table], "int")
    own = F.struct(F.col("part").alias("at"), F.lit(False).alias("guest"))
    is_first = F.col("id").eqNullSafe(first_id) & (F.col("tie") == first_tie)
    guest = F.struct(F.when(is_first, host).alias("at"), F.lit(True).alias("guest"))
    dealt = base.select("id", "text", "tie", F.inline(F.array(own, guest))).where(F.col("at").isNotNull())
    order = W.partitionBy("at").orderBy("guest", F.col("id").asc_nulls_first(), "tie")
    return dealt.select(
        "at",
        F.row_number().over(order).alias("place"),
        "id",
        "text",
        F.lead("text").over(order).alias("next_text"),
        "guest",
    )


def imatch_neighbours(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_idf: float = MIN_IDF,
    max_idf: float = MAX_IDF,
) -> DataFrame:
    """I-Match fingerprints of every text and of an edited copy, with their likeness and that to the next document.

    The edited copy ends with the first half of the next document instead of
    its own second half (code points, rounded down); next is by ascending id,
    the first follows the last. A fingerprint keeps the distinct terms in the
    idf band, sorts them by hash, and hashes the whole and 272 random subsets
    of the lexicon. Returns the id as `doc_id`, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    Texts without a term in the band are printed by two of their rare terms,
    the least and the greatest hash, or, without any, by two of their common
    ones. Null and empty texts and texts without a term have a fingerprint of
    zeros and are fully alike. Null ids come first. Repeated
    ids and rows are separate rows, ordered by text. A single document is its
    own next one. An empty table gives no rows; other columns are not read.
    """
    pairs = ordered_pairs(docs, id_col, text_col)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    with_edit = pairs.select("at", "place", "guest", "id", "text", F.when(~F.col("guest"), edited).alias("edited"))
    # a head row carries the columns of the result; two further rows carry the texts to split
    digest = F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")
    head = F.struct(
        F.struct("id", F.length("text").alias("n_chars"), digest, "guest").alias("head"),
        F.lit(None).cast("array<string>").alias("ts"),
        F.lit(0).alias("kind"),
    )
    no_head = F.lit(None).cast("struct<id:bigint,n_chars:int,edited_sha256:string,guest:boolean>").alias("head")
    body = lambda text, kind: F.struct(no_head, terms(F.col(text)).alias("ts"), F.lit(kind).alias("kind"))
    rows = with_edit.select("at", "place", F.inline(F.array(head, body("text", 1), body("edited", 2))))
    words = rows.select("at", "place", "head", "kind", F.explode_outer("ts").alias("t"))
    hashed = words.select("at", "place", "head", "kind", F.when(F.col("t") != "", F.xxhash64("t")).alias("term"))
    marked = hashed.join(F.broadcast(lexicon(docs, text_col, min_idf, max_idf)), "term", "left")

    def per_kind(kind: int) -> Column:
        of = lambda c: F.when((F.col("kind") == kind) & c, F.col("term"))
        rare, common = F.col("known").isNull(), ~F.col("known")
        ends = lambda c: F.array_distinct(F.array(F.min(of(c)), F.max(of(c))))
        found = F.array_sort(F.collect_list(of(F.col("known"))))
        return (
            F.when(F.size(found) > 0, found)
            .when(F.min(of(rare)).isNotNull(), ends(rare))
            .when(F.min(of(common)).isNotNull(), ends(common))
            .otherwise(found)
        )

    grouped = marked.groupBy("at", "place").agg(
        F.first("head", ignorenulls=True).alias("head"), per_kind(1).alias("own"), per_kind(2).alias("changed")
    )
    printed = grouped.select(
        "at", "place", "head.*", fingerprint(F.col("own")).alias("f"), fingerprint(F.col("changed")).alias("g")
    )
    order = W.partitionBy("at").orderBy("place")
    beside = printed.withColumn("following", F.lead("f").over(order)).where(~F.col("guest"))
    return beside.select(
        F.col("id").alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        F.array_join("f", "").alias("fingerprint"),
        F.array_join("g", "").alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("g")).alias("near_edited"),
        likeness(F.col("f"), F.col("following")).alias("near_next"),
    )
