"""The operators as queries over whole tables; the columns are digests of what each operator gives."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.llm.common import id_remainder, read
from paperloom.llm.fingerprints import imatch_neighbours
from paperloom.llm.kd_search import top_inner_products
from paperloom.llm.language import identify_languages, train_languages
from paperloom.llm.near_duplicates import near_duplicate_classes
from paperloom.llm.near_vectors import near_vectors
from paperloom.llm.packing import pack_sequences
from paperloom.llm.passages import remove_repeated_passages
from paperloom.llm.resampling import resample
from paperloom.llm.sharding import histogram_shards
from paperloom.llm.tiktokens import encode_and_decode
from paperloom.llm.token_files import token_file_round_trip
from paperloom.llm.toxicity import score_toxicity, train_toxicity
from paperloom.llm.whitening import whiten

SHARDS = 24
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of all texts, beside those of edited texts and of the next documents."""
    found = imatch_neighbours(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op2_noisy_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels whose id remainder is not 0."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(True))
    model = train_toxicity(docs, read(spark, sf_dir, "labels"), ~held_out)
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "offending")


def op3_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near duplicates of every document."""
    return near_duplicate_classes(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "keeps")


def op4_kd_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every twentieth vector with all others."""
    return top_inner_products(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op5_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without the windows of 20 words that start earlier."""
    cut = remove_repeated_passages(read(spark, sf_dir, "documents"))
    kept = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return cut.select("doc_id", "n_words", "n_removed", kept)


def op6_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 24 shards of nearly equal bytes, in the order of their ids."""
    placed = histogram_shards(
        read(spark, sf_dir, "documents"),
        SHARDS,
        columns={
            "doc_id": F.col("doc_id"),
            "text_crc32": F.crc32(F.coalesce("text", F.lit("")).cast("binary")),
        },
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files in id order, and their ids as read back from these files."""
    back = token_file_round_trip(read(spark, sf_dir, "documents"), BYTE_BPE, end_id=2)
    return back.select(
        "doc_id",
        "start",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op8_hyperdimensional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those whose id remainder is not 2."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(True))
    found = identify_languages(docs, train_languages(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_first_fit_decreasing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and packed into sequences of at most 2048 tokens."""
    return pack_sequences(read(spark, sf_dir, "documents"), BYTE_BPE, end_id=1, with_ids=False)


def op10_tiktoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of the bytes that they decode to."""
    coded = encode_and_decode(read(spark, sf_dir, "documents"), MULTI_RANKS, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_radix_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark texts, and the ranks of the tenth drawn by them."""
    drawn = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_polynomial_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 32 largest whitened components of every embedding."""
    return whiten(read(spark, sf_dir, "embeddings"))


def op13_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every embedding at a cosine of 0.9 or more, and the components they form."""
    return near_vectors(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_imatch": op1_imatch,
    "op2_noisy_or": op2_noisy_or,
    "op3_weighted_minhash": op3_weighted_minhash,
    "op4_kd_trees": op4_kd_trees,
    "op5_super_kmers": op5_super_kmers,
    "op6_histogram_sort": op6_histogram_sort,
    "op7_rans": op7_rans,
    "op8_hyperdimensional": op8_hyperdimensional,
    "op9_first_fit_decreasing": op9_first_fit_decreasing,
    "op10_tiktoken": op10_tiktoken,
    "op11_radix_resampling": op11_radix_resampling,
    "op12_polynomial_whitening": op12_polynomial_whitening,
    "op13_flat_graph": op13_flat_graph,
}
ORACLE_SQL: dict[str, str] = {
    "op4_kd_trees": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v AS q JOIN v AS c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op5_super_kmers": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), win AS (
            SELECT doc_id, s, array_to_string(ws[s : s + 19], ' ') AS k
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w WHERE len(ws) >= 20)
        ), again AS (
            SELECT doc_id, s FROM (
                SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM win
            ) WHERE r > 1
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM again
        ), words AS (
            SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
            FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
        )
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
               CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op11_radix_resampling": r"""
        WITH bytes AS (
            SELECT list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))) AS c, i
            FROM (SELECT unnest(range(256)) AS i)
        ), tab AS (
            SELECT list(c ORDER BY i) AS t FROM bytes
        ), words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
        ), wanted AS (
            SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
        ), each AS (
            SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS w FROM words) GROUP BY ALL
        ), vocab AS (
            SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM each UNION SELECT DISTINCT w FROM wanted)
        ), hashed AS (
            SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(h) + 1, 2),
                          lambda i: CAST('0x' || h[i : i + 1] AS BIGINT))),
                          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM vocab, tab
        ), s AS (
            SELECT bucket, CAST(sum(n) AS BIGINT) AS s FROM each JOIN hashed USING (w) GROUP BY bucket
        ), t AS (
            SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (w) GROUP BY bucket
        ), gains AS (
            SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000.0::DOUBLE)
                   / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000.0::DOUBLE)))) AS BIGINT) AS gain
            FROM s FULL JOIN t USING (bucket)
        ), weights AS (
            SELECT doc_id, CAST(sum(n * gain) AS BIGINT) AS weight
            FROM each JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY doc_id
        ), scored AS (
            SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || doc_id), 8) AS BIGINT)
                   + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
            FROM words LEFT JOIN weights USING (doc_id)
        ), ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank,
                   (10 * count(*) OVER ()) // 100 AS drawn
            FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score, CAST(CASE WHEN rank <= drawn THEN rank END AS BIGINT) AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)""",
    "op13_flat_graph": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), unit AS (
            SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM v
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM unit AS a JOIN unit AS b
            ON a.vec_id <> b.vec_id AND list_dot_product(a.u, b.u) >= 0.9
        ), reach AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ), least AS (
            SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
        ), degree AS (
            SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
        )
        SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN least USING (vec_id) LEFT JOIN degree USING (vec_id)""",
}
