from collections import Counter
from zlib import crc32

import re
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from paperloom.llm import resampling
from paperloom.llm.resampling import bucket_gains, feature_buckets, noise, radix_ranked, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, most):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(folded)
    return [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("abZ09 . é 中\n-_😀"), max_size=60), st.integers(1, 3), st.integers(1, 9))
def test_features_are_those_of_the_whole_text(text, most, piece):
    kept, resampling.PIECE_BYTES = resampling.PIECE_BYTES, piece
    try:
        found = Counter(int(b) for _, buckets in feature_buckets(text.encode(), most, 10_000) for b in buckets)
    finally:
        resampling.PIECE_BYTES = kept
    assert found == Counter(crc32(f.encode()) % 10_000 for f in plain_features(text, most))


@pytest.mark.parametrize("width", [3, 12])
def test_ranks_follow_score_and_id(spark, monkeypatch, width):
    monkeypatch.setattr(resampling, "DIGIT_BITS", width)
    ids = [5, -3, 2**62, -(2**63), 2**63 - 1, None, 0, 7, 7, 1]
    rows = [(s, i) for s in (-(10**7), 3, 3, 250_000) for i in ids]
    found = radix_ranked(spark.createDataFrame(rows, "score long, id long").repartition(5), "score", "id", "rank").collect()
    found.sort(key=lambda r: r["rank"])
    assert [r["rank"] for r in found] == list(range(1, len(rows) + 1))
    wanted = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    assert [(r["score"], r["id"]) for r in found] == wanted


def test_many_rows_of_one_score_are_ranked_in_many_blocks(spark):
    rows = spark.range(20_000).select(F.lit(4).cast("long").alias("score"), (F.col("id") * 7919 % 20_011).alias("id"))
    found = radix_ranked(rows, "score", "id", "rank").orderBy("rank").collect()
    assert [r["id"] for r in found] == sorted(r["id"] for r in found) and found[-1]["rank"] == 20_000


def test_brute_force_with_pairs_of_words(spark, odd_docs):
    target = spark.createDataFrame([("alpha beta gamma",), (None,), ("word1 thing1",)], "text string")
    rows = {r["doc_id"]: r for r in resample(odd_docs, target, max_words=2, percent=50).collect() if r["doc_id"] in (4, 6, -7)}
    source, wanted = Counter(), Counter()
    for r in odd_docs.collect():
        source.update(crc32(f.encode()) % 10_000 for f in plain_features(r["text"] or "", 2))
    for text in ("alpha beta gamma", "word1 thing1"):
        wanted.update(crc32(f.encode()) % 10_000 for f in plain_features(text, 2))
    import numpy as np

    gains = bucket_gains(np.array([source[i] for i in range(10_000)]), np.array([wanted[i] for i in range(10_000)]))
    for r in odd_docs.collect():
        if r["doc_id"] in rows:
            found = rows[r["doc_id"]]
            features = plain_features(r["text"] or "", 2)
            assert found["n_features"] == len(features)
            assert found["weight"] == sum(int(gains[crc32(f.encode()) % 10_000]) for f in features)
            assert found["score"] == found["weight"] + noise(2024, r["doc_id"])


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    found = resample(odd_docs, no_docs, percent=100).collect()
    assert len(found) == odd_docs.count()
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, sum(r["n_words"] >= 20 for r in found) + 1))
    assert resample(no_docs, odd_docs).count() == 0
