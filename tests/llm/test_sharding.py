from collections import Counter

import pytest

from paperloom.llm.sharding import histogram_shards


def check(docs, shards, slack):
    rows = histogram_shards(docs, shards).collect()
    assert len(rows) == docs.count()
    slots, sizes = {}, Counter()
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] += r["size"]
        assert r["size"] == len((r.text or "").encode()) + 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    share = sum(sizes.values()) / shards
    largest = max(r["size"] for r in rows)
    assert all(abs(sizes[s] - share) <= slack * share + largest for s in range(shards))
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    keys = [-(2**62) if r.doc_id is None else r.doc_id for r in order]
    assert keys == sorted(keys)


@pytest.mark.parametrize("step", [1, 10**12])
def test_even_bytes_over_any_span_of_keys(spark, step):
    rows = [(i * i * step // 7, "x" * (i * 37 % 211)) for i in range(3000)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 24, 0.01)


def test_a_key_that_holds_a_third_of_all_rows_is_cut(spark):
    rows = [(5, "same") for _ in range(1000)] + [(i, "other") for i in range(2000)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 24, 0.01)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs.select("doc_id", "text"), 3, 0.01)
    assert histogram_shards(odd_docs, 24).count() == odd_docs.count()
    assert histogram_shards(no_docs, 24).count() == 0
