import hashlib

import pytest

from paperloom.llm import fingerprints as P

ZEROS = P.EMPTY_PART * (1 + 16 + 256)


def neighbours(rows):
    """Edited texts in ascending order of (id, text), null ids first, as the contract puts them."""
    n = len(rows)
    for i, (doc_id, text) in enumerate(rows):
        half = len(text) // 2
        yield doc_id, len(text), text[: len(text) - half] + rows[(i + 1) % n][1][:half]


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_edited_texts_over_any_ranges(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    rows = [(i * 3, f"text number {i} " * (1 + i % 5) + "é😀") for i in range(40)]
    got = P.imatch_neighbours(spark.createDataFrame(rows[::-1], "doc_id long, text string"), max_idf=5.0).collect()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    wanted = {d: (n, hashlib.sha256(t.encode()).hexdigest()) for d, n, t in neighbours(rows)}
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == wanted


def test_likeness_follows_shared_terms(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i * 20 : i * 20 + 60]) for i in range(10)] + [" ".join(words[:60])]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in P.imatch_neighbours(docs).collect()}
    assert got[0].fingerprint == got[10].fingerprint and got[10].near_next == 1.0  # the first follows the last
    assert got[0].fingerprint != got[1].fingerprint
    assert all(0 < r.near_edited < 1 for r in got.values() if r.doc_id < 9)


def test_band_and_order(spark):
    rows = [(0, "the cat sat"), (1, "the dog sat"), (2, "the sat cat"), (3, "the bird flew")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in P.imatch_neighbours(docs, min_idf=0.1).collect()}
    assert got[0] == got[2]  # order and the term of every document do not count
    assert len(set(got.values())) == 3


def test_odd_rows(odd_docs, no_docs):
    got = P.imatch_neighbours(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].fingerprint == by_id[3].fingerprint == ZEROS and by_id[2].n_chars == 0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert P.imatch_neighbours(no_docs).count() == 0


def test_one_document_follows_itself(spark):
    (row,) = P.imatch_neighbours(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0


def test_texts_without_a_term_in_the_band_differ(spark):
    rows = [(i, "common words " + " ".join(f"w{j}" for j in range(i, i + 5))) for i in range(60)]
    rows += [(100, "common here"), (101, "words common"), (102, "common strange"), (103, "common strange")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # words of one text in 64 or less are above the band
    got = {r.doc_id: r for r in P.imatch_neighbours(docs, max_idf=3.0).collect()}
    prints = [got[i].fingerprint for i in (100, 101, 102)]
    assert ZEROS not in prints and len(set(prints)) == 3
    assert got[102].fingerprint == got[103].fingerprint and got[102].near_next == 1.0
    assert got[100].near_next < 1 and got[101].near_next < 1


def test_prints_are_hashes_of_the_sorted_terms_of_every_subset(spark):
    """Lexicon, band, subsets and likeness by hand; Spark only hashes."""
    import math
    from collections import Counter

    rows = [(i, " ".join(f"t{(i * 7 + j * j) % 40}" for j in range(12)) + " all") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in P.imatch_neighbours(docs).collect()}
    df = Counter(t for _, text in rows for t in set(text.split()))
    band = {t for t, n in df.items() if n >= 30 * math.exp(-P.MAX_IDF) and (n <= 30 * math.exp(-P.MIN_IDF) or n < 3)}
    numbers = {r.t: r.h for r in spark.createDataFrame([(t,) for t in band], "t string").selectExpr("t", "xxhash64(t) AS h").collect()}

    def printed(text):
        hashes = sorted(numbers[t] for t in set(text.split()) & band)
        part = lambda bits: [[h for h in hashes if (h % 2**64) >> (64 - bits) == p] for p in range(2**bits)]
        subsets = [hashes, *part(4), *part(8)]
        frame = spark.createDataFrame([(i, s) for i, s in enumerate(subsets)], "i int, s array<long>")
        found = frame.selectExpr("i", "s", "lower(right(lpad(hex(xxhash64(s)), 16, '0'), 4)) AS p").orderBy("i").collect()
        return [r.p if r.s else P.EMPTY_PART for r in found]

    prints = {i: printed(text) for i, text in rows[:4]}
    for i in range(3):
        assert got[i].fingerprint == "".join(prints[i])
        used = [(a, b) for a, b in zip(prints[i], prints[i + 1]) if (a, b) != (P.EMPTY_PART, P.EMPTY_PART)]
        same = sum(a == b for a, b in used)
        assert got[i].near_next == pytest.approx(1.0 if prints[i] == prints[i + 1] else same / len(used))
