import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from paperloom.llm import near_duplicates as N, passages as S
from paperloom.llm.kd_search import top_inner_products


def brute_top(rows, k):
    usable = [
        (i, [int(64 * x // 1) for x in v]) for i, v in rows if v and all(x is not None and abs(x) < float("inf") for x in v)
    ]
    out = []
    for at, (q, v) in enumerate(usable):
        if q is None or q % 20:
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w)), c)
            for other, (c, w) in enumerate(usable)
            if other != at and len(w) == len(v)
        ]
        scored.sort(key=lambda s: (s[0], s[1] is None, s[1]))
        out += [(q, rank, c, -s) for rank, (s, c) in enumerate(scored[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("shard_rows", [40, 10_000])
def test_largest_products(spark, shard_rows):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.5, 0.25, rng.random()]) for _ in range(4)]) for i in range(700)]
    rows += [(700, None), (720, [1.0, None, 2.0, 3.0]), (740, [float("nan")] * 4), (760, [float("inf")] * 4), (780, [])]
    rows += [(800, [1.0, 2.0]), (820, [2.0, 1.0]), (None, [1.0] * 4), (840, [0.5] * 4), (841, [0.5] * 4), (860, [1e9, 1.0, 1.0, 1.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = top_inner_products(docs, F.col("vec_id") % 20 == 0, 20, shard_rows=shard_rows).collect()
    assert Counter(tuple(r) for r in got) == brute_top(rows, 20)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_inner_products(empty, F.col("vec_id") % 20 == 0, 20).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert top_inner_products(one, F.col("vec_id") % 20 == 0, 20).count() == 0


def brute_cut(rows, window):
    """rows in ascending order of documents."""
    seen, out = set(), []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out.append((doc_id, len(words), sum(gone), kept))
    return Counter(out)


@pytest.mark.parametrize("window", [3, 20])
def test_repeated_passages(spark, window):
    rng = random.Random(window)
    passages = [" ".join(rng.choices("abcdefgh", k=30)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [" ".join(rng.choices("abcdefghijklmnop", k=rng.randint(0, 40))) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages))
        rows.append((i, "\n".join(parts)))
    rows += [(200, "x y " * 60), (201, "the same word " + "w " * 100), (202, None), (203, ""), (204, "a\x1cb c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = S.remove_repeated_passages(docs, window=window).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_cut(rows, window)


def test_odd_rows_of_passages(odd_docs, no_docs):
    rows = S.remove_repeated_passages(odd_docs, keep=("score", "k")).collect()
    assert len(rows) == odd_docs.count()
    first = sorted((r.n_removed, r.doc_id is None) for r in rows if r.n_words == 24)
    assert first == [(0, True), (24, False), (24, False)]  # the text without an id comes first
    assert S.remove_repeated_passages(no_docs).count() == 0
    as_written = S.remove_repeated_passages(odd_docs, as_written=True).collect()
    assert "   \n\t " in {r.kept_text for r in as_written}


def edited(text, rng, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def brute_classes(texts, threshold):
    shingles = {i: N.Shingles(*TABLE).of(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            same = (texts[i] or "") == (texts[j] or "")
            if same or N.weighted_jaccard(shingles[i], shingles[j]) >= threshold:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in ids}


def test_classes_of_near_duplicates(spark):
    global TABLE
    rng = random.Random(9)
    texts, number = {}, 0
    for group in range(14):
        base = " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(30, 200)))
        for _ in range(rng.choice([1, 1, 2, 3, 12])):
            texts[number] = edited(base, rng, rng.choice([0, 0, 1, 2, 12]))
            number += 1
    chain = " ".join(f"c{i}" for i in range(120)).split()
    for step in range(8):  # each like the next, the first unlike the last
        texts[number] = " ".join(chain[step * 6 : step * 6 + 70])
        number += 1
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(4)
    TABLE = N.word_weights(docs)
    got = N.near_duplicate_classes(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == brute_classes(texts, N.THRESHOLD)
    assert all(r.keeps == (r.doc_id == r.class_id) for r in got)


def test_pairs_among_many_unlike_documents_with_one_passage(spark, monkeypatch):
    """All share a long passage, so they meet in large buckets; each has one near copy."""
    monkeypatch.setattr(N, "SMALL_BUCKET", 3)
    monkeypatch.setattr(N, "STARS", 1)
    shared = " ".join(f"s{i}" for i in range(120))
    texts = {}
    for i in range(80):
        own = " ".join(f"o{i // 2}x{j}" for j in range(60))
        texts[i] = f"{shared} {own}" + (" end" if i % 2 else "")
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in N.near_duplicate_classes(docs).collect()}
    assert got == {i: i - i % 2 for i in range(80)}


def test_odd_rows_of_classes(odd_docs, no_docs):
    rows = N.near_duplicate_classes(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    classes = defaultdict(set)
    for r in rows:
        classes[r.doc_id].add(r.class_id)
    assert classes[2] == classes[3] == {2} and 1 in classes[1]
    assert N.near_duplicate_classes(no_docs).count() == 0
