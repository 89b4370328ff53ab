"""Every two texts that share a band are compared, however large their buckets and classes are."""

import random

import pytest

from paperloom.llm import near_duplicates as N


def classes_by_bands(docs, texts, threshold):
    """Least id of each class when all pairs that share a band are compared."""
    shingles, ids = N.Shingles(*N.word_weights(docs)), sorted(texts)
    vectors = [shingles.of(texts[i]) for i in ids]
    bands = N.Sampler().bands(vectors)
    comp = {i: i for i in ids}
    for x, i in enumerate(ids):
        for y in range(x):
            j = ids[y]
            if comp[i] != comp[j] and (bands[x] == bands[y]).any() and N.weighted_jaccard(vectors[x], vectors[y]) >= threshold:
                lo, hi = sorted((comp[i], comp[j]))
                comp = {k: lo if c == hi else c for k, c in comp.items()}
    return comp


def classes(spark, texts, threshold):
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(4)
    want = classes_by_bands(docs, texts, threshold)
    return {r.doc_id: r.class_id for r in N.near_duplicate_classes(docs, threshold=threshold).collect()}, want


def test_pairs_that_share_one_crowded_band(spark, monkeypatch):
    """A template makes all buckets large; each text has one like it, and often they share a single band."""
    monkeypatch.setattr(N, "BLOCK", 8, raising=False)
    shared, own = [f"t{i}" for i in range(120)], 80
    texts = {}
    for i in range(200):
        words = [f"p{i // 2}x{j}" if j < 48 else f"o{i}x{j}" for j in range(own)]
        texts[i] = " ".join(shared * 2 + words)
    got, want = classes(spark, texts, 0.62)
    assert 100 <= len(set(want.values())) < 190
    assert got == want


def test_link_to_one_member_of_a_class(spark, monkeypatch):
    """Chains of versions: a class meets the next version through its last member only."""
    monkeypatch.setattr(N, "BLOCK", 4, raising=False)
    monkeypatch.setattr(N, "SMALL_BUCKET", 2)
    monkeypatch.setattr(N, "STARS", 0)
    texts = {}
    for chain in range(12):
        words = [f"v{chain}x{i}" for i in range(800)]
        for step in range(25):
            texts[chain * 100 + step] = " ".join(words[step * 20 : step * 20 + 130])
    got, want = classes(spark, texts, 0.6)
    assert len(set(want.values())) < 60
    assert got == want


@pytest.mark.parametrize("features", [3, 4096])
def test_products_equal_pairwise_sums(monkeypatch, features):
    monkeypatch.setattr(N, "FEATURES", features)
    rng = random.Random(2)
    words = N.np.array([], "int64"), N.np.array([], "float32"), 3.0
    vectors = [N.Shingles(*words).of(" ".join(rng.choices("ab", k=rng.randint(1, 60)))) for _ in range(20)]
    by_weight, by_count = N.overlaps(vectors[:7], vectors)
    for x in range(7):
        for y in range(20):
            _, i, j = N.np.intersect1d(vectors[x][0], vectors[y][0], return_indices=True)
            assert by_weight[x, y] == pytest.approx(N.np.minimum(vectors[x][1][i], vectors[y][1][j]).sum(), rel=1e-5)
            assert by_count[x, y] == N.np.minimum(vectors[x][2][i], vectors[y][2][j]).sum()
