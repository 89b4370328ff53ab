import numpy as np
import pytest

from paperloom.llm import near_vectors as module
from paperloom.llm.flat_graph import Graph, Search, build_graph, range_pairs, robust_prune
from paperloom.llm.near_vectors import cluster_centres, near_vectors, unit_rows

SCHEMA = "vec_id long, embedding array<double>, node string, unit int, part double"


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", kept)


def plain(ids, vectors, threshold=0.9):
    units = unit_rows(np.asarray(vectors, "float64"))
    near = units @ units.T >= threshold
    np.fill_diagonal(near, False)
    label = np.arange(len(ids))
    while True:
        before = label.copy()
        for i in range(len(ids)):
            label[i] = min([label[i], *label[near[i]]])
        if (label == before).all():
            return near.sum(axis=1).tolist(), [ids[x] for x in label]


def planted(sizes, dim=24, spread=0.05, seed=5, alone=150):
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=(alone, dim))]
    for size in sizes:
        centre = rng.normal(size=dim)
        rows.append(centre + spread * np.linalg.norm(centre) * rng.normal(size=(size, dim)) / np.sqrt(dim))
    return np.concatenate(rows)


def table(spark, ids, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "x", 3, 1.5) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("shard_rows", [4096, 64])
def test_links_and_components_equal_brute_force(spark, shard_rows):
    vectors = planted([2, 2, 3, 5, 40, 200])  # the last group is larger than a shard and stays one crowded group
    ids = np.random.default_rng(0).permutation(len(vectors)).tolist()
    order = np.argsort(ids)
    links, comps = plain(sorted(ids), vectors[order])
    found = near_vectors(table(spark, ids, vectors), shard_rows=shard_rows).orderBy("vec_id").collect()
    assert [r["component_id"] for r in found] == comps
    assert [r["kept"] for r in found] == [r["vec_id"] == r["component_id"] for r in found]
    got = np.array([r["n_links"] for r in found])
    assert (got <= links).all() and got.sum() >= 0.98 * sum(links)


def test_further_levels_of_clusters(spark, monkeypatch):
    monkeypatch.setattr(module, "MAX_CENTRES", 4)
    vectors = planted([2] * 40 + [6] * 5, alone=500)
    links, _ = plain(list(range(len(vectors))), vectors)
    found = near_vectors(table(spark, range(len(vectors)), vectors), shard_rows=64).orderBy("vec_id").collect()
    assert sum(r["n_links"] for r in found) >= 0.95 * sum(links)


def test_copies_scaled_copies_and_a_hub(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(2, 16))
    chain = [np.cos(t) * np.eye(16)[0] + np.sin(t) * np.eye(16)[1] for t in np.arange(6) * 0.4]  # cosines 0.92, 0.70
    vectors = [a] * 30 + [2 * a, -a, b, 1e200 * b, 1e-200 * b] + chain
    ids = list(range(100, 100 + len(vectors)))
    found = near_vectors(table(spark, ids, vectors)).orderBy("vec_id").collect()
    links, comps = plain(ids, vectors)
    assert [r["n_links"] for r in found] == links and [r["component_id"] for r in found] == comps


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 0.0]]
    held = [(7, [1.0, 0.0]), (7, [1.0, 0.0]), (3, [1.0, 0.01]), (None, [1.0, 0.02]), (9, [1.0, 0.0, 0.0]), (8, [0.0, -1.0])]
    ids = [i for i, _ in held] + [1] * len(odd)
    rows = table(spark, ids, [v for _, v in held] + odd)
    found = sorted(((r["vec_id"] is None, r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(rows).collect()), key=str)
    wanted = [(False, 1, 0, 1, True)] * len(odd)
    wanted += [(False, 7, 3, 3, False)] * 2 + [(False, 3, 3, 3, True), (True, None, 3, 3, False), (False, 9, 0, 9, True), (False, 8, 0, 8, True)]
    assert found == sorted(wanted, key=str)
    none = near_vectors(table(spark, [None, None], [[1.0], None])).collect()
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in none] == [(0, None, True)] * 2
    assert near_vectors(rows.limit(0)).count() == 0


def test_a_weak_round_is_repeated_and_a_hopeless_one_reported(spark, monkeypatch):
    vectors = planted([2] * 30)
    rows = table(spark, range(len(vectors)), vectors)
    shares = []
    monkeypatch.setattr(module, "recall", lambda found, audited: shares.append(0.91 + len(shares) / 100) or shares[-1])
    with pytest.warns(UserWarning, match="recall 0.930"):
        near_vectors(rows, shard_rows=64).count()
    assert len(shares) == 3
    monkeypatch.setattr(module, "recall", lambda found, audited: 0.5)
    with pytest.raises(RuntimeError, match="recall 0.500"):
        near_vectors(rows, shard_rows=64)


def test_graph_finds_nearly_all_pairs_in_range():
    units = unit_rows(planted([30, 100, 3, 2], alone=700)).astype("float32")
    graph = build_graph(units)
    assert graph.edges.shape[0] == len(units) and (graph.edges != np.arange(len(units))[:, None]).all()
    true = set(zip(*np.nonzero(units @ units.T >= 0.9)))
    found = range_pairs(graph, units, 0.9)
    assert len({tuple(p) for p in found.tolist()}) == len(found)
    both = {tuple(p) for p in found.tolist()} | {(b, a) for a, b in found.tolist()}
    assert both <= true and len(both) >= 0.99 * len(true)


def test_pruning_keeps_one_of_those_behind_each_other():
    vectors = unit_rows(np.array([[1, 0], [1, 0.1], [1, 0.11], [1, -0.3]])).astype("float32")
    sims = (vectors @ vectors[0])[None, 1:]
    assert robust_prune(vectors, sims, np.array([[1, 2, 3]]))[0].tolist()[:3] == [1, 3, -1]


def test_nodes_are_scored_once():
    vectors = unit_rows(np.eye(4)).astype("float32")
    search = Search(Graph(vectors, np.full((4, 1), -1, "int32"), np.array([0])), vectors[:1])
    new, _ = search.score(np.array([0, 0, 0, 0]), np.array([2, 2, -1, 3]))
    assert sorted(np.array([2, 2, -1, 3])[new]) == [2, 3]
    assert len(search.score(np.array([0]), np.array([2]))[0]) == 0


def test_centres_of_one_group_become_one():
    sample = unit_rows(planted([300], alone=0, spread=0.02))
    assert len(cluster_centres(sample, 8)) == 1
