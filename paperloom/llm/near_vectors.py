"""Near duplicates among embeddings: a flat graph built on overlapping cluster shards, searched by range."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paperloom.llm.flat_graph import BEAM, Graph, build_graph, medoids, range_pairs
from paperloom.llm.near_duplicates import components
from paperloom.operators.skew import lookup_join
from paperloom.session import materialise, spread

THRESHOLD = 0.9
SLACK = 1e-4  # single precision finds candidates down to the threshold less this; doubles decide
SHARD_ROWS = 4096
OVERLAP = 2  # shards that a vector belongs to, at each level of clustering
MAX_CENTRES = 1024  # of one level; larger tables get further levels
PER_CENTRE = 32  # vectors sampled for each centre
ROUNDS = 8  # of k-means
ONE_GROUP = 0.9  # centres nearer than this are one: a crowded group is not torn apart by its noise
LEVELS = 4
AUDITED = 1024  # vectors compared with all others
WANTED_RECALL = 0.98
LEAST_RECALL = 0.9
NODE = "node long, unit binary, copies long"


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares of very large or small entries stay in range."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def as_rows(column: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(-1, dim)


def distinct_nodes(picked: DataFrame, dim: int) -> DataFrame:
    """One node for equal vectors, in ascending order of their least id: node, first_id, k1, k2, copies, unit.

    Partial groups are combined before the shuffle, so a vector that a third of
    the rows repeat costs a row for each task.
    """
    grouped = picked.groupBy("k1", "k2").agg(
        F.first("v").alias("v"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id")
    )
    ordered = grouped.withColumn("no_id", F.col("first_id").isNull()).repartitionByRange("no_id", "first_id", "k1", "k2")
    ordered = ordered.sortWithinPartitions("no_id", "first_id", "k1", "k2")

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = unit_rows(batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
            columns = [batch.column(c) for c in ("node", "first_id", "k1", "k2", "copies")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([r.tobytes() for r in rows.astype("<f8")], pa.binary())],
                ["node", "first_id", "k1", "k2", "copies", "unit"],
            )

    named = ordered.withColumn("node", F.monotonically_increasing_id())
    return materialise(
        named.mapInArrow(unit, "node long, first_id long, k1 long, k2 long, copies long, unit binary"), "vector-nodes"
    )


def cluster_centres(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Spherical k-means; of centres nearer than ONE_GROUP the first stays."""
    centres = sample[np.linspace(0, len(sample) - 1, min(wanted, len(sample))).astype(int)]
    for _ in range(ROUNDS):
        part = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, part, sample)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
    kept: list[int] = []
    for i in range(len(centres)):
        if not kept or (centres[kept] @ centres[i]).max() < ONE_GROUP:
            kept.append(i)
    return centres[kept]


def split_shards(members: DataFrame, sizes: DataFrame, dim: int, overlap: int, shard_rows: int) -> DataFrame:
    """Members (node, unit, copies, shard) of shards in `sizes` (shard, size), dealt to the shards of their nearest centres.

    Centres come from a sample of at most PER_CENTRE x MAX_CENTRES rows of a
    shard. Rows meet them in chunks, so that a large shard is many tasks.
    Returns shard, `parent`, and `whole`: the shard is one crowded group that has one centre only.
    """
    wanted = F.least(F.lit(MAX_CENTRES), F.ceil(F.col("size") * overlap / F.lit(shard_rows))).cast("long")
    plan = sizes.select("shard", "size", wanted.alias("k"))
    planned = materialise(lookup_join(members, plan, "shard", counts=sizes.withColumnRenamed("size", "n_rows")), "shard-rows")
    drawn = planned.where(F.pmod(F.xxhash64("node", "shard"), "size") < F.col("k") * PER_CENTRE)

    def centres_of(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        order = np.random.default_rng(0).permutation(len(rows))
        found = cluster_centres(as_rows(rows["unit"], dim)[order], int(rows["k"].iloc[0]))
        return pd.DataFrame({"shard": [key[0]], "centres": [found.astype("<f8").tobytes()]})

    centres = materialise(drawn.groupBy("shard").applyInPandas(centres_of, "shard long, centres binary"), "shard-centres")
    chunks = F.ceil(F.col("size") / F.lit(4 * shard_rows)).cast("long")
    asked = planned.select("node", "unit", "copies", "shard", F.pmod(F.xxhash64("node"), chunks).alias("chunk"))
    offered = centres.join(plan.select("shard", "size"), "shard").select(
        "shard", "centres", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk")
    )

    def deal(key: tuple, rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=["node", "unit", "copies", "parent", "shard", "whole"])
        # a shard whose sample came out empty stays as it is
        means = np.frombuffer(held["centres"].iloc[0], "<f8").reshape(-1, dim) if len(held) else np.zeros((1, dim))
        near = np.argsort(-(as_rows(rows["unit"], dim) @ means.T), axis=1, kind="stable")[:, :overlap]
        out = rows.loc[rows.index.repeat(near.shape[1]), ["node", "unit", "copies"]]
        child = key[0] * (MAX_CENTRES + 1) + 1 + near.ravel()
        return out.assign(parent=key[0], shard=child, whole=len(means) == 1)

    dealt = asked.groupBy("shard", "chunk").cogroup(offered.groupBy("shard", "chunk"))
    return dealt.applyInPandas(deal, NODE + ", parent long, shard long, whole boolean")


def overlapping_shards(nodes: DataFrame, dim: int, overlap: int, shard_rows: int) -> DataFrame:
    """Members (node, unit, copies, shard): clusters, split level by level until they are small or one crowded group."""
    ready: list[DataFrame] = []
    members = nodes.select("node", "unit", "copies", F.lit(0).cast("long").alias("shard"), F.lit(False).alias("whole"))
    for level in range(LEVELS + 1):
        sizes = materialise(members.groupBy("shard", "whole").agg(F.count(F.lit(1)).alias("size")), "shard-sizes")
        large = sizes.where(~F.col("whole") & (F.col("size") > shard_rows)) if level < LEVELS else sizes.where(F.lit(False))
        n_large = large.count()
        if not n_large:
            ready.append(members)
            break
        counts = sizes.select("shard", F.col("size").alias("n_rows"))
        marked = lookup_join(members, sizes.select("shard", "size"), "shard", counts=counts)
        splits = ~F.col("whole") & (F.col("size") > shard_rows)
        marked = materialise(marked.withColumn("splits", splits), "shard-members")
        ready.append(marked.where(~F.col("splits")).drop("size", "splits"))
        going = marked.where("splits").drop("size", "splits", "whole")
        members = materialise(split_shards(going, large.select("shard", "size"), dim, overlap, shard_rows).drop("parent"), "shards")
    own = reduce(DataFrame.unionByName, [part.select("node", "unit", "copies", "shard") for part in ready])
    sizes = own.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"))
    sizes = materialise(sizes, "shard-sizes")
    parts = sizes.select("shard", F.ceil(F.col("n_rows") / F.lit(shard_rows)).cast("int").alias("parts"))
    placed = lookup_join(own, parts, "shard", counts=sizes)
    # a crowded group is dealt into parts by hash
    return materialise(placed.withColumn("part", F.pmod(F.xxhash64("node", "shard"), "parts").cast("int")), "members")


def neighbour_lists(members: DataFrame, dim: int, beam: int) -> DataFrame:
    """Union of the edges that the graphs of a node's shards give it: (node, edges, shards)."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        names = rows["node"].to_numpy("int64")
        edges = build_graph(as_rows(rows["unit"], dim), beam).edges
        lists = [names[e[e >= 0]].tolist() for e in edges]
        return pd.DataFrame({"node": names, "edges": lists, "shard": key[0]})

    built = members.groupBy("shard", "part").applyInPandas(build, "node long, edges array<long>, shard long")
    return built.groupBy("node").agg(
        F.array_distinct(F.flatten(F.collect_list("edges"))).alias("edges"),
        F.sort_array(F.collect_set("shard")).alias("shards"),
    )


def local_edges(names: np.ndarray, lists: list) -> np.ndarray:
    """Neighbour lists as places among `names` (ascending); neighbours that are not there are left out."""
    sizes = np.array([len(e) for e in lists])
    flat = np.concatenate([np.asarray(e, "int64") for e in lists]) if len(lists) else np.zeros(0, "int64")
    at = np.minimum(np.searchsorted(names, flat), len(names) - 1)
    at = np.where(names[at] == flat, at, -1)
    out = np.full((len(lists), max(1, sizes.max(initial=0))), -1, "int32")
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = at
    return out


def first_common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least shard that rows of two padded lists have in common."""
    none = np.iinfo("int64").max
    same = (left[:, :, None] == right[:, None, :]) & (left[:, :, None] >= 0)
    return np.where(same.any(axis=2), left, none).min(axis=1)


def find_links(members: DataFrame, lists: DataFrame, dim: int, threshold: float, beam: int) -> DataFrame:
    """(node, links, root): links found in a cell of a shard, and the least node that they lead to there.

    Parts of a shard meet in cells of two parts; a part alone is a cell too. A
    pair that several shards hold counts in the first of them only. What leaves
    a cell is a row for each node, however many pairs there are.
    """

    def search(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node").reset_index(drop=True)
        names, units = rows["node"].to_numpy("int64"), as_rows(rows["unit"], dim)
        part, copies = rows["part"].to_numpy(), rows["copies"].to_numpy("int64")
        width = max(len(s) for s in rows["shards"])
        shards = np.array([list(s) + [-1] * (width - len(s)) for s in rows["shards"]], "int64")
        linked = np.zeros((len(rows), len(rows)), bool)
        for graph_part, query_part in {(key[1], key[2]), (key[2], key[1])}:
            inside, asking = np.flatnonzero(part == graph_part), np.flatnonzero(part == query_part)
            if not len(inside) or not len(asking):
                continue
            edges = local_edges(names[inside], rows["edges"].iloc[inside].tolist())
            vectors = np.ascontiguousarray(units[inside], "float32")
            graph = Graph(vectors, edges, medoids(vectors))
            own = local_edges(names[inside], rows["edges"].iloc[asking].tolist())
            found = range_pairs(graph, units[asking], threshold - SLACK, beam, own)
            linked[asking[found[:, 0]], inside[found[:, 1]]] = True
        linked |= linked.T
        a, b = np.nonzero(np.triu(linked, 1))
        keep = np.zeros(len(a), bool)
        for start in range(0, len(a), 1 << 16):
            one, other = a[start : start + (1 << 16)], b[start : start + (1 << 16)]
            near = np.einsum("ij,ij->i", units[one], units[other]) >= threshold
            keep[start : start + (1 << 16)] = near & (first_common(shards[one], shards[other]) == key[0])
        a, b = a[keep], b[keep]
        links = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
        root = np.arange(len(rows))
        while True:
            before = root.copy()
            np.minimum.at(root, a, before[b])
            np.minimum.at(root, b, before[a])
            root = root[root]
            if (root == before).all():
                break
        has = links > 0
        return pd.DataFrame({"node": names[has], "links": links[has].astype("int64"), "root": names[root[has]]})

    rows = members.join(lists, "node").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    cells = rows.select(
        "node", "unit", "copies", "edges", "shards", "part", "shard",
        F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"),
    )
    return cells.groupBy("shard", "lo", "hi").applyInPandas(search, "node long, links long, root long")


def audited_nodes(nodes: DataFrame, dim: int, threshold: float) -> pd.DataFrame:
    """(node, links) of at most AUDITED nodes, the least by hash, compared with every other node."""
    chosen = nodes.select("node", "unit", F.xxhash64("node", F.lit(3)).alias("h")).orderBy("h", "node").limit(AUDITED)
    asked = chosen.select("node", "unit").toPandas()
    names, units = asked["node"].to_numpy("int64"), as_rows(asked["unit"], dim)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names), "int64")
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column("unit").to_pylist()), "<f8").reshape(-1, dim)
            near = (rows @ units.T) >= threshold
            near &= batch.column("node").to_numpy()[:, None] != names
            total += batch.column("copies").to_numpy() @ near
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(total)], ["node", "links"])

    counted = nodes.select("node", "unit", "copies").mapInArrow(count, "node long, links long")
    return counted.groupBy("node").agg(F.sum("links").alias("links")).toPandas()


def recall(found: DataFrame, audited: pd.DataFrame) -> float:
    """Share of the audited links that were found: over all of them, or as the mean over nodes, whichever is less."""
    wanted = audited[audited["links"] > 0].set_index("node")["links"]
    if not len(wanted):
        return 1.0
    spark = found.sparkSession
    asked = spark.createDataFrame([(int(n),) for n in wanted.index], "node long")
    held = found.join(F.broadcast(asked), "node").groupBy("node").agg(F.sum("links").alias("links")).toPandas()
    share = held.set_index("node")["links"].reindex(wanted.index).fillna(0)
    return float(min(share.sum() / wanted.sum(), (share / wanted).mean()))


def near_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    shard_rows: int = SHARD_ROWS,
    overlap: int = OVERLAP,
    wanted_recall: float = WANTED_RECALL,
) -> DataFrame:
    """Links at a cosine of at least `threshold`, and what they join: vec_id, n_links, component_id, kept.

    Equal vectors are one node. Nodes are clustered into shards that overlap; a
    shard larger than `shard_rows` that further clustering does not split, as
    one crowded group, is dealt into parts, and every two parts meet. In each
    part a graph is grown by greedy searches and robust pruning; the edges of a
    node from all its shards are united. Every node is then searched for from
    the medoids of each of its shards and from its own edges, and whatever is
    in range is opened in turn. Pairs are verified in doubles. A bounded sample
    is compared with all nodes; below `wanted_recall` the search is repeated
    with more overlap and a wider beam, at last with all parts against all
    parts; the best round is given, and below LEAST_RECALL it raises an error.
    The work grows with the square of a crowded group, whose links are counted
    one by one, though no pair leaves a task.

    n_links counts other rows linked directly, copies too; component_id is the
    least id that links lead to, the own one included; kept marks rows whose id
    is that one. Vectors that are null, empty, zero or hold null or non-finite
    entries link with nothing. Vectors link with others of their length only.
    Repeated rows count as often as they occur; a row with a null id takes part
    and is named last, so its component_id is null only if no other id is there.
    An empty table gives no rows; other columns are not read.
    """
    wide = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    limit = F.lit(float("inf"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == limit))
    able = F.coalesce(F.exists(wide, lambda x: x != 0) & ~bad, F.lit(False))
    # adding zero makes -0.0 the same vector as 0.0
    vector = F.when(able, F.transform(wide, lambda x: x + F.lit(0.0)))
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v"))
    base = base.withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit(1), "v"), "dim": F.size("v")})
    base = materialise(spread(base, "vec_id"), "vectors")
    usable = base.where(F.col("v").isNotNull())
    results = []
    for dim in sorted(r["dim"] for r in usable.groupBy("dim").agg(F.lit(1)).collect()):
        picked = usable.where(F.col("dim") == dim)
        results.append(_linked(picked, dim, threshold, shard_rows, overlap, wanted_recall))
    alone = base.where(F.col("v").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    whole = reduce(DataFrame.unionByName, results, alone)
    return whole.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _linked(picked: DataFrame, dim: int, threshold: float, shard_rows: int, overlap: int, wanted_recall: float) -> DataFrame:
    """vec_id, n_links and component_id of usable vectors of one length."""
    nodes = distinct_nodes(picked, dim)
    audited = audited_nodes(nodes, dim, threshold)
    best: tuple[float, DataFrame | None] = (-1.0, None)
    total = nodes.count()
    rounds = [(overlap, BEAM, shard_rows), (2 * overlap, 2 * BEAM, shard_rows), (1, 2 * BEAM, None)]
    for width, beam, size in rounds:
        if size is None:  # one shard of many parts: every two parts meet
            members = nodes.select("node", "unit", "copies", F.lit(0).cast("long").alias("shard"))
            parts = -(-total // shard_rows)
            members = members.withColumns({"parts": F.lit(parts), "part": F.pmod(F.xxhash64("node"), F.lit(parts)).cast("int")})
        else:
            members = overlapping_shards(nodes, dim, width, size)
        lists = materialise(neighbour_lists(members, dim, beam), "neighbour-lists")
        found = materialise(find_links(members, lists, dim, threshold, beam), "vector-links")
        share = recall(found, audited)
        if share > best[0]:
            best = (share, found)
        if share >= wanted_recall:
            break
    share, found = best
    if share < LEAST_RECALL:
        raise RuntimeError(f"recall {share:.3f} of links, measured on {len(audited)} vectors, is below {LEAST_RECALL}")
    if share < wanted_recall:
        warnings.warn(f"recall {share:.3f} of links, measured on {len(audited)} vectors", stacklevel=3)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    first = nodes.select("node", "first_id")
    label = lambda c: F.struct(F.col("first_id").isNull().alias("no_id"), "first_id", c)
    ends = found.where("node <> root").select("node", "root").distinct()
    named = ends.join(first, "node").select("root", label("node").alias("a"))
    named = named.join(first.withColumnRenamed("node", "root"), "root").select("a", label(F.col("root").alias("node")).alias("b"))
    edges = materialise(named, "vector-edges")
    linked = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    comps = components(linked, edges).select(F.col("node.node").alias("node"), F.col("comp.first_id").alias("least"))
    told = nodes.select("k1", "k2", "node", "first_id", "copies").join(links, "node", "left").join(comps, "node", "left")
    told = told.select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.when(F.col("least").isNull(), F.col("first_id")).otherwise(F.col("least")).alias("component_id"),
        F.struct("k1", "k2").alias("key"), "copies",
    )
    told = materialise(told, "vector-classes")
    keyed = picked.select("vec_id", F.struct("k1", "k2").alias("key"))
    counts = told.select("key", F.col("copies").alias("n_rows"))
    joined = lookup_join(keyed, told.select("key", "n_links", "component_id"), "key", counts=counts)
    return joined.select("vec_id", "n_links", "component_id")
