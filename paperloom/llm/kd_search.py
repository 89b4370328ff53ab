"""Exact search for the largest inner products with a KD-tree in each shard."""

from __future__ import annotations

import heapq
from bisect import insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from paperloom.session import materialise

SHARD_ROWS = 8192
LEAF_ROWS = 128
BLOCK_QUERIES = 512
EXACT_DOUBLE = 1 << 20  # components up to here: sums of products are whole numbers below 2**53 in a double
INDEX_SCHEMA = "dim int, shard long, ids binary, own binary, vectors binary, nodes binary, low binary, high binary"
FOUND_SCHEMA = "query_row long, query_id long, vec_id long, score long"


def build_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by leaf, nodes (first row, end, left child or -1), and the tight box of each node.

    A node is split at the median of its widest side until LEAF_ROWS remain;
    the right child follows the left one. Equal vectors are never split by value, only by place.
    """
    order = np.arange(len(vectors))
    nodes, low, high = [], [], []

    def box(first: int, end: int) -> int:
        rows = vectors[order[first:end]]
        nodes.append([first, end, -1])
        low.append(rows.min(axis=0))
        high.append(rows.max(axis=0))
        return len(nodes) - 1

    waiting = [box(0, len(order))]
    while waiting:
        at = waiting.pop()
        first, end, _ = nodes[at]
        side = high[at] - low[at]
        if end - first <= LEAF_ROWS or not side.any():
            continue
        axis, half = int(np.argmax(side)), (end - first) // 2
        own = order[first:end]
        order[first:end] = own[np.argpartition(vectors[own, axis], half, kind="introselect")]
        left, right = box(first, first + half), box(first + half, end)
        nodes[at][2] = left
        waiting += [left, right]
    return order, np.array(nodes, "int64").reshape(-1, 3), np.array(low), np.array(high)


class Tree:
    """One shard's tree as read from its row of the index."""

    def __init__(self, row: dict, dim: int):
        kind = "<i8"
        self.ids, self.own = np.frombuffer(row["ids"], kind), np.frombuffer(row["own"], kind)
        self.vectors = np.frombuffer(row["vectors"], kind).reshape(-1, dim)
        self.nodes = np.frombuffer(row["nodes"], kind).reshape(-1, 3)
        self.low = np.frombuffer(row["low"], kind).reshape(-1, dim)
        self.high = np.frombuffer(row["high"], kind).reshape(-1, dim)

    def search(self, queries: np.ndarray, own: np.ndarray, bounds: np.ndarray, k: int) -> list[list[tuple]]:
        """For each query its best (-score, id) pairs here that reach its bound, the least score still of use.

        The most promising box is opened first; the search of a query ends when
        no box can reach its k-th best score. Equal scores are kept for the
        choice by id, so only boxes strictly below it are left out.
        """
        largest = max(np.abs(queries).max(initial=0), np.abs(self.low).max(initial=0), np.abs(self.high).max(initial=0))
        kind = "float64" if largest <= EXACT_DOUBLE else "int64"
        q, vectors = queries.astype(kind), self.vectors.astype(kind)
        # the most that a point of the box can give: each side at the end that suits the query
        reach = np.maximum(q, 0) @ self.high.astype(kind).T + np.minimum(q, 0) @ self.low.astype(kind).T
        out = []
        for i, query in enumerate(q):
            best: list[tuple] = []  # ascending, so the k-th is the last one
            least = bounds[i]
            limits = reach[i]
            heap = [(-limits[0], 0)]
            while heap and -heap[0][0] >= least:
                _, at = heapq.heappop(heap)
                first, end, left = self.nodes[at]
                if left >= 0:
                    for child in (left, left + 1):
                        if limits[child] >= least:
                            heapq.heappush(heap, (-limits[child], child))
                    continue
                scores = vectors[first:end] @ query
                for j in np.flatnonzero(scores >= least):
                    row = first + j
                    if self.own[row] != own[i]:
                        insort(best, (-int(scores[j]), int(self.ids[row]), int(self.own[row])))
                        if len(best) >= k:
                            del best[k:]
                            least = max(least, -best[-1][0])
            out.append(best)
        return out


def top_inner_products(
    rows: DataFrame,
    is_query: Column,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 64.0,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The `k` largest inner products of every query row with all other rows: query_id, rank, vec_id, score.

    Components are floor(scale x component) as whole numbers. Rows are dealt to
    shards by hash and each shard builds a KD-tree; queries travel in blocks.
    A block first searches one shard; its k-th scores then bound the search of
    all other shards. Equal scores take the smaller id.

    Null vectors and vectors with a null or non-finite component take no part,
    as candidate or query; vectors only meet vectors of the same length. A row
    is no candidate for itself, but another row with its id is. With fewer
    than `k` candidates all are returned. Null ids come after others at equal
    scores. An empty table gives no rows; other columns are not read.
    """
    wide = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    usable = rows.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).where(~bad)
    whole = F.transform(wide, lambda x: F.floor(x * F.lit(scale)).cast("long"))
    picked = usable.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("id"),
        whole.alias("v"),
        F.size(vector_col).alias("dim"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    # written before use: a row's number is the same in every job and after a lost executor
    base = materialise(picked.withColumn("own", F.monotonically_increasing_id()), "vectors")
    sizes = {r["dim"]: r["count"] for r in base.groupBy("dim").count().collect()}  # one row for each vector length
    counts = {dim: -(-n // shard_rows) for dim, n in sizes.items()}
    shards = F.lit(1)
    for dim, n in counts.items():
        shards = F.when(F.col("dim") == dim, F.lit(n)).otherwise(shards)
    dealt = base.withColumn("shard", F.pmod(F.xxhash64("own"), shards).cast("long"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("own")
        vectors = np.stack(group["v"].to_numpy()).astype("<i8")
        order, nodes, low, high = build_tree(vectors)
        row = {
            "dim": group["dim"].iloc[0],
            "shard": group["shard"].iloc[0],
            "ids": group["id"].to_numpy("<i8")[order].tobytes(),
            "own": group["own"].to_numpy("<i8")[order].tobytes(),
            "vectors": vectors[order].tobytes(),
            "nodes": nodes.astype("<i8").tobytes(),
            "low": low.astype("<i8").tobytes(),
            "high": high.astype("<i8").tobytes(),
        }
        return pd.DataFrame([row])

    index = materialise(dealt.drop("asks").groupBy("dim", "shard").applyInPandas(pack, INDEX_SCHEMA), "kd-trees")
    # blocks of queries by hash: their number follows that of the queries
    asking = base.where("asks")
    n_blocks = max(1, -(-asking.count() // BLOCK_QUERIES))
    blocks = asking.select("dim", "id", "own", "v", F.pmod(F.xxhash64("own", F.lit(1)), F.lit(n_blocks)).alias("block"))

    def look(key, trees: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(trees) and len(queries):
            tree = Tree(trees.iloc[0].to_dict(), int(trees["dim"].iloc[0]))
            vectors = np.stack(queries["v"].to_numpy()).astype("int64")
            own, ids = queries["own"].to_numpy("int64"), queries["id"].to_numpy("int64")
            for at, best in enumerate(tree.search(vectors, own, queries["bound"].to_numpy("float64"), k)):
                found += [(own[at], ids[at], number, -score) for score, number, _ in best]
        return pd.DataFrame(found, columns=["query_row", "query_id", "vec_id", "score"])

    def searched(asked: DataFrame) -> DataFrame:
        """Every (shard, block) in `asked` on its own: one tree and one block of queries in memory."""
        # a column of its own: the two sides come from one table
        wanted = asked.select("dim", "shard", (F.col("block") + 0).alias("block")).distinct()
        keys = ["dim", "shard", "block"]
        trees = index.join(wanted, ["dim", "shard"])
        return trees.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(look, FOUND_SCHEMA)

    ranked = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    best = lambda df: df.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    lowest = F.lit(float("-inf"))
    with_count = blocks.withColumn("shards", shards)
    home = F.pmod(F.col("block"), F.col("shards")).cast("long")
    first = materialise(searched(with_count.withColumns({"shard": home, "bound": lowest})), "home-shard")
    kth = best(first).where(F.col("rank") == k).select("query_row", F.col("score").cast("double").alias("kth"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("shards").cast("long") - 1), lambda s: s != home)
    rest = with_count.withColumn("shard", F.explode(others)).join(
        kth.withColumnRenamed("query_row", "own"), "own", "left"
    )
    second = searched(rest.withColumn("bound", F.coalesce("kth", lowest)))
    final = best(first.unionByName(second))
    no_id = F.lit((1 << 63) - 1)
    return final.select(
        F.when(F.col("query_id") != no_id, F.col("query_id")).alias("query_id"),
        F.col("rank").cast("int").alias("rank"),
        F.when(F.col("vec_id") != no_id, F.col("vec_id")).alias("vec_id"),
        "score",
    )
