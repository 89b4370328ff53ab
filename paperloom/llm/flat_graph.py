"""A robust-pruned neighbour graph over a block of unit vectors, and range search on it, many queries at a time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEGREE = 24  # edges a node keeps in a block
BEAM = 32  # nodes a greedy search holds
EXPAND = 6  # of them opened at a time
ALPHA = 1.2  # a candidate goes if a kept one is nearer to it by this factor than the node is
ENTRIES = 16
CHUNK = 1024  # queries searched together
SEEDS = 64  # nodes that are linked before any search
GROWTH = 1024  # nodes put in at a time


@dataclass(frozen=True)
class Graph:
    """Vectors in single precision, edges padded with -1, and the nodes where searches begin."""

    vectors: np.ndarray
    edges: np.ndarray
    entries: np.ndarray


def medoids(vectors: np.ndarray, wanted: int = ENTRIES) -> np.ndarray:
    """The nodes nearest to the means of the whole block and of parts of it around evenly spaced nodes."""
    seeds = vectors[np.linspace(0, len(vectors) - 1, min(wanted, len(vectors))).astype(int)]
    part = np.argmax(vectors @ seeds.T, axis=1)
    means = [vectors.mean(axis=0)] + [vectors[part == i].mean(axis=0) for i in np.unique(part)]
    return np.unique(np.argmax(vectors @ np.array(means, "float32").T, axis=0))


class Search:
    """State of a batch of queries on one graph: which nodes were scored, and their similarities."""

    def __init__(self, graph: Graph, queries: np.ndarray):
        self.graph, self.queries = graph, queries
        self.size = len(graph.vectors)
        self.seen = np.zeros(len(queries) * self.size, bool)
        self.stamp = np.empty(len(queries) * self.size, "int32")

    def score(self, query: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs that were not scored before, each once, and their similarities; -1 is no node."""
        flat = query.astype("int64") * self.size + node
        new = np.flatnonzero(node >= 0)
        new = new[~self.seen[flat[new]]]
        self.stamp[flat[new]] = new
        new = new[self.stamp[flat[new]] == new]  # of equal pairs the last one
        self.seen[flat[new]] = True
        return new, np.einsum("ij,ij->i", self.graph.vectors[node[new]], self.queries[query[new]])

    def greedy(self, starts: np.ndarray, beam: int, bound: float = np.inf) -> tuple[np.ndarray, np.ndarray, list, np.ndarray]:
        """Beam (nodes, similarities) of each query, pairs met at `bound` or nearer, and flags of the opened pairs."""
        n = len(self.queries)
        near: list[np.ndarray] = []
        opened = np.zeros((n, self.size), bool)

        def offer(active: np.ndarray, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The best of the beams of the active queries and of the nodes offered to each."""
            query, flat = np.repeat(active, nodes.shape[1]), nodes.ravel()
            new, found = self.score(query, flat)
            offered = np.full(len(flat), -np.inf, "float32")
            offered[new] = found
            hit = new[found >= bound]
            near.append(np.column_stack([query[hit], flat[hit]]))
            ids = np.hstack([ids, nodes])
            sims = np.hstack([sims, offered.reshape(nodes.shape)])
            best = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
            return np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)

        ids = np.full((n, beam), -1, "int32")
        sims = np.full((n, beam), -np.inf, "float32")
        ids, sims = offer(np.arange(n), starts.astype("int32"), ids, sims)
        active = np.arange(n)
        while len(active):
            own_ids, own_sims = ids[active], sims[active]
            waiting = np.where(opened[active[:, None], own_ids] | (own_ids < 0), -np.inf, own_sims)
            going = np.isfinite(waiting).any(axis=1)
            active, own_ids, own_sims, waiting = active[going], own_ids[going], own_sims[going], waiting[going]
            if not len(active):
                break
            first = np.argpartition(-waiting, min(EXPAND, beam) - 1, axis=1)[:, :EXPAND]
            chosen = np.where(np.isfinite(np.take_along_axis(waiting, first, 1)), np.take_along_axis(own_ids, first, 1), -1)
            at, column = np.nonzero(chosen >= 0)
            opened[active[at], chosen[at, column]] = True
            edges = np.where((chosen >= 0)[:, :, None], self.graph.edges[chosen], -1)
            ids[active], sims[active] = offer(active, edges.reshape(len(active), -1), own_ids, own_sims)
        return ids, sims, near, opened

    def within(self, starts: np.ndarray, bound: float, beam: int) -> np.ndarray:
        """(query, node) pairs at `bound` or nearer: greedy search, then every node in range is opened until none is new."""
        _, _, near, opened = self.greedy(starts, beam, bound)
        found = np.concatenate(near)
        out = [found]
        while len(found):
            fresh = found[~opened[found[:, 0], found[:, 1]]]
            opened[fresh[:, 0], fresh[:, 1]] = True
            met = []
            for start in range(0, len(fresh), 1 << 15):
                part = fresh[start : start + (1 << 15)]
                query = np.repeat(part[:, 0], self.graph.edges.shape[1])
                node = self.graph.edges[part[:, 1]].ravel()
                new, sims = self.score(query, node)
                hit = new[sims >= bound]
                met.append(np.column_stack([query[hit], node[hit]]))
            found = np.concatenate(met) if met else found[:0]
            out.append(found)
        return np.concatenate(out)


def robust_prune(vectors: np.ndarray, sims: np.ndarray, ids: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Edges of several nodes from candidates (-1 for none): the nearest is kept and shades those behind it, and so on."""
    held = vectors[ids]
    between = 2 - 2 * np.matmul(held, held.transpose(0, 2, 1))
    away = np.where(ids >= 0, 2 - 2 * sims, np.inf)
    edges = np.full((len(ids), degree), -1, "int32")
    rows = np.arange(len(ids))
    for place in range(min(degree, ids.shape[1])):
        pick = np.argmin(away, axis=1)
        good = np.isfinite(away[rows, pick])
        if not good.any():
            break
        edges[good, place] = ids[good, pick[good]]
        shaded = ALPHA * ALPHA * between[rows, pick] <= away
        away[shaded & good[:, None]] = np.inf
        away[rows, pick] = np.inf
    return edges


def _link(vectors: np.ndarray, edges: np.ndarray, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
    """Set the edges of `nodes` from candidates, and offer each node to those it points at."""
    ids = np.where(ids == nodes[:, None], -1, ids)
    for start in range(0, len(nodes), 256):
        part = slice(start, start + 256)
        edges[nodes[part]] = robust_prune(vectors, sims[part], ids[part])
    to = edges[nodes]
    source, target = np.repeat(nodes, to.shape[1])[to.ravel() >= 0], to.ravel()[to.ravel() >= 0]
    near = np.einsum("ij,ij->i", vectors[source], vectors[target])
    order = np.lexsort((-near, target))
    source, target = source[order], target[order]
    met, first, times = np.unique(target, return_index=True, return_counts=True)
    # a node that many point at considers the nearest of them
    nth = np.arange(len(target)) - np.repeat(first, times)
    kept = nth < DEGREE
    offered = np.full((len(met), DEGREE), -1, "int32")
    offered[np.repeat(np.arange(len(met)), times)[kept], nth[kept]] = source[kept]
    known = (offered[:, :, None] == edges[met][:, None, :]).any(axis=2)
    candidates = np.hstack([edges[met], np.where(known, -1, offered)])
    for start in range(0, len(met), 256):
        part = slice(start, start + 256)
        ids = candidates[part]
        sims = np.matmul(vectors[ids], vectors[met[part]][:, :, None])[:, :, 0]
        edges[met[part]] = robust_prune(vectors, sims, ids)


def build_graph(vectors: np.ndarray, beam: int = BEAM, seed: int = 0) -> Graph:
    """Put the nodes in by growing batches, each searched for on the graph so far; then search for all once more."""
    n = len(vectors)
    vectors = np.ascontiguousarray(vectors, "float32")
    order = np.random.default_rng(seed).permutation(n)
    edges = np.full((n, DEGREE), -1, "int32")
    first = order[: min(n, SEEDS)]
    _link(vectors, edges, first, np.tile(first.astype("int32"), (len(first), 1)), vectors[first] @ vectors[first].T)
    entries = first[medoids(vectors[first])] if n else first

    def insert(nodes: np.ndarray) -> None:
        graph = Graph(vectors, edges, entries)
        starts = np.hstack([np.tile(entries.astype("int32"), (len(nodes), 1)), edges[nodes]])
        ids, sims, _, _ = Search(graph, vectors[nodes]).greedy(starts, beam)
        own = edges[nodes]
        repeated = (own[:, :, None] == ids[:, None, :]).any(axis=2)
        own = np.where(repeated, -1, own)
        own_sims = np.matmul(vectors[own], vectors[nodes][:, :, None])[:, :, 0]
        _link(vectors, edges, nodes, np.hstack([ids, own]), np.hstack([sims, own_sims]))

    done = len(first)
    while done < n:
        nodes = order[done : done + min(done, GROWTH)]
        insert(nodes)
        done += len(nodes)
    entries = medoids(vectors) if n else entries
    for start in range(0, n if n > SEEDS else 0, GROWTH):
        insert(order[start : start + GROWTH])
    return Graph(vectors, edges, entries)


def range_pairs(graph: Graph, queries: np.ndarray, bound: float, beam: int = BEAM, own: np.ndarray | None = None) -> np.ndarray:
    """(query, node) pairs at `bound` or nearer, searched from the medoids and from each query's `own` nodes."""
    queries = np.ascontiguousarray(queries, "float32")
    out = [np.zeros((0, 2), "int64")]
    for start in range(0, len(queries), CHUNK):
        part = queries[start : start + CHUNK]
        starts = np.tile(graph.entries.astype("int32"), (len(part), 1))
        if own is not None:
            starts = np.hstack([starts, own[start : start + CHUNK]])
        found = Search(graph, part).within(starts, bound, beam)
        out.append(found + np.array([start, 0]))
    return np.concatenate(out)
