"""Near duplicates by improved consistent weighted sampling over tf-idf shingles, banded and verified.

The idf of a shingle is the mean idf of its words. A shingle's own document
frequency would be the size of its group of copies: in a group of thousands the
shared shingles would weigh next to nothing against each copy's own edits, and
near copies would fall below any threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from paperloom.session import materialise

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 14, 4  # a pair at 0.8 is missed with probability (1 - 0.8**4)**14 = 0.0006
TABLE_BITS = 16
SEED = 7
RAREST = 2000  # words in fewer than one in RAREST documents count as if in that many; bounds the table of words
BATCH_SHINGLES = 30_000  # of a few texts: their arrays stay in the processor's cache
CACHED_WORDS = 300_000
SPLIT = r"[ \t\n\x0B\f\r]+"
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
SMALL_BUCKET = 8  # up to so many nodes every pair between classes is compared
STARS = 3  # further leaders of a larger bucket before all its nodes are compared in blocks
BLOCK = 128  # nodes of a block
BLOCK_BYTES = 1 << 20  # of its texts
FEATURES = 4096  # columns of a dense part of a block's matrix
NEAR = 1e-3  # pairs so far below the threshold by single precision are still verified exactly


def word_weights(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray, float]:
    """Hashes (ascending) and idf of the words that one in RAREST documents has, and the idf of all others.

    At most RAREST x (mean distinct words of a document) words reach that share,
    whatever the size of the corpus. Counts are combined before the shuffle.
    """
    found = docs.select(F.explode(F.array_distinct(F.split(F.lower(text_col), SPLIT))).alias("w"))
    counts = found.select(F.xxhash64("w").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    total = docs.count()
    common = counts.where(F.col("df") * RAREST >= total).toPandas().sort_values("word")
    idf = 1.0 + np.log(max(total, 1) / common["df"].to_numpy("float64"))
    return common["word"].to_numpy("int64"), idf.astype("float32"), 1.0 + math.log(RAREST)


Vector = tuple[np.ndarray, np.ndarray, np.ndarray]


class Shingles:
    """Distinct shingles of a text with their tf-idf weights."""

    def __init__(self, words: np.ndarray, idf: np.ndarray, other: float):
        self.words, self.common_idf, self.other = words, idf, other
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}  # word: its place in the arrays
        self.hashes, self.idf = np.zeros(4096, "uint64"), np.zeros(4096)

    def learn(self, new: list[bytes]) -> None:
        """Hashes and idf of words not met before, all at once."""
        start = len(self.known)
        while start + len(new) > len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
            self.idf = np.concatenate([self.idf, np.zeros_like(self.idf)])
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in new), "uint64", len(new))
        idf = np.full(len(new), self.other)
        if len(self.words):
            signed = hashes.view("int64")
            at = np.minimum(np.searchsorted(self.words, signed), len(self.words) - 1)
            idf = np.where(self.words[at] == signed, self.common_idf[at], self.other)
        self.hashes[start : start + len(new)], self.idf[start : start + len(new)] = hashes, idf
        self.known.update(zip(new, range(start, start + len(new))))

    def of(self, text: str | None) -> Vector:
        """Hashes, ascending, tf-idf weights and counts. Fewer than five words are one shingle; no words are none."""
        words = (text or "").lower().encode().split()
        if not words:
            return np.zeros(0, "uint64"), np.zeros(0), np.zeros(0)
        if len(self.known) >= CACHED_WORDS:
            self.forget()
        new = set(words).difference(self.known)
        if new:
            self.learn(list(new))
        places = np.fromiter(map(self.known.__getitem__, words), "int64", len(words))
        hashes, idf = self.hashes[places], self.idf[places]
        width = min(SHINGLE_WORDS, len(words))
        n = len(words) - width + 1
        mixed, weight = np.full(n, width, "uint64"), np.zeros(n)
        for i in range(width):
            mixed = (mixed ^ hashes[i : i + n]) * np.uint64(MIX[i])
            mixed ^= mixed >> np.uint64(29)
            weight += idf[i : i + n]
        order = np.argsort(mixed)
        ascending = mixed[order]
        first = np.flatnonzero(np.append(True, ascending[1:] != ascending[:-1]))
        times = np.diff(np.append(first, n)).astype("float64")
        # equal shingles have equal words, so any of them tells the weight
        return ascending[first], times * weight[order[first]] / width, times


class Sampler:
    """Consistent weighted samples: gamma, gamma and uniform variates of a shingle come from tables by its hash."""

    def __init__(self):
        rng = np.random.default_rng(SEED)
        size = 1 << TABLE_BITS
        r = rng.gamma(2.0, 1.0, size)
        log_c = np.log(rng.gamma(2.0, 1.0, size))
        self.beta = rng.random(size).astype("float32")
        self.r, self.inverse = r.astype("float32"), (1 / r).astype("float32")
        # log a = log c - r (t - beta + 1), what does not depend on t is added up once
        self.fixed = (log_c + r * (self.beta - 1.0)).astype("float32")
        self.factors = rng.integers(1 << 62, size=BANDS * ROWS, dtype="uint64") * np.uint64(2) + np.uint64(1)

    def bands(self, vectors: list[Vector]) -> np.ndarray:
        """Band hashes of several documents that have shingles: one row for each document."""
        sizes = np.array([len(v[0]) for v in vectors])
        starts = np.cumsum(sizes) - sizes
        hashes = np.concatenate([v[0] for v in vectors])
        log_w = np.log(np.concatenate([v[1] for v in vectors])).astype("float32")
        out = np.zeros((len(vectors), BANDS), "uint64")
        for number, factor in enumerate(self.factors):
            place = (hashes * factor) >> np.uint64(64 - TABLE_BITS)
            t = self.inverse[place]
            t *= log_w
            t += self.beta[place]
            np.floor(t, out=t)
            log_a = self.fixed[place]
            log_a -= self.r[place] * t
            least = np.minimum.reduceat(log_a, starts)
            hits = np.flatnonzero(log_a == np.repeat(least, sizes))
            owner = np.searchsorted(starts, hits, "right") - 1
            chosen = hits[np.append(True, owner[1:] != owner[:-1])]  # the first shingle, in hash order, of a tie
            sample = hashes[chosen] ^ (t[chosen].astype("int64").astype("uint64") * np.uint64(MIX[0]))
            band = number // ROWS
            out[:, band] = (out[:, band] ^ sample) * np.uint64(MIX[1]) + np.uint64(number)
            out[:, band] ^= out[:, band] >> np.uint64(31)
        return out.astype("int64")


def weighted_jaccard(a: Vector, b: Vector) -> float:
    """Sum of the smaller over the sum of the larger weights, for tf-idf or for plain counts, whichever is more.

    An edit puts in rare words as a rule; by tf-idf alone a pair just above the
    threshold by its shingles would fall below it.
    """
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    best = 0.0
    for kind in (1, 2):
        shared = float(np.minimum(a[kind][i], b[kind][j]).sum())
        union = float(a[kind].sum() + b[kind].sum()) - shared
        best = max(best, shared / union if union else 0.0)
    return best


def overlaps(left: list[Vector], right: list[Vector]) -> tuple[np.ndarray, np.ndarray]:
    """What `left` and `right` share, by tf-idf and by counts, in single precision.

    A shingle that occurs t times is t features of the same weight, so the sum
    of the smaller weights is a product of two matrices of zeros and ones.
    """
    held = left + right
    sizes = np.array([int(v[2].sum()) for v in held])
    times = np.concatenate([v[2] for v in held]).astype("int64")
    weights = np.repeat(np.concatenate([v[1] for v in held]) / times, times)
    nth = np.arange(len(weights)) - np.repeat(np.cumsum(times) - times, times)
    names = np.repeat(np.concatenate([v[0] for v in held]), times) ^ (nth.astype("uint64") * np.uint64(MIX[2]))
    owner = np.repeat(np.arange(len(held)), sizes)
    order = np.argsort(names, kind="stable")
    names, owner, weights = names[order], owner[order], weights[order]
    starts = np.flatnonzero(np.append(True, names[1:] != names[:-1])[: len(names)])
    column = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(names))))
    # only what both sides have adds to a sum
    in_left = np.logical_or.reduceat(owner < len(left), starts)
    in_right = np.logical_or.reduceat(owner >= len(left), starts)
    both = in_left & in_right
    number = np.cumsum(both) - 1
    chosen = both[column]
    owner, column, weight = owner[chosen], number[column[chosen]], weights[starts[both]].astype("float32")
    by_weight, by_count = np.zeros((2, len(left), len(right)), "float32")
    for start in range(0, len(weight), FEATURES):
        lo, hi = np.searchsorted(column, [start, start + FEATURES])
        part = weight[start : start + FEATURES]
        has = np.zeros((len(held), len(part)), "float32")
        has[owner[lo:hi], column[lo:hi] - start] = 1
        a, b = has[: len(left)], has[len(left) :].T
        by_count += a @ b
        by_weight += (a * part) @ b
    return by_weight, by_count


def links(vectors: list[Vector], comps: np.ndarray, one_side: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Linked pairs that join all classes that any pair of `one_side` with any vector joins."""
    comps = comps.copy()
    rows = np.flatnonzero(one_side)
    sums = np.array([[v[1].sum(), v[2].sum()] for v in vectors], "float32")
    found = []
    shared = overlaps([vectors[i] for i in rows], vectors)
    best = np.zeros((len(rows), len(vectors)), "float32")
    for kind in (0, 1):
        union = sums[rows, kind][:, None] + sums[:, kind][None, :] - shared[kind]
        best = np.maximum(best, shared[kind] / np.maximum(union, 1e-9))
    for at, i in enumerate(rows):
        near = np.flatnonzero((best[at] >= threshold - NEAR) & (comps != comps[i]))
        while len(near):
            j, near = near[0], near[1:]
            if weighted_jaccard(vectors[i], vectors[j]) >= threshold:
                found.append((int(i), int(j)))
                comps[comps == comps[j]] = comps[i]
                near = near[comps[near] != comps[i]]
    return found


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Least node of each connected component: (node, comp) for all `nodes`, with edges (a, b).

    Labels take the least label across each edge and then that label's own
    label, so long chains shrink fast. Each round is written to the shared
    folder; what comes to the driver is one number.
    """
    labels = materialise(nodes.select("node", F.col("node").alias("comp")), "labels")
    both = materialise(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("other")), "b")
        least = near.groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other"))
        hooked = labels.join(least, "node", "left").select(
            "node", "comp", F.least("comp", F.coalesce("other", "comp")).alias("next")
        )
        hooked = materialise(hooked, "labels")
        jump = hooked.select(F.col("node").alias("next"), F.col("next").alias("after"))
        moved = (F.col("after") != F.col("comp")).alias("moved")
        jumped = hooked.join(jump, "next").select("node", F.col("after").alias("comp"), moved)
        labels = materialise(jumped, "labels")
        if not labels.where("moved").limit(1).count():
            return labels.select("node", "comp")


def crowded(rows: DataFrame) -> DataFrame:
    """Rows (bucket, node) of the buckets with more than one node, with their size; written once."""
    sizes = F.count(F.lit(1)).over(W.partitionBy("bucket"))
    return materialise(rows.withColumn("size", sizes).where(F.col("size") > 1), "bucket-members")


def near_duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Classes of documents linked by a weighted Jaccard similarity of at least `threshold`.

    Returns doc_id, text_key (md5 of the text), class_id (the least id of the
    class) and keeps (true for the row that stands for the class: the least
    id, then the least text_key). Equal texts are one node of the search.
    Every class of a bucket, at first each node, sends one member, chosen by
    hash, to be compared with the bucket's leader; so a group of copies costs
    one comparison for each member. A bucket of up to SMALL_BUCKET nodes that
    still has several classes is compared pair by pair. A larger one gets other
    leaders, which join most copies; if it still has several classes, its nodes
    are dealt into blocks and all nodes of different classes are compared, each
    pair of blocks as one product of small matrices. So every two nodes that
    share a band are compared or are in one class already. Unlike documents
    that crowd one bucket cost in step with the square of their number; rows
    sent are that square over BLOCK, and a task holds two blocks at a time.

    Null texts count as empty, and all texts without a word are one class;
    texts of fewer than five words are one shingle. Repeated rows are in one
    class and all marked alike. A class of null ids only has a null class_id.
    An empty table gives no rows; other columns are not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    base = base.withColumn("text_key", F.md5(F.col("text").cast("binary")))
    # bounded, see `word_weights`
    table = docs.sparkSession.sparkContext.broadcast(word_weights(base))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, sampler = Shingles(*table.value), Sampler()
        for batch in batches:
            held, size, begin = [], 0, 0
            texts = batch["text"].tolist()
            for at, text in enumerate(texts):
                held.append(shingles.of(text))
                size += len(held[-1][0])
                if size >= BATCH_SHINGLES or at == len(texts) - 1:
                    full = [i for i, v in enumerate(held) if len(v[0])]
                    bands = [[] for _ in held]
                    if full:
                        for i, row in zip(full, sampler.bands([held[i] for i in full]).tolist()):
                            bands[i] = row
                    yield batch.iloc[begin : at + 1][["doc_id", "text_key"]].assign(bands=bands)
                    held, size, begin = [], 0, at + 1

    signed = materialise(base.mapInPandas(sign, "doc_id long, text_key string, bands array<long>"), "signatures")
    nodes = signed.groupBy(F.col("text_key").alias("node")).agg(F.first("bands").alias("bands"))
    spots = nodes.select("node", F.posexplode("bands").alias("number", "band"))
    members = crowded(spots.select(F.xxhash64("number", "band").alias("bucket"), "node"))
    asked = members.select(F.col("node").alias("text_key")).distinct()
    # partly combined before the shuffle, so copies of one text do not meet in one task
    texts = base.groupBy("text_key").agg(F.first("text").alias("text")).join(asked, "text_key", "left_semi")
    texts = texts.withColumn("bytes", F.octet_length("text"))
    texts = materialise(texts, "bucket-texts")
    labels = materialise(asked.select(F.col("text_key").alias("node"), F.col("text_key").alias("comp")), "labels")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(*table.value)
        last: tuple = (None, None)
        for batch in batches:
            linked = []
            for a, b, text_a, text_b in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"]):
                if a != last[0]:
                    last = (a, shingles.of(text_a))
                linked.append(weighted_jaccard(last[1], shingles.of(text_b)) >= threshold)
            yield batch[["a", "b"]].assign(linked=linked)

    tested: DataFrame | None = None

    def compare(pairs: DataFrame) -> None:
        """Verify pairs that were not yet compared and join the classes of those that are linked."""
        nonlocal tested
        ordered = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        if tested is not None:
            ordered = ordered.join(tested, ["a", "b"], "left_anti")
        with_b = ordered.join(texts.select(F.col("text_key").alias("b"), F.col("text").alias("text_b")), "b")
        with_both = with_b.join(texts.select(F.col("text_key").alias("a"), F.col("text").alias("text_a")), "a")
        asked_pairs = with_both.select("a", "b", "text_a", "text_b")
        result = materialise(asked_pairs.mapInPandas(verify, "a string, b string, linked boolean"), "pairs")
        tested = result.select("a", "b") if tested is None else tested.union(result.select("a", "b"))
        join_classes(result.where("linked"))

    def join_classes(pairs: DataFrame) -> None:
        """Join the classes of linked pairs (a, b)."""
        nonlocal labels
        label = lambda end: labels.select(F.col("node").alias(end), F.col("comp").alias(f"{end}_comp"))
        linked = pairs.join(label("a"), "a").join(label("b"), "b")
        between = linked.select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b")).distinct()
        between = materialise(between, "links")
        if not between.limit(1).count():
            return
        ends = between.select(F.col("a").alias("node")).union(between.select(F.col("b").alias("node"))).distinct()
        moved = components(ends, between).select(F.col("node").alias("comp"), F.col("comp").alias("into"))
        joined = labels.join(moved, "comp", "left").select("node", F.coalesce("into", "comp").alias("comp"))
        labels = materialise(joined, "labels")

    def unsettled(rows: DataFrame) -> DataFrame:
        """Rows of the buckets that have several classes."""
        spread = rows.join(labels, "node").groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        return materialise(rows.join(spread.where("lo <> hi").select("bucket"), "bucket", "left_semi"), "open-buckets")

    def star(rows: DataFrame, seed: int) -> None:
        """Compare one node of each class of a bucket with the leader among them."""
        order = F.struct(F.xxhash64("node", "bucket", F.lit(seed)).alias("h"), "node")
        ones = rows.join(labels, "node").groupBy("bucket", "comp").agg(F.min(order).alias("one"))
        leaders = ones.groupBy("bucket").agg(F.min("one").alias("lead"))
        met = ones.join(leaders, "bucket").where(F.col("one.node") != F.col("lead.node"))
        compare(met.select(F.col("one.node").alias("x"), F.col("lead.node").alias("y")))

    def every_pair(rows: DataFrame) -> None:
        """Compare all nodes of different classes; for small buckets only."""
        left = rows.join(labels, "node").select("bucket", F.col("node").alias("x"), F.col("comp").alias("x_comp"))
        right = left.select("bucket", F.col("x").alias("y"), F.col("x_comp").alias("y_comp"))
        met = left.join(right, "bucket").where((F.col("x") < F.col("y")) & (F.col("x_comp") != F.col("y_comp")))
        compare(met.select("x", "y"))

    def settle(cell: pd.DataFrame) -> pd.DataFrame:
        """Links between two blocks, or within one; a node of the block `lo` is in each pair."""
        shingles = Shingles(*table.value)
        vectors = [shingles.of(text) for text in cell["text"]]
        comps = pd.factorize(cell["comp"])[0]
        one_side = (cell["block"] == cell["lo"]).to_numpy()
        found = links(vectors, comps, one_side, threshold) if one_side.any() and len(set(comps)) > 1 else []
        node = cell["node"].tolist()
        return pd.DataFrame([(node[i], node[j]) for i, j in found], columns=["a", "b"])

    def blocks(rows: DataFrame) -> None:
        """Compare all nodes of different classes of a bucket, block by block.

        The largest class needs no comparison with itself: its blocks are
        numbered last and meet those of the others only.
        """
        sized = rows.select("bucket", "node").join(labels, "node").join(
            texts.select(F.col("text_key").alias("node"), "bytes"), "node"
        )
        sized = materialise(sized, "block-nodes")
        parts = sized.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
        parts = materialise(parts, "block-classes")
        whole = parts.groupBy("bucket").agg(
            F.max(F.struct("n", "comp", "bytes")).alias("main"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes")
        )
        number = lambda n, size: F.ceil(F.greatest(n / BLOCK, size / BLOCK_BYTES)).cast("int")
        rest = number(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes"))
        plan = whole.select(
            "bucket", F.col("main.comp").alias("largest"), rest.alias("rest"), number(F.col("main.n"), F.col("main.bytes")).alias("own")
        )
        placed = sized.select("bucket", "node", "comp").join(plan, "bucket")
        deal, in_largest = F.xxhash64("node", "bucket"), F.col("comp") == F.col("largest")
        block = F.when(in_largest, F.col("rest") + F.pmod(deal, "own")).otherwise(F.pmod(deal, "rest")).cast("int")
        others = F.when(in_largest, F.col("rest")).otherwise(F.col("rest") + F.col("own"))
        dealt = placed.select("bucket", "node", "comp", block.alias("block"), F.explode(F.sequence(F.lit(0), others - 1)).alias("other"))
        dealt = dealt.select(
            "bucket", "node", "comp", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
        )
        cells = dealt.join(texts.select(F.col("text_key").alias("node"), "text"), "node")
        found = cells.groupBy("bucket", "lo", "hi").applyInPandas(settle, "a string, b string")
        join_classes(materialise(found.distinct(), "block-links"))

    star(members, 0)
    still = unsettled(members.where(F.col("size") > 2))
    every_pair(still.where(F.col("size") <= SMALL_BUCKET))
    large = still.where(F.col("size") > SMALL_BUCKET)
    for seed in range(1, STARS + 1):
        large = unsettled(large)
        if not large.limit(1).count():
            break
        star(large, seed)
    large = unsettled(large)
    if large.limit(1).count():
        blocks(large)

    grouped = signed.select("doc_id", "text_key").join(labels.withColumnRenamed("node", "text_key"), "text_key", "left")
    grouped = grouped.withColumn("comp", F.coalesce("comp", "text_key"))
    standing = grouped.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first"))
    named = grouped.join(standing, "comp")
    first = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_key") == F.col("text_key"))
    return named.select("doc_id", "text_key", F.col("first.doc_id").alias("class_id"), first.alias("keeps"))
