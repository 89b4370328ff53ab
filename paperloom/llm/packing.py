"""First-fit-decreasing packing of token pieces into sequences, in randomised groups of documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from paperloom.llm.tokens import worker_encoder

SEQUENCE_TOKENS = 2048
GROUP_DOCUMENTS = 4096
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
BIN_BITS = 32


class CapacityTree:
    """A tournament tree of what is left in each bin; finds the first bin that a piece fits in logarithmic time."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.most = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """The first bin with enough room, and the place in it counted from what was left: (bin, room before)."""
        most, node = self.most, 1
        while node < self.leaves:
            node *= 2
            if most[node] < length:
                node += 1
        room = most[node]
        most[node] = room - length
        leaf = node
        while node > 1:
            node //= 2
            left, right = most[2 * node], most[2 * node + 1]
            most[node] = left if left >= right else right
        return leaf - self.leaves, room


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each piece: longest first, equal lengths in the given order; full pieces have their own bin."""
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    full = 0
    while full < len(order) and lengths[order[full]] == capacity:
        out[order[full]] = (full, 0)
        full += 1
    tree = CapacityTree(max(1, len(order) - full), capacity)
    for i in order[full:]:
        number, room = tree.place(lengths[i])
        out[i] = (full + number, capacity - room)
    return out


def pack_sequences(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = SEQUENCE_TOKENS,
    group_documents: int = GROUP_DOCUMENTS,
    with_ids: bool = True,
) -> DataFrame:
    """Cut every tokenised document into pieces of at most `capacity` ids and pack the pieces into sequences.

    Each document is its ids followed by `end_id`. Groups of about
    `group_documents` documents, chosen by hash, are packed on their own by
    first-fit decreasing, so nothing is sorted or packed as a whole, and a
    group has at most one shorter piece of each of its documents. Full pieces
    are spread over the groups one by one, and long texts make more groups, so
    a group has about that many pieces however long a document is. Returns
    doc_id, start, length, ids_crc32 (of the ids as little-endian 32-bit
    integers), doc_tokens, sequence_id, offset and, if asked for, the ids
    themselves (the same integers as bytes).

    Null and empty texts are the end id alone. Repeated ids and rows are
    documents of their own and are spread over groups. An empty table gives no
    rows; other columns are not read.
    """
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text_col)).alias("bytes")).first()
    # an id stands for a byte at least, so a text has no more full pieces than this
    groups = max(1, -(-size["n"] // group_documents), -(-(size["bytes"] or 0) // (group_documents * capacity)))

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, number = worker_encoder(tokenizer_path), 0
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["id"].tolist(), batch["text"].tolist()):
                ids = np.append(encoder.encode(text or "").astype("<u4"), np.uint32(end_id)).astype("<u4")
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                number += 1  # keeps apart rows that are equal in all else
                key = f"{doc_id} {len(ids)} {zlib.crc32(ids)} {number}"
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    raw = part.tobytes()
                    own = f"{key} {start}" if len(part) == capacity else key
                    group = xxhash.xxh3_64_intdigest(own) % groups
                    out.append(
                        (doc_id, start, len(part), zlib.crc32(raw), len(ids), raw if with_ids else None, group)
                    )
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "group"]
            frame = pd.DataFrame(out, columns=names)
            yield frame.astype({"doc_id": "Int64"})

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start", "doc_tokens", "ids_crc32"], kind="stable")
        placed = np.array(first_fit_decreasing(group["length"].tolist(), capacity), "int64").reshape(-1, 2)
        packed = group.drop(columns="group")
        packed["sequence_id"] = group["group"].astype("int64") * (1 << BIN_BITS) + placed[:, 0]
        packed["offset"] = placed[:, 1]
        return packed

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    cut = texts.mapInPandas(pieces, f"{PIECE_SCHEMA}, group long")
    packed = cut.groupBy("group").applyInPandas(pack, f"{PIECE_SCHEMA}, sequence_id long, offset long")
    return packed if with_ids else packed.drop("ids")
