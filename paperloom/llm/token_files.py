"""Token files: documents in id order, coded in independent blocks by a static range asymmetric numeral system.

A block holds whole documents. Its ids are dealt to LANES interleaved coders
(id i belongs to lane i mod LANES), each with a 64-bit state that gives off
32-bit words into one common stream. All blocks share one frequency table.
Every CHECK_STEPS rounds the states and the place in the stream are noted, so a
reader can start there as well as at the beginning; the words of each segment
between two such checkpoints have a CRC-32.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paperloom.llm.common import range_bounds, range_of, shuffle_width
from paperloom.llm.tokens import ByteLevelEncoder, worker_encoder
from paperloom.session import fresh_path

BLOCK_TOKENS = 1 << 19
LANES = 2048
CHECK_STEPS = 128
SCALE_BITS = 20
LOW = np.uint64(1 << 31)
WORD_BITS = np.uint64(32)
RAW_SCHEMA = "range int, first long, doc_ids binary, null_ids binary, lengths binary, ids binary, counts binary"
RAW_FIELDS = pa.schema(
    [("range", pa.int32()), ("first", pa.int64())]
    + [(name, pa.binary()) for name in ("doc_ids", "null_ids", "lengths", "ids", "counts")]
)
BATCH_TEXTS = 128
BLOCK_SCHEMA = (
    "first_token long, n_tokens long, doc_ids binary, null_ids binary, lengths binary, "
    "words binary, ends binary, states binary, checksums binary"
)


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a total of 2**SCALE_BITS; every id that occurs keeps at least one."""
    counts = counts.astype("float64")
    total = 1 << SCALE_BITS
    if not counts.sum():
        return np.zeros(len(counts), "uint64")
    scaled = np.where(counts > 0, np.maximum(1, np.floor(counts * total / counts.sum())), 0).astype("int64")
    excess = int(scaled.sum()) - total
    order = np.argsort(-scaled, kind="stable")
    while excess:  # the most frequent ids give or take the rest, each at most half of its share in a pass
        for at in order:
            step = min(excess, int(scaled[at]) // 2) if excess > 0 else excess
            if excess > 0 and step <= 0:
                break
            scaled[at] -= step
            excess -= step
            if not excess:
                break
    return scaled.astype("uint64")


class Coder:
    """Encodes and decodes blocks with one frequency table."""

    def __init__(self, frequencies: np.ndarray):
        self.freq = frequencies.astype("uint64")
        self.start = (np.cumsum(self.freq) - self.freq).astype("uint64")
        self.symbol = np.repeat(np.arange(len(self.freq), dtype="uint32"), self.freq.astype("int64"))
        self.limit = self.freq << np.uint64(63 - SCALE_BITS)

    def encode(self, ids: np.ndarray) -> dict[str, bytes]:
        """The ids from last to first, so that a reader gets them in order."""
        steps = -(-len(ids) // LANES)
        states = np.full(LANES, LOW, "uint64")
        parts, at, noted, ends = [], 0, [], []
        freq, start, limit, bits = self.freq[ids], self.start[ids], self.limit[ids], np.uint64(SCALE_BITS)
        for step in range(steps - 1, -1, -1):
            one = slice(step * LANES, min(len(ids), (step + 1) * LANES))
            f, x = freq[one], states[: one.stop - one.start]
            full = x >= limit[one]
            if full.any():
                parts.append(x[full].astype("uint32"))
                at += len(parts[-1])
                x[full] >>= WORD_BITS
            quotient = x // f
            states[: len(x)] = (quotient << bits) + (x - quotient * f) + start[one]
            if step % CHECK_STEPS == 0:
                noted.append(states.copy())
                ends.append(at)
        # a reader takes the words of a round in lane order and the rounds backwards
        words = np.concatenate(parts[::-1]) if parts else np.zeros(0, "uint32")
        ends = [at - e for e in ends[::-1]] + [at]  # where each segment begins, and the end
        raw = words.astype("<u4")
        return {
            "words": raw.tobytes(),
            "ends": np.array(ends, "<i8").tobytes(),
            "states": np.array(noted[::-1], "<u8").tobytes(),
            "checksums": np.array(
                [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(ends, ends[1:])], "<u4"
            ).tobytes(),
        }

    def segments(self, block: dict[str, bytes]) -> int:
        return len(block["ends"]) // 8 - 1 if block["ends"] else 0

    def decode_segment(self, block: dict[str, bytes], number: int, n_tokens: int) -> np.ndarray:
        """The ids between two checkpoints; raises if the words are damaged."""
        ends = np.frombuffer(block["ends"], "<i8")
        words = np.frombuffer(block["words"], "<u4")[ends[number] : ends[number + 1]]
        if zlib.crc32(words.tobytes()) != np.frombuffer(block["checksums"], "<u4")[number]:
            raise ValueError("token block is damaged: checksum of a segment differs")
        states = np.frombuffer(block["states"], "<u8").reshape(-1, LANES)[number].copy()
        first = number * CHECK_STEPS * LANES
        out = np.empty(min(n_tokens - first, CHECK_STEPS * LANES), "uint32")
        bits, mask, at = np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1), 0
        wide = words.astype("uint64")
        for begin in range(0, len(out), LANES):
            x = states[: min(LANES, len(out) - begin)]
            slot = x & mask
            ids = self.symbol[slot]
            out[begin : begin + len(x)] = ids
            x[:] = self.freq[ids] * (x >> bits) + slot - self.start[ids]
            low = x < LOW
            n = int(np.count_nonzero(low))
            if n:
                x[low] = (x[low] << WORD_BITS) | wide[at : at + n]
                at += n
        return out

    def decode(self, block: dict[str, bytes], n_tokens: int) -> np.ndarray:
        parts = [self.decode_segment(block, i, n_tokens) for i in range(self.segments(block))]
        return np.concatenate(parts) if parts else np.zeros(0, "uint32")


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Tokenise every whole text, append `end_id`, and write `path`/blocks and `path`/frequencies.

    Documents lie in ascending id order, null ids first, equal ids by text; a
    block closes once it has `block_tokens` ids, so only a longer document
    makes a larger one. Null and empty texts are the end id alone; repeated
    rows are documents of their own. An empty table writes no blocks. Other
    columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = shuffle_width(spark)
    bounds = range_bounds(base, "id", parts)
    ranged = base.withColumn("range", range_of(F.col("id"), bounds)).repartition(parts, "range")
    ordered = ranged.sortWithinPartitions("range", F.col("id").asc_nulls_first(), "text")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, current, first = worker_encoder(tokenizer_path), None, 0
        ids: list[np.ndarray] = []
        owners: list[tuple[int, bool]] = []
        end, seen = np.array([end_id], "<u4"), np.zeros(0, "int64")

        def block() -> pa.RecordBatch:
            nonlocal seen
            lengths = np.array([len(x) for x in ids], "<i8")
            whole = np.concatenate(ids)
            own = np.bincount(whole)
            if len(own) > len(seen):
                own, seen = seen, own
            seen[: len(own)] += own
            row = {
                "range": current,
                "first": first,
                "doc_ids": np.array([o for o, _ in owners], "<i8").tobytes(),
                "null_ids": np.array([n for _, n in owners], "u1").tobytes(),
                "lengths": lengths.tobytes(),
                "ids": whole.astype(encoder.width).tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], schema=RAW_FIELDS)

        def tally() -> pa.RecordBatch:
            """A last row that holds no block but how often each id occurs in the task's blocks."""
            used = np.flatnonzero(seen)
            row = {"counts": np.stack([used, seen[used]]).astype("<i8").tobytes()}
            return pa.RecordBatch.from_pylist([{**dict.fromkeys(RAW_FIELDS.names), **row}], schema=RAW_FIELDS)

        held = 0
        # a few texts at a time become Python strings
        pieces = (b.slice(at, BATCH_TEXTS).to_pydict() for b in batches for at in range(0, b.num_rows, BATCH_TEXTS))
        for piece in pieces:
            for number, doc_id, text in zip(piece["range"], piece["id"], piece["text"]):
                if ids and (number != current or held >= block_tokens):
                    yield block()
                    first, ids, owners, held = first + held, [], [], 0
                if number != current:
                    current, first = number, 0
                ids.append(np.concatenate([encoder.encode(text).astype("<u4"), end]))
                owners.append((doc_id or 0, doc_id is None))
                held += len(ids[-1])
        if ids:
            yield block()
        yield tally()

    width = "<u2" if _fits_two_bytes(tokenizer_path, end_id) else "<u4"
    raw_path = fresh_path(spark, "raw-ids")
    ordered.mapInArrow(tokenise, RAW_SCHEMA).write.option("compression", "zstd").parquet(raw_path)
    written = spark.read.schema(RAW_SCHEMA).parquet(raw_path)
    raw = written.where(F.col("ids").isNotNull()).drop("counts")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pairs in batch["counts"]:
                used, times = np.frombuffer(pairs, "<i8").reshape(2, -1)
                yield pd.DataFrame({"id": used, "n": times})

    tallies = written.where(F.col("counts").isNotNull()).select("counts")
    counted = tallies.mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = counted.collect()  # one row for each id of the vocabulary that occurs
    counts = np.zeros(max((r["id"] for r in rows), default=-1) + 1, "int64")
    for r in rows:
        counts[r["id"]] = r["n"]
    frequencies = scaled_frequencies(counts)
    table = [(int(i), int(f)) for i, f in enumerate(frequencies) if f]
    spark.createDataFrame(table, "id long, frequency long").coalesce(1).write.parquet(f"{path}/frequencies")
    per_range = raw.groupBy("range").agg(F.sum(F.octet_length("ids")).alias("bytes")).collect()  # one row for each range
    start, offsets = 0, {}
    for r in sorted(per_range, key=lambda r: r["range"]):
        offsets[r["range"]] = start
        start += r["bytes"] // np.dtype(width).itemsize

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(frequencies)
        for batch in batches:
            for r in batch.itertuples():
                ids = np.frombuffer(r.ids, width).astype("int64")
                row = {"first_token": offsets[r.range] + r.first, "n_tokens": len(ids)}
                row |= {"doc_ids": r.doc_ids, "null_ids": r.null_ids, "lengths": r.lengths} | coder.encode(ids)
                yield pd.DataFrame([row])

    raw.mapInPandas(encode, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")


def _fits_two_bytes(tokenizer_path: str, end_id: int) -> bool:
    return ByteLevelEncoder(tokenizer_path).width == "<u2" and end_id < 1 << 16


def read_token_files(spark, path: str) -> DataFrame:
    """Documents of token files, decoded and checked: doc_id, start (ids before it), ids (little-endian 32-bit)."""
    table = spark.read.parquet(f"{path}/frequencies").collect()  # one row for each id of the vocabulary
    frequencies = np.zeros(max((r["id"] for r in table), default=-1) + 1, "uint64")
    for r in table:
        frequencies[r["id"]] = r["frequency"]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(frequencies)
        for batch in batches:
            for block in batch.to_dict("records"):
                ids = coder.decode(block, block["n_tokens"]).astype("<u4")
                lengths = np.frombuffer(block["lengths"], "<i8")
                ends = np.cumsum(lengths)
                doc_ids = pd.array(np.frombuffer(block["doc_ids"], "<i8"), "Int64")
                doc_ids[np.frombuffer(block["null_ids"], "u1") == 1] = pd.NA
                yield pd.DataFrame(
                    {
                        "doc_id": doc_ids,
                        "start": block["first_token"] + ends - lengths,
                        "ids": [ids[a:b].tobytes() for a, b in zip(ends - lengths, ends)],
                    }
                )

    return spark.read.parquet(f"{path}/blocks").mapInPandas(decode, "doc_id long, start long, ids binary")


def token_file_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write token files to a fresh folder in the shared storage and read the documents back."""
    spark = docs.sparkSession
    path = fresh_path(spark, "token-files")
    write_token_files(docs, tokenizer_path, end_id, path)
    return read_token_files(spark, path)
