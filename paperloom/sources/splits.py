"""Large text files, read by many tasks although a record may be many lines and its border depends on all before it.

A file is cut into splits of lines. What a run of lines does to the state of a
reader (inside quotes or not; how deep in braces) is a small function that can
be put together from parts, so:

1. each split is summarised as one such function, whatever state it begins in;
2. the functions of a file's splits are applied in order, which gives the true
   state at the beginning of every split;
3. each split is read again from there: lines before its first record belong to
   a record of an earlier split, whole records are given out, and the last one
   may be open;
4. open records and the lines that continue them, two pieces for each split at
   most, are put together.

Only the summaries, one row for each split, reach the driver, which plans the
splits anyway.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from paperloom.session import materialise

WHOLE, HEAD, OPEN = 0, 1, 2
RECORD_SCHEMA = "path string, block long, number long, kind int, text string"
OUTPUT_ROWS = 4096


class Borders(ABC):
    """How lines change the state of a reader. States are whole numbers, 0 at the beginning of a file."""

    @abstractmethod
    def summarise(self, lines: pa.StringArray) -> tuple[int, int]:
        """What the lines do to any state, as two numbers."""

    @abstractmethod
    def join(self, first: tuple[int, int], then: tuple[int, int]) -> tuple[int, int]:
        """What two runs of lines do one after the other."""

    @abstractmethod
    def apply(self, effect: tuple[int, int], state: int) -> int:
        """The state after lines with this effect."""

    @abstractmethod
    def starts(self, lines: pa.StringArray, state: int) -> np.ndarray:
        """Whether a record begins with each line, if the first line is met in `state`."""

    #: what does nothing
    nothing: tuple[int, int] = (0, 0)


class Quotes(Borders):
    """Delimited text: a line begins a record if the quotes before it are even in number. Effects are (parity, 0)."""

    def __init__(self, quote: str = '"'):
        self.quote = quote

    def _counts(self, lines: pa.StringArray) -> np.ndarray:
        return pc.count_substring(lines, self.quote).to_numpy(zero_copy_only=False)

    def summarise(self, lines: pa.StringArray) -> tuple[int, int]:
        return int(self._counts(lines).sum()) % 2, 0

    def join(self, first: tuple[int, int], then: tuple[int, int]) -> tuple[int, int]:
        return first[0] ^ then[0], 0

    def apply(self, effect: tuple[int, int], state: int) -> int:
        return state ^ effect[0]

    def starts(self, lines: pa.StringArray, state: int) -> np.ndarray:
        counts = self._counts(lines)
        return (np.cumsum(counts) - counts + state) % 2 == 0


class Braces(Borders):
    """Entries in braces: a line begins one if it looks like it and no brace is open before it.

    A line that begins with a known type does so even if one is: the entry
    before it never ended. Depth never falls below zero, whatever closes in the
    text between entries. An effect (a, b) takes depth x to max(x + a, b); a
    line that begins whatever the depth is the constant b, written as (NEVER, b).
    """

    NEVER = -(1 << 40)

    def __init__(self, pattern: str, sure: str):
        self.pattern, self.sure = pattern, sure

    nothing = (0, 0)

    def _parts(self, lines: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """By line: opening and closing braces, whether it looks like a beginning, whether it is one for sure."""
        opening = pc.count_substring(lines, "{").to_numpy(zero_copy_only=False)
        closing = pc.count_substring(lines, "}").to_numpy(zero_copy_only=False)
        like = pc.match_substring_regex(lines, self.pattern).to_numpy(zero_copy_only=False)
        sure = pc.match_substring_regex(lines, self.sure).to_numpy(zero_copy_only=False)
        return opening.astype("int64"), closing.astype("int64"), like, sure & like

    def _walk(self, lines: pa.StringArray, low: int, shift: int, flags: np.ndarray | None, state: int) -> tuple[int, int, int]:
        opening, closing, like, sure = self._parts(lines)
        busy = np.flatnonzero((opening > 0) | (closing > 0) | like)
        a, b, depth = shift, low, state
        texts = lines.take(pa.array(busy)).to_pylist()
        for at, text in zip(busy.tolist(), texts):
            if like[at] and flags is not None and (depth == 0 or sure[at]):
                flags[at] = True
            if sure[at]:
                a, b, depth = self.NEVER, 0, 0
            if opening[at] and closing[at]:
                marks = [1 if c == "{" else -1 for c in text if c in "{}"]
            else:
                marks = [int(opening[at] - closing[at])]
            for m in marks:
                a, b, depth = max(a + m, self.NEVER), max(b + m, 0), max(depth + m, 0)
        return a, b, depth

    def summarise(self, lines: pa.StringArray) -> tuple[int, int]:
        a, b, _ = self._walk(lines, 0, 0, None, 0)
        return a, b

    def join(self, first: tuple[int, int], then: tuple[int, int]) -> tuple[int, int]:
        return max(first[0] + then[0], self.NEVER), max(first[1] + then[0], then[1])

    def apply(self, effect: tuple[int, int], state: int) -> int:
        return max(state + effect[0], effect[1])

    def starts(self, lines: pa.StringArray, state: int) -> np.ndarray:
        flags = np.zeros(len(lines), bool)
        self._walk(lines, 0, 0, flags, state)
        return flags


def split_lines(spark: SparkSession, path: str, names: str = "*") -> DataFrame:
    """(path, block, value): the lines of all files, in the order of their split, without their line feed."""
    lines = spark.read.text(path, lineSep="\n", pathGlobFilter=names)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.StringArray]]:
    """The lines of each batch, cut where another split begins."""
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column("path").dictionary_encode()
        place = codes.indices.to_numpy(zero_copy_only=False)
        block = batch.column("block").to_numpy()
        cuts = np.flatnonzero((block[1:] != block[:-1]) | (place[1:] != place[:-1])) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            lines = batch.column("value").slice(start, end - start)
            yield (codes.dictionary[int(place[start])].as_py(), int(block[start])), lines


def split_states(lines: DataFrame, borders: Borders) -> dict[tuple[str, int], int]:
    """The state in which each split begins."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], tuple[int, int]] = {}
        for key, run in _runs(batches):
            effect = borders.summarise(run)
            held[key] = borders.join(held[key], effect) if key in held else effect
        rows = [{"path": p, "block": b, "x": e[0], "y": e[1]} for (p, b), e in held.items()]
        schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("x", pa.int64()), ("y", pa.int64())])
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    found = lines.mapInArrow(summarise, "path string, block long, x long, y long").collect()  # a row for each split
    states, state, path = {}, 0, None
    for row in sorted(found, key=lambda r: (r["path"], r["block"])):
        if row["path"] != path:
            path, state = row["path"], 0
        states[(path, row["block"])] = state
        state = borders.apply((row["x"], row["y"]), state)
    return states


def split_records(lines: DataFrame, borders: Borders) -> DataFrame:
    """(path, block, number, text): the records of all files in order of block and number; text before the first is dropped.

    Pieces are written once to the shared folder. A record spans as many splits
    as it likes; it is put together in one task, as any record is in the end.
    """
    spark = lines.sparkSession
    states = spark.sparkContext.broadcast(split_states(lines, borders))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("path", pa.string()), ("block", pa.int64()), ("number", pa.int64()), ("kind", pa.int32()), ("text", pa.string())]
        )
        key, state, number, waiting, kind = None, 0, 0, [], HEAD
        out: list[tuple] = []

        def close(last: bool) -> None:
            """Give out the lines held so far; the last of a split may go on in the next one."""
            nonlocal waiting, number
            if waiting:
                out.append((*key, number, OPEN if last and kind == WHOLE else kind, "\n".join(waiting)))
                number += 1
            waiting = []

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), schema)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for own, run in _runs(batches):
            if own != key:
                if key is not None:
                    close(last=True)
                key, state, number, kind = own, states.value[own], 0, HEAD
            flags = borders.starts(run, state)
            state = borders.apply(borders.summarise(run), state)
            texts = run.to_pylist()
            at = 0
            for start in np.flatnonzero(flags).tolist():
                waiting += texts[at:start]
                close(last=False)
                kind, at = WHOLE, start
                if len(out) >= OUTPUT_ROWS:
                    yield flush()
            waiting += texts[at:]
        if key is not None:
            close(last=True)
        if out:
            yield flush()

    pieces = materialise(lines.mapInArrow(cut, RECORD_SCHEMA), "record-pieces")
    # two pieces for each split at most; a head comes before the record that its split leaves open
    ends = pieces.where(F.col("kind") != WHOLE)
    before = W.partitionBy("path").orderBy("block", "number").rowsBetween(W.unboundedPreceding, 0)
    opener = F.last(F.when(F.col("kind") == OPEN, F.struct("block", "number")), ignorenulls=True).over(before)
    owned = ends.withColumn("opener", opener).where(F.col("opener").isNotNull())
    parts = F.array_sort(F.collect_list(F.struct("block", "number", "text")))
    joined = owned.groupBy("path", "opener").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    whole = pieces.where(F.col("kind") == WHOLE).select("path", "block", "number", "text")
    return whole.unionByName(joined.select("path", "opener.block", "opener.number", "text"))
