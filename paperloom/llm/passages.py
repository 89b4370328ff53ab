"""Removal of repeated passages: super-k-mers of words, dealt to buckets by their minimiser.

A window is WINDOW consecutive words; its minimiser is the least hash among its
runs of GRAM words. Consecutive windows with the same minimiser at the same
place form a super-k-mer, which travels as one packed string. Equal windows
have equal minimisers, so they meet in one bucket, where sorting finds them
exactly. A minimiser that occurs once in the corpus has no repeated window, so
only its hash is sent, not its words. The windows of a minimiser with more than
HOT_RUNS super-k-mers are dealt one by one, by a hash of their words, so a line
in many different surroundings does not gather all of them in one bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from paperloom.llm.common import by_rows
from paperloom.session import fresh_path, materialise

WINDOW = 20
GRAM = 4
PLACE_BITS = 20  # low bits of a minimiser hold its place, so that each occurrence begins a run of its own
RUN_BITS = 8
BATCH_TEXTS = 256
BUCKET_RUNS = 20_000
HOT_RUNS = 2_000  # super-k-mers of a minimiser from which on its windows are dealt by their own hash
SEEN_BYTES = 48 << 20  # packed strings that a task remembers to settle repeats before the shuffle
CACHED_WORDS = 300_000
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8: runs of characters other than space, tab, line feed, vertical tab, form feed, carriage return."""
    return (text or "").encode().split()


class WordHashes(dict):
    """64-bit hash of each word; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def super_kmers(words: list[bytes], hashes: WordHashes, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of each super-k-mer of a text."""
    n = len(words) - window + 1
    if n < 1:
        none = np.zeros(0, "int64")
        return none, none, none
    word = np.fromiter(map(hashes.__getitem__, words), "uint64", len(words))
    gram = min(GRAM, window)
    count = len(words) - gram + 1
    mixed = np.zeros(count, "uint64")
    for i in range(gram):
        mixed = (mixed ^ word[i : i + count]) * np.uint64(MIX[i])
        mixed ^= mixed >> np.uint64(31)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    placed = (mixed & ~mask) | (np.arange(count, dtype="uint64") & mask)
    span, least, width = window - gram + 1, placed, 1
    while width * 2 <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:n], least[span - width : span - width + n])
    change = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    return (least[change] >> np.uint64(PLACE_BITS)).astype("int64"), change, np.diff(np.append(change, n))


def window_strings(packed: bytes, window: int) -> list[bytes]:
    """Every window of a packed string of words, as a slice of it."""
    raw = np.frombuffer(packed, "u1")
    gaps = np.flatnonzero(raw == 32)
    starts = np.append(0, gaps + 1).tolist()
    ends = np.append(gaps, len(raw)).tolist()
    return [packed[starts[i] : ends[i + window - 1]] for i in range(len(starts) - window + 1)]


def repeated_windows(bucket: pd.DataFrame, window: int) -> pd.DataFrame:
    """Windows of a bucket that also start earlier, as runs (k, oid, tie, start, n).

    Rows without words were settled before they were sent and pass through.
    """
    settled = bucket[bucket["words"].isna()]
    open_rows = bucket[bucket["words"].notna()].sort_values(["oid", "tie", "first"], kind="stable")
    windows: list[bytes] = []
    rows: list[int] = []
    starts: list[int] = []
    for at, (packed, first) in enumerate(zip(open_rows["words"], open_rows["first"].tolist())):
        found = window_strings(bytes(packed), window)
        windows += found
        rows += [at] * len(found)
        starts += range(first, first + len(found))
    # the sort is stable: of equal windows the earliest comes first
    order = sorted(range(len(windows)), key=windows.__getitem__)
    again = np.zeros(len(windows), bool)
    for before, here in zip(order, order[1:]):
        again[here] = windows[before] == windows[here]
    at, start = np.array(rows, "int64")[again], np.array(starts, "int64")[again]
    begin = np.flatnonzero(np.append(True, (np.diff(at) != 0) | (np.diff(start) != 1)))[: len(at)]
    keys = open_rows.iloc[at[begin]][["k", "oid", "tie"]].reset_index(drop=True)
    keys["start"] = start[begin]
    keys["n"] = np.diff(np.append(begin, len(at)))
    passed = settled[["k", "oid", "tie"]].assign(start=settled["first"], n=settled["n"])
    return pd.concat([keys, passed], ignore_index=True)


def remove_repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    keep: tuple[str, ...] = (),
    as_written: bool = False,
) -> DataFrame:
    """Remove each word covered by a window of words that also starts earlier: doc_id, n_words, n_removed, kept_text, `keep`.

    Earlier is a smaller id, or the same document and an earlier start; windows
    are judged on the input. kept_text has the remaining words joined by one
    space; with `as_written` a text that loses no word stays as it is.

    Null and empty texts have no words; a text of fewer than `window` words
    stays. Null ids come before all others; rows with equal ids are ordered by
    a hash of the text, and of identical rows only one is the first. An empty
    table gives no rows. `keep` must not name added columns.
    """
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), *[c for c in keep if c != "doc_id"], F.col(text_col).alias("text")
    )
    kept_names = [f.name for f in base.schema.fields if f.name != "text"]
    keyed = base.select(
        F.xxhash64("doc_id", "text").alias("k"),
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("oid"),
        F.xxhash64("text", F.col("doc_id").isNull()).alias("tie"),
        "text",
        F.struct(*kept_names).alias("row"),
    )

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for piece in by_rows(batches, BATCH_TEXTS):
            found = [super_kmers(words_of(text), hashes, window) for text in piece["text"]]
            sizes = [len(m) for m, _, _ in found]
            if sum(sizes):
                yield pd.DataFrame(
                    {
                        "mini": np.concatenate([m for m, _, _ in found]),
                        "k": np.repeat(piece["k"].to_numpy(), sizes),
                        "at": np.concatenate([(f << RUN_BITS) | n for _, f, n in found]),
                    }
                )

    path = fresh_path(docs.sparkSession, "super-kmers")
    found_runs = keyed.select("k", "text").mapInPandas(heads, "mini long, k long, at long")
    found_runs.write.option("compression", "zstd").parquet(path)
    runs = docs.sparkSession.read.schema(found_runs.schema).parquet(path)
    n_windows = F.sum(F.col("at").bitwiseAND((1 << RUN_BITS) - 1)).alias("windows")
    counts = materialise(
        runs.groupBy("mini").agg(F.count(F.lit(1)).alias("c"), n_windows).where(F.col("c") > 1), "minimisers"
    )
    hot = F.col("c") > HOT_RUNS
    dealt_singly = counts.where(hot).agg(F.coalesce(F.sum("windows"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, -(-(runs.count() + dealt_singly) // BUCKET_RUNS))
    repeated = counts.select("mini", hot.alias("hot"))
    wanted = runs.join(repeated, "mini").groupBy("k").agg(F.collect_set(F.struct("at", "mini", "hot")).alias("wanted"))

    # one row for each distinct (id, text); dealt out by k once, for both joins below
    dealt = keyed.repartition("k")
    texts = dealt.groupBy("k", "oid", "tie").agg(F.first("text").alias("text"), F.collect_list("row").alias("rows"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, tuple] = {}
        held = 0

        def earlier(string: bytes, place: tuple) -> bool:
            """Whether the task has sent the string from an earlier place; else this place is remembered."""
            nonlocal held
            before = seen.get(string)
            if before is not None and before < place:
                return True
            if before is None:
                held += len(string) + 200
                if held > SEEN_BYTES:
                    seen.clear()
                    held = 0
            seen[string] = place
            return False

        for piece in by_rows(batches, BATCH_TEXTS):
            out = []
            for k, oid, tie, text, asked in zip(piece["k"], piece["oid"], piece["tie"], piece["text"], piece["wanted"]):
                words = words_of(text)
                for run in asked:
                    first, n = run["at"] >> RUN_BITS, run["at"] & ((1 << RUN_BITS) - 1)
                    if first + n + window - 1 > len(words):
                        continue  # of another text with the same key
                    packed = b" ".join(words[first : first + n + window - 1])
                    if earlier(packed, (oid, tie, first)):
                        out.append((k % buckets, k, oid, tie, first, n, None))
                    elif not run["hot"]:
                        out.append((run["mini"] % buckets, k, oid, tie, first, n, packed))
                    elif n == 1:
                        out.append((xxhash.xxh3_64_intdigest(packed) % buckets, k, oid, tie, first, 1, packed))
                    else:
                        for at, string in enumerate(window_strings(packed, window), first):
                            if earlier(string, (oid, tie, at)):
                                out.append((k % buckets, k, oid, tie, at, 1, None))
                            else:
                                bucket = xxhash.xxh3_64_intdigest(string) % buckets
                                out.append((bucket, k, oid, tie, at, 1, string))
            yield pd.DataFrame(out, columns=["bucket", "k", "oid", "tie", "first", "n", "words"])

    # with all columns, so that the exchange of texts is the same as in the last join and is made once
    joined = texts.join(wanted, "k")
    packed = joined.mapInPandas(pack, "bucket long, k long, oid long, tie long, first long, n long, words binary")
    found = packed.groupBy("bucket").applyInPandas(
        lambda bucket: repeated_windows(bucket, window), "k long, oid long, tie long, start long, n long"
    )
    per_text = found.groupBy("k").agg(F.collect_list(F.struct("oid", "tie", "start", "n")).alias("again"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in by_rows(batches, BATCH_TEXTS):
            n_words, n_removed, kept = [], [], []
            for oid, tie, text, again in zip(piece["oid"], piece["tie"], piece["text"], piece["again"]):
                words = words_of(text)
                gone = np.zeros(len(words) + 1, "int64")
                for run in again if again is not None else ():
                    if run["oid"] == oid and run["tie"] == tie:
                        gone[run["start"]] += 1
                        gone[min(len(words), run["start"] + run["n"] + window - 1)] -= 1
                covered = np.cumsum(gone[:-1]) > 0
                removed = int(covered.sum())
                n_words.append(len(words))
                n_removed.append(removed)
                left = words if not removed else [w for w, c in zip(words, covered.tolist()) if not c]
                kept.append(text or "" if as_written and not removed else b" ".join(left).decode())
            yield piece[["rows"]].assign(n_words=n_words, n_removed=n_removed, kept_text=kept)

    judged = texts.join(per_text, "k", "left").select("oid", "tie", "text", "rows", "again")
    added = StructType.fromDDL("n_words long, n_removed long, kept_text string")
    schema = StructType([texts.schema["rows"], *added.fields])
    done = judged.mapInPandas(cut, schema)
    # of identical rows all but one have started before
    copies = done.select(F.posexplode("rows").alias("copy", "row"), "n_words", "n_removed", "kept_text")
    whole = (F.col("copy") > 0) & (F.col("n_words") >= window)
    return copies.select(
        "row.*",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )
