"""Byte-level BPE by the tiktoken library and a local rank file, with raw-byte decoding."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

LONG_TEXT = 1 << 16
# the split pattern never matches from another character into white space, so a text may be cut there
SAFE_BOUNDARY = re.compile(r"(?<=\S)(?=\s)")
BATCH_TEXTS = 512
SCHEMA = "doc_id long, n_tokens long, ids binary, decoded binary"


def rank_encoding(path: str, pattern: str):
    """The encoding of a rank file (a base64 token and its rank in each line)."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local-ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, size: int = LONG_TEXT) -> Iterator[str]:
    """The text in parts of about `size` characters, cut only where no match of the split pattern can lie across."""
    start = 0
    while len(text) - start > size:
        cut = SAFE_BOUNDARY.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(encoding, text: str) -> np.ndarray:
    """Ids of a text without special tokens, as little-endian 32-bit integers."""
    if len(text) <= LONG_TEXT:
        return np.array(encoding.encode_ordinary(text), "<u4")
    return np.concatenate([np.array(encoding.encode_ordinary(part), "<u4") for part in safe_parts(text)])


def encode_and_decode(
    docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Ids of every whole text and the bytes they stand for: doc_id, n_tokens, ids, decoded.

    Ids are little-endian 32-bit integers; decoding joins the raw bytes of the
    tokens, so it also holds where a character is spread over several tokens.
    Null and empty texts have no ids. Every row is on its own: repeated ids and
    rows, ties and null ids stay as they are. An empty table gives no rows;
    other columns are not read.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = rank_encoding(rank_path, pattern)
        for batch in batches:
            for start in range(0, len(batch), BATCH_TEXTS):
                piece = batch.iloc[start : start + BATCH_TEXTS]
                ids = [encode_text(encoding, text or "") for text in piece["text"]]
                yield pd.DataFrame(
                    {
                        "doc_id": piece["id"].astype("Int64").array,
                        "n_tokens": [len(x) for x in ids],
                        "ids": [x.tobytes() for x in ids],
                        "decoded": [encoding.decode_bytes(x.tolist()) for x in ids],
                    }
                )

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInPandas(work, SCHEMA)
