"""Token ids of whole texts from vocabulary files of public tokenizers."""

from __future__ import annotations

import os
import re
import string
import sys
from array import array
from functools import lru_cache

import numpy as np

CACHED_CHUNKS = 600_000  # encoded chunks that a task remembers, some 150 bytes each; then only the earliest, mostly frequent ones stay
KEPT_CHUNKS = 300_000
LONGEST_CACHED = 40
SIGNS = string.punctuation  # neither letters nor digits nor white space in any version of the character tables
LAST_SIMPLE_LETTER = "\u0530"  # Latin, Greek and Cyrillic: letters in every version of the character tables
SPACE_AFTER_SPACE = re.compile(r"\s\s")
BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes in
    ascending order for the characters from U+0100 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class ChunkIds(dict):
    """Ids of chunks that begin with `prefix`, as little-endian bytes; a missing chunk is encoded when asked for.

    A word of letters alone and the signs behind it are matched separately by
    the split pattern, so they are looked up separately, and the word goes to
    the merges of the file's model without being split again.
    """

    def __init__(self, tokenizer, prefix: str, width: str, plain: ChunkIds | None = None):
        super().__init__()
        self.whole, self.merge = tokenizer.encode, tokenizer.model.tokenize
        self.prefix, self.plain, self.symbols = prefix, plain, byte_symbols()
        self.lead = prefix.translate(self.symbols)
        self.code = "H" if width == "<u2" else "I"

    def packed(self, ids: list[int]) -> bytes:
        found = array(self.code, ids)
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isalpha():
            if chunk.isascii():  # such letters stand for themselves
                found = self.packed([token.id for token in self.merge(self.lead + chunk)])
            elif max(chunk) < LAST_SIMPLE_LETTER:
                spelled = (self.prefix + chunk).encode().decode("latin-1").translate(self.symbols)
                found = self.packed([token.id for token in self.merge(spelled)])
            else:
                found = self.packed(self.whole(self.prefix + chunk, add_special_tokens=False).ids)
        else:
            word = chunk.rstrip(SIGNS)
            if self.plain is not None and word.isalpha() and len(word) < len(chunk):
                found = self[word] + self.plain[chunk[len(word) :]]
            else:
                found = self.packed(self.whole(self.prefix + chunk, add_special_tokens=False).ids)
        if len(chunk) <= LONGEST_CACHED:
            if len(self) >= CACHED_CHUNKS:
                for late in list(self)[KEPT_CHUNKS:]:
                    del self[late]
            self[chunk] = found
        return found


class ByteLevelEncoder:
    """A byte-level BPE file of the tokenizers library, one chunk at a time.

    The split pattern of such files never matches across a change from another
    character to white space. A text may therefore be cut before each space
    that does not follow white space, and equal chunks have equal ids wherever
    they are; the library then encodes each chunk once. The strings of added
    tokens are found before anything is split, as the library does, and what
    lies between them is a text of its own. `width` is `<u2` for vocabularies
    of up to 65,536 ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = tokenizer.get_added_tokens_decoder()
        self.width = "<u2" if max(tokenizer.get_vocab_size(), *(i + 1 for i in added), 0) <= 1 << 16 else "<u4"
        self.first = ChunkIds(tokenizer, "", self.width)
        self.spaced = ChunkIds(tokenizer, " ", self.width, self.first)
        self.whole = tokenizer.encode
        self.added = {t.content: np.array([i], self.width).tobytes() for i, t in added.items()}
        # tokens that take in the space or depend on the word around them are left to the library
        self.plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized and not t.special for t in added.values())
        names = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def encode(self, text: str) -> np.ndarray:
        if self.marks is None or not self.marks.search(text):
            return np.frombuffer(self._plain(text), self.width)
        if not self.plain:
            return np.array(self.whole(text, add_special_tokens=False).ids, self.width)
        parts = self.marks.split(text)
        return np.frombuffer(b"".join(self.added[p] if i % 2 else self._plain(p) for i, p in enumerate(parts)), self.width)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        if SPACE_AFTER_SPACE.search(text):
            return b"".join(map(self.first.__getitem__, BEFORE_SPACE.split(text)))
        # each line end is matched alone, each space with the word behind it
        return self.first["\n"].join(map(self._line, text.split("\n")))

    def _line(self, line: str) -> bytes:
        head, *rest = line.split(" ")
        return (self.first[head] if head else b"") + b"".join(map(self.spaced.__getitem__, rest))


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> ByteLevelEncoder:
    """The encoder of a Python worker: the next task that it runs finds the chunks of earlier ones."""
    return ByteLevelEncoder(path)
