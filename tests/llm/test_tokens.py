import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from paperloom.llm import token_files as T
from paperloom.llm.packing import first_fit_decreasing, pack_sequences
from paperloom.llm.tiktokens import encode_and_decode, encode_text, rank_encoding, safe_parts
from paperloom.llm.tokens import ByteLevelEncoder
from paperloom.session import fresh_path

BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = st.sampled_from(
    ["word", "Word", "don't", "'s", ".", ",,", "!?", " ", "  ", "\n", "\t", "\x1c", "\x85", " "]
    + ["é", "²", "12", "中", "😀", "_", "<|endoftext|>"]
)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def chunked():
    return ByteLevelEncoder(BPE)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_chunks_give_the_ids_of_the_whole_text(library, chunked, text):
    assert chunked.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES, max_size=40).map("".join), st.integers(1, 9))
def test_safe_parts_give_the_ids_of_the_whole_text(text, size):
    encoding = rank_encoding(RANKS, public_tokenizers.PATTERN) if not hasattr(safe_parts, "kept") else safe_parts.kept
    safe_parts.kept = encoding
    parts = list(safe_parts(text, size))
    assert "".join(parts) == text
    assert [i for p in parts for i in encoding.encode_ordinary(p)] == encoding.encode_ordinary(text)


def test_strings_of_added_tokens_are_their_ids(library, chunked):
    assert chunked.encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    for text in ("<|endoftext|>", "<|endoftext|><|endoftext|>  x", "\n<|endoftext|>\n", "<|endoftext|", "a<|endoftext|>a"):
        assert chunked.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_signs_behind_a_word_are_looked_up_apart(library):
    """The library is asked once for each run of signs, not once for each word that stands before one."""
    encoder, asked = ByteLevelEncoder(BPE), []
    for chunks in (encoder.first, encoder.spaced):
        chunks.whole = lambda text, **kw: asked.append(text) or library.encode(text, **kw)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    signs = ["***", "'", ".%%%", "<|", "$"]
    text = "".join(f" {w}{sign}" for w in words for sign in signs)
    assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert sorted(x for x in asked if x != "\n") == sorted(signs)


def test_long_texts_are_cut():
    encoding = rank_encoding(RANKS, public_tokenizers.PATTERN)
    text = "some words and  more\n" * 9000
    assert len(list(safe_parts(text))) > 2
    assert encode_text(encoding, text).tolist() == encoding.encode_ordinary(text)


def test_round_trip_of_every_row(odd_docs, no_docs):
    rows = encode_and_decode(odd_docs, RANKS, public_tokenizers.PATTERN).collect()
    texts = Counter((r.text or "").encode() for r in odd_docs.collect())
    assert Counter(bytes(r.decoded) for r in rows) == texts
    assert all(len(r.ids) == 4 * r.n_tokens for r in rows)
    assert encode_and_decode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 3000), st.integers(1, 400), st.integers(0, 1000))
def test_coder_round_trip(n, kinds, seed):
    ids = np.random.default_rng(seed).zipf(1.4, n) % kinds
    coder = T.Coder(T.scaled_frequencies(np.bincount(ids, minlength=1)))
    assert (coder.decode(coder.encode(ids), n) == ids).all()


def test_a_reader_may_start_at_a_checkpoint_and_sees_damage():
    ids = np.random.default_rng(1).zipf(1.2, 400_000) % 5000
    frequencies = T.scaled_frequencies(np.bincount(ids))
    assert frequencies.sum() == 1 << T.SCALE_BITS and ((frequencies > 0) == (np.bincount(ids) > 0)).all()
    coder = T.Coder(frequencies)
    block = coder.encode(ids)
    step = T.CHECK_STEPS * T.LANES
    assert coder.segments(block) == 2
    assert (coder.decode_segment(block, 1, len(ids)) == ids[step:]).all()
    entropy = -sum(c * np.log2(c / len(ids)) for c in np.bincount(ids) if c) / 8
    assert len(block["words"]) < 1.02 * entropy + 8 * T.LANES
    damaged = bytearray(block["words"])
    damaged[len(damaged) // 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        coder.decode(block | {"words": bytes(damaged)}, len(ids))


@pytest.mark.parametrize("block_tokens", [1, 50, T.BLOCK_TOKENS])
def test_token_files(spark, library, odd_docs, no_docs, block_tokens):
    path = fresh_path(spark, "tokens")
    T.write_token_files(odd_docs, BPE, 2, path, block_tokens=block_tokens)
    rows = T.read_token_files(spark, path).orderBy("start").collect()
    assert len(rows) == odd_docs.count()
    start, wanted = 0, Counter()
    for r in odd_docs.collect():
        wanted[(r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids + [2]))] += 1
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows) == wanted
    for r in rows:
        assert r.start == start
        start += len(r.ids) // 4
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda x: (x is not None, x or 0))
    path = fresh_path(spark, "tokens")
    T.write_token_files(no_docs, BPE, 2, path)
    assert T.read_token_files(spark, path).count() == 0


def plain_first_fit(lengths, capacity):
    bins = []
    out = [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        for b, used in enumerate(bins):
            if used + lengths[i] <= capacity:
                out[i], bins[b] = (b, used), used + lengths[i]
                break
        else:
            bins.append(lengths[i])
            out[i] = (len(bins) - 1, 0)
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_first_fit_as_by_hand(lengths):
    assert first_fit_decreasing(lengths, 64) == plain_first_fit(lengths, 64)


def test_every_id_lies_in_one_piece(library, odd_docs, no_docs):
    rows = pack_sequences(odd_docs, BPE, 1, capacity=64, group_documents=4).collect()
    wanted = Counter()
    for r in odd_docs.collect():
        wanted[tuple(library.encode(r.text or "", add_special_tokens=False).ids + [1])] += 1
    by_doc, places = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length <= 64 and zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_doc[(r.doc_id, r.doc_tokens)].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for placed in places.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r.length for r in rows) == sum(len(k) * n for k, n in wanted.items())
    single = [sorted(v, key=lambda r: r.start) for v in by_doc.values() if len({r.start for r in v}) == len(v)]
    known = {np.array(k, "<u4").tobytes() for k in wanted}
    assert single and {b"".join(bytes(r.ids) for r in v) for v in single} <= known
    assert pack_sequences(no_docs, BPE, 1).count() == 0
