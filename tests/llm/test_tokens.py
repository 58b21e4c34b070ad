import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quoteline.llm import sentencepiece_codec, token_counts, token_store
from quoteline.llm.common import tokenizer_path

from llm_rows import AWKWARD

ALPHABET = "ab cd\n\t\r  's'll.,!|é▁ßñ日\x00  <|endoftext|></s>0129ſʼ😀"
TEXT = st.text(st.one_of(st.sampled_from(ALPHABET), st.characters(exclude_categories=("Cs",))), max_size=60)


@pytest.fixture(scope="module")
def byte_bpe():
    return token_store.ByteTokenizer(tokenizer_path("byte_bpe_50k.json"), memo_size=50)


@pytest.fixture(scope="module")
def counter():
    return token_counts.PieceCounter(tokenizer_path("piece_bpe_32k.model"), memo_size=50)


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.WordCodec(tokenizer_path("piece_bpe_32k.model"), memo_size=50)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_ids_equal_the_library(byte_bpe, texts):
    want = [e.ids for e in byte_bpe.tok.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in byte_bpe.encode(texts)] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=8))
def test_piece_counts_and_codec_equal_the_library(counter, codec, texts):
    lib = counter.model.lib
    want = [lib.encode(t) for t in texts]
    assert counter.counts(texts) == [len(w) for w in want]
    csv, decoded = codec.encode_csv(texts)
    assert csv == [",".join(map(str, w)) for w in want]
    assert decoded == [lib.decode(w) if w else "" for w in want]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500))
def test_codes_give_every_value_and_each_alone(values):
    codes = token_store.Codes(token_store.encode_levels(np.array(values, dtype=np.uint32)))
    assert codes.all().tolist() == values
    for i in random.Random(1).sample(range(len(values)), min(20, len(values))):
        assert codes[i] == values[i]
    with pytest.raises(IndexError):
        codes[len(values)]


def test_store_round_trip_and_random_access(sp, awkward, workdir):
    path = f"{workdir}/tokens"
    token_store.write_tokens(awkward, path, segment_tokens=1000)
    got = [tuple(r) for r in token_store.read_documents(sp, path).collect()]
    lib = token_store.ByteTokenizer(tokenizer_path("byte_bpe_50k.json")).tok
    encoded = {t: lib.encode(t or "", add_special_tokens=False).ids + [0] for _, t in AWKWARD}
    assert sorted((d, n, c) for d, _, n, c in got if d is not None) == sorted(
        (d, len(encoded[t]), zlib.crc32(np.array(encoded[t], dtype="<u4").tobytes())) for d, t in AWKWARD if d is not None)
    # starts follow ascending ids without gaps, the null id first
    in_order = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in in_order] == sorted((r[0] for r in got), key=lambda d: (d is not None, d or 0))
    at = 0
    for _, start, n, _ in in_order:
        assert start == at
        at += n
    flat = [i for d in (r[0] for r in in_order) for i in []]
    stream = {r[1]: r for r in in_order}
    for _, t in AWKWARD[:6]:
        doc = next(r for r in got if r[2] == len(encoded[t]))
        assert token_store.read_token(sp, path, doc[1] + doc[2] - 1) == 0
    assert token_store.read_token(sp, path, at) is None and not flat and stream


def test_empty_table(sp, nothing, workdir):
    token_store.write_tokens(nothing, f"{workdir}/tokens")
    assert token_store.read_documents(sp, f"{workdir}/tokens").count() == 0
    assert token_counts.token_counts(nothing).count() == 0
    assert sentencepiece_codec.round_trip_digests(nothing).count() == 0


def test_counts_and_digests_of_awkward_rows(sp, awkward):
    lib = token_counts.PieceCounter(tokenizer_path("piece_bpe_32k.model")).model.lib
    ids = {t: lib.encode(t or "") for _, t in AWKWARD}
    got = sorted((tuple(r) for r in token_counts.token_counts(awkward).collect()), key=str)
    assert got == sorted(((d, len((t or "").encode()), len(ids[t]), len(ids[t]) > 4096) for d, t in AWKWARD), key=str)

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    got = sorted((tuple(r) for r in sentencepiece_codec.round_trip_digests(awkward).collect()), key=str)
    assert got == sorted(((d, len(ids[t]), sha(",".join(map(str, ids[t]))), sha(lib.decode(ids[t]) if ids[t] else ""))
                          for d, t in AWKWARD), key=str)
    encoded = sentencepiece_codec.encode(awkward)
    assert sorted((tuple(r) for r in encoded.collect()), key=str) == sorted(((d, ids[t]) for d, t in AWKWARD), key=str)
    back = sentencepiece_codec.decode(encoded)
    assert sorted((tuple(r) for r in back.collect()), key=str) == sorted(
        ((d, lib.decode(ids[t]) if ids[t] else "") for d, t in AWKWARD), key=str)


def test_merge_order_of_equal_ranks_is_leftmost():
    assert token_counts.merge_count("aaa", {"a": 9.0, "aa": 1.0}) == 2
    assert token_counts.merge_count("aaaa", {"a": 9.0, "aa": 1.0, "aaaa": 2.0}) == 1
    assert token_counts.merge_count("日a", {"a": 1.0}) == 4  # three bytes and one piece


def test_tables_stay_below_their_bytes(byte_bpe, counter, codec):
    """Texts without spaces, short and long: no table passes its bound, the long chunks leave with their batch."""
    rnd = random.Random(3)
    lib = counter.model.lib
    for memo in (byte_bpe.memo, counter.memo, codec.memo):
        memo.size, memo.max_bytes = 10**6, 50_000
    largest = 0  # what one batch may add: ids and their decimals take up to eight bytes for a byte
    try:
        for size in (20, 200, 257, 20_000):
            for _ in range(6):
                batch = ["".join(rnd.choices("abcdefghij日本", k=size)) for _ in range(40 if size < 1000 else 3)]
                assert [x.tolist() for x in byte_bpe.encode(batch)] == [
                    e.ids for e in byte_bpe.tok.encode_batch(batch, add_special_tokens=False)]
                largest = max(largest, 8 * sum(len(t.encode()) for t in batch if len(t) <= 256))
                want = [lib.encode(t) for t in batch]
                assert counter.counts(batch) == [len(w) for w in want]
                assert codec.encode(batch) == want
                for memo in (byte_bpe.memo, counter.memo, codec.memo):
                    for part in (memo.young, memo.old):
                        held = sum(len(k) + (len(v) if isinstance(v, (str, bytes)) else 0) for k, v in part.items())
                        assert held <= memo.max_bytes + largest
                        assert all(len(k) <= memo.longest for k in part)
    finally:
        for memo in (byte_bpe.memo, counter.memo, codec.memo):
            memo.size, memo.max_bytes = 50, 96 << 20
