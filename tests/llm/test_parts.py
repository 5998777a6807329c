"""The numpy and Python parts, against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest

from annolake.llm import simhash, suffixes, tokenbin, warc, windows


@pytest.mark.parametrize("width", [1, 7, 16, 17, 31, 32])
def test_packing_round_trip_and_random_access(width):
    ids = np.random.default_rng(1).integers(0, 2**width, 1000).astype(np.uint32)
    packed = tokenbin.pack(ids, width)
    assert (tokenbin.unpack(packed, width, 0, 1000) == ids).all()
    assert (tokenbin.unpack(packed, width, 63, 130) == ids[63:130]).all()
    assert len(packed) == -(-1000 // 64) * 8 * width


def test_encoder_equals_the_tokenizer_on_odd_white_space():
    texts = ["", "a", "  x y", "x  y", " a", "a ", "tab\there", "a\n\nb c", "é  ü", "<|endoftext|> a<|endoftext|>b c", "a\xa0b c", "q r s", "a b\nc d.\nE f"]
    tokenizer = tokenbin.load_tokenizer(tokenbin.TOKENIZER)
    encoder = tokenbin._Encoder(tokenizer)
    for _ in range(2):
        ids, counts = encoder.encode(pa.array(texts))
        at = 0
        for text, count in zip(texts, counts.tolist(), strict=True):
            assert tokenizer.encode(text, add_special_tokens=False).ids == ids[at : at + count].tolist()
            at += count


def test_suffix_array_equals_sorting():
    random.seed(3)
    for turn in range(400):
        text = bytes(random.choice(b"ab" if turn % 2 else b"abcd") for _ in range(random.randint(0, 60)))
        assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_golay_keys_meet_within_two_bits():
    errors, offsets = simhash.golay_tables()
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 23, 20_000)
    near = words ^ (1 << rng.integers(0, 23, len(words))) ^ (1 << rng.integers(0, 23, len(words)))
    left, right = simhash.golay_keys(words, errors, offsets), simhash.golay_keys(near, errors, offsets)
    assert ((left[:, :, None] == right[:, None, :]) & (left[:, :, None] >= 0)).any((1, 2)).all()


def test_chunked_framing_and_records():
    for size in (0, 1, 5000, 70_000):
        payload = bytes(random.randrange(256) for _ in range(size))
        assert warc.dechunked(warc.chunked(payload)) == payload
    records = list(warc.page_records("u", 7, "http://x/\r\ny", b"p" * 50_000, "d", None))
    assert len(records) == 4
    parsed = list(warc.parse(b"".join(r + warc.END for r in records)))
    assert [p[2] for p in parsed] == [1, 2, 3, 4] and parsed[-1][3] == sum(len(p[-1]) for p in parsed)
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_rolling_hashes_and_intervals():
    values = np.random.default_rng(2).integers(0, 2**63, 200).astype(np.uint64)
    values[100:150] = values[20:70]
    hashes = windows.Rolling(values).all(50)
    assert hashes[100] == hashes[20] and len(np.unique(hashes)) == len(hashes) - 1
    assert windows.sliding_min(np.array([5, 3, 4, 1, 9]), 3).tolist() == [3, 1, 1]
    starts, ends = windows.merged(np.array([5, 0, 2]), np.array([7, 2, 3]))
    assert starts.tolist() == [0, 5] and ends.tolist() == [3, 7]
