import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusq.llm import range_coder as R
from corpusq.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def decoded(ids, block=R.BLOCK):
    return R.decode_blocks(*R.encode_blocks(np.asarray(ids, np.int64), block))


@given(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 2**17), st.integers(2**32 - 9, 2**32 - 1)), max_size=300), st.integers(1, 40), st.sampled_from([7, 64, R.BLOCK]))
@settings(max_examples=25, deadline=None, database=None, derandomize=True)
def test_round_trip(ids, copies, block):
    ids = np.array(ids * copies, np.int64)
    assert (decoded(ids, block) == ids).all()


def test_one_id_and_equal_ids():
    for ids in ([5], [0] * 9000, [1, 2] * 5000):
        assert decoded(ids).tolist() == ids


def test_repeats_shrink():
    ids = np.tile(np.arange(40000, 40040), 400)
    header, blocks = R.encode_blocks(ids)
    assert [b[0] for b in blocks] == [4096, 4096, 4096, 3712]
    assert sum(len(b[1]) for b in blocks) + len(header) < len(ids) // 8


def test_fewer_bits_than_order_0():
    """Header included, below the entropy of the ids on their own, and below half of it where the last id tells much."""
    rng = np.random.default_rng(3)
    likely = rng.zipf(1.3, 200_000) % 3000
    after = rng.integers(0, 3000, (3000, 4))
    follow, pick = rng.random(len(likely)) < 0.8, rng.integers(0, 4, len(likely))
    for k in range(1, len(likely)):
        if follow[k]:
            likely[k] = after[likely[k - 1], pick[k]]
    p = np.bincount(likely) / len(likely)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum()
    header, blocks = R.encode_blocks(likely)
    bits = 8 * (len(header) + sum(len(b[1]) for b in blocks)) / len(likely)
    assert bits < 0.75 * entropy


def test_tables_text_beats_order_0_and_deflate():
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
    lib = Tokenizer.from_file(PATH)
    ids = np.concatenate([np.array(lib.encode(t or "", add_special_tokens=False).ids + [1]) for t in texts])
    p = np.bincount(ids) / len(ids)
    header, blocks = R.encode_blocks(ids)
    size = len(header) + sum(len(b[1]) for b in blocks)
    assert 8 * size / len(ids) < -(p[p > 0] * np.log2(p[p > 0])).sum()
    assert size < len(zlib.compress(ids.astype("<u2").tobytes(), 9))


def test_blocks_stand_alone_and_are_checked():
    ids = np.random.default_rng(2).integers(0, 49408, 9000)
    header, blocks = R.encode_blocks(ids)
    assert (R.decode_blocks(header, blocks[1:2]) == ids[4096:8192]).all()
    n, coded, crc = blocks[0]
    with pytest.raises(ValueError):
        R.decode_blocks(header, [(n, coded[:50] + bytes([coded[50] ^ 1]) + coded[51:], crc)])


def test_a_very_long_text(spark):
    """One document over many blocks."""
    text = " ".join(f"w{k % 977} x{k % 13}" for k in range(60_000))
    row = R.round_trip(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).collect()
    ids = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids + [1]
    assert len(ids) > 20 * R.BLOCK
    assert [tuple(r) for r in row] == [(1, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))]


def test_groups():
    f = io.BytesIO()
    docs = [(None, b""), (3, np.array([1, 2], "<u4").tobytes()), (3, np.array([9], "<u4").tobytes())]
    R.write_group(f, docs)
    R.write_group(f, [(4, b"")])
    f.seek(0)
    assert [(d, i.tolist()) for d, i in R.read_groups(f)] == [(None, []), (3, [1, 2]), (3, [9]), (4, [])]


def test_files(spark):
    lib, rng = Tokenizer.from_file(PATH), random.Random(6)
    docs = [(i * 3 % 41, rng.choice([None, "", "a b", "The\tend.", "word " * rng.randrange(300)]), "x") for i in range(41)] + [(None, "b", None), (5, "a", None), (5, "a", None)]
    rows = R.round_trip(spark.createDataFrame(docs, "doc_id long, text string, start string"), PATH).collect()
    at, want = 0, []
    for d, t, _ in sorted(docs, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want


def test_empty(spark):
    assert R.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_word_encoder_takes_words_apart(monkeypatch):
    """No call of the whole library for each new word; signs, case, Latin-1 and what lower case makes of a letter as the library has them."""
    lib, enc, rng = Tokenizer.from_file(PATH), Encoder(PATH, False), random.Random(7)
    made = ["".join(rng.choices("abcdefghijklméß", k=9)) for _ in range(3000)]
    texts = [" ".join(w.capitalize() + rng.choice(["", ".", ",", "!!", " (x)", "\n"]) for w in made)]
    calls, whole = [], enc.whole
    monkeypatch.setattr(enc, "whole", lambda t: calls.append(t) or whole(t))
    odd = ["aİ. xİ!", "क़, שּׁ.", "Å= ≠ ẖ H̱.", "l'Été's DON'T 'S", "<|ENDOFTEXT|> a<|endoftext|>B.", "tab\tÀ\x0b\x0cÇ\r\nẞ ª.º µ", "no\xa0break 12a3\x7f4 ×÷x²", "ﬁN. ΑΣ, ΑΣ"]
    for t, got in zip(texts + odd, enc.encode_many(texts + odd), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)
    assert len(calls) < 100


def test_damage_ends_in_an_error():
    """Also where damaged codes ask for followers of an id that has none, or for words behind the end."""
    ids = np.r_[np.tile([5, 6, 7], 800), np.arange(100, 2500), np.tile([5, 6, 7], 800)]
    header, blocks = R.encode_blocks(ids)
    rng = np.random.default_rng(4)
    for _ in range(20):
        n, coded, crc = blocks[0]
        other = bytearray(coded)
        other[int(rng.integers(len(coded)))] ^= int(rng.integers(1, 256))
        with pytest.raises(ValueError):
            R.decode_blocks(header, [(n, bytes(other[: int(rng.integers(2, len(other)))]), crc)])


def test_carries():
    """Long runs of likely ids, whose ranges end in many set bits, between rare ones."""
    rng = np.random.default_rng(5)
    for share in (0.9, 0.999, 0.99999):
        ids = np.where(rng.random(60_000) < share, 3, rng.integers(0, 40_000, 60_000))
        assert (decoded(ids, 256) == ids).all()
