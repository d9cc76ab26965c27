import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusq.llm import packing
from corpusq.llm.tokens import Encoder, plain

PATH = public_tokenizers.path("byte_bpe_50k.json")


def best_fit(counts, size):
    """One piece at a time: the smallest gap that fits."""
    gaps = []
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [(g, i) for i, g in enumerate(gaps) if g >= n]
        if fits:
            gaps[min(fits)[1]] -= n
        else:
            gaps.append(size - n)
    return len(gaps), sorted(gaps)


def matched(spark, lengths, size):
    rows = [(i, n) for i, n in enumerate(lengths)]
    return {r.id: r.seq for r in packing.matched(spark.createDataFrame(rows, "id long, size int"), size).collect()}


@pytest.mark.parametrize("each", [200_000, 40])
def test_rounds_against_best_fit_decreasing(spark, monkeypatch, each):
    """Small parts make sweeps pass many partitions, with one length over several of them."""
    monkeypatch.setattr(packing, "EACH", each)
    rng = random.Random(3)
    cases = [[rng.randrange(1, 64) for _ in range(400)], [21] * 300 + [rng.randrange(22, 33) for _ in range(50)], [rng.randrange(1, 5) for _ in range(300)], [40], [63, 1] * 60]
    for lengths in cases:
        seq = matched(spark, lengths, 64)
        assert sorted(seq) == list(range(len(lengths)))
        used = {}
        for i, s in seq.items():
            used[s] = used.get(s, 0) + lengths[i]
        assert max(used.values()) <= 64
        counts = {n: lengths.count(n) for n in lengths}
        assert len(used) <= 1.02 * best_fit(counts, 64)[0] + 1


def brute_sweep(gaps, pieces):
    """Longest first, each piece takes the smallest free gap that fits: size to sizes of partners."""
    free, found = sorted(gaps), []
    for n in sorted(pieces, reverse=True):
        fits = [g for g in free if g >= n]
        if fits:
            free.remove(fits[0])
            found.append((n, fits[0]))
    return sorted(found)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_sweep_is_the_successor_of_every_piece(spark, parts):
    rng = random.Random(8)
    for _ in range(3):
        gaps, pieces = [rng.randrange(1, 30) for _ in range(60)], [rng.randrange(1, 30) for _ in range(60)]
        g = spark.createDataFrame([(n, 0, -i - 1, n) for i, n in enumerate(gaps)], "size int, kind int, id long, whole int")
        p = spark.createDataFrame([(n, 1, i) for i, n in enumerate(pieces)], "size int, kind int, id long")
        rows = packing.sweep(g, p, parts).collect()
        assert len(rows) == 120
        assert sorted((r["size"], r.by_size) for r in rows if r.kind and r.by_id is not None) == brute_sweep(gaps, pieces)
        there = {(r.id, r.by_id) for r in rows if r.kind == 0 and r.by_id is not None}
        assert there == {(r.by_id, r.id) for r in rows if r.kind == 1 and r.by_id is not None}


TEXTS = [None, "", " ", "a", "two  spaces", "line\nbreak  \n x", "l'été's don't", "tab\tb c", "  wide", "<|endoftext|> x", "z " * 3000, "ab" * 4000, "é́ ́x ﬁ Σς"]


@pytest.mark.parametrize("name,keep", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_is_the_library(name, keep):
    lib, enc = Tokenizer.from_file(public_tokenizers.path(name)), Encoder(public_tokenizers.path(name), keep, cache=50)
    rng = random.Random(4)
    parts = ["a", "Bé", "'s", "don't", " ", "  ", "\n", "\t", "12", "!!", "ſ", "́", "😀", "x" * 30, "\x1c", "\xa0", "ß", "<|"]
    texts = TEXTS[1:] + ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(30))) for _ in range(2000)]
    assert sum(map(plain, filter(None, texts))) > 40
    texts += [" ".join(rng.choice(["w.", "éa,", "b\nc.", "1.", "d.,", "x\n.", "don't.", "ﬁ."]) for _ in range(9)) for _ in range(300)]
    for t, got in zip(texts, enc.encode_many(texts), strict=True):
        assert got == enc.encode(t)
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_pack(spark):
    lib, rng = Tokenizer.from_file(PATH), random.Random(5)
    docs = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "no id", None), (3, "a", None)]
    docs += [(100 + i, " ".join(rng.choice(["alpha", "bee", "c"]) for _ in range(rng.randrange(900))), None) for i in range(60)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string, piece string"), PATH).collect()
    want = []
    for d, t, _ in docs:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        at, k = 0, 0
        while at < len(ids):
            n = (len(ids) - at) % 1024 or 1024
            want.append((d, k, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())))
            at, k = at + n, k + 1
    assert sorted(map(str, ((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows))) == sorted(map(str, want))
    spans, counts = {}, {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
        counts[r.length] = counts.get(r.length, 0) + 1
    for s in spans.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 1024
    assert len(spans) <= 1.02 * best_fit(counts, 1024)[0] + 1


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
