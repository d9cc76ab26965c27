import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from corpusq.llm import piece_scan as S

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(7)
    alphabet = ["a", "e", "th", "ing", "of", ".", ",", "!!", " ", "  ", "\n", "\t", "é", "ß", "😀", "　", "zq", "the", "X", "12", "▁", "aaaa", "\x00", "　"]
    found = ["", " ", "a", "   ", " a ", "a" * 100, "▁", "é", " \n ", "<s>x</s>", "=" * 99]
    return found + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(1500)]


def test_encode_is_the_library(lib):
    m = S.Pieces(PATH)
    for t, ids in zip(texts(), m.encode_many(texts()), strict=True):
        assert ids == m.encode(t)
        assert np.frombuffer(m.encode(t), "<u4").tolist() == lib.encode(t), repr(t)
        assert m.decode(m.encode(t)) == lib.decode(lib.encode(t)), repr(t)


def test_long_runs_that_no_piece_joins(lib):
    m = S.Pieces(PATH)
    for t in ["7" * 5000, "\n" * 5000, "0123456789" * 500, "漢字かな" * 1250, "я中\n4" * 1250, "a1" * 2500 + "the", "word " + "9" * 5000 + " word", "x" * 5000]:
        assert np.frombuffer(m.encode(t), "<u4").tolist() == lib.encode(t), repr(t[:20])
        assert m.decode(m.encode(t)) == lib.decode(lib.encode(t)), repr(t[:20])


def test_long_runs_within_a_chunk(spark, lib):
    texts = ["5" * 5000, "\n" * 5000, "head " + "8" * 3000 + " middle " + "\n" * 3000 + " tail " * 50]
    rows = S.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH).collect()
    want = [(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in enumerate(map(lib.encode, texts))]
    assert sorted(tuple(r)[:3] for r in rows) == want


def test_chunks_anywhere(lib):
    m, rng = S.Pieces(PATH), random.Random(8)
    for t in [*texts()[:80], "thequickbrownfox" * 30, "a" * 300, " ".join(["word"] * 60)]:
        full = S.SPACE + t.replace(" ", S.SPACE)
        if not t or len(full) < 40:
            continue
        chunk = rng.randrange(34, 80)
        bounds = [(s, min(len(full), s + chunk)) for s in range(0, len(full), chunk)]
        cut = lambda s, e: (full[max(0, s - 64) : e + 64], max(0, s - 64))
        states = S.combine([m.transfer(*cut(s, e), s, e, len(full)) for s, e in bounds])
        got = b"".join(m.trace(*cut(s, e), s, e, i, j) for (s, e), (i, j) in zip(bounds, states))
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(t), repr(t)


def test_product_is_associative(lib):
    m = S.Pieces(PATH)
    t = S.SPACE + "thequickbrownfox12jumps" * 20
    bounds = [(k, min(len(t), k + 40)) for k in range(0, len(t), 40)]
    ms = [m.transfer(t[max(0, a - 64) : b + 64], max(0, a - 64), a, b, len(t)) for a, b in bounds]
    left = ms[0]
    for x in ms[1:]:
        left = S.product(left, x)
    right = ms[-1]
    for x in ms[-2::-1]:
        right = S.product(x, right)
    assert sorted(left, key=str) == sorted(right, key=str) == sorted(S.whole(ms), key=str)
    a, b, c = ms[1:4]
    assert sorted(S.product(S.product(a, b), c)) == sorted(S.product(a, S.product(b, c)))


def test_documents_in_small_chunks(spark, lib, monkeypatch):
    """The query's table with nearly every document scanned, over trees of several levels."""
    monkeypatch.setattr(S, "FAN", 3)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 8000")
    rows = {r.doc_id: r for r in S.encode(docs, PATH, chunk=150).collect()}
    assert len(rows) == docs.count() and sum(r.n_chunks > 9 for r in rows.values()) > 30
    for d in docs.collect():
        ids = lib.encode(d.text or "")
        assert (rows[d.doc_id].n_pieces, rows[d.doc_id].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_a_very_long_text(spark, lib):
    text = "some words 12 " * 20_000 + "龘靐齉" * 10_000 + "12345" * 10_000 + "😀🎉" * 10_000
    (r,) = S.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).collect()
    ids = lib.encode(text)
    assert (r.n_pieces, r.ids_crc32, r.n_chunks) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), 6)


def test_table(spark, lib):
    docs = [(i, t, 1) for i, t in enumerate(texts()[:60])] + [(None, None, 1), (5, "dup text " * 40, 1), (5, "dup text " * 40, 1), (6, "x" * 777, 1), (None, "lone " * 90, 1)]
    rows = S.encode(spark.createDataFrame(docs, "doc_id long, text string, n_pieces int"), PATH, chunk=100).collect()
    want = []
    for d, t, _ in docs:
        ids = lib.encode(t or "")
        n = len(t or "")
        want.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), -(-(n + 1) // 100) if n >= 100 else 1, lib.decode(ids) == (t or "")))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert S.encode(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
