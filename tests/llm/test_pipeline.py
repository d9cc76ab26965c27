import random

import public_tokenizers
from test_near_copies import brute_components
from test_pii import P, good
from tokenizers import Tokenizer

import corpus_pipeline


def brute(docs):
    """ids that stay, with the number of tokens of their final texts; quality rules are taken as passed or not by the fixture."""
    kept = [(d, t) for d, t, ok in sorted(docs) if ok]
    seen, first = set(), []
    for d, t in kept:
        if t not in seen:
            seen.add(t)
            first.append((d, t))
    group = brute_components([t for _, t in first])
    stay = {}
    for (d, t), g in zip(first, group):
        stay.setdefault(g, (d, t))
    lib, found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), {}
    for d, t in stay.values():
        spans = sorted((s, i, e) for i, (k, p) in enumerate(P.items()) for s, e in (m.span() for m in p.finditer(t) if good(k, m[0])))
        out, at = "", 0
        for s, i, e in spans:
            if s >= at:
                out += t[at:s] + f"<{list(P)[i].upper()}>"
            at = max(at, e)
        found[d] = len(lib.encode(out + t[at:], add_special_tokens=False).ids) + 1
    return found


def test_pipeline(spark, tmp_path):
    rng, words = random.Random(9), [f"wo{i}" for i in range(300)]
    docs = []
    for k in range(30):
        t = [rng.choice(words) for _ in range(rng.choice([80, 300, 3000]))]
        docs.append((len(docs), " ".join(t) + ".", True))
        if k % 3 == 0:
            docs.append((len(docs), " ".join(t) + ".", True))
        if k % 5 == 0:
            t[40] = "changed"
            docs.append((len(docs), " ".join(t) + ".", True))
        if k % 4 == 0:
            docs.append((len(docs), " ".join(t[:60]) + " me@mail.org and 4111 1111 1111 1111 or +1 (499) 555-6503.", True))
    docs += [(1000, "too short", False), (1001, "a | b | c | " * 40, False), (1002, "X!! " * 200, False), (1003, "", False)]
    rows = [(d, t, "en", "src0", len(t)) for d, t, _ in docs] + [(None, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = {}
    for r in pieces:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    want = brute(docs)
    assert got == want and 20 < len(got) < len(docs)
    docs_in = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs_in, str(tmp_path)).columns == docs_in.columns


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
