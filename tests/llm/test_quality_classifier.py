import zlib

import numpy as np
import pytest

from corpusq.llm import quality_classifier as C


def test_features_and_bag():
    assert len(C.features("ab")) == 1 + 2 + 1 and len(C.features("")) == 1
    assert len(C.features("éü")) == len(C.features("ab"))  # characters, not bytes
    ids, n = C.bag("ab ab\ncd")
    want = {}
    hashes = np.array([zlib.crc32(w.encode(), 2) for w in ("ab", "ab", "cd")])
    for f in [*C.features("ab"), *C.features("ab"), *C.features("cd"), *C.pairs(hashes).tolist()]:
        want[f] = want.get(f, 0) + 1
    assert dict(zip(ids.tolist(), n.tolist())) == want
    assert len(C.bag(None)[0]) == 0


def test_training_against_a_plain_version():
    """The same gradient descent, feature by feature in lists."""
    texts = [("good words here and there", 1), ("spam spam spam", 0), ("more good words", 1), ("###", 0), ("", 1)]
    weights, bias = C.train([(*C.bag(t), y) for t, y in texts])
    rng = np.random.default_rng(C.SEED)
    out, b, vec = rng.uniform(-1, 1, (C.DIM, 2)).tolist(), [0.0, 0.0], {}
    docs = []
    for t, y in texts:
        ids, n = C.bag(t)
        if len(ids):
            docs.append((dict(zip(ids.tolist(), (n / n.sum()).tolist())), y))
    step = 0
    for _ in range(C.EPOCHS):
        for k in rng.permutation(len(docs)):
            share, y = docs[k]
            rate = C.RATE * (1 - step / (C.EPOCHS * len(docs)))
            step += 1
            mean = [sum(s * vec.get(f, [0.0] * C.DIM)[d] for f, s in share.items()) for d in range(C.DIM)]
            z = [b[c] + sum(mean[d] * out[d][c] for d in range(C.DIM)) for c in (0, 1)]
            e = [np.exp(v - max(z)) for v in z]
            g = [v / sum(e) - (c == y) for c, v in enumerate(e)]
            back = [out[d][0] * g[0] + out[d][1] * g[1] for d in range(C.DIM)]
            for c in (0, 1):
                b[c] -= rate * g[c]
                for d in range(C.DIM):
                    out[d][c] -= rate * mean[d] * g[c]
            for f, s in share.items():
                old = vec.get(f, [0.0] * C.DIM)
                vec[f] = [old[d] - rate * s * len(share) * back[d] for d in range(C.DIM)]
    assert bias == pytest.approx(b[1] - b[0])
    for f, v in vec.items():
        assert weights[f] == pytest.approx(sum(v[d] * (out[d][1] - out[d][0]) for d in range(C.DIM)))
    assert np.count_nonzero(weights) == len(vec)


def test_the_sample_bounds_rows_where_ids_repeat(spark):
    d = spark.createDataFrame([(1, f"a{k}") for k in range(30)] + [(2, "b")], "doc_id long, text string")
    lab = spark.createDataFrame([(1, 0), (2, 1), (1, 0)], "doc_id long, quality int")
    assert C.sample(d, lab, "doc_id", "text", "quality", 7).count() == 7


def test_score_is_the_softmax_of_the_average():
    weights = np.random.default_rng(1).normal(size=C.BUCKETS)
    s = C.Scorer(weights, 0.25)
    for t in ["a", "a a b " + "x" * 300, "é\x1fü " * 40]:
        ids, n = C.bag(t)
        assert s.score(t) == pytest.approx(1 / (1 + np.exp(-(weights[ids] @ n / n.sum() + 0.25))))
    assert s.score(None) == s.score(" ") == pytest.approx(1 / (1 + np.exp(-0.25)))


def test_held_out_accuracy(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in C.classify(d, lab).collect()}
    assert len(rows) == d.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for i, r in rows.items())
    held = [(rows[x.doc_id].score, x.quality) for x in lab.collect() if rows[x.doc_id].held_out]
    pairs = [(a > b) + 0.5 * (a == b) for a, y in held for b, z in held if y == 1 and z == 0]
    assert sum(pairs) / len(pairs) > 0.85


def test_odd_rows(spark):
    d = spark.createDataFrame([(None, "a b", 1), (1, None, 1), (1, None, 1), (2, "", 0), (3, "x" * 5000, 0)], "doc_id long, text string, score int")
    lab = spark.createDataFrame([(1, None), (2, 7), (None, 1)], "doc_id long, quality int")
    rows = C.classify(d, lab).collect()
    assert len(rows) == 5 and all(r.score == 0.5 and r.predicted == 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert C.classify(d.limit(0), lab.limit(0)).collect() == []
