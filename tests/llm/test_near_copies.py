import random

import numpy as np
import pytest

from corpusq.llm import near_copies as N


def brute_set(text, width=5):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ")
    w = [x for x in w if x]
    return frozenset(" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_components(texts, similarity=0.8):
    sets = [brute_set(t) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both >= similarity * (len(sets[i]) + len(sets[j]) - both):
                group = [group[j] if g == group[i] else g for g in group]
    return group


def corpus(seed, groups=9, copies=8):
    rng, words, docs = random.Random(seed), [f"w{i}" for i in range(500)], []
    for g in range(groups):
        t = [rng.choice(words) for _ in range(rng.choice([60, 300, 900]))]
        for _ in range(copies):
            u = list(t)
            for _ in range(rng.randrange(0, max(2, len(t) // 60))):
                u[rng.randrange(len(u))] = "Changed" if rng.random() < 0.5 else "other"
            docs.append((len(docs), " ".join(u)))
    return docs


@pytest.mark.parametrize("reach", [N.REACH, 2])
def test_components_against_brute_force(spark, monkeypatch, reach):
    monkeypatch.setattr(N, "REACH", reach)
    docs = corpus(1) + [(900, None), (901, ""), (902, " \n"), (903, "a B"), (904, "A b"), (905, "a c"), (900, None), (None, "alone here"), (None, "alone here"), (None, "quite another"), (7, "same id as another text")]
    rows = N.near_groups(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, component_id string")).collect()
    group = brute_components([t for _, t in docs])
    want = []
    for i, (d, _) in enumerate(docs):
        want.append((d, min((docs[j][0] for j in range(len(docs)) if group[j] == group[i] and docs[j][0] is not None), default=None)))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    assert len(set(group)) < len(docs) // 3


def test_pairs_at_the_threshold(spark):
    """Nearly every pair between 0.8 and 0.85 is found, none below 0.8; operator 8 alone finds few of them."""
    rng, docs, near = random.Random(3), [], []
    for k in range(150):
        t = [f"{k}w{rng.randrange(10**6)}" for _ in range(400)]
        u = list(t)
        for at in rng.sample(range(5, 395), rng.randrange(7, 14)):
            u[at] = "x"
        docs += [(2 * k, " ".join(t)), (2 * k + 1, " ".join(u))]
        a, b = brute_set(docs[-1][1]), brute_set(docs[-2][1])
        near.append(len(a & b) / len(a | b))
    rows = {r.doc_id: r.component_id for r in N.near_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    found = [rows[2 * k + 1] == 2 * k for k in range(150)]
    sure = [f for f, s in zip(found, near) if s >= 0.8]
    assert len(sure) > 40 and sum(sure) >= 0.95 * len(sure)
    assert not any(f for f, s in zip(found, near) if s < 0.8) and sum(s < 0.8 for s in near) > 20


def test_one_of_each_stays(spark):
    docs = corpus(5, 3, 6) + [(None, "lone"), (50, None), (51, "")]
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in docs], "doc_id long, text string, rep int, _row string")
    kept = N.keep_one(df)
    group = brute_components([t for _, t in docs])
    want = {min((docs[j][0] for j in range(len(docs)) if group[j] == g and docs[j][0] is not None), default=None) for g in set(group)}
    assert kept.columns == df.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, want))
    assert N.keep_one(df.limit(0)).collect() == []


def test_bands_in_steps(monkeypatch):
    hashes = np.random.default_rng(1).integers(0, 2**64, 9000, np.uint64, endpoint=False)
    whole = N.bands(hashes)
    monkeypatch.setattr(N, "_STEP", 17)
    assert N.bands(hashes) == whole == N.bands(hashes[::-1]) and len(set(whole)) == N.BANDS


def test_a_very_long_text(spark):
    t = [f"w{k % 7919}" for k in range(200_000)]
    u = t[:100_000] + ["new"] + t[100_001:]
    rows = N.near_groups(spark.createDataFrame([(2, " ".join(t)), (5, " ".join(u))], "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == {2: 2, 5: 2}


def test_links_between_components_of_many_members(spark, monkeypatch):
    """Two families hang together by one pair, whose nodes do not stand for their components in the buckets."""
    monkeypatch.setattr(N, "MEMBERS", 2)
    rng, families = random.Random(1), []
    for g in range(8):
        a = [f"{g}w{rng.randrange(10**6)}" for _ in range(300)]
        places = rng.sample(range(5, 295, 6), 16)
        changed = lambda n: [f"x{p}" if p in places[:n] else w for p, w in enumerate(a)]  # noqa: E731, B023
        family = [changed(5), changed(11)]
        for t in (a, changed(16)):
            for _ in range(12):
                u = list(t)
                u[rng.randrange(300)] = f"y{rng.randrange(10**6)}"
                family.append(u)
        rng.shuffle(family)
        families.append([" ".join(u) for u in family])
    docs = list(enumerate(t for f in families for t in f))
    rows = {r.doc_id: r.component_id for r in N.near_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    at = 0
    for f in families:
        group = brute_components(f)
        assert [rows[at + i] for i in range(len(f))] == [at + group.index(g) for g in group]
        at += len(f)


@pytest.mark.parametrize("changes", [3, 13])
def test_verified_pairs_grow_with_the_rows(spark, monkeypatch, changes):
    """A large group of copies of one text, all near it or all too far from it and from each other: few pairs a row."""
    rng, seen = random.Random(changes), []
    a = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    docs = [(0, " ".join(a))]
    for k in range(1, 201):
        u = list(a)
        for at in rng.sample(range(5, 295, 5), changes):
            u[at] = f"y{rng.randrange(10**6)}"
        docs.append((k, " ".join(u)))
    whole = N.verified
    monkeypatch.setattr(N, "verified", lambda pairs, *more: (seen.append(pairs.count()), whole(pairs, *more))[1])
    rows = {r.doc_id: r.component_id for r in N.near_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [rows[k] for k in range(len(docs))] == brute_components([t for _, t in docs])
    assert len(set(rows.values())) == (1 if changes == 3 else len(docs))
    assert sum(seen) <= 3 * len(docs)


def test_parity_bits_differ_at_most_as_sets_do():
    rng = np.random.default_rng(2)
    for n in (1, 40, 3000):
        hashes = np.unique(rng.integers(0, 2**64, 2 * n, np.uint64, endpoint=False))
        x, y = hashes[: n + n // 9], hashes[n // 9 :]
        bits = [np.array(N.parity(s), np.int64).view(np.uint64) for s in (x, y)]
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(x, y)) and len(bits[0]) == N.PARITY
    assert N.parity(np.zeros(0, np.uint64)) == [0] * N.PARITY
