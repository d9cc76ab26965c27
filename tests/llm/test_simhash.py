import random

import xxhash

from corpusq.llm import simhash as S


def brute_fp(text, width=3):
    w = [x for x in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if x]
    if not w:
        return 0
    s = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint():
    rng = random.Random(1)
    for t in [None, "", " \t\n", "A", "a B", "É x\x0by z\x1fq", *[" ".join(rng.choice("abcdeÄ") for _ in range(rng.randrange(60))) for _ in range(50)]]:
        assert S.fingerprint(t) == brute_fp(t)


def cluster(n, seed):
    rng = random.Random(seed)
    mids = [rng.getrandbits(64) for _ in range(3)]
    found = {rng.getrandbits(64) for _ in range(n // 4)}
    while len(found) < n:
        x = rng.choice(mids)
        for _ in range(rng.randrange(6)):
            x ^= 1 << rng.choice(range(0, 64, rng.choice([1, 3, 9])))
        found.add(x)
    return sorted(map(signed, found))


def brute_links(fps):
    return {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}


def test_links(spark):
    for n, hot in ((300, 256), (300, 8), (24, 1)):
        fps = cluster(n, 5)
        df = spark.createDataFrame([(x,) for x in fps], "fp long")
        want = brute_links(fps)
        assert len(want) > n // 3
        got = [(r.a, r.b) for r in S.links(df, hot).collect()]
        assert len(got) == len(set(got)) and set(got) == want, hot


def test_components(spark):
    words = [f"w{i}" for i in range(200)]
    rng = random.Random(2)
    docs = []
    for g in range(4):
        t = [rng.choice(words) for _ in range(300)]
        for k in range(5):
            t = list(t)
            t[rng.randrange(300)] = "new"
            docs.append((len(docs), " ".join(t), "x"))
    docs += [(100, None, "x"), (101, "", "x"), (102, " \n", "x"), (100, None, "x"), (None, "alone here", "x"), (7, docs[7][1], None)]
    rows = S.near_groups(spark.createDataFrame(docs, "doc_id long, text string, fingerprint string")).collect()
    fps = [brute_fp(t) for _, t, _ in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                group = [group[j] if g == group[i] else g for g in group]
    want = []
    for i, (d, _, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if group[j] == group[i] and docs[j][0] is not None]
        want.append((d, f"{fps[i]:016x}", min(ids, default=None)))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_empty(spark):
    assert S.near_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
