"""Operators on small cases worked out by hand or by a plain version."""

import math
import random
import re
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusq.functions import edits
from corpusq.functions import statistics as S
from corpusq.functions import text as X
from corpusq.operators import corpus, entities, heads, markup, ordered, spans
from corpusq.sources import files


def value(spark, c, **cols):
    row = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'int'}" for k, v in cols.items()))
    return row.select(c.alias("x")).first().x


def test_text_functions(spark):
    t = lambda f, s: value(spark, f(F.col("s")), s=s)
    assert t(X.normalize_for_comparison, " «a»  b ; c – d­e’s ") == "\"a\" b; c - de's"
    assert t(X.normalize_for_tei, "‹a› — b !") == "’a’ – b!"
    assert t(X.fold, "Ärger groß É") == "arger gross e"
    assert [t(X.normalize_lang_code, s) for s in ("fr-FR", "[ger]", "zxx", "??", "")] == ["fra", "deu", "zxx", "??", ""]
    assert [t(X.blank_reason, s) for s in (None, " ab ", "-- ... -- ...", "[ Blank  Page. ]", "a real page text")] == ["", "len<=5", "no-alnum", "blank-marker", ""]
    assert t(X.strip_markup, "<p>a<!-- x --><b>b</b> &lt;c&amp;</p>") == "a b <c&"
    assert t(lambda c: X.nth_index(c, F.lit("ab"), F.lit(1)), "abxabab") == 3
    assert t(lambda c: X.nth_index(c, F.lit("ab"), F.lit(3)), "abxabab") == -1
    assert t(X.initials_only, "J.-P. A.") and not t(X.initials_only, "Anna P.")
    assert t(X.title_author, "ANNA KELLER") == "Anna Keller" and t(X.title_author, "Anna KELLER") == "Anna KELLER"
    assert t(X.dehyphenate, "wo-\nrd A-\nB") == "word A-\nB"


def test_cer(spark):
    c = lambda r, h: value(spark, X.cer(F.col("r"), F.col("h")), r=r, h=h)
    assert (c("", ""), c("", "x"), c("abcd", "abxd"), c("é", "e"), c("same", "same")) == (0.0, 1.0, 0.25, 1.0, 0.0)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_edit_scripts():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcé ") for _ in range(rng.randrange(25))) for _ in range(2))
        ops = edits.opcodes(a, b)
        assert "".join(b[j1:j2] if t != "equal" else a[i1:i2] for t, i1, i2, j1, j2 in ops) == b
        assert [o[1] for o in ops[1:]] == [o[2] for o in ops[:-1]] and [o[3] for o in ops[1:]] == [o[4] for o in ops[:-1]]
        assert edits.decompose(a, b, 4)[2] == plain_distance(a, b)
    assert edits.decompose("ab", "a" + "x" * 60 + "b") == (0, 60, 60)
    assert edits.decompose("a" + "x" * 60 + "b", "ab") == (60, 0, 60)


def test_categories():
    c = edits.category
    assert [c(" ", ""), c("e", "é"), c(",", "."), c("-\n", ""), c("x" * 60, ""), c("".join(map(chr, range(200, 290))), ""), c("a", "b")] == ["whitespace", "diacritic", "punctuation", "punctuation", "artifact", "layout", "other"]
    assert c("a-", "a") == "hyphenation"


def test_words_as_chars():
    a, b = edits.words_as_chars("the cat sat", "the dog sat down")
    assert plain_distance(a, b) == 2 and len(a) == 3


def test_bootstrap():
    v, one = np.array([0.0, 1.0, 2.0, 3.0, 10.0]), np.ones(5, np.int64)
    assert S.percentile_ci(v, S.mean, 500, 1) == S.percentile_ci(v, S.mean, 500, 1)
    for f in (S.percentile_ci, S.bca_ci):
        lo, hi = f(v, S.mean, 2000, 1)
        assert v.min() <= lo < v.mean() < hi <= v.max()
        assert f(v[:1], S.mean, 10, 1) == (0.0, 0.0)
    assert S.norm_ppf(0.975) == pytest.approx(1.96, abs=0.01) and S.chi2_sf(3.84, 1) == pytest.approx(0.05, abs=0.005)
    assert S.paired(np.array([1.0]), 100, 1, np.array([3])) == (1.0, 1.0, 1.0, 0.0)
    rng = np.random.default_rng(4)
    for _ in range(50):
        values = np.unique(rng.integers(0, 30, rng.integers(1, 9))).astype(float)
        counts = rng.integers(1, 6, len(values))
        whole = np.repeat(values, counts)
        assert S.mean(values, counts) == pytest.approx(whole.mean()) and S.median(values, counts) == np.median(whole)
    # Counted values give the distribution of resampled rows.
    rows = rng.choice(v, (20_000, 40))
    lo, hi = S.percentile_ci(v, S.mean, 20_000, 3, counts=8 * one)
    assert (lo, hi) == (pytest.approx(np.quantile(rows.mean(1), 0.025), abs=0.15), pytest.approx(np.quantile(rows.mean(1), 0.975), abs=0.15))


def test_block_and_share_intervals():
    rates, weights = np.array([0.1, 0.2, 0.05]), np.array([10.0, 20.0, 70.0])
    lo, hi = S.block_ci(rates, weights, 4000, 1)
    assert 0.05 <= lo < np.average(rates, weights=weights) < hi <= 0.2
    assert S.block_ci(np.array([0.4]), np.array([3.0]), 10, 1) == (pytest.approx(0.4), pytest.approx(0.4))
    assert S.block_ci(np.array([0.4, 0.1]), np.array([1.0, 3.0]), 10, 1) == (pytest.approx(0.175), pytest.approx(0.175))
    lo, hi = S.bernoulli_ci(80, 100, 10_000, 1)
    assert (lo, hi) == (pytest.approx(0.72, abs=0.02), pytest.approx(0.87, abs=0.02)) and S.bernoulli_ci(5, 5, 100, 1) == (1.0, 1.0)


def test_p_values():
    assert S.pearson_p(0.5, 20) == pytest.approx(0.02477, abs=1e-5) and S.pearson_p(0.0, 9) == pytest.approx(1) and S.pearson_p(1.0, 9) == 0
    assert S.incomplete_beta(2, 3, 0.4) == pytest.approx(0.5248) and S.ks_p(0.5, 10, 12) == pytest.approx(0.09, abs=0.03) and S.ks_p(0.01, 50, 50) == 1


def test_leave_one_out():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=30), rng.normal(size=30)
    out = []
    for k in range(30):
        a, b = np.delete(x, k), np.delete(y, k)
        slope = np.cov(a, b)[0, 1] / a.var()
        out.append(b.mean() + slope * (x[k] - a.mean()))
    assert S.single_loocv(x, y) == pytest.approx(1 - ((y - out) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    z = rng.normal(size=(40, 2))
    t = z @ [2.0, -1.0] + 3 + rng.normal(size=40)
    c, inverse = S.solved(40, z.sum(0), z.T @ z, t.sum(), z.T @ t)
    full = np.column_stack([np.ones(40), z])
    e, h = t - full @ c, np.einsum("ij,jk,ik->i", full, inverse, full)
    refits = [t[k] - full[k] @ np.linalg.lstsq(np.delete(full, k, 0), np.delete(t, k), rcond=None)[0] for k in range(40)]
    assert e / (1 - h) == pytest.approx(np.array(refits))


def plain_order(boxes, wide=60, gap=12):
    top = sorted((i for i, b in enumerate(boxes) if b[2] >= wide), key=lambda i: (boxes[i][1], i))

    def columns(ids):
        ids = sorted(ids, key=lambda i: (boxes[i][0] + boxes[i][2] / 2, i))
        cols = []
        for i in ids:
            if cols and boxes[i][0] + boxes[i][2] / 2 - (boxes[cols[-1][-1]][0] + boxes[cols[-1][-1]][2] / 2) <= gap:
                cols[-1].append(i)
            else:
                cols.append([i])
        return [i for c in cols for i in sorted(c, key=lambda i: (boxes[i][1], i))]

    out, low = [], float("-inf")
    for t in [*top, None]:
        high = boxes[t][1] if t is not None else float("inf")
        out += columns([i for i, b in enumerate(boxes) if b[2] < wide and low <= b[1] < high])
        if t is not None:
            out.append(t)
            low = high
    return out


def test_reading_order(spark):
    rng = random.Random(2)
    pages = [[(rng.randrange(60) * 1.0, rng.randrange(40) * 1.0, rng.choice([10.0, 30.0, 70.0])) for _ in range(rng.randrange(1, 9))] for _ in range(60)]
    rows = [(p, i, *b) for p, page in enumerate(pages) for i, b in enumerate(page)]
    got = ordered.reading_order(spark.createDataFrame(rows, "page int, idx int, x double, y double, w double"), ["page"]).orderBy("page", "place").collect()
    for p, page in enumerate(pages):
        assert [r.idx for r in got if r.page == p] == plain_order(page)


def test_interpolation_never_fills_before_the_first(spark):
    rows = [(1, 1, None), (1, 2, 5), (1, 3, None), (1, 4, 7), (1, 5, None), (1, 6, 12), (1, 7, None)]
    got = ordered.interpolate(spark.createDataFrame(rows, "d int, page int, num int"), ["d"], "page", "num").orderBy("page").collect()
    assert [r.filled for r in got] == [None, 5, 6, 7, None, 12, 13]


def test_page_lists(spark):
    rows = [("a", 1, 3), ("a", 2, 3), ("a", 3, 3), ("b", 1, 9), ("b", 3, 9), ("b", 4, 9), ("b", 9, 9), ("b", 9, 9)]
    got = ordered.encode_pages(spark.createDataFrame(rows, "d string, page int, total int"), ["d"], "page", F.col("total")).collect()
    assert {r.d: r.pages for r in got} == {"a": "*", "b": "1,3-4,9"}


def test_spans(spark):
    points = spark.createDataFrame([(1, 0), (1, 5), (1, 99), (2, 3)], "d int, at int")
    starts = spark.createDataFrame([(1, 2, 1), (1, 5, 2), (1, 50, 3)], "d int, start int, page int")
    assert sorted((r.d, r.at, r.page) for r in spans.page_of(points, starts, ["d"], "at").collect()) == [(1, 0, 1), (1, 5, 2), (1, 99, 3), (2, 3, 1)]
    zones = spark.createDataFrame([(1, 0, 5), (1, 90, 99)], "d int, start int, end int")
    assert sorted((r.d, r.at) for r in spans.in_zone(points, zones, ["d"], "at", "left_anti").collect()) == [(1, 5), (1, 99), (2, 3)]
    merged = spans.merge_spans(spark.createDataFrame([(1, 0, 4), (1, 2, 3), (1, 4, 9), (1, 11, 12)], "d int, start int, end int"), ["d"])
    assert sorted((r.start, r.end) for r in merged.collect()) == [(0, 9), (11, 12)]


def plain_heads(segments, n_pages):
    """Page by page: {(page, idx): (form, kind, reason)} of one document's segments [(page, idx, form, in_head)]."""
    short = [x for x in segments if 2 <= len(x[2]) <= 80]
    on = {}
    for page, _, form, _ in short:
        on.setdefault(form, []).append(page)
    solo = {f: {p for p in ps if ps.count(p) == 1} for f, ps in on.items()}
    kinds = {f: "primary" for f, ps in solo.items() if len(ps) >= max(3, math.ceil(n_pages * 0.05))}
    if not kinds:
        sides = [f for f, ps in solo.items() if len(ps) >= 2 and len({p % 2 for p in ps}) == 1]
        for f in sides:
            for g in sides:
                if min(solo[f]) % 2 != min(solo[g]) % 2 and len(solo[f] | solo[g]) >= n_pages * 0.5:
                    kinds[f] = "alternating"
    base = list(kinds)
    for f in on:
        if f not in kinds and any(len(f) <= 2 * len(b) and re.search(rf"(?:^|\W){re.escape(b)}(?:\W|$)", f) for b in base):
            kinds[f] = "contains"
    place = {(p, i): f for p, i, f, _ in short}
    follows = {}
    for (p, i), f in place.items():
        if f in kinds and place.get((p, i - 1)) in kinds and place[p, i - 1] != f:
            follows.setdefault(f, set()).add(p)
    found = {}
    for p, i, f, _ in short:
        if f not in kinds:
            continue
        lead = [x for x in segments if x[0] == p]
        block = 0
        while block < min(4, len(lead)) and 2 <= len(lead[block][2]) <= 80:
            block += 1
        block = block if any(x[3] for x in lead[:block]) else 0
        reason = None
        if p not in solo[f]:
            reason = "repeated-on-page"
        elif i < block:
            reason = "title-block"
        elif p in follows.get(f, ()) and len(follows[f]) * 2 < len(solo[f]):
            reason = "off-slot"
        elif kinds[f] == "contains" and i >= 3:
            reason = "inner-variant"
        found[p, i] = (f, kinds[f], reason)
    return found


def test_running_heads_against_a_plain_version(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for d in range(40):
        n_pages, forms = rng.randrange(1, 14), ["my head", "verso", "recto", "my head now", "a my head", "chapter two", "x" * 90, "of it", "head"]
        segments = []
        for p in range(1, n_pages + 1):
            lines = [rng.choice(forms[:4] if d % 2 else forms) if rng.random() < 0.6 else f"line {p} {k} of text" for k in range(rng.randrange(1, 7))]
            if d % 4 == 3:
                lines = ["verso" if p % 2 else "recto", *(f"t {p} {k}" for k in range(3))]
            segments += [(p, i, f, i == 0 and rng.random() < 0.3) for i, f in enumerate(lines)]
        rows += [(d, *x) for x in segments]
        want |= {(d, *k): v for k, v in plain_heads(segments, n_pages).items()}
    got = heads.detect(spark.createDataFrame(rows, "doc int, page int, idx int, form string, in_head boolean")).collect()
    assert {(r.doc, r.page, r.idx): (r.form, r.kind, r.reason) for r in got} == want and len(got) == len(want)
    assert {v[2] for v in want.values()} >= {None, "repeated-on-page", "title-block", "off-slot", "inner-variant"}


def test_allocation_and_sample(spark):
    cells = spark.createDataFrame([("a", 5), ("b", 3), ("c", 2)], "k string, n int")
    got = {r.k: r.share for r in corpus.largest_remainder(cells, ["k"], "n", 7).collect()}
    assert sum(got.values()) == 7 and got == {"a": 4, "b": 2, "c": 1}
    rows = spark.createDataFrame([(i % 3, i) for i in range(50)], "s int, k int")
    one, two = (sorted((r.s, r.k) for r in corpus.stratified_sample(rows.repartition(n), ["s"], "k", 4, 1).collect()) for n in (1, 7))
    assert one == two and len(one) == 12


def test_mentions_with_punctuation(spark):
    forms = ["Jean-Paul Sartre", "J. Smith", "O'Neil", "Weber, Max", "'t Hooft", "Hooft", "Jean", "St.Gallen", "..."]
    text = "Jean-Paul Sartre, J. Smith; O'Neil and O'Neill; (Weber, Max) 't Hooft ... Jean Hooft St.Gallen xJ. Smith"
    docs = spark.createDataFrame([(1, text), (2, "J. Smith")], "doc_id long, text string")
    rows = entities.scan_mentions(docs, [(f, f"g{k}", "headword", 1) for k, f in enumerate(forms)]).orderBy("doc_id", "start").collect()
    assert [r.surface for r in rows] == ["Jean-Paul Sartre", "J. Smith", "O'Neil", "Weber, Max", "'t Hooft", "Jean", "Hooft", "St.Gallen", "J. Smith"]
    assert all((text if r.doc_id == 1 else "J. Smith")[r.start : r.end] == r.surface for r in rows)


def test_mentions(spark):
    lexicon = [("Anna Keller", "g1", "exact", 1), ("Keller", "g1", "bare-surname", 2), ("Keller", "g2", "bare-surname", 2)]
    text = "Kellermann met Anna Keller, then Keller's friend and Anna."
    rows = entities.scan_mentions(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), lexicon).orderBy("start").collect()
    assert [(text[r.start : r.end], r.gid, r.tier, r.rule, r.alternatives) for r in rows] == [("Anna Keller", "g1", 1, "exact", []), ("Keller", "g1", 2, "bare-surname:ambiguous", ["g2"])]


@pytest.mark.parametrize("partitions", [1, 3, 4, 64])
def test_case_numbers(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = spark.createDataFrame([(i, i * 7 % 1013) for i in range(3000)], "doc int, score int")
        got = entities.numbered(df, [F.col("score").desc(), "doc"], "f").collect()
        assert {r.case_id: (r.score, r.doc) for r in got} == {f"f{k + 1:04d}": (-a, b) for k, (a, b) in enumerate(sorted((-(i * 7 % 1013), i) for i in range(3000)))}
        ranks = ordered.ranked(df.withColumn("score", F.col("score") % 3), ["score"], ["doc"]).collect()
        for k in range(3):
            mine = sorted((r["rank"], r.doc) for r in ranks if r.score == k)
            assert [a for a, _ in mine] == list(range(1, len(mine) + 1)) and [b for _, b in mine] == sorted(b for _, b in mine)
        m = {r.score: r["median"] for r in ordered.medians(df.withColumn("score", F.col("score") % 3), ["score"], "doc").collect()}
        assert m == {k: float(np.median([i for i in range(3000) if i * 7 % 1013 % 3 == k])) for k in range(3)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_drifting_pages_against_a_plain_version(spark):
    from corpusq.operators.pages import match_drifting

    rng, rows, want = random.Random(11), [], {}
    words = ["Alphabet", "notebook", "Seventeen", "mountain", "yellowish", "Kerosene", "windowsill", "paperback", "short", "of"]
    for d in range(30):
        ref = {p: " ".join(rng.choice(words) + rng.choice(["", "x", "yz"]) for _ in range(rng.randrange(1, 14))) for p in range(1, rng.randrange(2, 9))}
        hyp, shift = {}, rng.randrange(0, 4)
        for p, t in ref.items():
            shift += rng.random() < 0.2
            if rng.random() < 0.85:
                hyp[p + shift] = t.upper() if rng.random() < 0.5 else "nothing here " * 5
        rows += [(d, "ref", p, t) for p, t in ref.items()] + [(d, "hyp", p, t) for p, t in hyp.items()]

        def score(a, b):
            return sum(w.lower() in b.lower() for w in [w for w in a.split() if len(w) > 5][:8])

        offset, found = 0, False
        for p in sorted(ref):
            if len(ref[p]) < 50:
                continue
            for pages in ([] if found else sorted(hyp)), [q for q in range(p + offset - 2, p + offset + 4) if q in hyp]:
                scored = [(score(ref[p], hyp[q]), q) for q in pages]
                top = max((s for s, _ in scored), default=0)
                if top >= 2:
                    q = next(q for s, q in scored if s == top)
                    offset, found, want[d, p] = q - p, True, q
                    break
            else:
                if p + offset in hyp:
                    want[d, p] = p + offset
    got = match_drifting(spark.createDataFrame(rows, "doc long, kind string, page long, text string")).collect()
    assert {(r.doc, r.page): r.match for r in got} == want and len(want) > 40


def test_pages_pair_by_place_without_common_numbers(spark):
    from corpusq.operators.pages import pair_pages

    ref = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (2, 2, "d"), (3, 1, "e")], "doc int, page int, ref string")
    hyp = spark.createDataFrame([(1, 2, "B"), (1, 9, "x"), (2, 30, "C"), (2, 40, "D"), (2, 50, "E")], "doc int, page int, hyp string")
    assert sorted(tuple(r) for r in pair_pages(ref, hyp, "doc", "page").select("doc", "page", "ref", "hyp").collect()) == [(1, 2, "b", "B"), (2, 1, "c", "C"), (2, 2, "d", "D")]


def test_markup():
    x = "<TEI xmlns='t'><text><body><pb/><p>a<lb/>b<lb break='no'/>c <choice><sic>x</sic><corr>y</corr></choice><note place='foot'>no</note> t</p><pb/>z &amp;</body></text></TEI>"
    assert markup.body_pages(x) == [(1, "a bc y t"), (2, "z &")]
    assert markup.body_pages(x, True)[0] == (1, "a bc yno t")
    assert markup.body_pages("<p>broken <b>x &amp; y") == [(1, "broken x & y")]


def test_rewrites_are_idempotent(spark):
    assert value(spark, markup.apostrophes(markup.apostrophes(F.col("s"))), s="l'été <a b='c'd'>n'a 'x'") == "l’été <a b='c'd'>n’a 'x'"
    assert value(spark, markup.bracketed(markup.bracketed(F.col("s"))), s="12") == "[12]"


def test_sources(spark, tmp_path):
    for source, page, text in (("mistral", 1, "m1"), ("curated", 1, "c1"), ("mistral", 2, "m2"), ("other", 3, "o3")):
        (tmp_path / "ocr" / source).mkdir(parents=True, exist_ok=True)
        (tmp_path / "ocr" / source / f"10_p{page}.md").write_text(text)
    best = files.best_texts(files.page_texts(spark, str(tmp_path / "ocr")))
    assert sorted((r.doc, r.page, r.source, r.text) for r in best.collect()) == [("10", 1, "curated", "c1"), ("10", 2, "mistral", "m2")]
    assert files.skip_cover(best, spark.createDataFrame([("10", True)], "doc string, has_cover boolean")).count() == 1
    (tmp_path / "layout").mkdir()
    (tmp_path / "layout/a.json").write_text('{"doc_id": "10", "page": 1, "image_width": 0, "regions": [{"label": "x", "bbox": {"x_pct": -5, "y_pct": 1, "w_pct": 300, "h_pct": 4}}]}')
    (tmp_path / "layout/b.json").write_text("{broken")
    pages = files.layouts(spark, str(tmp_path / "layout"))
    assert [(r.x, r.w) for r in files.regions(pages).collect()] == [(0.0, 100.0)]
    with pytest.raises(Exception, match="(?i)malformed|failfast|bad"):
        files.layouts(spark, str(tmp_path / "layout"), strict=True).collect()
    (tmp_path / "m.csv").write_text("ID;PublForm;Jahr;Anzahl Seiten;Sprache;digitalisiert\n10.0;article;ca. 1946/47;12;fr;x\n ;;;;;\nA7;book;s.d.;;de;\n")
    assert [tuple(r) for r in files.masterfile(spark, str(tmp_path / "m.csv")).collect()] == [("10", "article", "1946", 12, "fr", True), ("A7", "book", "", None, "de", None)]
    (tmp_path / "img").mkdir()
    (tmp_path / "img/a.png").write_bytes(b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 640, 480))
    (tmp_path / "img/b.png").write_bytes(b"GIF")
    assert sorted((r.name, r.width, r.height) for r in files.png_sizes(spark, str(tmp_path / "img")).collect()) == [("a.png", 640, 480), ("b.png", None, None)]
    files.write_worklist(spark.createDataFrame([(1, "a")], "k int, v string").coalesce(1), str(tmp_path / "out"))
    assert next((tmp_path / "out").glob("*.csv")).read_text() == "﻿k;v\n1;a\n"


def test_stream_is_the_batch(spark, tmp_path):
    from corpusq.streaming import status

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    q = status.latest_status(status.read_events(spark, str(tmp_path / "in"), events.schema, 1)).writeStream.outputMode("complete").format("memory").queryName("latest").start()
    q.processAllAvailable()
    q.stop()
    want = ordered.latest(events, ["user_id"], "event_type", ["ts", "event_id"])
    assert sorted(map(tuple, spark.table("latest").collect())) == sorted(map(tuple, want.collect()))


def test_greedy_match(spark):
    from corpusq.operators.pages import greedy_match

    rows = [(1, "ref", 7, 10, 1), (1, "ref", 7, 12, 1), (1, "ref", 7, 900, 1), (1, "cand", 7, 11, 2), (1, "cand", 7, 60, 1), (1, "cand", 7, 13, 2), (1, "cand", 8, 10, 1)]
    got = greedy_match(spark.createDataFrame(rows, "doc long, kind string, gid long, at long, tier long")).collect()
    assert sorted((r.at, r.matched, r.tier) for r in got) == [(10, 60, 1), (12, 11, 2)]


def test_balanced():
    from corpusq.operators.pages import balanced

    for s in ("</div>a<div>b", "<div><div>x</div>", "a", "", "<div n='1'></div></div></div>"):
        t = balanced(s)
        assert t.count("<div") == t.count("</div>") and balanced(t) == t


def test_language_and_text_helpers(spark):
    t = lambda f, s: value(spark, f(F.col("s")), s=s)
    assert [t(X.first_language, s) for s in ("FR", "fra/deu", "en, fr", "?", None, "/x")] == ["fr", "fra", "en", "unknown", "unknown", "unknown"]
    assert [t(X.language_idents, s) for s in ("fra", "fra/deu", "fr", "", "?", "fr;fr")] == ["fra", "fra,deu", "fra", "und", "und", "fra"]
    assert [t(X.has_emphasis, s) for s in ("a *b* c", "a * b * c", "_x y_", "snake_case_name", "**bold**", "no")] == [True, False, True, False, True, False]
    assert t(lambda c: X.tagged_block(c, "text"), "a <text> b\nc </text>") == "b\nc" and t(lambda c: X.tagged_block(c, "text"), " d ") == "d"
    assert t(X.unbracketed, "[12]") == t(X.unbracketed, "12") == "12" and t(X.bracketed, "12") == "[12]"
    assert t(X.xml_escape, '<a b="c">&') == "&lt;a b=&quot;c&quot;&gt;&amp;" and t(X.ascii_only, "Größe – x") == "Grosse ? x"
    assert t(X.nfc, "e\u0301a") == "\xe9a" and t(lambda c: X.regime(c, "nfc_hyphen_case"), "A\u2010b\u00adC") == "a-bc"
    assert [t(lambda c: F.array_join(X.rated_words(c, F.lit("fr")), " "), s) for s in ("le chat Paris ONU", "Paris Rome le")] == ["le chat onu", "paris rome le"]


def test_cases_in_two_batches_are_an_error(spark):
    from corpusq.operators import reviews

    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "case_id int, v string"), spark.createDataFrame([(3, "z")], "case_id int, v string")
    assert reviews.merged(a, b, "case_id").count() == 3
    with pytest.raises(Exception, match="case in two batches: 2"):
        reviews.merged(a, b.unionByName(a.where("case_id = 2")), "case_id").collect()


def test_stored_tables(spark):
    from corpusq import storage

    assert storage.work_path(spark, "x") != storage.work_path(spark, "x")
    kept = storage.stored(spark.range(5), "kept")
    assert kept.count() == 5
    storage.discard(kept)
    with pytest.raises(Exception, match="(?i)not exist|does not exist|FileNotFound|FAILED_READ"):
        kept.count()
