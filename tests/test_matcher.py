"""The entity matcher on sentences worked out by hand, and its spans against a plain scan."""

import random
import re

import pytest

from corpusq.operators import matcher as M

FORMS = [
    ("Karl Jaspers", "g1", "person", "full-name"), ("Jeanne Hersch", "g2", "person", "full-name"), ("Ignace", "g5", "person", "full-name"), ("Hans Mayer", "g8", "person", "full-name"),
    ("Die Mauer", "w1", "work", "work-title"), ("Der Turm", "w2", "work", "work-title"), ("UNESCO", "o1", "org", "org-token"), ("Neue Partei", "o2", "org", "org-name"),
    ("Anna Weber", "g11", "person", "full-name"), ("Anna Weber", "g12", "person", "variant-full-name"), ("J. Hersch", "g2", "person", "initial-surname"), ("K. J.", "g1", "person", "full-name:initials"),
]
SURNAMES = [
    ("Jaspers", "g1", False), ("Hersch", "g2", False), ("Mayer", "g3", False), ("Mayer", "g8", False), ("Loyola", "g5", False), ("Kant", "g6", True),
    ("Schwarz-Bart", "g7", False), ("Freud", "g9", False), ("Weil", "g10", False), ("Weber", "g11", False),
]
CASES = {
    "Jaspers met Karl Jaspers. Then Jaspers too.": [("Jaspers", "g1", "anchored-surname", 1), ("Karl Jaspers", "g1", "full-name", 1), ("Jaspers", "g1", "anchored-surname", 1)],
    "Then Hersch and Herschs Werk.": [("Hersch", "g2", "bare-surname", 2), ("Herschs", "g2", "bare-surname", 2)],
    "Karl Jasperss book, Karl Jaspersheim.": [("Karl Jasperss", "g1", "full-name", 1)],
    "KARL JASPERS, die Mauer; Die Mauer.": [("KARL JASPERS", "g1", "caps-full-name", 1), ("die Mauer", "w1", "work-title:suspect", 2), ("Die Mauer", "w1", "work-title", 1)],
    "neue Partei und Neue partei": [("neue Partei", "o2", "org-name", 1), ("Neue partei", "o2", "org-name", 1)],
    "neue partei": [("neue partei", "o2", "org-name:suspect", 2)],
    "UNESCO-Kommission, UNESCO": [("UNESCO", "o1", "org-token:suspect", 2), ("UNESCO", "o1", "org-token", 1)],
    "Saint Ignace de Loyola kam. Ignace de Mayer.": [("Ignace de Loyola", "g5", "full-name", 1), ("Ignace", "g5", "full-name", 1), ("Mayer", "g3", "bare-surname:ambiguous", 2)],
    "Er las Kant. Schwarz-Barts Buch, Freudschen, FREUD.": [("Kant", "g6", "anchor-free-surname", 1), ("Schwarz-Barts", "g7", "bare-surname", 2), ("Freudschen", "g9", "adjective-form", 2), ("FREUD", "g9", "caps-surname", 2)],
    "Er traf Otto Mayer, Hans Mayer und Mayer.": [("Mayer", "g8", "anchored-surname:suspect", 2), ("Hans Mayer", "g8", "full-name", 1), ("Mayer", "g8", "anchored-surname", 1)],
    "Frau Hersch (de Genève). Hersch (1910).": [("Hersch", "g2", "bare-surname:suspect", 2), ("Hersch", "g2", "bare-surname", 2)],
    "kant und Kant. Weil er kam.": [("Kant", "g6", "anchor-free-surname:suspect", 2), ("Weil", "g10", "bare-surname:suspect", 2)],
    "Salamun K., Karl Jaspers, Munich. Fondation Karl Jaspers. Karl Jaspers, éd. X": [("Karl Jaspers", "g1", "full-name:suspect", 2)] * 3,
    "Anna Weber. Weber kam.": [("Anna Weber", "g11", "full-name:ambiguous", 2), ("Weber", "g11", "bare-surname", 2)],
    "J. Hersch und K. J. hier; Hersch.": [("J. Hersch", "g2", "initial-surname", 1), ("K. J.", "g1", "full-name:initials", 2), ("Hersch", "g2", "anchored-surname", 1)],
    "Le Hersch Paris.": [("Hersch", "g2", "bare-surname:suspect", 2)],
}


@pytest.fixture(scope="module")
def lists(spark):
    return spark.createDataFrame(FORMS, "form string, gid string, category string, rule string"), spark.createDataFrame(SURNAMES, "key string, gid string, released boolean")


def test_rules(spark, lists):
    texts = list(CASES)
    rows = M.find(spark.createDataFrame([*enumerate(texts), (99, None), (98, "")], "doc_id long, text string"), *lists).orderBy("doc", "start").collect()
    got = {t: [(t[r.start : r.stop], r.gid, r.rule, r.tier) for r in rows if r.doc == i] for i, t in enumerate(texts)}
    for t, want in CASES.items():
        assert got[t] == want, t
    assert {tuple(r.alternatives) for r in rows if r.form == "Mayer"} == {("g3", "g8")} and {tuple(r.alternatives) for r in rows if r.form == "Anna Weber"} == {("g11", "g12")}


def test_zones(spark, lists):
    text = "Karl Jaspers here. Karl Jaspers there. Hersch too."
    zones = spark.createDataFrame([(1, "running-head", 0, 5), (1, "in-figure", 0, 5), (1, "in-plain-bibl", 19, 30)], "doc long, kind string, start long, stop long")
    rows = M.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), *lists, zones=zones).orderBy("start").collect()
    assert [(r.rule, r.tier) for r in rows] == [("full-name:in-figure:running-head", 2), ("full-name:in-plain-bibl", 2), ("bare-surname", 2)]


def test_spans_against_a_plain_scan(spark):
    """Listed forms only: longest first at each word start, whole words, a genitive s, no overlap."""
    rng, parts = random.Random(2), ["ab", "cd", "Ef", "Gh", "x-y", "12"]
    forms = sorted({" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(25)})
    texts = ["".join(rng.choice([*parts, "abs", "Efs", "cdian"]) + rng.choice([" ", " ", ". ", "-", "  "]) for _ in range(rng.randrange(40))) for _ in range(60)]
    f = spark.createDataFrame([(x, f"g{k}", "org", "org-name") for k, x in enumerate(forms)], "form string, gid string, category string, rule string")
    none = spark.createDataFrame([], "key string, gid string, released boolean")
    rows = M.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), f, none).collect()
    got = sorted((r.doc, r.start, r.stop, r.form) for r in rows if r.form == texts[r.doc][r.start : r.start + len(r.form)])
    want = []
    for d, t in enumerate(texts):
        at = 0
        for m in re.finditer(r"\w+", t):
            if m.start() < at:
                continue
            for x in sorted(forms, key=len, reverse=True):
                end = re.match(rf"{re.escape(x)}(?:(?:{'|'.join(M.ADJECTIVE_SUFFIXES)})(?!\w)|s?(?!\w))", t[m.start() :])
                if end and re.match(r"\w+", x)[0] == m[0]:  # forms are looked up by their whole first word
                    at = m.start() + end.end()
                    want.append((d, m.start(), at, x))
                    break
    assert sorted(set(got) ^ set(want)) == []
    assert len(want) > 100 and len(got) == len(want)


def test_an_empty_list(spark):
    forms, none = spark.createDataFrame([], "form string, gid string, category string, rule string"), spark.createDataFrame([], "key string, gid string, released boolean")
    assert M.find(spark.createDataFrame([(1, "Some text")], "doc_id long, text string"), forms, none).collect() == []
