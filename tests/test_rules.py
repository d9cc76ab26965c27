"""Every audit rule on a document that breaks it and one that does not."""

import pytest

from corpusq.operators import rules

GOOD = (
    '<TEI xmlns="http://www.tei-c.org/ns/1.0" type="edition"><teiHeader><title>T</title><author>A</author><language ident="fra"/><idno type="GND">1</idno></teiHeader><facsimile><surface/></facsimile><text><body>'
    '<pb facs="#f1" n="1"/><div type="chapter"><p>Some text that is long enough for one page of a book, at least.<lb/></p><figure xml:id="fig1"/><note place="foot" n="1" xml:id="fn1-1">x</note>'
    '<sp><speaker>S</speaker></sp><foreign xml:lang="lat">a</foreign><persName ref="GND:11-X">B</persName><hi rendition="#b">b</hi><graphic url="a.jpg"/></div></body><back><div type="reprint">r</div></back></text></TEI>'
)
BROKEN = {
    "R1": ('type="edition"', 'type="other"'), "R2": ("<teiHeader><title>T</title><author>A</author>", "<head0>"), "R3": ("body>", "main>"), "R5": ('type="chapter"', 'type="odd"'), "R6": (' place="foot"', ""),
    "R7": ('<lb/></p><figure xml:id="fig1"/>', '<lb/><figure xml:id="fig1"/></p>'), "W1": ('ident="fra"', 'ident="und"'), "W2": ("<author>A</author>", "<author> </author>"), "W3": ("<surface/>", "<surface/><surface/>"),
    "W4": ('<div type="reprint">r</div>', '<div type="reprint"/>'), "W5": ("Some text that is long enough for one page of a book, at least.", "Few."), "W6": ("<lb/>", ""), "W7": ("a.jpg", "unknown"),
    "W11": ('<div type="chapter">', '<div n="1">a</div>' * 4 + '<div type="chapter">'), "W12": ('place="foot" n="1"', 'place="foot"'), "W13": ("fn1-1", "note1"), "W14": ('type="reprint"', 'type="chapter"'),
    "W15": ('type="chapter"', 'type="chapter" n="2"'), "W16": (' xml:id="fig1"', ""), "W17": ("<speaker>S</speaker>", "<speaker> </speaker>"), "W18": ('xml:lang="lat"', 'xml:lang="la"'), "Z1": ("GND:11-X", "http://x"),
    "Z2": ('type="GND"', 'type="Wikidata"'), "Z3": ("<lb/>", "<lb/><placeName>P</placeName>"), "Z4": ("<facsimile>", "<standOff/><facsimile>"), "Z5": ('"#b"', '"#x"'), "Z6": (' n="1"/>', "/>"), "Z8": (' ref="GND:11-X"', ""),
    "XML": ("</TEI>", ""),
}


@pytest.fixture(scope="module")
def found(spark):
    texts = [GOOD]
    for rule, (old, new) in BROKEN.items():
        x = GOOD.replace(old, new)
        if rule == "R2":
            x = x.replace("</teiHeader>", "</head0>")
        assert x != GOOD, rule
        texts.append(x)
    texts += [GOOD.replace("<div ", "<part ").replace("</div>", "</part>"), '<TEI type="edition"><teiHeader><title>a</title><author>b</author></teiHeader><text><body><div type="bibliography"><bibl ref="x">c</bibl></div><bibl ref="x"/></body></text></TEI>', None]
    e = rules.elements(spark.createDataFrame(list(enumerate(texts)), "doc long, xml string"), "doc", "xml")
    rows = rules.findings(e, ["chapter", "reprint", "bibliography"], "edition").collect()
    return {k: {r.rule: r.n for r in rows if r.doc == k} for k in range(len(texts))}


def test_good_document(found):
    assert found[0] == {}


@pytest.mark.parametrize("k", range(len(BROKEN)))
def test_rule(found, k):
    rule = list(BROKEN)[k]
    assert rule in found[k + 1]
    assert set(found[k + 1]) <= {rule, *{"R2": ["W2"], "R3": ["W6"], "R6": ["W12"], "W14": [], "W18": []}.get(rule, [])}


def test_no_division_and_bibliographies(found):
    assert "R4" in found[len(BROKEN) + 1]
    assert found[len(BROKEN) + 2] == {"Z1": 1} and found[len(BROKEN) + 3] == {"XML": 1}


def test_element_table(spark):
    e = rules.elements(spark.createDataFrame([(7, '<a type="t">x<b id="1">y</b><!-- c --><c/>z</a>')], "doc long, xml string"), "doc", "xml").orderBy("i").collect()
    assert [(r.i, r.parent, r.name, r.path, r.text, r.own, r.kids) for r in e] == [(0, -1, "a", ["a[t]"], "xyz", "x", 2), (1, 0, "b", ["a[t]", "b"], "y", "y", 0), (2, 0, "c", ["a[t]", "c"], "", "", 0)]
    assert e[1].attrs == {"id": "1"}
