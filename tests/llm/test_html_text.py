import math
import random
import re
from html import unescape

import pytest

from corpusq.llm import html_text
from corpusq.llm.html_text import extract, main_text, smoothed

LONG = "Some words that make a sentence of a fair length, long enough for the ratio to rise. " * 3


def clean(s):
    return " ".join(unescape(re.sub("<[^>]*>", "", s)).split())


@pytest.mark.parametrize(
    "html,want",
    [
        (None, ""), ("", ""), ("   ", ""), ("plain &amp; text", "plain & text"), ("<p>", ""), ("<script>var x='<p>no</p>'", ""),
        ("<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>M</a></ul></nav><div class=ad>Buy now</div>"
         "<article><h1>Head</h1><p><b>One <i>two</i>\n three.<br><p>Sh.</p></article><footer>&copy; x</footer></body></html>", "Head\nOne two three.\nSh."),
        (f"<body><header><p>{LONG}</p></header><main><p>a&nbsp;b</p><form><p>f</p></form><section id='comments'><article><p>{LONG}</p></article></section></main>", "a b"),
        (f"<div id=menu><p>{LONG}</p></div><div><h2>Title</h2><p>{LONG}</p><p>{LONG}</p></div><div class='page-footer'>x</div>", "Title\n" + "\n".join([LONG.strip()] * 2)),
        (f"<nav><li>x<article><p>{LONG}</p></article>", LONG.strip()),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table></article>", "a\nb\nc\nd\ne"),
        ("<article><p>one<aside><p>side</p></aside>two</p><div class='lead header'>three</div><div hidden>no</div></article>", "one\ntwo\nthree"),
        ("<article>a &lt;b&gt; &#x41;&unknown; <!-- c --> d<![CDATA[e]]></article>", "a <b> A&unknown; d"),
        (f"<main><div>Other things on this site that nobody asked for.</div><article><p class=byline>By A</p><p>{LONG}</p></article></main>", "By A\n" + LONG.strip()),
        (f"<article><p>{LONG}</p></article><article><p>{LONG}{LONG}</p></article>", (LONG + LONG).strip()),
        ("<article>" + "<div>" * 3000 + "deep" + "</article>", "deep"),
    ],
)
def test_cases(html, want):
    assert main_text(html) == want


def test_long():
    html = "<article>" + "<p>w&eacute; <b>x</b></p>" * 20000 + "</article>"
    assert main_text(html) == "\n".join(["wé x"] * 20000)
    html = "<article>" + "<font><div>a</div>" * 20000
    assert main_text(html) == "\n".join(["a"] * 20000)


def test_smoothing():
    assert smoothed([3.0]) == [3.0]
    assert smoothed([0.0] * 9) == [0.0] * 9
    s = smoothed([0, 0, 0, 9, 0, 0, 0])
    assert s[3] == max(s) and s[0] == 0 < s[1] < s[2]


def test_table(spark):
    """Brute force over pages of one template: the article's blocks, by pattern."""
    rows = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    for r in extract(spark.createDataFrame(list(rows.values()))).collect():
        body = re.search(r"(?s)<article>(.*?)</article>", rows[r.page_id].html)[1]
        blocks = [clean(b.replace("<br>", " ")) for b in re.split(r"</?(?:h1|p)>", body)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == rows[r.page_id].url


MENU = "".join(f"<li><a href='/{k}'>Link number {k} to some place</a></li>" for k in range(12))
#: Pages on which no name marks the content or what surrounds it.
PLAIN = f"<body><ul>{MENU}</ul><h2>Title</h2><p>{LONG}</p><p>{LONG}</p><p>One</p><p>Two</p><p>Three</p><p>Four</p></body>"
INNER = f"<article><p>{LONG}</p><p>{LONG}</p><div>{MENU}</div><p>{LONG}</p><p>Short end.</p></article>"


def test_the_ratio_chooses(monkeypatch):
    """Without article, main or class names the cluster finds the text (smoothing lifts the next line), and drops a list of links in an article."""
    want = {PLAIN: "\n".join(["Title", LONG.strip(), LONG.strip(), "One"]), INNER: "\n".join([*[LONG.strip()] * 3, "Short end."])}
    for page, text in want.items():
        assert main_text(page) == text
    monkeypatch.setattr(html_text, "smoothed", lambda ratios: [1.0] * len(ratios))
    for page, text in want.items():
        assert main_text(page) != text


def brute_ratio_path(blocks):
    """Lines (text, tags, characters in links) of a page without elements: from the first to the last line at or above the mean."""
    raw = [(len(t) - k) / max(1, n) for t, n, k in blocks]
    smooth = []
    for i in range(len(raw)):
        w = {j: math.exp(-((i - j) ** 2) / 2) for j in range(len(raw)) if abs(i - j) <= 2}
        smooth.append(sum(raw[j] * v for j, v in w.items()) / sum(w.values()))
    high = [i for i, x in enumerate(smooth) if x >= sum(smooth) / len(smooth)]
    low = [i not in high or blocks[i][2] == len(blocks[i][0]) for i in range(len(blocks))]
    found, i = [], high[0]
    while i <= high[-1]:
        j = i
        while j <= high[-1] and low[j]:
            j += 1
        run = range(i, j)
        menu = len(run) >= 3 and any(k not in high for k in run) and sum(blocks[k][2] for k in run) >= 0.8 * sum(len(blocks[k][0]) for k in run)
        found += [] if menu else run
        found += [j] if j <= high[-1] else []
        i = j + 1
    return "\n".join(blocks[i][0] for i in found)


def test_ratio_path_against_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        blocks, page = [], ""
        for _ in range(rng.randrange(1, 30)):
            text = ("word " * rng.choice([1, 2, 3, 30, 80])).strip()
            links = rng.choice([0, 0, 1])
            page += f"<p>{'<a>' * links}{text}{'</a>' * links}</p>"
            blocks.append((text, 1 + 2 * links, len(text) * links))
        assert main_text(page) == brute_ratio_path(blocks)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(None, None, None, "x"), (1, "u", "<p>a</p>", "y"), (1, "u", "<p>a</p>", "y")], "page_id long, url string, html string, text string")
    assert sorted(map(str, (tuple(r) for r in extract(pages).collect()))) == sorted(map(str, [(None, None, "", 0), (1, "u", "a", 1), (1, "u", "a", 1)]))
    assert extract(pages.limit(0)).collect() == []
