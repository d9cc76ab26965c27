import gzip
import hashlib
import io
import json

import pytest

from corpusq.llm import warc as W


def test_rewrite_streams_members():
    records = [W.record("http://a/\r\nx y", b"p" * 3_000_000, "<urn:x-page:1>", None), W.record(None, b"\r\n\r\nWARC/1.1\r\n", "<urn:x-page:-:0:1>", None), W.record("u", b"z" * 1500, "<urn:x-page:3:0:2>", "<urn:x-page:1>")]
    out, index = io.BytesIO(), io.BytesIO()
    with gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(b"".join(records[:2])) + gzip.compress(records[2]))) as g:
        assert W.rewrite(g, out, index) == 3
    for line, want in zip(index.getvalue().splitlines(), records, strict=True):
        at, size, kind, urn = json.loads(line)
        assert gzip.decompress(out.getvalue()[at : at + size]) == want
        got = W.read_member(out.getvalue()[at : at + size])
        assert got[3] == kind and str(got[0] or "-") in urn
    with gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(records[0][:-10_000]))) as g, pytest.raises(ValueError):
        W.rewrite(g, io.BytesIO(), io.BytesIO())


def test_archived(spark):
    big = "é" * 500
    pages = [(1, "u", big), (5, None, big), (3, "u", big), (None, "u", big), (7, "u", "x" * 999), (8, "u", "x" * 999), (9, "u", None), (10, "u", ""), (5, "again", big), (11, "u", "only" * 400), (None, None, "n" * 2000), (None, None, "n" * 2000)]
    pages = [(*p, "x") for p in pages]
    rows = W.archived(spark.createDataFrame(pages, "page_id long, url string, html string, record_type string")).collect()
    want, seen = [], set()
    for p, _, h, _ in sorted(pages, key=lambda r: -1 if r[0] is None else r[0], reverse=True):
        b = (h or "").encode()
        again = len(b) >= 1000 and b in seen
        seen.add(b)
        same = [q for q, _, x, _ in pages if x == h and q is not None]
        want.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", max(same, default=None) if again else None))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))


def test_empty(spark):
    assert W.archived(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
