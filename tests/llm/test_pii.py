import hashlib
import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusq.llm import pii

P = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def good(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and luhn(d)
    return kind == "email" or 10 <= len(d) <= 15


def brute(text):
    text = text or ""
    found = {k: [m.span() for m in p.finditer(text) if good(k, m[0])] for k, p in P.items()}
    joined = sorted((s, i, e) for i, k in enumerate(P) for s, e in found[k])
    line = ",".join(f"{list(P)[i]}:{s}:{e}" for s, i, e in joined)
    return {k: len(v) for k, v in found.items()}, hashlib.sha256(line.encode()).hexdigest()


def check(spark, texts):
    rows = pii.spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts, sha = brute(texts[r.doc_id])
        assert ({k: r[f"n_{k}"] for k in P}, r.base_sha256) == (counts, sha), texts[r.doc_id]
    return {r.doc_id: r for r in rows}


CASES = [
    None, "", "a@b.c_d@e.f", "x@y.z.@q.w é@b.c ü a.b@c-d.e.f", "1.2.3.4.5.6.7.8 0255.1.1.1 256.1.1.1 99999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 and +1 (499) 555-6503 +49.30.1234567-", "𝔘𝔫 4111111111111111 😀 me@x.org",
    "+" + "(" * 5000, "1 " * 20000, "12" * 30000, "a" * 50000, ("a." * 20000) + "@", "@" * 1000 + "a@b.c" * 300,
    "IBAN DE89 3704 0044 0532 0130 00, GB82WEST12345698765432; ssn 123-45-6789 or 123-45-6780",
]


def test_cases(spark):
    rows = check(spark, CASES)
    assert rows[len(CASES) - 1].spans == "iban:5:32,iban:34:56,ssn:62:73,ssn:77:88"
    assert rows[0].spans == ""


def iban(code, spaced):
    full = code[:2] + f"{98 - int(''.join(str(int(c, 36)) for c in code[4:] + code[:2] + '00')) % 97:02d}" + code[4:]
    return " ".join(full[k : k + 4] for k in range(0, len(full), 4)) if spaced else full


BE, ES = "BE68539007547034", "ES91 2100 0418 4502 0005 1332"


def test_iban_ends_before_other_text(spark):
    texts = [f"{BE} 2024", f"{ES} PAID", f"{ES} {ES}", f"{BE} {BE} {ES} X", f"AB12 CDEF GHIJ {BE}", f"ES12 3456 7890 {ES}", f"😀 {BE} {ES}", f"{BE}A", f"BE69539007547034 {BE[:-1]}"]
    rows = check(spark, texts)
    for i, t in enumerate(texts):
        want = [] if i >= 7 else [m.span() for m in re.finditer(f"{BE}|{ES}", t)]
        assert rows[i].spans == ",".join(f"iban:{a}:{b}" for a, b in want), t
    found = pii.redact(spark.createDataFrame([(t,) for t in texts[:3]], "text string")).collect()
    assert [r.text for r in found] == ["<IBAN> 2024", "<IBAN> PAID", "<IBAN> <IBAN>"]


def test_iban_of_every_country(spark):
    texts, want = [], []
    for n, codes in pii.IBAN.items():
        for c in codes.split():
            for spaced in (False, True):
                x = iban(f"{c}00" + "1234567890ABCDEFGH7654321098765"[: n - 4], spaced)
                texts.append(f"to {x} {x} TEXT 12")
                want.append(f"iban:3:{3 + len(x)},iban:{4 + len(x)}:{4 + 2 * len(x)}")
    rows = check(spark, texts)
    assert [rows[i].spans for i in range(len(texts))] == want


def test_random(spark):
    texts = []

    @given(st.lists(st.text(alphabet="a@.-_ +()019\né😀", max_size=60), min_size=40, max_size=40))
    @settings(max_examples=8, deadline=None, database=None, derandomize=True)
    def gather(x):
        texts.extend(x)

    gather()
    check(spark, texts)


def test_one_text_of_many_numbers(spark):
    """200,000 matches in one text, thousands of them confirmed, take seconds, alone and in redaction."""
    rng = random.Random(6)
    numbers = [f"{rng.randrange(10**15, 10**16)}" if k % 4 else f"{rng.randrange(256)}.{rng.randrange(300)}.1.9" for k in range(200_000)]
    text = ", ".join(numbers)
    df = spark.createDataFrame([(0, text)], "doc_id long, text string")
    began = time.time()
    (r,) = pii.spans(df).collect()
    (masked,) = pii.redact(df).collect()
    assert time.time() - began < 150
    counts, sha = brute(text)
    assert ({k: r[f"n_{k}"] for k in P}, r.base_sha256) == (counts, sha)
    want = ", ".join("<CARD>" if len(n) == 16 and luhn(n) else "<IP>" if len(n) < 16 and int(n.split(".")[1]) < 256 else n for n in numbers)
    assert masked.text == want


def test_one_text_of_many_ibans(spark):
    text = " ".join([BE, "mail a@b.org", ES] * 4000)
    rows = check(spark, [text])
    assert rows[0].spans.count("iban") == 8000


def test_spans_among_clashing_columns(spark):
    d = spark.createDataFrame([(1, "me@x.org", 5, "z", [1])], "doc_id long, text string, n_email int, _t string, _all array<int>")
    assert [(r.doc_id, r.n_email, r.spans) for r in pii.spans(d).collect()] == [(1, 1, "email:0:8")]


def test_redaction_of_overlaps(spark):
    """Base spans may overlap: an address within a number, a number within a phone."""
    text = "x " * 400 + "+4111111111111111 then 1.2.3.4111111111111111 and +1 499 555 6503, me@1.2.3.4 " + "y" * 700
    (r,) = pii.spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    out, at = "", 0
    for k, a, b in (x.split(":") for x in r.spans.split(",")):
        if int(a) >= at:
            out += text[at : int(a)] + f"<{k.upper()}>"
        at = max(at, int(b))
    (m,) = pii.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert m.text == out + text[at:] and "<" in m.text


def test_empty_table(spark):
    assert pii.spans(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_redact(spark):
    d = spark.createDataFrame([(1, "a me@x.org b", "s", 12), (1, None, "s", 7), (2, "ok", None, 2)], "doc_id long, text string, spans string, n_chars long")
    rows = pii.redact(d).collect()
    assert [(r.text, r.n_chars, r.spans) for r in rows] == [("a <EMAIL> b", 11, "s"), (None, 7, "s"), ("ok", 2, None)]
