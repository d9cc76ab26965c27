"""The queries opN_ with SQL against DuckDB, and the general properties of the others, on a small table."""

import duckdb
import pytest
from test_queries import key, plain

from corpusq.llm import exact_dedup, oracle, quality_rules, registry

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df = registry.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    rel = con.sql(oracle.ORACLE[name])
    at = [rel.columns.index(c) for c in cols]
    assert sorted(rel.columns) == cols
    assert sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=key) == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=key)


ODD = [(1, "a  b\n", "x"), (2, "a b ", "x"), (3, None, "x"), (4, "", "x"), (None, "a\tb ", "x"), (2, "a b ", "x"), (9, "A b ", "x"), (None, "z", None), (None, "z", None)]


@pytest.mark.parametrize("digest_bytes", [32, 0])
def test_exact_dedup_odd_rows(spark, digest_bytes):
    """With a digest of no bytes all rows collide, and byte verification alone decides."""
    df = spark.createDataFrame(ODD, "doc_id long, text string, kept string")
    rows = exact_dedup.exact_groups(df, digest_bytes=digest_bytes).collect()
    got = sorted(str((str(r.doc_id), r.keep_id, r.group_size, r.kept)) for r in rows)
    want = [("1", 1, 4, True), ("2", 1, 4, False), ("2", 1, 4, False), ("None", 1, 4, False), ("3", 3, 2, True), ("4", 3, 2, False), ("9", 9, 1, True), ("None", None, 2, True), ("None", None, 2, False)]
    assert got == sorted(map(str, want))
    assert all(len(r.text_sha256) == 64 for r in rows)
    if digest_bytes:
        kept = exact_dedup.drop_copies(df).collect()
        assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "9", "None"] and kept[0].asDict().keys() == {"doc_id", "text", "kept"}
        assert exact_dedup.exact_groups(df.limit(0)).collect() == [] and exact_dedup.drop_copies(df.limit(0)).collect() == []


def test_quality_odd_rows(spark):
    good = " ".join(f"word{i}" for i in range(60)) + "."
    docs = [(None, None), (1, ""), (2, good), (2, good), (3, good + "\nAll rights reserved."), (4, "a | b | c " * 40), (5, "go go go " * 30), (6, "x" * 200_000), (7, "\n".join([good, "Home | About | Contact", "wow!! such!! text!! here!!"]))]
    df = spark.createDataFrame([(*d, "n") for d in docs], "doc_id long, text string, n_words string")
    rows = sorted(((str(r.doc_id), r.kept, r.n_removed_lines) for r in quality_rules.quality(df).collect()))
    assert rows == [("1", False, 0), ("2", True, 0), ("2", True, 0), ("3", True, 1), ("4", False, 1), ("5", False, 0), ("6", False, 0), ("7", True, 2), ("None", False, 0)]
    clean = {r.doc_id: r.text for r in quality_rules.clean_documents(df).collect()}
    assert clean == {2: good, 3: good, 7: good} and quality_rules.clean_documents(df).columns == df.columns
    assert quality_rules.quality(df.limit(0)).collect() == []


def test_notices(spark):
    """Every pattern holds its part; notices go from lines of any length, ordinary sentences stay."""
    assert all(part in p for part, patterns in quality_rules.NOTICES.items() for p in patterns)
    good = " ".join(f"word{i}" for i in range(60)) + "."
    lines = {
        "This site uses cookies.": False, "She baked a cookie and read about copyright law.": True, "Alle Rechte vorbehalten.": False, "Copyright 2019 Somebody": False, "He was told to wait...": False, "An end … here": True,
        ("All rights reserved. " + "x" * 60 + " ") * 6: False, "read more " + "y" * 400: True, "conditions d'utilisation": False, "": True,
    }
    df = spark.createDataFrame([(i, good + "\n" + line) for i, line in enumerate(lines)], "doc_id long, text string")
    rows = {r.doc_id: r.n_removed_lines for r in quality_rules.quality(df).collect()}
    assert {line: rows[i] == 0 for i, line in enumerate(lines)} == lines
