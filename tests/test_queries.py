"""Every query against its SQL in DuckDB, as rows in any order; the others run and keep their schema."""

import math

import duckdb
import pytest

from corpusq.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, list):
        return tuple(map(plain, v))
    return float(v) if type(v).__name__ == "Decimal" else v


def key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    df = registry.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=key)
    if name in registry.ORACLE:
        rel = db.sql(registry.ORACLE[name])
        assert sorted(rel.columns) == cols
        at = [rel.columns.index(c) for c in cols]
        assert got == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=key)
    else:
        assert len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
