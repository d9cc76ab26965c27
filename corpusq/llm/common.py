"""What the operators of this folder share: inputs, the shared work folder, salted groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.session import ship_package
from corpusq.storage import discard, stored, work_path

__all__ = ["SPACE", "discard", "read_table", "salt", "salted_groups", "sized", "spread", "stored", "work_path"]

#: White space of the contracts: space and the ASCII controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
#: Rows of one key are spread over at most so many sub-keys. Small groups pay nothing for it:
#: a sub-key exists only where a row has it.
SALTS = 4096


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sized(df: DataFrame, rows: int, each: int = 50_000) -> DataFrame:
    """``df``, known to have about ``rows`` rows, in one partition per ``each`` of them: no swarm of tiny files."""
    return df.coalesce(max(1, -(-rows // each)))


def salt(*cols: str | Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(SALTS)).cast("int")


def salted_groups(rows: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Smallest id and size of each group, one row per (keys, _salt) that occurs.

    ``rows`` must hold ``_salt``. A group of a third of all rows is first combined within its
    salts, so that no task sees the whole group; rows join back on (keys, _salt), not on the keys.
    """
    parts = rows.groupBy(*keys, "_salt").agg(F.min(id_col).alias("_least"), F.count(F.lit(1)).alias("_n"))
    whole = parts.groupBy(*keys).agg(F.min("_least").alias("keep_id"), F.sum("_n").alias("group_size"))
    return parts.select(*keys, "_salt").join(whole, keys)


def spread(rows: DataFrame, other: DataFrame, on: list[str], wide: bool = False) -> DataFrame:
    """``rows`` (with ``_salt``) joined with ``other``, which has each key once.

    A key that many rows share is dealt out: ``other`` meets its salts, one row each, then the rows meet
    those. ``wide``: the other side's rows are long, so that few of them are no broadcast.
    """
    keys = rows.select(*on, "_salt").distinct()
    if wide:
        return rows.join(keys.join(other.hint("merge"), on).hint("merge"), [*on, "_salt"])
    return rows.join(keys.join(other, on), [*on, "_salt"])
