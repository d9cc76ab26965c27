"""Reading the input tables: one Parquet file or folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, else as it is: joins then shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to four tasks a core, for work that takes long over few bytes.

    Adaptive execution joins small partitions by their bytes, so that one task would do all of it; it
    leaves a number that is given alone.
    """
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def sized(df: DataFrame, *keys: str, most: int = 500_000) -> DataFrame:
    """``df`` dealt by ``keys`` to tasks of about ``most`` rows: the memory of a task that sorts or groups its rows stays as the input grows.

    Adaptive execution sizes tasks by compressed bytes, which small numbers have few of. Counts the rows first: for tables and what is selected from them.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // most)), *keys)
