"""Corpus bookkeeping: strata, counts, funnels, reconciliation, drift, status, samples, upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusq.operators.ordered import medians
from corpusq.storage import stored


def describe(value: str | Column, digits: int = 6) -> list[Column]:
    """n, mean, median, sample deviation (0 for one row), least and greatest.

    The median gathers a stratum's distinct values: for scores of a fixed grid (a thousand values at
    most), merged before the shuffle. :func:`summary` takes any values.
    """
    v = F.col(value) if isinstance(value, str) else value
    return [
        F.count(v).alias("n"), F.round(F.avg(v), digits).alias("mean"), F.round(F.percentile(v, 0.5), digits).alias("median"),
        F.round(F.coalesce(F.stddev_samp(v), F.lit(0.0)), digits).alias("std"), F.round(F.min(v), digits).alias("lo"), F.round(F.max(v), digits).alias("hi"),
    ]


def summary(df: DataFrame, keys: list[str], value: str, *more: Column, digits: int = 6) -> DataFrame:
    """:func:`describe` for values without a grid: the median comes from ranks along a range sort.

    The rows are stored once, as they are read four times and a value may be dear.
    """
    df = stored(df, "values")
    plain = [c for c, name in zip(describe(value, digits), ("n", "mean", "median", "std", "lo", "hi")) if name != "median"]
    return df.groupBy(*keys).agg(*plain, *more).join(medians(df, keys, value).withColumn("median", F.round("median", digits)), keys, "left")


def stratify(df: DataFrame, dimensions: list[str], value: str) -> DataFrame:
    """One pass of grouping sets: each dimension's strata by itself; null strata are 'unknown'."""
    known = df.select(value, *[F.coalesce(F.col(d).cast("string"), F.lit("unknown")).alias(d) for d in dimensions])
    sets = known.groupingSets([[F.col(d)] for d in dimensions], *[F.col(d) for d in dimensions]).agg(*describe(value))
    which = F.coalesce(*[F.when(F.col(d).isNotNull(), F.lit(d)) for d in dimensions])
    return sets.select(which.alias("dimension"), F.coalesce(*map(F.col, dimensions)).alias("stratum"), "n", "mean", "median", "std", "lo", "hi")


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    """Counts, most common first, ties by key."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), *cols)


def funnel(stages: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Distinct keys per stage, and how many of the stage before are missing."""
    rows = []
    for k, (name, df) in enumerate(stages):
        ids = df.select(key).distinct()
        lost = stages[k - 1][1].select(key).distinct().join(ids, key, "left_anti").agg(F.count(F.lit(1)).alias("lost")) if k else None
        here = ids.agg(F.lit(k).alias("stage"), F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
        rows.append(here.crossJoin(lost) if lost is not None else here.withColumn("lost", F.lit(0).cast("long")))  # one row each
    return reduce(DataFrame.unionByName, rows)


def drift(claimed: DataFrame, computed: DataFrame, key: str, value: str) -> DataFrame:
    """Claimed against computed values: OK where equal (null equals null), else DRIFT."""
    both = claimed.withColumnRenamed(value, "claimed").join(computed.withColumnRenamed(value, "computed"), key, "full")
    return both.withColumn("status", F.when(F.col("claimed").eqNullSafe(F.col("computed")), "OK").otherwise("DRIFT"))


def snapshot_drift(old: DataFrame, new: DataFrame, key: str, value: str, most: float = 0.05) -> DataFrame:
    """Rows whose value moved by more than ``most``, largest move first, with the verdict on the whole snapshot."""
    moved = old.select(key, F.col(value).alias("old")).join(new.select(key, F.col(value).alias("new")), key).withColumn("delta", F.col("new") - F.col("old"))
    far = moved.where(F.abs("delta") > most)
    verdict = far.agg(F.when(F.count(F.lit(1)) > 5, "stale").otherwise("minor").alias("verdict"))
    return far.crossJoin(verdict)  # one row


def migrate(status: Column, table: dict[str, str]) -> Column:
    known = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(known[status], status)


def upsert(existing: DataFrame, new: DataFrame, wave: str) -> DataFrame:
    """Replaces the waves that ``new`` holds, keeps the others."""
    return existing.join(new.select(wave).distinct(), wave, "left_anti").unionByName(new)


def stratified_sample(df: DataFrame, strata: list[str], key: str, n: int, seed: int) -> DataFrame:
    """Exactly n rows of each stratum (all if fewer), by a hash order that no partitioning changes."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*strata).orderBy(order, key))).where(F.col("place") <= n)


def largest_remainder(cells: DataFrame, key: list[str], size: str, total: int) -> DataFrame:
    """Shares of ``total`` in proportion to the cell sizes: floors, then one each by largest remainder, ties by key."""
    every = Window.partitionBy(F.lit(1))
    exact = F.col(size) * total / F.sum(size).over(every)
    df = cells.withColumn("_exact", exact).withColumn("_floor", F.floor("_exact"))
    df = df.withColumn("_left", F.lit(total) - F.sum("_floor").over(every))
    place = F.row_number().over(every.orderBy(F.round(F.col("_exact") - F.col("_floor"), 9).desc(), *key))
    df = df.withColumn("_place", place)
    return df.withColumn("share", F.least(F.col(size), F.col("_floor") + (F.col("_place") <= F.col("_left")).cast("int"))).drop("_exact", "_floor", "_left", "_place")


def reconcile_pages(df: DataFrame, claimed: Column, found: Column, cover: Column, split: Column) -> DataFrame:
    """Page counts after cover and split pages explain part of the gap (never more than it)."""
    gap = F.abs(claimed - found)
    rest = F.greatest(F.lit(0), gap - F.least(gap, cover + split))
    ratio = F.when(claimed > 0, found / claimed)
    status = F.when(rest == 0, "OK").when((ratio < 0.8) | (ratio > 1.3), "MISMATCH").otherwise("MINOR")
    return df.withColumn("gap", gap).withColumn("rest", rest).withColumn("status", status)
