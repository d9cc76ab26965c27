"""Judgments of finds: precision, splits, merged batches, and what a store must hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def precision(marks: DataFrame, keys: list[str], verdict: str = "verdict") -> DataFrame:
    """Decidable and correct judgments per group and their ratio; null where nothing could be decided."""
    sure, ok = F.count_if(F.col(verdict) != "undecidable"), F.count_if(F.col(verdict) == "correct")
    return marks.groupBy(*keys).agg(sure.alias("decidable"), ok.alias("correct"), F.round(ok / F.nullif(sure, F.lit(0)), 9).alias("rate"))


def split_of(doc: Column) -> Column:
    """held_out, special or dev; the first that holds."""
    return F.when(doc % 5 == 0, "held_out").when(doc % 11 == 0, "special").otherwise("dev")


def merged(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Both batches; a key that stands in both raises when the rows are read."""
    both = a.unionByName(b)
    twice = both.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    checked = twice.select(key, F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("case in two batches: "), F.col(key).cast("string"))).cast("int")).alias("_e"))
    return both.join(checked, key).where("_e is null").drop("_e")


def violations(marks: DataFrame, cases: DataFrame, key: str = "case_id") -> DataFrame:
    """(violation, key) of marks (key, doc, verdict, reason) against cases (key, doc)."""
    named = lambda df, name: df.select(F.lit(name).alias("violation"), key).distinct()
    twice = marks.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    other = marks.join(cases.withColumnRenamed("doc", "_doc"), key).where("doc <> _doc")
    return (
        named(twice, "duplicate").unionByName(named(marks.join(cases, key, "left_anti"), "unknown_case")).unionByName(named(other, "other_page"))
        .unionByName(named(cases.join(marks, key, "left_anti"), "no_mark")).unionByName(named(marks.where("verdict = 'wrong' AND reason IS NULL"), "no_reason"))
    )
