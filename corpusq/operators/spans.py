"""Joins on positions: offset to page, offset in zone, span overlap, ordinals.

Positions are joined within their document only, by an equality on the document plus a range; each
document's spans are few, so the range filter stays local.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def page_of(points: DataFrame, starts: DataFrame, keys: list[str], offset: str, start: str = "start", page: str = "page") -> DataFrame:
    """As-of: the last page that starts at or before the offset; offsets before the first break are on page 1.

    One union, one window: no range join.
    """
    marks = starts.select(*keys, F.col(start).alias(offset), F.col(page), F.lit(0).alias("_kind"))
    both = points.withColumn("_kind", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(offset, "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(page, F.coalesce(F.max(page).over(w), F.lit(1))).where("_kind = 1").drop("_kind")


def in_zone(points: DataFrame, zones: DataFrame, keys: list[str], offset: str, how: str = "inner") -> DataFrame:
    """Zones [start, end) that hold the offset; how='left_anti' gives the points outside every zone."""
    a, b = points.alias("a"), zones.alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys] + [F.col(f"a.{offset}") >= F.col("b.start"), F.col(f"a.{offset}") < F.col("b.end")]
    joined = a.join(b, on, how)
    return joined if "anti" in how or "semi" in how else joined.drop(*[F.col(f"b.{k}") for k in keys])


def overlap_pick(left: DataFrame, right: DataFrame, keys: list[str], id_cols: list[str], prefer: list[Column]) -> DataFrame:
    """For each left span (start, end) the preferred right span that overlaps it, right columns as ``r_``."""
    r = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    on = [left[k] == r[f"r_{k}"] for k in keys] + [r["r_start"] < left["end"], left["start"] < r["r_end"]]
    met = left.join(r, on, "left")
    return met.withColumn("_n", F.row_number().over(Window.partitionBy(*id_cols).orderBy(*prefer))).where("_n = 1").drop("_n")


def classify_marks(marks: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Judged marks against a new scan: kept exactly, moved (overlap), or gone, with the tier they have now."""
    f = found.select(*keys, "start", "end", F.col("tier").alias("new_tier"))
    exact = marks.join(f.withColumn("_exact", F.lit(True)), [*keys, "start", "end"], "left")
    hit = exact.where("_exact").withColumn("class", F.concat(F.lit("kept_tier"), "new_tier")).drop("_exact")
    rest = exact.where("_exact is null").drop("_exact", "new_tier")
    near = overlap_pick(rest, f, keys, [*keys, "start", "end"], [F.col("r_new_tier").asc_nulls_last(), F.col("r_start")])
    kind = F.when(F.col("r_new_tier").isNull(), "gone").otherwise(F.concat(F.lit("moved_tier"), "r_new_tier"))
    moved = near.withColumn("class", kind).withColumn("new_tier", F.col("r_new_tier"))
    return hit.unionByName(moved.select(hit.columns))


def merge_spans(df: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping or touching spans as one."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)
    runs = df.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w))
    return runs.groupBy(*keys, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_run")


def zip_ordinals(paragraphs: DataFrame, regions: DataFrame, keys: list[str], index: str = "ordinal") -> DataFrame:
    """Paragraph i to region i; what overflows the regions stands without one, empty regions stay."""
    return paragraphs.join(regions, [*keys, index], "full")


def reciprocity(links: DataFrame, doc: str) -> DataFrame:
    """Next/prev links whose target is missing or does not link back."""
    back = links.select(doc, F.col("id").alias("next"), F.col("prev").alias("_back"), F.lit(True).alias("_there"))
    met = links.where(F.col("next").isNotNull()).join(back, [doc, "next"], "left")
    kind = F.when(F.col("_there").isNull(), "missing_target").when(~F.col("_back").eqNullSafe(F.col("id")), "not_reciprocated")
    return met.withColumn("problem", kind).where(F.col("problem").isNotNull()).select(doc, "id", "next", "problem")


def unpaired_anchors(anchors: DataFrame, doc: str) -> DataFrame:
    """Names that have only a start or only an end."""
    side = lambda s: anchors.where(F.col("side") == s).select(doc, "name").distinct().withColumn(s, F.lit(True))
    both = side("start").join(side("end"), [doc, "name"], "full")
    return both.where(F.col("start").isNull() | F.col("end").isNull()).select(doc, "name", F.when(F.col("start").isNull(), "no_start").otherwise("no_end").alias("problem"))
