"""Ordered analytics: top-k, interpolation, islands, reading order, pagination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusq.storage import stored


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, place: str = "place") -> DataFrame:
    """The first k rows of each group; Spark keeps only k per group before the shuffle."""
    return df.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(place) <= k)


def pick(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The best row of each group: source precedence, keep-first."""
    return top_per_group(df, keys, order, 1, "_n").drop("_n")


def next_bound(df: DataFrame, keys: list[str], start: str, total: Column, end: str = "end") -> DataFrame:
    """A span ends where the next one of its group starts, the last at ``total``."""
    return df.withColumn(end, F.coalesce(F.lead(start).over(Window.partitionBy(*keys).orderBy(start)), total))


def interpolate(df: DataFrame, keys: list[str], order: str, value: str, filled: str = "filled") -> DataFrame:
    """Fills gaps in a numbering from the last known value on the left, if the next known one agrees.

    value + distance must match on both sides; without a right neighbour the left one decides;
    nothing is filled before the first known value.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    offset = F.when(F.col(value).isNotNull(), F.col(value) - F.col(order))
    left = F.last(offset, True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    right = F.first(offset, True).over(w.rowsBetween(1, Window.unboundedFollowing))
    guess = F.when(left.isNotNull() & (right.isNull() | (left == right)), left + F.col(order))
    return df.withColumn(filled, F.coalesce(F.col(value), guess))


def islands(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Runs of consecutive rows with one value: keys, value, first, last, n."""
    w = Window.partitionBy(*keys).orderBy(order)
    new = F.coalesce((~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int"), F.lit(1))
    runs = df.withColumn("_new", F.when(F.row_number().over(w) == 1, 1).otherwise(new)).withColumn("_run", F.sum("_new").over(w))
    return runs.groupBy(*keys, "_run", value).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n")).drop("_run")


def encode_pages(df: DataFrame, keys: list[str], page: str, total: Column) -> DataFrame:
    """Page lists as ``1-3,5``, or ``*`` where all pages are there; ``total`` is an aggregate."""
    w = Window.partitionBy(*keys).orderBy(page)
    runs = df.select(*keys, page, total.alias("_total")).distinct().withColumn("_run", F.col(page) - F.row_number().over(w))
    parts = runs.groupBy(*keys, "_run").agg(F.min(page).alias("a"), F.max(page).alias("b"), F.max("_total").alias("_total"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat_ws("-", "a", "b"))
    found = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("a", text.alias("t")))).alias("p"), F.sum(F.col("b") - F.col("a") + 1).alias("n"), F.max("_total").alias("_total"))
    return found.select(*keys, F.when(F.col("n") == F.col("_total"), "*").otherwise(F.array_join(F.col("p.t"), ",")).alias("pages"))


def _banded(df: DataFrame, keys: list[str], index: str, wides: list[float]) -> DataFrame:
    """Adds ``_mid``, and ``_wide{k}`` and ``_band{k}`` for each threshold, all along one sort of a page's regions by y."""
    by_y = Window.partitionBy(*keys).orderBy("y").rangeBetween(Window.unboundedPreceding, 0)
    along = Window.partitionBy(*keys).orderBy("y", index).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({"_mid": F.col("x") + F.col("w") / 2} | {f"_wide{k}": F.col("w") >= v for k, v in enumerate(wides)})
    count = lambda k, w: F.sum(F.col(f"_wide{k}").cast("int")).over(w)
    df = df.withColumns({f"_nth{k}": count(k, along) for k in range(len(wides))})
    # A narrow region belongs behind every wide one that starts at or above it.
    df = df.withColumns({f"_above{k}": count(k, by_y) for k in range(len(wides))})
    bands = {f"_band{k}": F.when(F.col(f"_wide{k}"), F.col(f"_nth{k}") - 1).otherwise(F.col(f"_above{k}")) for k in range(len(wides))}
    return df.withColumns(bands).drop(*[f"{c}{k}" for c in ("_nth", "_above") for k in range(len(wides))])


def _columned(df: DataFrame, keys: list[str], index: str, k: int, gaps: list[float]) -> DataFrame:
    """Adds ``_col{k}_{g}`` for each gap: the column of a region in its band under the k-th threshold, along one sort."""
    cols = Window.partitionBy(*keys, f"_band{k}", f"_wide{k}").orderBy("_mid", index)
    df = df.withColumn("_step", F.col("_mid") - F.lag("_mid").over(cols))
    return df.withColumns({f"_col{k}_{g}": F.sum(F.coalesce((F.col("_step") > v).cast("int"), F.lit(0))).over(cols) for g, v in enumerate(gaps)}).drop("_step")


def reading_order(df: DataFrame, keys: list[str], index: str = "idx", wide: float = 60.0, gap: float = 12.0, place: str = "place") -> DataFrame:
    """Canonical order of page regions (x, y, w in percent of the page).

    Regions of at least ``wide`` cut the page into bands at their top; within a band, columns start
    where the centre jumps by more than ``gap``; a column reads downwards. Ties keep the input order.
    """
    df = _columned(_banded(df, keys, index, [wide]), keys, index, 0, [gap])
    order = Window.partitionBy(*keys).orderBy("_band0", "_wide0", "_col0_0", "y", index)
    return df.withColumn(place, F.row_number().over(order)).drop("_wide0", "_mid", "_band0", "_col0_0")


def order_stability(df: DataFrame, keys: list[str], wides: list[float], gaps: list[float], index: str = "idx") -> DataFrame:
    """Whether :func:`reading_order` changes the input's order of a page's regions: none, robust (all thresholds agree) or fragile.

    One pass for all thresholds: a sort for the bands, one for the columns of each ``wide``, one list a page.
    """
    df = _banded(df, keys, index, wides)
    for k in range(len(wides)):
        df = _columned(df, keys, index, k, gaps)
    kept = [c for c in df.columns if c.startswith(("_band", "_wide", "_col"))]
    g = df.groupBy(*keys).agg(F.collect_list(F.struct(*kept, "y", index)).alias("_r"))
    order = lambda k, j: F.transform(F.array_sort(F.transform("_r", lambda r: F.struct(r[f"_band{k}"], r[f"_wide{k}"], r[f"_col{k}_{j}"], r["y"], r[index].alias("i")))), lambda x: x["i"])
    g = g.select(*keys, F.array(*[order(k, j) for k in range(len(wides)) for j in range(len(gaps))]).alias("_o"))
    moved = F.exists("_o", lambda o: o != F.array_sort(o))
    return g.select(*keys, F.when(~moved, "none").when(F.size(F.array_distinct("_o")) == 1, "robust").otherwise("fragile").alias("class"))


def mode_offset(df: DataFrame, keys: list[str], page: str, number: str) -> DataFrame:
    """The commonest difference of printed number and page, its share, and whether it is stable (3 pages, 0.9)."""
    seen = df.where(F.col(number).isNotNull()).withColumn("offset", F.col(number) - F.col(page))
    counts = seen.groupBy(*keys, "offset").agg(F.count(F.lit(1)).alias("n"), F.min(page).alias("first"))
    best = counts.withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    best = pick(best, keys, [F.col("n").desc(), F.col("first")])
    share = F.col("n") / F.col("total")
    return best.select(*keys, "offset", "n", "total", ((F.col("total") >= 3) & (share >= 0.9)).alias("stable"))


def pagination_class(df: DataFrame, keys: list[str], page: str, number: str) -> DataFrame:
    """How a document's page numbers run: scan sequence, printed folio, mixed or undetermined."""
    w = Window.partitionBy(*keys).orderBy(page)
    before = F.lag(number).over(Window.partitionBy(*keys, F.col(number).isNotNull()).orderBy(page))
    seen = df.withColumn("_up", F.when(before.isNotNull() & F.col(number).isNotNull(), (F.col(number) > before).cast("int"))).withColumn("_at", F.row_number().over(w))
    g = seen.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pages"), F.count(number).alias("numbered"), F.avg("_up").alias("ascending"),
        F.count_if(F.col(number) == F.col("_at")).alias("in_sequence"), F.count_if(F.abs(F.col(number) - F.col("_at")) > 50).alias("wild"),
    )
    kind = (
        F.when((F.col("numbered") == 0), "undetermined")
        .when(F.col("in_sequence") == F.col("pages"), "scan_sequence")
        .when((F.col("ascending") >= 0.9) & (F.col("wild") * 2 <= F.col("numbered")), "printed_folio")
        .when(F.col("numbered") < 3, "undetermined")
        .otherwise("mixed")
    )
    return g.withColumn("class", kind)


def occurrence_index(df: DataFrame, keys: list[str], start: str, name: str = "occurrence") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(start)))


def latest(df: DataFrame, keys: list[str], value: str, at: list[str]) -> DataFrame:
    """Last event wins; the struct of order columns settles ties."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*at)).alias(value), F.count(F.lit(1)).alias("events"))


def ranked(df: DataFrame, keys: list[str], order: list[str | Column], name: str = "rank") -> DataFrame:
    """Numbers the rows of each group from 1 along a total order, without a group in one task.

    Rows are range-sorted and stored once, so that both passes see the same partitions: one counts
    each partition's rows of each group, the other numbers rows behind those counts. The window goes
    over the counts: a row for each partition and group in it.
    """
    rows = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    rows = stored(rows.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()), "ranked")
    runs = rows.groupBy("_part", *keys).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    same = [F.col("a._part") == F.col("b._part"), *[F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]]
    met = rows.alias("a").join(runs.alias("b"), same)
    return met.select("a.*", (F.col("b._base") + F.col("a._at") - F.col("b._first") + 1).alias(name)).drop("_at", "_part")


def medians(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The exact median of each group, from ranks along a range sort."""
    n = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    at = ranked(df.where(F.col(value).isNotNull()).select(*keys, value), keys, [value], "_rank").join(n, keys)
    middle = at.where((F.col("_rank") == F.floor((F.col("_n") + 1) / 2)) | (F.col("_rank") == F.floor(F.col("_n") / 2) + 1))
    return middle.groupBy(*keys).agg(F.avg(value).alias("median"))
