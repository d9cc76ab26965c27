"""Best-fit packing of token pieces into sequences, bulk-synchronously.

One pass encodes the documents and cuts those over ``size`` tokens; the first piece is the shorter one.
Only lengths go on, the ids are not moved. Pieces of ``size`` tokens are sequences of their own. The
others and the gaps are rows of tables, and rounds match them:

1. Gaps at least twice as long as the longest piece left are offered in that many parts. Gaps and
   pieces are range-sorted together, longest first, gaps before pieces of the same length.
2. The successor sweep takes them in that order: every piece wants the smallest gap above it that is
   still free. Each partition knows how many gaps and pieces it holds of each length; a running
   count over these runs (at most partitions plus two for each length) tells how many gaps are free
   before each run.
3. Conflicts are resolved by rank: the gaps of a length take the levels above the free ones, the pieces
   of a length the free levels from the top, in the order of their ranks. On each level gaps and
   pieces take turns, so a piece gets the last gap before it there; pieces for which no level is
   left wait. Levels are spread over the cluster; one holds two rows a length at most.
4. Matched gaps shrink and used up ones go; the round's table is stored, and the next one reads what is
   left in it. Where pieces are longer than any gap, new sequences are opened first: as many as those
   pieces need at least.

At the end the pieces of each sequence follow one another, longest first. Tests hold the number
of sequences against best-fit decreasing, one piece at a time. There are a few rounds, whatever the
number of rows; for each the driver sees how many pieces and gaps there are of each length, at most
``2 * size`` numbers.

Null text counts as empty: one piece, the end id. Null and repeated ids are kept, each row with its
own pieces. Extra columns are ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusq.llm.common import discard, stored
from corpusq.llm.tokens import encoder

SIZE = 1024
#: Rows a task sorts in a round.
EACH = 200_000


def cuts(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    first = (n - 1) % size + 1
    return [(0, first), *((at, size) for at in range(first, n, size))]


def pieces(docs: DataFrame, path: str, end_id: int, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, piece, start, length, ids_crc32 of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path, True), np.array([end_id], "<u4").tobytes()
        for b in batches:
            found: list[tuple] = []
            for i, x in zip(b.column(0).to_pylist(), enc.encode_many(b.column(1).to_pylist())):
                ids = memoryview(x + end)
                found += [(i, k, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)])) for k, (at, n) in enumerate(cuts(len(ids) // 4, size))]
            cols = list(zip(*found)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"))
    return rows.mapInArrow(run, "_id long, piece int, start long, length long, ids_crc32 long")


def offered(gaps: DataFrame, longest: int) -> DataFrame:
    """The gaps (id, size) as rows to match: size, kind 0, id, whole; long ones in equal parts."""
    parts = F.greatest(F.lit(1), F.floor(F.col("size") / longest)).cast("int")
    each = gaps.select("id", F.col("size").alias("whole"), parts.alias("k"), F.explode(F.sequence(F.lit(1), parts)))
    return each.select(F.floor(F.col("whole") / F.col("k")).cast("int").alias("size"), F.lit(0).alias("kind"), "id", "whole")


def sweep(gaps: DataFrame, pieces: DataFrame, parts: int) -> DataFrame:
    """One round over gaps (size, kind 0, id, whole) and pieces (size, kind 1, id).

    The same rows with their partner (by_id, by_size), null where they have none.
    """
    rows = gaps.unionByName(pieces.withColumn("whole", F.lit(None).cast("int")))
    order = [F.col("size").desc(), F.col("kind"), F.col("id")]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = stored(rows.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()), "pack-sorted")
    runs = rows.groupBy("part", "size", "kind").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    # Bounded: a row for each partition and for each length and kind.
    before = Window.orderBy(F.col("size").desc(), "kind", "part").rowsBetween(Window.unboundedPreceding, -1)
    more = F.when(F.col("kind") == 0, F.col("n")).otherwise(-F.col("n"))
    runs = runs.withColumn("sum", F.coalesce(F.sum(more).over(before), F.lit(0)))
    runs = runs.withColumn("free", F.col("sum") - F.least(F.lit(0), F.coalesce(F.min("sum").over(before), F.lit(0)), F.col("sum")))
    number = F.col("at") - F.col("first")
    level = F.when(F.col("kind") == 0, F.col("free") + number + 1).otherwise(F.col("free") - number)
    placed = rows.join(F.broadcast(runs.select("part", "size", "kind", "first", "free")), ["part", "size", "kind"])
    placed = placed.select("size", "kind", "id", "whole", level.alias("level"))
    turn = Window.partitionBy("level").orderBy(F.col("size").desc(), "kind")
    gap = F.col("kind") == 0
    met = placed.where("level > 0").repartition(parts, "level").withColumn("next", F.lead("kind").over(turn))
    by = {c: F.when(gap & (F.col("next") == 1), F.lead(c).over(turn)).when(~gap, F.lag(c).over(turn)) for c in ("id", "size")}
    met = met.select("size", "kind", "id", "whole", by["id"].alias("by_id"), by["size"].alias("by_size"))
    none = placed.where("level <= 0").select("size", "kind", "id", "whole", F.lit(None).cast("long").alias("by_id"), F.lit(None).cast("int").alias("by_size"))
    found = stored(met.unionByName(none), "pack-met")
    discard(rows)
    return found


def matched(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """(id, seq) of every piece (id, size below ``size``); sequences are numbered from -1 downwards."""
    spark = pieces.sparkSession
    left, gaps = pieces.select("size", F.lit(1).alias("kind"), "id"), spark.createDataFrame([], "id long, size int")
    opened, rounds = 0, []
    while True:
        both = left.select("kind", "size").unionByName(gaps.select(F.lit(0).alias("kind"), "size"))
        count = {(r.kind, r["size"]): r["count"] for r in both.groupBy("kind", "size").count().collect()}
        wants, has = {n: c for (k, n), c in count.items() if k}, {n: c for (k, n), c in count.items() if not k}
        if not wants:
            break
        widest, longest, n_gaps = max(has, default=0), max(wants), sum(has.values())
        hopeless = {n: c for n, c in wants.items() if n > widest}
        if hopeless:
            new = max(-(-sum(n * c for n, c in hopeless.items()) // size), -(-sum(hopeless.values()) // (size // min(hopeless))))
            gaps = gaps.unionByName(spark.range(opened + 1, opened + new + 1).select((-F.col("id")).alias("id"), F.lit(size).alias("size")))
            opened, n_gaps, widest = opened + new, n_gaps + new, size
        met = sweep(offered(gaps, longest), left, -(-(sum(wants.values()) + n_gaps) // EACH))
        rounds.append(met)
        left = met.where("kind = 1 AND by_id IS NULL").select("size", "kind", "id")
        rest = met.where("kind = 0").select("id", F.col("whole").alias("size"), F.coalesce("by_size", F.lit(0)).alias("used"))
        if widest >= 2 * longest:  # some were offered in parts
            rest = rest.groupBy("id").agg(F.max("size").alias("size"), F.sum("used").alias("used"))
        gaps = rest.select("id", (F.col("size") - F.col("used")).cast("int").alias("size")).where("size > 0")
    found = spark.createDataFrame([], "id long, seq long")
    for met in rounds:
        found = found.unionByName(met.where("kind = 1 AND by_id IS NOT NULL").select("id", F.col("by_id").alias("seq")))
    found = stored(found, "pack-placed")
    for met in rounds:
        discard(met)
    return found


def pack(docs: DataFrame, path: str, end_id: int = 2, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = pieces(docs, path, end_id, size, id_col, text_col).withColumn("id", F.monotonically_increasing_id())
    rows = stored(rows, "pack-pieces")
    placed = matched(rows.where(F.col("length") < size).select("id", F.col("length").cast("int").alias("size")), size)
    within = Window.partitionBy("seq").orderBy(F.col("length").desc(), "id").rowsBetween(Window.unboundedPreceding, -1)
    short = rows.join(placed, "id").withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0)))
    whole = rows.where(F.col("length") == size).select("*", F.col("id").alias("seq"), F.lit(0).cast("long").alias("offset"))
    result = short.unionByName(whole.select(short.columns))
    return result.select(F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"), "offset")
