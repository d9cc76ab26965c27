"""The status history as a stream: the same last-wins rule as the batch query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusq.operators.ordered import latest


def read_events(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """New Parquet files of a folder, a bounded number per trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def latest_status(events: DataFrame) -> DataFrame:
    """One state row per key; write it in update mode."""
    return latest(events, ["user_id"], "event_type", ["ts", "event_id"])


def windowed_counts(events: DataFrame, delay: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events per day and type; the watermark bounds the state, later events are dropped."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("day"), "event_type", "n")


def write_waves(df: DataFrame, path: str, checkpoint: str):  # noqa: ANN201
    """Idempotent upsert: each batch replaces its own folder, so a repeated batch leaves the same rows."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/wave={number}")

    return df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).start()
