"""Tables in the shared folder: where lineage ends, and where a second pass must see the rows of the first."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusq.session import ship_package

_TEMPORARY: set[str] = set()


def work_path(spark: SparkSession, tag: str) -> str:
    """A new path under ``spark.checkpoint.dir``, the folder that driver and executors share.

    Where the setting is missing a temporary folder takes its place in a local session, whose
    threads share it; elsewhere executors could not see it, so that is an error.
    """
    ship_package(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), f"corpusq-work-{os.getpid()}")
        if base not in _TEMPORARY:
            _TEMPORARY.add(base)
            atexit.register(shutil.rmtree, base.removeprefix("file://"), ignore_errors=True)
    return f"{base.rstrip('/')}/corpusq/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there."""
    path = work_path(df.sparkSession, tag)
    df.write.options(**{k.replace("__", "."): v for k, v in options.items()}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table that :func:`stored` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file.rpartition("/")[0])
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
