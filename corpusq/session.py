"""The Spark session used by the bench and the tests.

On a cluster the submitting side owns the settings; nothing here is needed there.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, once per application.

    The same as ``--py-files`` on submission; needed where the workers' path lacks the repository.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp()) / "corpusq.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))


def local_session(cores: int | None = None, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with adaptive execution, Arrow transfer and a UTC clock."""
    cores = cores or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusq")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
