"""Sessions and the shipping of this package to executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Rows of any text are sent to Python in batches of so many, so that a task holds little at once.
ROWS_PER_BATCH = 1000

_shipped: set[str] = set()


def build(cores: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings that the results rely on (UTC, ANSI, adaptive execution)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quillmesh")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python once per application, so that they can import it,
    and bound the batches that it gets."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        here = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="spark-")) / "quillmesh.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for p in sorted(here.rglob("*.py")):
                z.write(p, f"quillmesh/{p.relative_to(here)}")
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)
    return spark
