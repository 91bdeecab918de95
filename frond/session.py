"""Sessions, and the library's own code on the workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application.

    The driver may have found it on a path that the workers do not have. Spark's file server hands
    the archive to executors, new ones included.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    at = Path(tempfile.mkdtemp(prefix="frond-code-")) / "frond.zip"
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path("frond") / p.relative_to(root)))
    sc.addPyFile(str(at))
    _SHIPPED.add(sc.applicationId)


def local_session(cores: int = 8, memory: str = "12g", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions)).config("spark.driver.memory", memory)
        .config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
