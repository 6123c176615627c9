"""The session, and what Python workers need from it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with what the queries rely on: UTC, adaptive execution, last value wins in maps."""
    b = SparkSession.builder.appName("lakesieve").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.mapKeyDedupPolicy", "LAST_WIN").config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of every executor, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)
