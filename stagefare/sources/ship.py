"""Sending this package to the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="stagefare-ship-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as files:
        for source in sorted(root.rglob("*.py")):
            files.write(source, source.relative_to(root.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)
