"""What Python workers need of this package."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once an application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        root = Path(__file__).resolve().parent
        with tempfile.TemporaryDirectory() as d:
            shutil.copytree(root, f"{d}/src/{root.name}", ignore=shutil.ignore_patterns("__pycache__"))
            sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), f"{root.name}-workers"), "zip", f"{d}/src"))
