"""Makes the package importable in Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    The archive is read on the driver only; Spark's file server hands it out.
    Not needed where the job is submitted with the package in ``--py-files``.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp()}/newscorpus", "zip", root_dir=root.parent, base_dir=root.name
    )
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
