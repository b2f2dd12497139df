"""Session settings used by the tests and the benchmark.

On a cluster the session comes from ``spark-submit``; nothing in the library
needs these settings except the UTC session time zone, which makes month keys
and alert windows independent of where the job runs.
"""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "caselume") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if cores != "*" else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Operators with Python tasks call it, so they run from any working folder. A
    package that was itself submitted as a zip is already on the workers.
    """
    context = spark.sparkContext
    folder = os.path.dirname(os.path.abspath(__file__))
    if context.applicationId in _shipped or not os.path.isdir(folder):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="caselume-"), "caselume")
    context.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(folder), os.path.basename(folder)))
    _shipped.add(context.applicationId)
