"""What a session needs for the Python functions of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import oncolake

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to all executors through Spark, once per application.

    The archive is built in a folder of the driver; executors get it from Spark, not from there.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.abspath(oncolake.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="oncolake-"), "oncolake_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Bound Arrow batches by bytes, for texts of any length: memory only, results are the same.

    Queries and pipeline stages call this; operators leave the session alone.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
