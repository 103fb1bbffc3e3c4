"""Makes this package importable on executors that do not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import voltaria


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_voltaria_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(voltaria.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="voltaria-ship-"), "voltaria_sources.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("voltaria", os.path.relpath(full, root)))
    context.addPyFile(path)
    context._voltaria_shipped = True
