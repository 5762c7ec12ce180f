"""Sends this package to executors that do not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package as a zip file to the session's context, once per application."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="spark-"), "storyloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(home, "storyloom")):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), home))
    context.addPyFile(path)
    _sent.add(context.applicationId)
