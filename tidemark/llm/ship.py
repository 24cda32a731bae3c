"""Hands this package to the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tidemark


def ship(spark: SparkSession) -> SparkSession:
    """Lets the session's Python workers import this package, wherever they run.

    Spark itself carries the zip file to the executors. On a cluster with the package
    installed this changes nothing. Repeated calls do nothing.
    """
    context = spark.sparkContext
    if not any(name.endswith("/tidemark.zip") for name in context.listFiles):
        root = os.path.dirname(os.path.abspath(tidemark.__file__))
        path = os.path.join(tempfile.mkdtemp(), "tidemark.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        file = os.path.join(folder, name)
                        out.write(file, os.path.relpath(file, os.path.dirname(root)))
        context.addPyFile(path)
    return spark
