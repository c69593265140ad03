"""Send this package to the executors, for sessions started without ``--py-files``."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tarmac

_sent: set[str] = set()


def ensure(spark: SparkSession) -> None:
    """Once per application: zip the package and have Spark distribute it to Python workers."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = os.path.dirname(os.path.abspath(tarmac.__file__))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tarmac-ship-")), "tarmac.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("tarmac", os.path.relpath(full, root)))
    context.addPyFile(path)
    _sent.add(context.applicationId)
