"""Gives the package to the Python workers of a running session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import pricewatch

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """``addPyFile`` of this package, once for each application. Workers that
    find it on their own path or by ``--py-files`` are served the same code.
    The archive is made on the driver; Spark copies it to the executors."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(pricewatch.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="pricewatch-code-"), "pricewatch.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
