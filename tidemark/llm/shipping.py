"""Make this package importable in Python workers wherever the driver was started from."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tidemark

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors by Spark's own file server, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(tidemark.__file__))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.join("tidemark", os.path.relpath(path, top)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark.zip")  # read by the driver alone
    with open(path, "wb") as f:
        f.write(held.getvalue())
    context.addPyFile(path)
    _shipped.add(context.applicationId)
