"""Making the package importable in Spark's Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_ROOT = os.path.dirname(_PACKAGE)
_shipped: set[str] = set()


def ensure(spark: SparkSession) -> None:
    """Send the package to the workers, once an application, unless ``PYTHONPATH`` names its folder.

    The archive lies on the driver only; Spark's file server passes it to the executors.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped or _ROOT in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(_PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, _ROOT))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
