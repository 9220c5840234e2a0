"""Make this package importable in the Python workers of a session."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application.

    Not needed where it is installed on every node or passed with ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    base = os.path.join(tempfile.mkdtemp(prefix="kindred-ship-"), "kindred")
    parent, package = os.path.split(_PACKAGE)
    context.addPyFile(shutil.make_archive(base, "zip", parent, package))
    _shipped.add(context.applicationId)
