"""Session helpers: make the package importable on executors."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each application.

    Functions of the package are pickled by name, so workers must be able to import it even where only the
    driver's path has it.
    """
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    package = Path(__file__).parent
    folder = tempfile.mkdtemp(prefix="tidemark-")
    staged = Path(folder, "staged")
    shutil.copytree(package, staged / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(folder, package.name), "zip", staged))
    shutil.rmtree(staged)
    _sent.add(sc.applicationId)
