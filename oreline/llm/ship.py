"""Makes this package importable on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]

#: Folders by application; Spark fetches the archive from there as executors come.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Adds the package to the application's Python files, once.

    Spark hands it to every executor, those that join later too, as ``--py-files`` would.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    folder = _shipped[app] = tempfile.TemporaryDirectory(prefix="package-")
    archive = f"{folder.name}/{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(PACKAGE.rglob("*.py")):
            packed.write(file, file.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(archive)
