"""What the operators share: shipping the code, files in the shared folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 1000  # rows of an Arrow batch, at most: texts are long, and two tasks share an executor's memory

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for each application.

    Functions then travel by name, and what a module remembers (vocabularies,
    power tables) lives as long as the Python worker.  Also keeps the session's Arrow
    batches to ``BATCH_ROWS`` rows.
    """
    sc = spark.sparkContext
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(size)) <= BATCH_ROWS:
        spark.conf.set(size, BATCH_ROWS)
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="code-"), "tillwatch_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, root))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all executors share, and the path on it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path if not path.startswith("file:/") or path.startswith("file://") else "file://" + path[5:])


def narrow(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that others can neither clash nor be read."""
    return docs.select(*[docs[c] for c in columns])
