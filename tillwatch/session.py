"""Session defaults and the shared scratch area for intermediate tables.

Some operators must read an expensive intermediate more than once (quantiles of
de-duplicated rows, windows over range-partitioned blocks).  They write it as
Parquet under the cluster's ``spark.checkpoint.dir`` and go on from the written
table: the lineage is cut, a lost executor costs only the re-read of a file, and
later scans are column-pruned and carry their true size into join planning.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def get_spark(app: str = "tillwatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for (UTC, AQE)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediates: the session's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on
    a cluster a machine-local folder would not be visible to other executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return f"{root.rstrip('/')}/tillwatch"
    if not re.match(r"local($|\[)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _local_dirs:
        folder = tempfile.mkdtemp(prefix="tillwatch-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_dirs[sc.applicationId] = folder
    return _local_dirs[sc.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch root, remembered for ``drop_scratch``."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the scratch area and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file tree on whatever file system ``path`` lives on."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(target, True))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly below ``path`` (none if it is absent)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (or a glob) matches anything on its file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the intermediates made inside the block when it ends."""
    made = _written.setdefault(spark.sparkContext.applicationId, [])
    start = len(made)
    try:
        yield
    finally:
        for path in made[start:]:
            delete_path(spark, path)
        del made[start:]


def drop_scratch(spark: SparkSession) -> int:
    """Delete this application's intermediates; tables built on them go with it."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    return sum(delete_path(spark, path) for path in paths)
