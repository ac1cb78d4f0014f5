"""Intermediate results in the folder that all executors share.

The folder is the one the session names in ``spark.checkpoint.dir``.  Only
where that is unset and the master is local (a laptop, the tests) is a temporary
folder made; on a cluster without the setting nothing runs.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_OWN: dict[str, str] = {}
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder, without a trailing slash.  Raises ValueError where it is
    not set and executors do not share the driver's file system."""
    found = spark.sparkContext.getConf().get(_SETTING) or spark.conf.get(_SETTING, None)
    if not found:
        app = spark.sparkContext.applicationId
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="tidewater-")
        found = _OWN[app]
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; removed by ``cleanup`` or at exit."""
    path = f"{shared_dir(spark)}/scratch/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return a scan of it.

    This cuts lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mappable_dir(spark: SparkSession, name: str) -> str:
    """A new folder that every worker can open as plain files (for memory maps).

    Raises ValueError where the shared folder is no mounted file system: memory
    maps need one, so name a mount in ``spark.checkpoint.dir`` or pass a folder.
    """
    parts = urlparse(fresh_path(spark, name))
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {parts.scheme}://")
    return parts.path


def cleanup(spark: SparkSession) -> None:
    """Delete all that this module wrote.  Results built on it end with it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)


@atexit.register
def _at_exit() -> None:
    spark = SparkSession.getActiveSession() if _WRITTEN else None
    if spark is not None:
        try:
            cleanup(spark)
        except Exception:  # noqa: BLE001  the session may be gone already
            _WRITTEN.clear()
