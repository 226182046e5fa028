"""Cut lineage by writing a frame once to the cluster's shared folder.

A staged frame is plain Parquet under ``spark.checkpoint.dir``: it survives
lost executors, keeps column pruning and filter pushdown, and gives Catalyst a
real byte size, so its join strategy is chosen from a measured size.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only on local[*]."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tapeloom-")
    return _local_roots[app]


def _session_folder(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/tapeloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession) -> str:
    """A new path that ``drop_staged`` deletes."""
    return f"{_session_folder(spark)}/{uuid.uuid4().hex}"


def stage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and return a frame that scans the written files."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this application has staged (frames on it become unreadable)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path, True)
