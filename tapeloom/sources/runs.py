"""Run log (parameters and metrics of named runs) and model storage."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession

from tapeloom.sources.tables import append_table

RUN_LOG_SCHEMA = (
    "run_name string, kind string, key string, value_str string, value_num double, logged_at timestamp"
)


def run_records(
    spark: SparkSession,
    run_name: str,
    logged_at: datetime,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | None = None,
) -> DataFrame:
    """One row per parameter and per metric of a run."""
    rows = [(run_name, "param", k, str(v), None, logged_at) for k, v in (params or {}).items()]
    rows += [(run_name, "metric", k, None, float(v), logged_at) for k, v in (metrics or {}).items()]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def log_run(
    spark: SparkSession,
    target: str,
    run_name: str,
    logged_at: datetime,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | None = None,
) -> int:
    """Append a run to the log table; returns the rows added."""
    return append_table(run_records(spark, run_name, logged_at, params, metrics).coalesce(1), target)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(kind: type[MLReadable], path: str):
    return kind.load(path)
