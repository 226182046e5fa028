"""Reading landed files and reading/writing the layer tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.functions.filters import between

DEFAULT_FORMAT = "parquet"


def use_namespace(spark: SparkSession, schema: str, catalog: str | None = None) -> None:
    """Make a catalog and schema the default for unqualified table names."""
    if catalog is not None:
        spark.catalog.setCurrentCatalog(catalog)
    spark.catalog.setCurrentDatabase(schema)


def read_landed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    format: str = DEFAULT_FORMAT,
    day: str | None = None,
    start_date: str | None = None,
    end_date: str | None = None,
    **options: str,
) -> DataFrame:
    """Files of a known schema, limited to ``[start_date, end_date)`` at the scan."""
    rows = spark.read.format(format).schema(schema).options(**options).load(path)
    if day is None:
        if start_date is not None or end_date is not None:
            raise ValueError("a date range needs the name of the day column")
        return rows
    return between(rows, day, start_date, end_date)


def _is_path(target: str) -> bool:
    return "/" in target


def read_table(spark: SparkSession, target: str, format: str = DEFAULT_FORMAT, **options: str) -> DataFrame:
    """A table by name or a path; ``mergeSchema="true"`` shows columns that only later files hold."""
    reader = spark.read.options(**options)
    if not _is_path(target):
        return reader.table(target)
    _heal(spark, target.rstrip("/"))
    return reader.format(format).load(target)


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    format: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] = (),
    **options: str,
) -> int:
    """Write to a table name or a path; returns the rows written.

    The count is observed during the write instead of running the plan twice.
    """
    counted = Observation()
    observed = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.format(format).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target) if _is_path(target) else writer.saveAsTable(target)
    return counted.get["rows"]


def write_profiled(
    df: DataFrame, target: str, columns: Sequence[str], flags: Mapping[str, Column] | None = None, **writing
) -> DataFrame:
    """Write like ``write_table`` and return what ``quality_profile`` finds, observed during the write.

    One row per column (``column_name, null_count, nan_count, row_count``) and one per flag, whose
    ``null_count`` is the rows it holds for. The written table is not read again.
    """
    kinds = dict(df.dtypes)
    flags = dict(flags or {})
    counts = [F.count(F.lit(1)).alias("rows")]
    for n, name in enumerate(columns):
        value = F.col(f"`{name}`")
        floating = kinds[name] in ("double", "float")
        counts.append(F.count_if(value.isNull()).alias(f"nulls_{n}"))
        counts.append(F.count_if(F.isnan(value) if floating else F.lit(False)).alias(f"nans_{n}"))
    counts += [F.count_if(holds).alias(f"flag_{n}") for n, holds in enumerate(flags.values())]
    seen = Observation()
    write_table(df.observe(seen, *counts), target, **writing)
    found = seen.get
    rows = [(name, found[f"nulls_{n}"], found[f"nans_{n}"], found["rows"]) for n, name in enumerate(columns)]
    rows += [(name, found[f"flag_{n}"], 0, found["rows"]) for n, name in enumerate(flags)]
    # one row per column of the table
    return df.sparkSession.createDataFrame(rows, "column_name string, null_count long, nan_count long, row_count long")


def append_table(
    df: DataFrame, target: str, format: str = DEFAULT_FORMAT, merge_schema: bool = False
) -> int:
    """Append; with ``merge_schema`` new columns join a named table and missing ones are NULL.

    Files under a path carry their own columns: read them with ``mergeSchema="true"``.
    """
    if merge_schema and not _is_path(target) and df.sparkSession.catalog.tableExists(target):
        df = _merged(df, target)
    return write_table(df, target, mode="append", format=format)


def _merged(df: DataFrame, target: str) -> DataFrame:
    spark = df.sparkSession
    stored = spark.read.table(target).schema
    known = {f.name.lower() for f in stored}
    fresh = [f for f in df.schema if f.name.lower() not in known]
    if fresh:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
        spark.sql(f"alter table {target} add columns ({columns})")
    given = {name.lower() for name in df.columns}
    absent = {f.name: F.lit(None).cast(f.dataType) for f in stored if f.name.lower() not in given}
    return df.withColumns(absent)


def replace_table(df: DataFrame, target: str, format: str = DEFAULT_FORMAT) -> int:
    """Overwrite ``target`` with a frame that may itself read ``target``.

    The successor is written in full beside the target before anything changes. A named table is then
    pointed at its new folder, one change of the catalog, if it keeps its columns. A path is renamed
    aside (``.old``) before its successor (``.next``) takes its name: whatever step a crash comes at, one
    complete copy is left, and ``read_table`` and the next ``replace_table`` finish or undo the switch.
    ``sources.versions`` has tables whose readers see no switch at all.
    """
    spark = df.sparkSession
    if not _is_path(target):
        return _replace_named(df, target, format)
    target = target.rstrip("/")
    _heal(spark, target)
    rows = write_table(df, f"{target}.next", format=format)
    files, path = _files_of(spark, target)
    if files.exists(path(target)):
        files.delete(path(f"{target}.old"), True)
        _rename(files, path, target, f"{target}.old")
    _rename(files, path, f"{target}.next", target)
    files.delete(path(f"{target}.old"), True)
    spark.catalog.refreshByPath(target)
    return rows


def _files_of(spark: SparkSession, target: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(target).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _rename(files, path, source: str, target: str) -> None:
    if not files.rename(path(source), path(target)):
        raise OSError(f"{source} could not be renamed to {target}")


def _heal(spark: SparkSession, target: str) -> None:
    """Finish a switch that was interrupted: the successor if it is complete, else the old table."""
    files, path = _files_of(spark, target)
    if files.exists(path(target)):
        return
    if files.exists(path(f"{target}.next/_SUCCESS")):
        _rename(files, path, f"{target}.next", target)
    elif files.exists(path(f"{target}.old")):
        _rename(files, path, f"{target}.old", target)


def _replace_named(df: DataFrame, target: str, format: str) -> int:
    spark = df.sparkSession
    if not spark.catalog.tableExists(target):
        return write_table(df, target, format=format)
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"describe formatted {target}").collect()}
    same = [(f.name, f.dataType) for f in spark.read.table(target).schema] == [(f.name, f.dataType) for f in df.schema]
    if same and "Location" in about and about.get("Provider") == format and "# Partition Information" not in about:
        old = about["Location"]
        new = f"{old.rstrip('/').split('__at_')[0]}__at_{uuid.uuid4().hex}"
        rows = write_table(df, new, format=format)
        spark.sql(f"alter table {target} set location '{new}'")
        spark.catalog.refreshTable(target)
        files, path = _files_of(spark, old)
        files.delete(path(old), True)
        return rows
    rows = write_table(df, f"{target}__next", format=format)
    spark.sql(f"drop table if exists {target}")
    spark.sql(f"alter table {target}__next rename to {target}")
    return rows
