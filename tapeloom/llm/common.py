"""Reading the tables of this subpackage and the folds of its models."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Sequence
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tapeloom.plans.staging import staging_root

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    It is written to the shared folder, where it stays: executors that join later fetch it too.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(_PACKAGE.rglob("*.py")):
            archive.write(file, str(file.relative_to(_PACKAGE.parent)))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark)}/tapeloom-{context.applicationId}.zip")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(content.getvalue())
    finally:
        out.close()
    context.addPyFile(path.toString())
    _shipped.add(context.applicationId)


def shipped(operator: Callable) -> Callable:
    """For operators on a DataFrame (the first argument) that run Python on the executors."""

    @wraps(operator)
    def run(rows: DataFrame, *args, **options):
        ship(rows.sparkSession)
        return operator(rows, *args, **options)

    return run


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns called 0, 1, 2 ...: names of helper columns beside them cannot clash."""
    return df.toDF(*[str(n) for n in range(len(df.columns))])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, folds: int) -> Column:
    """Fold of a document: CRC-32 of its id as text, modulo ``folds`` (null id: null)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def held_out(doc_id: str | Column, folds: int, fold_number: int = 2) -> Column:
    """True for the rows that no model may learn from; a null id is never held out."""
    return F.coalesce(fold(doc_id, folds) == fold_number, F.lit(False))


def bounded_sample(rows: DataFrame, key: Column, most: int) -> DataFrame:
    """All of ``rows`` if they are ``most`` or fewer, else about that many, chosen by a hash of ``key``.

    The share aims at 95 % of ``most``, so that a chance excess stays within it.
    """
    count = rows.count()
    if count <= most:
        return rows
    parts = 1 << 40
    return rows.where(F.pmod(F.xxhash64(key), F.lit(parts)) < int(parts * 0.95 * most / count))


def with_added(df: DataFrame, run: Callable, added: Sequence[StructField]) -> DataFrame:
    """``df.mapInArrow(run)`` where ``run`` appends the ``added`` columns to those of ``df``.

    Columns reach ``run`` under their positions as names, so that any name is
    allowed; columns of ``df`` called like added ones are replaced.
    """
    names = [field.name for field in added]
    rest = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in names])
    rows = numbered(rest)
    return rows.mapInArrow(run, StructType([*rows.schema.fields, *added])).toDF(*rest.columns, *names)
