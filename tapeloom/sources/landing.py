"""Landed rows that cannot be used: kept beside the others, with the reason, and counted.

A landed file is parsed once, permissively. A row goes to quarantine if its text does not fit the schema or
if it breaks a rule; every other row is kept. Nothing is skipped silently and no bad row fails the load.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.plans.staging import scratch_path

MALFORMED = "malformed"
_RAW, _REASON = "_raw_line", "_reason"


@dataclass(frozen=True)
class Landed:
    """``rows`` of the schema; ``rejected(raw, reason, columns...)``; ``counts`` by reason, ``kept`` and ``read``."""

    rows: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def bar_rules(day: str = "trade_date", key: str = "ticker") -> dict[str, Column]:
    """Rules that hold for every daily bar: reason -> what breaks it."""
    return {
        "no_key": F.col(key).isNull() | F.col(day).isNull(),
        "crossed_range": F.col("high") < F.col("low"),
        "negative_volume": F.col("volume") < 0,
    }


def read_checked(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    format: str = "csv",
    rules: Mapping[str, Column] | None = None,
    **options: str,
) -> Landed:
    """Parse text files of a known schema; rows that do not fit or break a rule are set apart.

    Of several reasons the first counts, ``malformed`` before the rules in their order; a
    rule that gives NULL is not broken. The parsed rows are written once (by ``reason``) and counted during that write;
    both results read their part of it.
    """
    given = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    for taken in (_RAW, _REASON):
        if taken in given.names:
            raise ValueError(f"{taken} is taken by the quarantine")
    wide = T.StructType([*given.fields, T.StructField(_RAW, T.StringType())])
    parsed = (
        spark.read.format(format)
        .schema(wide)
        .options(**{"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW, **options})
        .load(path)
    )
    rules = dict(rules or {})
    if {"kept", "read", MALFORMED} & rules.keys():
        raise ValueError("a rule is named like a count")
    reason = F.when(F.col(_RAW).isNotNull(), MALFORMED)
    for name, broken in rules.items():
        reason = reason.when(broken, name)
    judged = parsed.withColumn(_REASON, F.coalesce(reason, F.lit("")))

    seen = Observation()
    of = lambda name: F.count_if(F.col(_REASON) == name)
    judged = judged.observe(
        seen, F.count(F.lit(1)).alias("read"), of("").alias("kept"), *[of(n).alias(n) for n in (MALFORMED, *rules)]
    )
    # two folders: a reader of the kept rows does not open the others
    target = scratch_path(spark)
    judged.withColumn("_set", (F.col(_REASON) != "").cast("int")).write.partitionBy("_set").parquet(target)
    full = T.StructType([*wide.fields, T.StructField(_REASON, T.StringType()), T.StructField("_set", T.IntegerType())])
    stored = spark.read.schema(full).parquet(target)
    names = [F.col(f"`{n}`") for n in given.names]
    return Landed(
        stored.where("_set = 0").select(*names),
        stored.where("_set = 1").select(F.col(_RAW).alias("raw"), F.col(_REASON).alias("reason"), *names),
        dict(seen.get),
    )
