"""Dense global positions without moving the rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.plans.staging import stage

# monotonically_increasing_id() keeps the partition index above bit 33
_PARTITION_SHIFT = 33


def with_position(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Add the 0-based position of every row in the total order ``order``.

    Rows are range-partitioned and sorted (even partitions even if one leading
    key is hot, as long as the whole order tuple is selective), their place
    inside the partition is recorded, and the frame is staged so that the
    second pass sees the same partitions. The only unpartitioned window runs
    over one count per partition.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    placed = (
        stage(placed)
        .withColumn("_part", F.shiftright("_slot", _PARTITION_SHIFT))
        .withColumn("_slot", F.col("_slot") - F.shiftleft("_part", _PARTITION_SHIFT))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition, at most spark.sql.shuffle.partitions of them
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_slot"))
        .drop("_part", "_slot", "_start")
    )


def with_dense_key(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str,
    after: Column | int = 0,
    key_type: str = "int",
) -> DataFrame:
    """Number the rows ``after + 1, after + 2, ...`` in the given order."""
    offset = after if isinstance(after, Column) else F.lit(after)
    positioned = with_position(df, order, "_position")
    return positioned.withColumn(
        name, (offset + F.col("_position") + 1).cast(key_type)
    ).drop("_position")
