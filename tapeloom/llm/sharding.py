"""Balanced contiguous shards from global byte-size prefix sums.

Rows are range-partitioned by id and sorted; every partition contributes one
row of totals, the running sum of those totals gives each partition its offset,
and a row's place in the whole is that offset plus its place in the partition.
Shards are cut where the running size passes equal targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.plans.staging import stage


def byte_shards(docs: DataFrame, shards: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` in one of ``shards`` contiguous runs of near-equal bytes.

    Size is the text's UTF-8 bytes (null: none) plus 1. Order: id (null first),
    then checksum and size; rows equal in all three are interchangeable. A row
    goes to the shard in whose equal share of all bytes its middle byte lies, so
    a shard is off its share by less than the largest row. ``slot`` counts from 0
    inside each shard. An empty table gives no rows. Other columns of ``docs`` are
    not read, whatever they are called.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    checksum = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    narrow = docs.select(F.col(id).alias("doc_id"), size.alias("size"), checksum.alias("text_crc32"))
    # the row number only spreads repeated rows over partitions: equal rows may trade places
    spread = narrow.withColumn("_row", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange("doc_id", "text_crc32", "size", "_row")
    parts = stage(ranged.drop("_row").withColumn("_part", F.spark_partition_id()))

    totals = parts.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: the only window over everything
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_all"),
    )
    inside = Window.partitionBy("_part").orderBy("doc_id", "text_crc32", "size")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = parts.select(
        "*", F.sum("size").over(running).alias("_upto"), F.row_number().over(inside).alias("_nth")
    ).join(F.broadcast(offsets), "_part")
    middle = 2 * (F.col("_bytes_before") + F.col("_upto")) - F.col("size")
    shard = F.expr(f"least({shards - 1}L, (_middle * {shards}L) div (2L * _all))").cast("int")
    numbered = stage(
        placed.withColumn("_middle", middle).select(
            "doc_id",
            "size",
            "text_crc32",
            shard.alias("shard"),
            (F.col("_rows_before") + F.col("_nth") - 1).alias("_place"),
        )
    )
    first = numbered.groupBy("shard").agg(F.min("_place").alias("_first"))
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_place") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
