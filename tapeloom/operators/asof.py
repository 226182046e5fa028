"""The newest value at or before each row's time, without a range join.

Both sides are put into one order by time (values before the rows of their time) and cut into chunks of equal
size. Inside a chunk a window carries the last value forward; what a chunk begins with is the last
value of the chunks before it, found over one row per chunk. So a task holds one chunk, however
hot a time or a key is, and rows never meet more than one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.plans.ordering import with_position
from tapeloom.plans.series import DEFAULT_CHUNK_ROWS

_VALUE, _IS_ROW, _AT = "_asof_value", "_asof_row", "_asof_place"


def asof_value(
    rows: DataFrame, values: DataFrame, order: str, value: str, name: str, chunk_rows: int = DEFAULT_CHUNK_ROWS
) -> DataFrame:
    """``rows`` with ``name``: ``value`` of the newest row of ``values`` at or before their ``order``.

    ``values(order, value)`` should hold one row per time; of several any may be taken. A NULL value counts
    as a value. NULL before the first one, and for rows without a time, which
    never meet a value; values without a time are not used.
    """
    columns = rows.columns
    given = values.where(F.col(order).isNotNull()).select(
        *[F.col(order) if c == order else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in columns],
        F.struct(F.col(value).alias("value")).alias(_VALUE),
        F.lit(False).alias(_IS_ROW),
    )
    kind = values.schema[value].dataType.simpleString()
    asked = rows.withColumn(_VALUE, F.lit(None).cast(f"struct<value:{kind}>")).withColumn(_IS_ROW, F.lit(True))
    # many rows of one time are told apart by a hash, so that range partitions stay even
    plain = [c for c in columns if "map<" not in rows.schema[c].dataType.simpleString()]
    line = with_position(asked.unionByName(given), [order, _IS_ROW, F.xxhash64(*plain)], _AT)
    line = line.withColumn("_asof_chunk", F.expr(f"{_AT} div {chunk_rows}"))

    ends = line.where(~F.col(_IS_ROW)).groupBy("_asof_chunk").agg(F.max_by(_VALUE, _AT).alias("_asof_end"))
    # one row per chunk
    chunks = line.select("_asof_chunk").distinct().join(ends, "_asof_chunk", "left")
    earlier = Window.orderBy("_asof_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select("_asof_chunk", F.last("_asof_end", ignorenulls=True).over(earlier).alias("_asof_carried"))

    so_far = Window.partitionBy("_asof_chunk").orderBy(_AT).rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("_asof_found", F.last(_VALUE, ignorenulls=True).over(so_far)).where(_IS_ROW)
    newest = F.coalesce("_asof_found", "_asof_carried")["value"]
    return found.join(carried, "_asof_chunk").select(*columns, newest.alias(name))
