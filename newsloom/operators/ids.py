"""Serial ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stage

_OFFSET_BITS = 33


def assign_ids(df: DataFrame, order: list[str], start: Column | int = 0, out: str = "id") -> DataFrame:
    """Consecutive ids `start + 1, start + 2, ...` in the given order.

    Rows are range partitioned and numbered inside each partition; the partition totals (one row
    each) give every partition its offset. No task sees more than its own range.
    """
    numbered = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id()),
        "numbered",
    )
    numbered = numbered.withColumn("_part", F.shiftright("_row", _OFFSET_BITS))
    totals = numbered.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.col("_row").bitwiseAND((1 << _OFFSET_BITS) - 1)
    start = F.lit(start) if isinstance(start, int) else start
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(out, (start + F.col("_before") + within + 1).cast("bigint"))
        .drop("_part", "_row", "_before")
    )
