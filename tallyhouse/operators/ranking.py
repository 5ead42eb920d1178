"""Ranks over a whole table without putting the table into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import shared_folder

# monotonically_increasing_id: partition number above, row number in it below.
_ROW_BITS = 33


def ranked(frame: DataFrame, *order: Column, name: str) -> DataFrame:
    """Number the rows 1, 2, 3 ... in the given (total) order.

    The rows are range-sorted over all tasks and checkpointed with their place
    in their partition, so the numbers hold when a lost task is run again. Only
    one row per partition, its size, is then summed up in order.
    """
    shared_folder(frame.sparkSession)
    placed = frame.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = placed.checkpoint()
    part = F.shiftright("_place", _ROW_BITS)
    row = F.col("_place") - F.shiftleft(part, _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.withColumn("_part", part)
        # As many rows as the sort has partitions, whatever the table's size.
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + row + 1)
        .drop("_part", "_place", "_start")
    )
