"""Row numbers and running sums of a whole table, without bringing it to one task.

Rows are range-partitioned and sorted once and stored with their place; the totals of
the partitions, a row each, give the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.shared import stored


def _sorted_parts(df: DataFrame, order: list[str]) -> DataFrame:
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(placed.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_i")), "ordered")


def _offsets(parts: DataFrame, total: Column) -> DataFrame:
    """(_p, _before): what the partitions before each have in all; a row for each partition."""
    sums = parts.groupBy("_p").agg(total.alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    return sums.select("_p", F.coalesce(before, F.lit(0)).alias("_before"))


def row_numbers(df: DataFrame, order: list[str], name: str = "row_index") -> DataFrame:
    """``df`` with its row number from 0; ``order`` must be total."""
    parts = _sorted_parts(df, order)
    return parts.join(_offsets(parts, F.count("*")), "_p").withColumn(name, F.col("_before") + F.col("_i")).drop("_p", "_i", "_before")


def sum_before(df: DataFrame, order: list[str], value: str, name: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` over all rows before it; ``order`` must be total."""
    parts = _sorted_parts(df, order)
    local = F.coalesce(F.sum(value).over(Window.partitionBy("_p").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = parts.withColumn("_s", local).join(_offsets(parts, F.coalesce(F.sum(value), F.lit(0))), "_p")
    return out.withColumn(name, F.col("_before") + F.col("_s")).drop("_p", "_i", "_s", "_before")
