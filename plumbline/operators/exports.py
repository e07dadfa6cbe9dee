"""Exports: batches, run-length codes, label lines and package checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def batches(rows: DataFrame, keys: list[str], order: str, size: int) -> DataFrame:
    """Rows of each group in order, cut to batches with a file name each."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    batch = F.floor(n / size).cast("long")
    return rows.withColumns({"batch": batch, "file": F.concat(F.lit("tasks_"), F.lpad((batch + 1).cast("string"), 3, "0"), F.lit(".json"))})


def vector_energy(vector: Column) -> Column:
    return F.aggregate(F.transform(vector.cast("array<double>"), lambda x: x * x), F.lit(0.0), lambda a, x: a + x)


def ranked(rows: DataFrame, order: str) -> DataFrame:
    """rank: places from 0 in order of a column, found range by range: each range counts its own rows, and what comes before is a sum of counts."""
    parts = rows.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_id", F.monotonically_increasing_id())
    # an id is the partition in the upper bits and the row's place in it below
    parts = parts.withColumns({"_part": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id").persist()
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row for each partition
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    return parts.join(F.broadcast(before), "_part").select(*rows.columns, (F.coalesce("_before", F.lit(0)) + F.col("_at")).alias("rank"))
