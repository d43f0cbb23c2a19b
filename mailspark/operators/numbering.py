"""Dense numbers per folder without a per-folder task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def number_rows(rows: DataFrame, group: str, order: Sequence[str], staging: str, name: str = "uid") -> DataFrame:
    """1, 2, 3 … within each group in the given order, as ``row_number`` would, for groups of any size.

    Rows are range-partitioned over group and order, so that a hot group spreads over many tasks,
    and written once with their place in the partition. The first number of each (partition, group)
    is a running sum over at most partitions + groups rows. Null is a group like any other.
    """
    spark = rows.sparkSession
    keys = [group, *order]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed.withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id()}).write.parquet(
        staging
    )
    placed = spark.read.parquet(staging)
    runs = placed.groupBy(group, "__part").agg(F.min("__place").alias("__first"), F.count("*").alias("__rows"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        group, "__part", "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before")
    )
    runs = runs.withColumnsRenamed({group: "__group", "__part": "__of"})
    same = F.col(group).eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__of"))
    numbered = placed.join(runs, same)
    number = F.col("__before") + F.col("__place") - F.col("__first") + 1
    return numbered.select(*rows.columns, number.alias(name))
