"""Ranks without bringing rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.operators.lineage import cut


def ranked(df: DataFrame, order: list[Column], out: str = "rank") -> DataFrame:
    """``df`` with each row's place in ``order``, from 0.  Rows are
    range-sorted and kept; a row's rank is its place in its partition plus
    the sizes of the partitions before, one number each."""
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    d = cut(df.repartitionByRange(parts, *order).sortWithinPartitions(*order))
    at = F.monotonically_increasing_id()               # partition in the upper, place in the lower 33 bits
    d = d.withColumn("_part", F.shiftright(at, 33)).withColumn("_at", at.bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = d.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # one row a partition: bounded by the number of partitions
    d = d.join(F.broadcast(sizes), F.col("_part") == F.col("_p"))
    return d.select(*df.columns, (F.col("_at") + F.col("_before")).alias(out))
