"""Join-side sizing without jobs.

A unit table may be broadcast onto the (large) edge table, so that edges are
joined where they lie, if its size is known to be small: the source of the
units is a file scan, and Catalyst knows the bytes of its files.  The bound
is checked on that number when a query is built; no job runs for it.  Above
the bound, or where the size is not known, no hint is given: the join is
left to the planner and to AQE, which works from measured shuffle sizes and
splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest unit source (bytes of its files) whose unit tables are broadcast.
# A unit is some twenty bytes there, and a row of at most a hundred in a unit
# table, so a broadcast stays in the tens of MB.
UNIT_SOURCE_BYTES = 8 << 20


def source_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``: for a file scan, from the sizes of
    its files.  No job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(source: DataFrame, max_bytes: int = UNIT_SOURCE_BYTES) -> bool:
    return source_bytes(source) <= max_bytes


def maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast-hint ``df`` if the caller knows it to be small."""
    return F.broadcast(df) if small else df


def barrier_slots(spark: SparkSession) -> int:
    """Tasks that can run at one time, as a barrier stage needs them; 0 where
    executors come and go, which such a stage does not allow."""
    sc = spark.sparkContext
    if sc.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    jsc = sc._jsc.sc()
    return jsc.maxNumConcurrentTasks(jsc.resourceProfileManager().defaultResourceProfile())
