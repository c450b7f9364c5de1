"""Session settings and small relational helpers the operators share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.session import ensure_checkpoint_dir

# Rows per Arrow batch sent to Python.  Texts can be long, so a batch of the
# default 10,000 rows would be large; the operators cut batches further into
# blocks of bounded bytes (see text.blocks).
ARROW_ROWS = 512
ARROW_BYTES = 8 << 20      # of a batch: what a task's JVM holds beside its heap, twice


_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _in_bytes(size: str) -> int:
    """A size setting (``64MB``, ``8388608``) as a number; -1 is no bound."""
    found = re.fullmatch(r"\s*(-?\d+)\s*([kmgt]?)i?b?\s*", size.lower())
    return int(found[1]) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[found[2]] if found else -1


def prepare(spark: SparkSession) -> int:
    """Set up the session for an operator: shared checkpoint folder, held
    splits of scans, small Arrow batches.  Returns the number of shuffle partitions, from which
    the operators derive how many groups they make, so that a group's size
    follows from the cluster's own sizing of the job."""
    ensure_checkpoint_dir(spark)
    hold_splits(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    held = spark.conf.get(_BYTES, None)
    if held is None or not 0 < _in_bytes(held) <= ARROW_BYTES:
        spark.conf.set(_BYTES, str(ARROW_BYTES))
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Plan nodes that give the same rows in the same order each time they run,
# whichever columns are read.
_STEADY = {"Project", "Filter", "Relation", "LocalRelation", "LogicalRDD", "SubqueryAlias", "ResolvedHint", "Union"}


def hold_splits(spark: SparkSession) -> None:
    """Hold the parallelism that scans are split by.  Spark packs files (and
    local rows) into partitions by the cores alive when a job is planned, so
    an executor lost or won between two passes would give the rows other
    numbers.  The value of the first call stays for the session; one that
    the session sets itself is left.  Files are still split by
    ``spark.sql.files.maxPartitionBytes``, so a large scan has no fewer
    partitions."""
    cores = str(spark.sparkContext.defaultParallelism)
    leaf = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    if leaf is None:
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", cores)
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", leaf or cores)


def stable(df: DataFrame) -> DataFrame:
    """``df``, fit to have its rows numbered in each of several passes: a scan
    of files as it is, with the splits held, and anything with a shuffle,
    limit or the like below it kept in the shared folder first."""
    hold_splits(df.sparkSession)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    nodes = {line.lstrip(" :+-").split(" ")[0].split("(")[0] for line in plan.splitlines() if line.strip()}
    return df if all(n.split("[")[0] in _STEADY or n.startswith("Relation") for n in nodes) else cut(df)


def hash_sample(df: DataFrame, key: str, most: int, seed: int) -> DataFrame:
    """At most ``most`` rows of a kept table, those of the smallest hashes of
    ``key``: a sample that depends neither on order nor on partitions.  A
    threshold first leaves about as many rows as wanted, so that no
    partition sends more than its share."""
    n = df.count()
    h = F.xxhash64(F.lit(seed), key)
    if n > most:
        df = df.filter(F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * most / n + 1000 / n)))
    return df.orderBy(F.pmod(h, F.lit(1 << 30)), h).limit(most)


def pick_rows(df: DataFrame, chosen: DataFrame, copies: bool = False) -> DataFrame:
    """The rows of ``df`` whose number in the scan is a ``row`` of ``chosen``
    (each row once there), with the columns of ``df``; with ``copies``, as
    often as that column of ``chosen`` says.  ``df`` comes from ``stable``, so
    the number is the same for every scan of the same files.  The columns travel as one struct, so none
    can clash."""
    d = df.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"))
    if not copies:
        return d.join(chosen.select("row"), "row", "left_semi").select("doc.*")
    d = d.join(chosen.select("row", F.col("copies").cast("long").alias("copies")), "row")
    return d.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc.*")


def cut_narrow(df: DataFrame) -> DataFrame:
    """``cut`` for rows of a few numbers after a shuffle: shuffle partitions
    are sized for texts, so an eighth as many files hold such a table, and
    each file costs its writer a child process or a call to a name node."""
    return cut(df.coalesce(narrow_parts(df.sparkSession)))


def narrow_parts(spark: SparkSession) -> int:
    """Partitions for rows of a few numbers, where shuffle partitions are
    sized for texts."""
    return max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder once.
    Later reads come from there, also after an executor is lost; the files
    go when the driver drops the DataFrame (cleaner setting permitting)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def running_total(df: DataFrame, keys: list[str], bucket: str, order: list, value: str, out: str) -> DataFrame:
    """Inclusive running total of ``value`` per ``keys`` in the order of
    ``bucket`` and then ``order``, without bringing a key's rows together:
    totals per (key, bucket) are summed up first, and only rows of one
    bucket are sorted in one task."""
    totals = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_t"))
    before = (Window.partitionBy(*keys).orderBy(bucket)
              .rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(*keys, bucket, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"))
    inside = (Window.partitionBy(*keys, bucket).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    left = df.withColumn("_inside", F.sum(value).over(inside)).alias("l")
    right = totals.alias("r")
    on: Column = F.col(f"l.{bucket}") == F.col(f"r.{bucket}")
    for k in keys:
        on = on & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return left.join(right, on).select("l.*", F.col("r._before").alias("_before")).withColumn(
        out, F.col("_before") + F.col("_inside")).drop("_before", "_inside")


FEW_ROWS = 500_000   # rows of a few numbers that are broadcast if they are no more


def few(df: DataFrame) -> DataFrame:
    """Broadcast a kept table of a few numbers a row if its counted rows are
    few; a larger one is left to a shuffled join."""
    return F.broadcast(df) if df.count() <= FEW_ROWS else df


def ranked(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """``df`` with ``rank`` (from 0, in ``order``) and ``total``, the number
    of rows, of each group ``by``.  Rows are range-sorted over all groups,
    so a group of any size is spread over partitions: a row's rank is its
    place in its partition plus what its group has in earlier ones.  The
    sorted rows are kept, so every later pass sees the same places."""
    parts = narrow_parts(df.sparkSession)
    keys = [F.col(c).asc_nulls_first() for c in by] + order
    d = cut(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys))
    at = F.monotonically_increasing_id()               # partition in the upper, place in the lower 33 bits
    d = d.withColumn("_part", F.shiftright(at, 33)).withColumn("_at", at.bitwiseAND(F.lit((1 << 33) - 1)))
    held = d.groupBy(*by, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = cut(held.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_part").alias("_p"), "_first",
                           F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
                           F.sum("_n").over(group).alias("total")).coalesce(1 + parts // 4))
    on = F.col("_part") == F.col("_p")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return d.join(few(held), on).withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before")).select(
        *df.columns, "rank", "total")


def table_query(table: str, fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A registered query that applies ``fn`` to a whole table."""
    from affinity.sources.tables import read_table

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(read_table(spark, sf_dir, table))
    return run
