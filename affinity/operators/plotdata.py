"""Plot-ready tables in place of on-screen rendering: coloured map points,
scatter series and histograms."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.functions.color import STOPS_MEAN, color_position, color_stop


def map_points(df: DataFrame, value: str, stops: Sequence[float] = STOPS_MEAN) -> DataFrame:
    """Adds ``color_stop`` (stop interval index) and ``color_pos`` (0..1
    position in it) for a colour scale with the given stops."""
    return df.withColumns({"color_stop": color_stop(value, stops),
                           "color_pos": color_position(value, stops)})


def scatter_series(df: DataFrame, x: str, ys: Mapping[str, str]) -> DataFrame:
    """Long form ``(x, y, series)``: one row per input row and series.  Each
    point stays with its own x, so series cannot drift out of order."""
    point = F.inline(F.array(*[F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
                                        F.lit(name).alias("series")) for name, y in ys.items()]))
    return df.select(point)


def bucket_count(start: float, stop: float, step: float) -> int:
    """Buckets between the edges ``start + i * step <= stop``."""
    n = max(0, int((stop - start) // step))
    # the quotient may round either way next to a whole number
    while start + (n + 1) * step <= stop:
        n += 1
    while n and start + n * step > stop:
        n -= 1
    return n


def histogram(df: DataFrame, col: str, start: float, stop: float, step: float) -> DataFrame:
    """Histogram over equal-width edges ``start, start+step, ...`` as far as
    they do not pass ``stop``.

    Buckets are ``[lo, hi)`` except the last, which is closed; values
    below the first or above the last edge and nulls/NaN are ignored.  Every bucket is
    returned, empty ones with count 0.  The bucket index is arithmetic (no
    UDF); counting is a partial + final aggregation over at most
    ``n_buckets`` keys.
    """
    n = bucket_count(start, stop, step)
    if n < 1:
        raise ValueError("a histogram needs two edges")
    last = start + n * step
    x = F.col(col).cast("double")
    idx = F.least(F.floor((x - F.lit(start)) / F.lit(step)).cast("int"), F.lit(n - 1))
    counts = (df.where((x >= F.lit(start)) & (x <= F.lit(last)) & ~F.isnan(x))
              .groupBy(idx.alias("bucket")).agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    buckets = spark.range(n).select(F.col("id").cast("int").alias("bucket"))
    return (buckets.join(counts, "bucket", "left")
            .select("bucket",
                    (F.lit(start) + F.col("bucket") * F.lit(step)).alias("lo"),
                    (F.lit(start) + (F.col("bucket") + 1) * F.lit(step)).alias("hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def histogram_edges(df: DataFrame, col: str, edges: Sequence[float]) -> DataFrame:
    """Histogram over arbitrary ascending edges (same bucket rules as
    :func:`histogram`).  Out-of-range values are filtered before the
    bucketizer, which would reject them."""
    edges = [float(e) for e in edges]
    x = F.col(col).cast("double")
    inside = df.select(x.alias("_x")).where((F.col("_x") >= edges[0]) & (F.col("_x") <= edges[-1]))
    b = Bucketizer(splits=edges, inputCol="_x", outputCol="_b", handleInvalid="skip").transform(inside)
    counts = b.groupBy(F.col("_b").cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
    spark: SparkSession = df.sparkSession
    axis = spark.createDataFrame([(i, edges[i], edges[i + 1]) for i in range(len(edges) - 1)],
                                 "bucket int, lo double, hi double")
    return (axis.join(counts, "bucket", "left")
            .select("bucket", "lo", "hi", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))
