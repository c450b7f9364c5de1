"""Mixing sources to target weights by weighted fair queueing.

Every source's documents are shuffled by a seeded hash.  A document's
virtual finish time is the number of its source's tokens up to and including
it, divided by the source's target.  All sources advance evenly in this
time, so sorting all documents by it and cutting the sorted sequence at the
total budget takes from each source about its target, in an order that is
mixed throughout.

Only narrow rows (row key, source, size, hash) are moved; texts are not.
A hot source is no single group: running totals go through hash buckets, as
many as keep a bucket of the largest source below ``BUCKET_ROWS`` rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import cut, cut_narrow, narrow_parts, pick_rows, ranked, running_total, stable
from affinity.llm.text import WORD

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 20
BUCKET_ROWS = 20_000
BROADCAST_SOURCES = 50_000     # with fewer sources than this their table is broadcast, else joined


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source, source_rank,
    source_size, source_rows, weight, target.

    Sources in code point order, null last, take the weights in turn.  The
    total of all sizes is shared by weight; a target stops at
    ``max_repeats`` times its source's size and the excess goes to the
    others by weight until none is above.  One aggregation of the source
    table per round; only its sums reach the driver."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("source_rank") - 1) % len(weights) + 1).cast("int"))
    s = ranked(s, [], [F.col("source").asc_nulls_last()]).drop("total").withColumn("source_rank", F.col("rank") + 1).drop("rank")
    s = cut_narrow(s.withColumn("weight", w).withColumn("cap", F.col("source_size") * max_repeats))
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0                       # target per unit of weight where no cap holds
    while True:
        capped = F.col("cap") <= F.lit(level) * F.col("weight")
        fixed, free = s.agg(F.sum(F.when(capped, F.col("cap"))), F.sum(F.when(~capped, F.col("weight")))).first()
        new = (total - (fixed or 0)) / free if free else level
        if not free or new <= level:
            break
        level = new
    target = F.least(F.col("cap").cast("double"), F.lit(float(level)) * F.col("weight"))
    return s.withColumn("target", target).drop("cap")


def small(sources: DataFrame, n: int) -> DataFrame:
    """Broadcast a table of one narrow row per source if its counted rows are
    few; a larger one is left to a shuffled join."""
    return F.broadcast(sources) if n <= BROADCAST_SOURCES else sources


def document_sizes(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """Narrow rows (row, doc_id, source, size), in the shared folder.  ``row``
    numbers the rows of the scan, so repeated rows stay apart; size is the
    number of words, 0 for a null text."""
    d = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col(source).alias("source"),
                    F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    # dealt out anew, so that few files hold the narrow rows of many scan tasks
    return cut(d.repartition(narrow_parts(docs.sparkSession)))


def mixture(sizes: DataFrame, targets: DataFrame, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """The mixed sequence: (row, epoch, size, finish, position), where
    ``position`` is the number of tokens up to and including the row.  A
    source whose target exceeds its size is repeated in further epochs, at
    most ``max_repeats`` in all.  Rows of sources without a word are left
    out.  The sequence is range-partitioned and sorted by finish time."""
    spark = sizes.sparkSession
    parts = narrow_parts(spark)
    top, budget, n_sources = targets.agg(F.max("source_rows"), F.sum("target"), F.count(F.lit(1))).first()
    bits = max(0, math.ceil(math.log2(max(1, (top or 1) / BUCKET_ROWS))))
    t = small(targets.filter("target > 0").select(F.col("source").alias("_s"), "source_rank", "source_size", "target"), n_sources)
    # seeded shuffle; equal hashes are ordered by id and row
    d = sizes.withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 1))
    d = d.withColumn("b", F.shiftright(F.col("h"), 63 - bits))
    d = running_total(d, ["source"], "b", ["h", "doc_id", "row"], "size", "cum")
    d = d.join(t, F.col("source").eqNullSafe(F.col("_s")))
    epochs = F.least(F.lit(max_repeats), (F.floor(F.col("target") / F.col("source_size")) + 1).cast("int"))
    d = d.withColumn("epoch", F.explode(F.sequence(F.lit(1), epochs)))
    d = d.withColumn("finish", ((F.col("epoch") - 1) * F.col("source_size") + F.col("cum")) / F.col("target"))
    order = ["finish", "source_rank", "h", "row", "epoch"]
    d = cut(d.select("row", "epoch", "size", *[c for c in order if c not in ("row", "epoch")])
            .repartitionByRange(parts, *order).sortWithinPartitions(*order))
    # running total over the sorted partitions
    d = d.withColumn("part", F.spark_partition_id())
    offsets = d.groupBy("part").agg(F.sum("size").alias("n"))
    offsets = offsets.select(F.col("part").alias("_p"), F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("inside", F.sum("size").over(inside)).join(F.broadcast(offsets), F.col("part") == F.col("_p"))
    # targets are doubles: half a token keeps rounding from cutting a row that fits exactly
    return (d.withColumn("position", F.col("before") + F.col("inside"))
            .filter(F.col("position") <= F.lit(float(budget or 0.0)) + 0.5)
            .select("row", "epoch", "size", "finish", "position"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): row, doc_id, size,
    source_size, target, copies, taken.

    Null text: size 0, taken 0.  Null source: a source of its own, last.
    Repeated rows: each counts and is taken by itself.  Empty table: no
    rows.  Other columns are not read.  Reruns over the same files agree."""
    sizes = document_sizes(stable(docs))
    targets = source_targets(sizes, weights, max_repeats)
    seq = mixture(sizes, targets, max_repeats, seed)
    copies = seq.groupBy("row").agg(F.count(F.lit(1)).alias("copies"))
    t = small(targets.select(F.col("source").alias("_s"), "source_size", "target"), targets.count())
    return (sizes.join(copies, "row", "left").join(t, F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("copies", F.coalesce("copies", F.lit(0)))
            .select("row", "doc_id", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mixed_documents(docs: DataFrame, **kw) -> DataFrame:
    """The documents themselves, once per copy taken, with the columns of ``docs``."""
    docs = stable(docs)
    return pick_rows(docs, mix_sources(docs, **kw).filter("copies > 0"), copies=True)
