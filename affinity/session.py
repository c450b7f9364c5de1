"""Session helpers: a tuned local session for tests/bench, and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale as much as locally: AQE re-plans joins from
# measured shuffle sizes (broadcast only what turned out small), coalesces
# small partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Suggested settings for a large cluster, sized from the input volume.

    Initial shuffle partitions ~ input / 256 MB, so a partition fits an
    executor's memory share without spilling; AQE then coalesces small
    partitions toward the same advisory size and splits skewed ones.
    """
    parts = max(200, -(-int(input_bytes) // target_partition_bytes))
    return {
        **{k: v for k, v in SCALE_CONF.items() if not k.startswith("spark.ui")},
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * target_partition_bytes),
        "spark.affinity.durableIndex": "true",
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "affinity", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench.  On a cluster, use the cluster's own
    session and only apply :data:`SCALE_CONF` if desired."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster
    (``spark.checkpoint.dir``).  Only a local-mode session (tests, this
    container) without one gets a scratch folder; on a cluster a missing
    setting is an error, never a machine-local folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="affinity-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local
