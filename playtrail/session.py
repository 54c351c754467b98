"""Session construction and the runtime settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that may be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Batches sent to Python: a batch of 10,000 long texts is a task's memory several times.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # Shuffle files go when their query ends, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


# Sizing for a large cluster (on the order of 1000 executors, 100 TB of
# events): scan splits and post-shuffle partitions of a few hundred MB, a wide
# initial shuffle that AQE coalesces, and skew splitting for hot join keys.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession, cluster: bool = False) -> SparkSession:
    """Apply the runtime settings (UTC clock, AQE with skew-join splitting);
    with ``cluster=True`` also the large-cluster sizing of ``CLUSTER_CONF``."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if cluster:
        for key, value in CLUSTER_CONF.items():
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "playtrail") -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the operator must set it (an error otherwise); only on a local
    master a scratch folder is created and registered when it is unset.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="playtrail-ckpt-")
    spark.sparkContext.setCheckpointDir(conf)
    return spark.sparkContext.getCheckpointDir() or conf


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path for intermediate tables under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{os.urandom(6).hex()}")


def materialize(df, name: str = "table"):
    """Write ``df`` as parquet under the shared checkpoint folder and continue
    from the written copy. Cuts lineage (a lost executor re-reads the files
    instead of recomputing from raw events), keeps plans small when a table is
    reused, and, unlike an RDD checkpoint, keeps column pruning and filter
    pushdown for every later scan."""
    return materialize_at(df, name)[0]


def materialize_at(df, name: str = "table"):
    """:func:`materialize`, also returning the path of the written copy."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def path_exists(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def listing(spark, path: str) -> tuple:
    """Name, size and time of change of the files of a table, in whatever store it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def bounded_broadcast(df, max_rows: int = 100_000):
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows
    (one small job over ``max_rows + 1`` rows); otherwise leave the join to the
    planner (sort-merge with AQE skew splitting)."""
    from pyspark.sql import functions as F
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
