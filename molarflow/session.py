"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from contextlib import contextmanager
from typing import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on: UTC wall clock for timestamp_ntz maths, AQE for
# runtime re-planning (partition coalescing, skew splitting, broadcast
# conversion from *measured* sizes), no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}


# Starting point for a large cluster (hundreds of executors, ~100 TB of feeds):
# many initial shuffle partitions that AQE coalesces to ~128 MB each and splits
# when skewed; scan splits of 256 MB; AQE broadcasts a join side only when its
# measured size is below 64 MB. The shared checkpoint folder comes from the cluster.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "molarflow", extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the engine's base settings.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests pass
    ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        spark.conf.set(k, conf[k])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; without it, only a local
    (single-process) session gets a scratch folder of its own, a cluster raises.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="molarflow-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def checkpoint_dir(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts) if parts else base


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet in the shared checkpoint folder and read back: cuts the lineage, survives lost
    executors, and later reads prune columns."""
    spark = df.sparkSession
    path = checkpoint_dir(spark, "stored", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a join side that goes to every executor through the driver.
BROADCAST_ROWS = 50_000


def join_side(df: DataFrame, rows: int) -> DataFrame:
    """`df`, of `rows` rows, as a side of joins: broadcast or dealt by its number of rows. Spark goes by the bytes of
    its files, and a few of these hold very many keys."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df.hint("merge")


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a function that keeps a DataFrame as compressed Parquet in the shared checkpoint folder and reads it
    back, like `stored`. What it kept is removed at the end, so nothing outside may still read it."""
    paths: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        paths.append(checkpoint_dir(spark, "stored", f"{name}-{uuid.uuid4().hex}"))
        df.write.option("compression", "zstd").parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        for path in paths:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clear_stored(spark: SparkSession, hours: float = 24, kinds: tuple[str, ...] = ("stored", "llm", "ingest")) -> int:
    """Remove what jobs stored under the shared checkpoint folder and has not changed for `hours`; the number of
    folders removed. For a job of its own, at a time when no job still reads what it stored before."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    jvm, limit = spark.sparkContext._jvm, int((time.time() - hours * 3600) * 1000)
    removed = 0
    for kind in kinds:
        p = jvm.org.apache.hadoop.fs.Path(f"{base}/{kind}/*")
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for st in fs.globStatus(p) or []:
            if st.getModificationTime() < limit:
                removed += bool(fs.delete(st.getPath(), True))
    return removed
