"""Physical deletes on partitioned Parquet tables (SNK5, SNK6).

Without a table format, a delete is either a rewrite of the touched partitions
or, when whole partitions go, removing their folders. Dynamic partition
overwrite cannot express "this partition is now empty" (an emptied partition
keeps its old files), so partitions left with no rows are removed explicitly.
"""

from __future__ import annotations

import datetime as dt
import os
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molarflow.session import ensure_checkpoint_dir
from molarflow.sinks.merge import retention_cutoff

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def partition_values(spark: SparkSession, root: str, col: str) -> list[str]:
    """Values of the first-level partition folders `col=value` under `root`."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(col + "="):
            out.append(name[len(col) + 1:])
    return sorted(out)


def drop_partitions(spark: SparkSession, root: str, col: str, values: Sequence[str]) -> list[str]:
    """Remove the folders `root/col=value` (only those, only under `root`)."""
    dropped = []
    for v in values:
        fs, p = _fs(spark, os.path.join(root, f"{col}={v}"))
        if fs.exists(p) and fs.delete(p, True):
            dropped.append(v)
    return dropped


def apply_retention(spark: SparkSession, root: str, now: dt.datetime, months: int = 2,
                    col: str = "month") -> list[str]:
    """SNK6 on a month-partitioned table: the cutoff is the first instant of a month,
    so retention is exactly "drop every month folder before the cutoff month";
    the null-date partition is kept. Returns the dropped months."""
    cut = retention_cutoff(now, months).strftime("%Y-%m")
    old = [v for v in partition_values(spark, root, col) if v != NULL_PARTITION and v < cut]
    return drop_partitions(spark, root, col, old)


def delete_keys_in_table(spark: SparkSession, root: str, schema: str, keys: DataFrame,
                         key_cols: Sequence[str], part_col: str) -> int:
    """SNK5: delete the listed keys from a table partitioned by `part_col`
    (a key column). Only the partitions holding listed keys are read and
    rewritten; partitions left empty are removed. Returns rows deleted."""
    ensure_checkpoint_dir(spark)
    k = keys.select(*key_cols).distinct()
    touched = [r[0] for r in k.select(part_col).distinct().collect()]
    present = set(partition_values(spark, root, part_col))
    touched = [t for t in touched if str(t) in present]
    if not touched:
        return 0
    paths = [os.path.join(root, f"{part_col}={t}") for t in touched]
    stored = spark.read.schema(schema).option("basePath", root).parquet(*paths)
    before = stored.groupBy(part_col).agg(F.count(F.lit(1)).alias("n"))
    kept = stored.join(k, list(key_cols), "left_anti").checkpoint(eager=True)
    after = {r[0]: r[1] for r in kept.groupBy(part_col).agg(F.count(F.lit(1))).collect()}
    deleted = sum(r.n for r in before.collect()) - sum(after.values())
    (kept.hint("rebalance", part_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part_col).parquet(root))
    emptied = [str(t) for t in touched if t not in after]
    drop_partitions(spark, root, part_col, emptied)
    return deleted
