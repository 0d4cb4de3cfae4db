"""Helpers the corpus operators share: tables, free column names, stored intermediates."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from molarflow.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """`base`, with underscores appended until no column of `df` has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that helper columns beside it cannot clash with any."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for one intermediate table, in the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as compressed Parquet in the shared folder and read back:
    cuts the lineage, survives lost executors, and later reads prune columns."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Plan nodes over which rows come in the same order whichever columns are read.
ROWWISE = {"Relation", "LogicalRDD", "LocalRelation", "Project", "Filter"}


def stable_rows(df: DataFrame, name: str) -> DataFrame:
    """`df`, stored first unless it only scans stored or local rows.

    Operators number rows with monotonically_increasing_id in more than one branch of a plan.
    Over a scan the numbers agree; over a shuffle they may not, as its order depends on the
    columns that are left after pruning."""
    tree = df._jdf.queryExecution().optimizedPlan().toString()
    nodes = {re.sub(r"^[\s:+-]*", "", line).split(" ")[0] for line in tree.splitlines() if line.strip()}
    return df if nodes <= ROWWISE and "rand" not in tree else stored(df, name)


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` in a reliable checkpoint of the shared folder; for narrow rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_bucket(col: str | Column, n: int) -> Column:
    """crc32 of the column's text modulo n; null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(c.cast("string").cast("binary")) % n
