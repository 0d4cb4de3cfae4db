"""Live campaign counts (STM6) as a stateful stream with exact results.

Distinct contacts and conversations per (clinic, month) are kept in native streaming state: the keys
of a micro-batch pass `dropDuplicates`, whose RocksDB state store remembers every key that came by, and
what is new raises the counts of a streaming aggregation in update mode. With changelog
checkpointing a micro-batch writes its new keys and the counts they change, whatever the state holds
already. A re-delivered conversation adds nothing.

Changed counts are upserted, as totals, into a small table of (clinic, month, kind); a batch
that is replayed after a crash writes the same totals again.

State is partitioned by key hash: a hot clinic or month spreads over all partitions, and what
meets in its count are partial sums of new keys.
"""

from __future__ import annotations

import os
from contextlib import contextmanager
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molarflow.config import CAMPAIGN_LABEL
from molarflow.functions.misc import epoch_or_iso_to_ts
from molarflow.sinks.versioned import VersionedTable
from molarflow.streaming.ingest import checked, land, landed

COUNTS_SCHEMA = "year_month string, clinic_id string, kind string, n bigint"
PARTS = ["year_month", "clinic_id"]
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _state_store(spark: SparkSession):
    """Queries started inside keep their state in RocksDB."""
    old = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def counts_table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, os.path.join(root, "counts"), COUNTS_SCHEMA, [*PARTS, "kind"])


def campaign_keys(conversations: DataFrame, units: DataFrame, label: str = CAMPAIGN_LABEL) -> DataFrame:
    """(kind, key, year_month, clinic_id): a contact and a conversation of every tagged conversation."""
    c = (conversations.where(F.array_contains("labels", label))
         .select("account_id", F.col("id").alias("conversation"),
                 F.date_format(epoch_or_iso_to_ts("created_at"), "yyyy-MM").alias("year_month"),
                 F.coalesce(F.col("meta.sender.id"), F.col("contact_id")).alias("contact"))
         .where(F.col("year_month").isNotNull())
         .join(units.select("account_id", "clinic_id"), "account_id"))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("key")) for k in ("contact", "conversation")]))
    return c.select(*PARTS, kinds.alias("k")).select("k.kind", "k.key", *PARTS).where(F.col("key").isNotNull())


def run_counts(spark: SparkSession, base: str, conversation_schema: str, units: DataFrame, label: str = CAMPAIGN_LABEL) -> None:
    """Count every conversation landed since the last run, then stop; lines that do not parse go to quarantine."""
    rows = checked(landed(spark, os.path.join(base, "landing"), conversation_schema), conversation_schema)
    keys = campaign_keys(rows.where("NOT _bad"), units, label).dropDuplicates(["kind", "key", *PARTS])
    counts = keys.groupBy(*PARTS, "kind").agg(F.count("*").alias("n"))

    def write(batch: DataFrame, epoch_id: int) -> None:
        counts_table(spark, base).upsert(batch.checkpoint(eager=True), order=F.lit(1))

    bad = rows.where("_bad").select(F.col("_line").alias("raw_line"))
    with _state_store(spark):
        queries = [
            counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", os.path.join(base, "counts-ckpt"))
            .trigger(availableNow=True).start(),
            bad.writeStream.outputMode("append").format("json").option("path", os.path.join(base, "quarantine"))
            .option("checkpointLocation", os.path.join(base, "quarantine-ckpt")).trigger(availableNow=True).start()]
        for q in queries:
            q.awaitTermination()


def campaign_counts(spark: SparkSession, base: str, label: str = CAMPAIGN_LABEL) -> DataFrame:
    """The counts as they stand."""
    return (counts_table(spark, base).read().groupBy(*PARTS)
            .agg(F.coalesce(F.sum(F.when(F.col("kind") == "contact", F.col("n"))), F.lit(0)).alias("contacts_count"),
                 F.coalesce(F.sum(F.when(F.col("kind") == "conversation", F.col("n"))), F.lit(0)).alias("conversations_count"))
            .withColumn("campaign_tag", F.lit(label)))


def campaign_counts_ingest(spark: SparkSession, base: str, conversation_schema: str, units: DataFrame,
                           deliveries: Sequence[DataFrame], label: str = CAMPAIGN_LABEL) -> DataFrame:
    """Land each delivery of raw conversations, run the stream, return the counts table."""
    for d in deliveries:
        land(d, os.path.join(base, "landing"))
        run_counts(spark, base, conversation_schema, units, label)
    return campaign_counts(spark, base, label)
