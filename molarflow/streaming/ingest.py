"""Incremental ingest as Structured Streaming (STM1-STM5).

The HTTP pulls of the reference end at a landing directory of JSON-lines files;
from there a file-source stream with `trigger(availableNow=True)` processes
whatever is new (the stream checkpoint remembers finished files, which is the
"resumable extract" of SRC6), and `foreachBatch` folds each micro-batch into
the stored table with the idempotent keyed upsert (SNK1). Re-delivered or
overlapping pulls (STM2) are therefore harmless: the latest batch wins.

Each micro-batch is stored once, as compressed Parquet, in the cluster's shared checkpoint folder until it is merged into a
`VersionedTable`: the (month, slice) folders it touches are written anew beside the old
ones, and a manifest commits the new version, so a crash leaves the old one.
"""

from __future__ import annotations

import datetime as dt
import os
import time
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, TimestampType

from molarflow import schemas
from molarflow.config import CAMPAIGN_LABEL
from molarflow.functions.misc import epoch_or_iso_to_ts
from molarflow.functions.text import fold_name, phone_digits
from molarflow.session import ensure_checkpoint_dir, passing
from molarflow.operators.leads import seen_ids, stale_leads
from molarflow.sinks.versioned import VersionedTable

#: Files of one micro-batch at most, so that a backlog is many bounded batches.
MAX_FILES = 1000


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def land(df: DataFrame, landing_dir: str) -> None:
    """Deliver one pull as new compressed JSON-lines files in a folder of its own, numbered by time."""
    df.write.option("compression", "gzip").json(os.path.join(landing_dir, f"pull-{time.time_ns():020d}"))


def delivery_order() -> Column:
    """Which of several rows of a key wins (largest): the later pull; inside a pull the first
    row (files by part number, then place in the file). Without a numbered pull folder the
    file's modification time stands in for the pull."""
    part = F.regexp_extract("_file", r"part-(\d+)", 1)
    return F.struct("_pull", (-F.when(part != "", part.cast("bigint")).otherwise(0)).alias("part"), (-F.col("_ord")).alias("row"))


def with_normalised(df: DataFrame) -> DataFrame:
    """The search columns of appointments, derived from the columns they normalise."""
    for source, target, fn in (("created_by_name", "created_by_name_norm", fold_name),
                               ("patient_name", "patient_name_norm", fold_name), ("phone", "phone_norm", phone_digits)):
        if target in df.columns and source in df.columns:
            df = df.withColumn(target, fn(source))
    return df


def monthly_upsert_writer(table_path: str, schema: str, keys: Sequence[str], date_col: str,
                          unit_col: str | None = "clinic_id") -> Callable[[DataFrame, int], None]:
    """foreachBatch body: upsert the batch into the versioned table at `table_path`."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        table = VersionedTable(batch.sparkSession, table_path, schema, keys, date_col, unit_col)
        table.upsert(with_normalised(batch), order=delivery_order())

    return write


#: Column (of type variant) for lines with fields outside the schema.
EXTRA = "extra"


def _raw_fields(schema: str) -> tuple[list[StructField], list[str]]:
    """Fields of a feed, and those that are time stamps: they are read as text."""
    fields = StructType.fromDDL(schema).fields
    return fields, [f.name for f in fields if isinstance(f.dataType, (TimestampType, TimestampNTZType))]


def landed(spark: SparkSession, landing_dir: str, schema: str, max_files: int = MAX_FILES) -> DataFrame:
    """The stream of landed JSON lines, as they are, with _corrupt_record, _file and _mtime.

    With a column `extra variant` in the schema, a line that has fields outside the schema is kept there whole."""
    fields, times = _raw_fields(schema)
    if any(f.name == EXTRA for f in fields):
        return _landed_with_extra(spark, landing_dir, fields, times, max_files)
    raw = StructType([StructField(f.name, StringType() if f.name in times else f.dataType) for f in fields]
                     + [StructField("_corrupt_record", StringType())])
    return (spark.readStream.schema(raw).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).json(landing_dir)
            .select("*", F.col("_metadata.file_path").alias("_file"),
                    F.col("_metadata.file_modification_time").cast("timestamp").alias("_mtime")))


def _landed_with_extra(spark: SparkSession, landing_dir: str, fields: list[StructField], times: list[str], max_files: int) -> DataFrame:
    typed = [f for f in fields if f.name != EXTRA]
    raw = StructType([StructField(f.name, StringType() if f.name in times else f.dataType) for f in typed]
                     + [StructField("_corrupt_record", StringType())])
    lines = (spark.readStream.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).text(landing_dir)
             .where(F.trim("value") != ""))
    row = F.from_json("value", raw, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    names = F.json_object_keys("value")  # skips the values
    unknown = F.size(F.array_except(names, F.array(*[F.lit(f.name) for f in typed]))) > 0
    return (lines.select(row.alias("_row"), F.when(unknown, F.try_parse_json("value")).alias(EXTRA),
                         F.col("_metadata.file_path").alias("_file"),
                         F.col("_metadata.file_modification_time").cast("timestamp").alias("_mtime"))
            .select(*[EXTRA if f.name == EXTRA else f"_row.{f.name}" for f in fields], "_row._corrupt_record", "_file", "_mtime"))


def extra_fields(rows: DataFrame, schema: str) -> DataFrame:
    """(column, filled, total): fields that came in beside the schema, and the rows that have a value there (AGG13)."""
    known = F.array(*[F.lit(f.name) for f in StructType.fromDDL(schema).fields])
    here = F.from_json(F.to_json(EXTRA), "map<string,string>")
    new = F.map_keys(F.map_filter(here, lambda k, v: v.isNotNull() & ~F.array_contains(known, k)))
    # a row counts once under the empty name, which is no field's, and once under each of its new fields
    names = F.array_append(F.coalesce(F.array_remove(new, ""), F.array().cast("array<string>")), F.lit(""))
    counts = rows.select(F.explode(names).alias("column")).groupBy("column").agg(F.count("*").alias("filled"))
    whole = Window.partitionBy(F.lit(1))  # one row per field name
    return (counts.withColumn("total", F.max(F.when(F.col("column") == "", F.col("filled"))).over(whole))
            .where("column <> ''").select("column", "filled", "total"))


def promote(rows: DataFrame, field: str, kind: str) -> DataFrame:
    """A field that came in beside the schema as a typed column; what does not fit the type is null."""
    return rows.withColumn(field, F.try_variant_get(EXTRA, f"$.{field}", kind))


def checked(rows: DataFrame, schema: str, id_col: str = "id") -> DataFrame:
    """`landed` rows with their time stamps parsed, `_bad` for a line that does not parse, has a time stamp
    that does not, or has no id, and `_line`, the raw line of such a row."""
    fields, times = _raw_fields(schema)
    parsed = {t: epoch_or_iso_to_ts(t) for t in times}
    broken = F.lit(False)
    for t in times:
        broken = broken | (F.col(t).isNotNull() & parsed[t].isNull())
    bad = F.col("_corrupt_record").isNotNull() | F.col(id_col).isNull() | broken
    line = F.coalesce("_corrupt_record", F.to_json(F.struct(*[f.name for f in fields if f.name != EXTRA])))
    return (rows.withColumn("_bad", bad).withColumn("_line", F.when(F.col("_bad"), line)).withColumns(parsed)
            .drop("_corrupt_record"))


def run_available(spark: SparkSession, landing_dir: str, schema: str, checkpoint: str,
                  body: Callable[[DataFrame, int], None], max_files: int = MAX_FILES,
                  quarantine_dir: str | None = None, id_col: str = "id") -> None:
    """Process every landed file not yet processed, at most `max_files` at a time, then stop (STM1).

    SRC2 rules: blank lines are skipped by the reader; time stamps are read as text
    (epoch, ISO, with or without a zone) and kept in UTC; a line that does not parse,
    has a time stamp that does not, or has no id, goes to `quarantine_dir` (JSON, with
    the raw line) when given, and never reaches the merge. The parsed batch is stored
    until `body` returns, which gets it with _pull, _file and _ord (see `delivery_order`)."""
    ensure_checkpoint_dir(spark)

    def split(batch: DataFrame, epoch_id: int) -> None:
        pull = F.regexp_extract("_file", r"/pull-(\d+)/", 1)
        batch = batch.withColumns({
            "_pull": F.when(pull != "", pull.cast("bigint")).otherwise(F.unix_micros("_mtime")),
            "_ord": F.monotonically_increasing_id()})
        with passing(spark) as keep:
            batch = keep(checked(batch, schema, id_col).drop("_mtime"), "batch")
            if quarantine_dir:
                (batch.where("_bad").drop("_bad", "_pull", "_ord", "_file").withColumnRenamed("_line", "raw_line")
                 .withColumn("_epoch", F.lit(epoch_id)).write.mode("append").json(quarantine_dir))
            body(batch.where("NOT _bad").drop("_bad", "_line"), epoch_id)

    q = (landed(spark, landing_dir, schema, max_files).writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def feed_ingest(spark: SparkSession, base: str, schema: str, keys: Sequence[str], date_col: str,
                deliveries: Sequence[DataFrame | Sequence[DataFrame]], unit_col: str | None = "clinic_id") -> DataFrame:
    """Land each delivery (one pull, or a backlog of several), run the stream after each one, return the stored table."""
    landing, path, ckpt = (os.path.join(base, x) for x in ("landing", "table", "stream-ckpt"))
    body = monthly_upsert_writer(path, schema, keys, date_col, unit_col)
    for d in deliveries:
        for pull in [d] if isinstance(d, DataFrame) else d:
            land(pull, landing)
        run_available(spark, landing, schema, ckpt, body, quarantine_dir=os.path.join(base, "quarantine"))
    return VersionedTable(spark, path, schema, keys, date_col, unit_col).read()


def _staged(spark: SparkSession, path: str, schema: str, keys: Sequence[str]) -> DataFrame:
    """The rows one run staged at `path`, the last delivered of each key."""
    full = StructType.fromDDL(schema + ", _pull bigint, _file string, _ord bigint")
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(full).option("recursiveFileLookup", "true").parquet(path)
    payload = [f.name for f in full.fields if f.name not in (*keys, "_pull", "_file", "_ord")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*payload), delivery_order()).alias("_last"))
    return last.select(*keys, "_last.*").select(*[f.name for f in full.fields[:-3]])


def lead_ingest(spark: SparkSession, base: str, contact_schema: str, conversation_schema: str, lead_schema: str,
                to_leads: Callable[[DataFrame, DataFrame, DataFrame], DataFrame], units: DataFrame,
                deliveries: Sequence[tuple[DataFrame, DataFrame]], run_at: Sequence[dt.datetime]
                ) -> tuple[DataFrame, DataFrame]:
    """STM3: each delivery (raw contacts, raw conversations) is landed and read by one stream per
    source into the run's staging folder; then the sources meet: leads cut at each account's stored
    watermark (FLT13), upsert (SNK1), and the state of every account (SNK7): when it ran, its
    watermark = greatest(old, seen) (AGG16), rows so far and status. Returns (leads, state).

    A run that dies is repeated whole: the streams go on after the files they finished, staging
    keeps what they wrote, and the two tables commit by version."""
    leads = VersionedTable(spark, os.path.join(base, "leads"), lead_schema, ["id", "account_id"], None, "account_id")
    state = VersionedTable(spark, os.path.join(base, "state"), schemas.LEAD_SYNC_STATE, ["account_id"])
    sources = {"contacts": contact_schema, "conversations": conversation_schema}
    for run, (delivery, now) in enumerate(zip(deliveries, run_at)):
        staged = []
        for (name, schema), df in zip(sources.items(), delivery):
            folder = os.path.join(base, name)
            stage = os.path.join(folder, "staged", f"run-{run}")

            def body(batch: DataFrame, epoch_id: int, stage=stage) -> None:
                batch.write.mode("overwrite").parquet(os.path.join(stage, f"epoch-{epoch_id}"))

            land(df, os.path.join(folder, "landing"))
            run_available(spark, os.path.join(folder, "landing"), schema, os.path.join(folder, "stream-ckpt"), body,
                          quarantine_dir=os.path.join(folder, "quarantine"))
            staged.append(_staged(spark, stage, schema, ["account_id", "id"]))
        before = state.read()
        new = to_leads(*staged, before).checkpoint(eager=True)
        leads.upsert(new, order=F.col("source"))
        seen = new.groupBy("account_id").agg(F.max("last_activity_at").alias("_seen"), F.count("*").alias("_rows"))
        now_col = F.lit(now).cast("timestamp_ntz")
        state.upsert(
            units.where("account_id IS NOT NULL").groupBy("account_id").agg(F.min("clinic_id").alias("_clinic"))
            .join(before, "account_id", "left").join(seen, "account_id", "left")
            .select("account_id", F.col("_clinic").alias("erp_clinic_id"), now_col.alias("last_synced_at"),
                    F.greatest("last_activity_seen", "_seen").alias("last_activity_seen"),
                    (F.coalesce("rows_synced_total", F.lit(0)) + F.coalesce("_rows", F.lit(0))).alias("rows_synced_total"),
                    F.lit("ok").alias("last_run_status"), F.lit(None).cast("string").alias("last_run_error"),
                    "full_refresh_at"), order=F.lit(1))
    return leads.read(), state.read()


def full_refresh(spark: SparkSession, leads: VersionedTable, union: DataFrame, failed_accounts: DataFrame | None = None,
                 label: str = CAMPAIGN_LABEL) -> None:
    """STM4 as a job that writes: upsert everything seen, then delete the tagged leads that
    were not seen, except of accounts with nothing seen or with a failed source."""
    union = union.checkpoint(eager=True)
    leads.upsert(union, order=F.col("source"), preserve=["created_at_cw"])
    leads.delete(stale_leads(leads.read(), seen_ids(union), failed_accounts, label))


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for one ingest run."""
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return os.path.join(ensure_checkpoint_dir(spark), "ingest", f"{name}-{stamp}-{os.getpid()}")
