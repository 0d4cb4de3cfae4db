"""Joins of stored keys are broadcast by their number of rows: their compressed files say little about it."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from molarflow.session import BROADCAST_ROWS
from molarflow.sinks.versioned import VersionedTable
from molarflow.streaming.snapshots import LiveSnapshots

N = 4 * BROADCAST_ROWS


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def plans(monkeypatch):
    """Plans of all that is written or collected."""
    seen = []
    own = DataFrame.collect, DataFrame.write.fget
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(_plan(self)) or own[0](self))
    monkeypatch.setattr(DataFrame, "write", property(lambda self: seen.append(_plan(self)) or own[1](self)))
    return seen


def test_many_keys_in_small_files_are_not_broadcast(spark, tmp_dir, plans):
    table = VersionedTable(spark, os.path.join(tmp_dir, "t"), "id bigint, unit bigint, a int", ["id"], None, "unit")
    rows = spark.range(N).withColumns({"unit": F.col("id"), "a": F.lit(1)})
    table.upsert(rows)
    path = f"{tmp_dir}/keys"
    rows.select("id", "unit").coalesce(1).write.option("compression", "zstd").parquet(path)
    assert sum(f.stat().st_size for f in os.scandir(path)) < 10 << 20  # below Spark's own limit
    keys = spark.read.schema("id bigint, unit bigint").parquet(path)
    plans.clear()
    assert "SortMergeJoin" in _plan(table.rows_of(keys)) and "SortMergeJoin" in _plan(table.rows_of_units(keys))
    table.upsert(keys.withColumn("a", F.lit(2)))
    table.delete(keys.where("id % 2 = 0"))
    assert plans and not any("BroadcastHashJoin" in p or "BroadcastExchange" in p for p in plans)
    assert table.read().agg(F.count("*"), F.sum("a"), F.min("id")).first() == (N // 2, N, 1)
    assert "BroadcastHashJoin" in _plan(table.rows_of(keys.where("id < 10")))
    assert table.rows_of(keys.where("id < 10")).count() == 5


def test_live_snapshots_of_many_patients_are_not_broadcast(spark, tmp_dir, plans):
    live = LiveSnapshots(spark, os.path.join(tmp_dir, "live"))
    visits = spark.range(N).select(
        "id", F.col("id").alias("patient_id"), F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz").alias("start_time"), F.lit(7).alias("status"),
        F.lit("eval").alias("speciality_id"), F.lit("mc_channel").alias("channel_id"), F.lit("x").alias("campaign_token"))
    logs = spark.range(N).select(F.concat(F.lit("l"), "id").alias("id"), F.col("id").alias("appointment_id"), F.lit("mc").alias("user_id"))
    live.appointments_changed(visits.limit(0), visits)
    live.logs_changed(logs.limit(0), logs)
    live.appointments_changed(visits, visits.where("id % 2 = 0"))
    assert plans and not any("BroadcastHashJoin" in p or "BroadcastExchange" in p for p in plans)
    found = live.read()
    assert found.patient_origin.count() == found.agent_evaluations.count() == N // 2
