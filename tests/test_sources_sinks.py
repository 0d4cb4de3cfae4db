"""Feed tables, per-unit JSONL sink, work lists, id coercion and lookback bounds."""

import datetime as dt
import os

from pyspark.sql import functions as F

from molarflow.functions.misc import lookback_bound
from molarflow.operators.leads import numeric_ids
from molarflow.sinks.merge import state_listing
from molarflow.sources import tables, testdata
from molarflow.sources.jsonl import write_units

from paths import SF_SMALL


def test_read_feed_month_partitions(spark, tmp_dir):
    pays = testdata.payments(spark, SF_SMALL).withColumn("month", F.date_format("date", "yyyy-MM"))
    pays.write.partitionBy("month").parquet(os.path.join(tmp_dir, "payments"))
    df = tables.read_feed(spark, tmp_dir, "payments").where(F.col("month") == "1998-01")
    assert df.count() == pays.where(F.col("month") == "1998-01").count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_unknown_table_rejected(spark):
    import pytest
    with pytest.raises(tables.UnknownTable):
        tables.scan({"a": spark.range(1)}, "b")


def test_write_units_replaces_only_its_unit(spark, tmp_dir):
    root = os.path.join(tmp_dir, "land")
    df = spark.createDataFrame([("payments", "1", "p1", 1), ("payments", "2", "p1", 2)],
                               "feed string, clinic_id string, period string, v int")
    write_units(df, root)
    write_units(spark.createDataFrame([("payments", "1", "p1", 9)], df.schema), root)
    got = sorted((r.clinic_id, r.v) for r in spark.read.schema(df.schema).json(root).collect())
    assert got == [("1", 9), ("2", 2)]


def test_work_list_periods(spark):
    units = spark.createDataFrame([("1", "a", "X", 1), (None, "b", "X", 2)],
                                  "clinic_id string, name string, regional string, account_id bigint")
    w = tables.work_list(units, ["appointments", "payments"], dt.datetime(2026, 4, 1), dt.datetime(2026, 5, 1), 15)
    rows = sorted((r.feed, r.period_start, r.period_end) for r in w.collect())
    assert len(rows) == 4
    assert rows[0][1:] == (dt.datetime(2026, 4, 1), dt.datetime(2026, 4, 16))
    assert rows[1][1:] == (dt.datetime(2026, 4, 16), dt.datetime(2026, 5, 1))
    done = spark.createDataFrame([("payments", "1", dt.datetime(2026, 4, 1))],
                                 "feed string, clinic_id string, period_start timestamp_ntz")
    assert tables.pending_work(w, done).count() == 3
    assert tables.nightly_window(dt.date(2026, 5, 3)) == (dt.date(2026, 5, 1), dt.date(2026, 5, 3))
    assert tables.nightly_window(dt.date(2026, 5, 31)) == (dt.date(2026, 5, 2), dt.date(2026, 5, 31))


def test_numeric_ids_and_lookback(spark):
    df = spark.createDataFrame([("12",), ("x1",), (None,), ("007",)], "id string")
    assert sorted(r.id for r in numeric_ids(df).collect()) == [7, 12]
    now = dt.datetime(2026, 5, 10, 12)
    assert lookback_bound(now, 36) == dt.datetime(2026, 5, 9, 0)
    assert lookback_bound(now, 24 * 30) == now - dt.timedelta(days=6)


def test_state_listing_order(spark):
    st = spark.createDataFrame([("a", "1", 5), ("b", "1", 9), ("c", "2", None)],
                               "feed string, clinic_id string, rows_synced_total long")
    assert [r.feed for r in state_listing(st, 2).collect()] == ["c", "b"]


def test_apply_retention_drops_whole_months(spark, tmp_dir):
    from molarflow.sinks.files import apply_retention, partition_values
    df = spark.createDataFrame([(1, dt.datetime(2026, 3, 1)), (2, dt.datetime(2026, 2, 28, 23, 59, 59)),
                                (3, None), (4, dt.datetime(2026, 5, 2))], "id long, d timestamp_ntz")
    root = os.path.join(tmp_dir, "t")
    df.withColumn("month", F.date_format("d", "yyyy-MM")).write.partitionBy("month").parquet(root)
    dropped = apply_retention(spark, root, dt.datetime(2026, 5, 20))
    assert dropped == ["2026-02"]
    left = sorted(r.id for r in spark.read.schema("id long, d timestamp_ntz, month string").parquet(root).collect())
    assert left == [1, 3, 4]
    assert "2026-02" not in partition_values(spark, root, "month")


def test_delete_keys_rewrites_and_drops_emptied(spark, tmp_dir):
    from molarflow.sinks.files import delete_keys_in_table, partition_values
    schema = "id long, name string, account_id long"
    root = os.path.join(tmp_dir, "leads")
    spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 3)], schema) \
        .write.partitionBy("account_id").parquet(root)
    keys = spark.createDataFrame([(1, 1), (2, 3), (3, 2), (9, 9)], "account_id long, id long")
    n = delete_keys_in_table(spark, root, schema, keys, ["account_id", "id"], "account_id")
    assert n == 2
    left = sorted((r.account_id, r.id) for r in spark.read.schema(schema).parquet(root).collect())
    assert left == [(1, 2), (3, 4)]
    assert partition_values(spark, root, "account_id") == ["1", "3"]


def test_backfill_skips_done_units(spark, tmp_dir):
    from molarflow.sources.backfill import land_backfill
    rows = spark.createDataFrame([(1, "1", dt.datetime(2026, 4, 2)), (2, "1", dt.datetime(2026, 4, 20)),
                                  (3, "2", dt.datetime(2026, 4, 3))], "id long, clinic_id string, ts timestamp_ntz")
    root = os.path.join(tmp_dir, "bf")
    land_backfill({"f": (rows.where(F.col("id") != 2), "ts")}, dt.datetime(2026, 4, 1), dt.datetime(2026, 5, 1), root)
    done = spark.createDataFrame([("f", "1", "20260401")], "feed string, clinic_id string, period string")
    # unit (1, 20260401) is done: pass 2 must not rewrite it, even though its rows changed
    changed = rows.withColumn("id", F.col("id") + 100)
    land_backfill({"f": (changed, "ts")}, dt.datetime(2026, 4, 1), dt.datetime(2026, 5, 1), root, done=done)
    got = sorted((r.clinic_id, r.period, r.id) for r in
                 spark.read.schema("id long, ts timestamp_ntz, clinic_id string, period string")
                 .json(os.path.join(root, "f")).collect())
    assert got == [("1", "20260401", 1), ("1", "20260416", 102), ("2", "20260401", 103)]


def test_cluster_profile_keys_are_valid_sql_confs(spark):
    from molarflow.session import CLUSTER_CONF
    saved = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        for k, v in CLUSTER_CONF.items():
            spark.conf.set(k, v)          # raises for unknown / non-modifiable keys
            assert spark.conf.get(k) is not None
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
