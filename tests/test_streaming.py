"""Stream = batch: the landing split into k deliveries gives the table one batch gives."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from molarflow import schemas
from molarflow.sinks.merge import upsert
from molarflow.sinks.versioned import VersionedTable
from molarflow.sources import testdata
from molarflow.streaming import ingest

from paths import SF_SMALL


def _canon(df):
    return sorted(tuple(r) for r in df.select("id", "clinic_id", "date", "amount", "is_confirmed").collect())


def test_stream_equals_batch(spark, tmp_dir):
    pays = testdata.payments(spark, SF_SMALL).dropDuplicates(["id"])
    k = 4
    parts = [pays.where(F.abs(F.hash("id")) % k == i) for i in range(k)]
    streamed = ingest.feed_ingest(spark, os.path.join(tmp_dir, "k"), schemas.PAYMENTS, ["id"], "date", parts)
    one = ingest.feed_ingest(spark, os.path.join(tmp_dir, "one"), schemas.PAYMENTS, ["id"], "date", [pays])
    batch = upsert(spark.createDataFrame([], schemas.PAYMENTS), pays, ["id"])
    assert _canon(streamed) == _canon(one) == _canon(batch)


def test_redelivery_is_idempotent_and_last_wins(spark, tmp_dir):
    pays = testdata.payments(spark, SF_SMALL).dropDuplicates(["id"]).limit(200)
    flipped = pays.withColumn("is_confirmed", ~F.col("is_confirmed"))
    out = ingest.feed_ingest(spark, tmp_dir, schemas.PAYMENTS, ["id"], "date", [pays, pays, flipped])
    assert out.count() == 200
    assert _canon(out) == _canon(flipped)


def test_malformed_landing_lines_are_quarantined(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "part-0.json"), "w") as f:
        f.write('{"id": "a", "patient_id": 1, "clinic_id": "1", "date": "2026-04-01T00:00:00", "amount": 1.5, '
                '"is_confirmed": true}\n\nnot json\n{"patient_id": 2, "clinic_id": "1"}\n')
    table, quarantine = os.path.join(tmp_dir, "table"), os.path.join(tmp_dir, "quarantine")
    body = ingest.monthly_upsert_writer(table, schemas.PAYMENTS, ["id"], "date")
    ingest.run_available(spark, landing, schemas.PAYMENTS, os.path.join(tmp_dir, "ckpt"), body,
                         quarantine_dir=quarantine)
    assert [r.id for r in _table(spark, table).read().collect()] == ["a"]
    bad = spark.read.json(quarantine).collect()
    assert len(bad) == 2 and any(r.raw_line == "not json" for r in bad)


def _table(spark, path):
    return VersionedTable(spark, path, schemas.PAYMENTS, ["id"], "date", "clinic_id")


def _pay(spark, *rows):
    return spark.createDataFrame([(i, c, d, float(a)) for i, c, d, a in rows], "id string, clinic_id string, date string, amount double")


def _stored(df):
    return {r.id: (r.clinic_id, str(r.date)[:10] if r.date else None, float(r.amount)) for r in df.collect()}


def test_null_dates_stay_and_moved_keys_are_stored_once(spark, tmp_dir):
    out = ingest.feed_ingest(spark, tmp_dir, schemas.PAYMENTS, ["id"], "date", [
        _pay(spark, ("n1", "1", None, 1), ("n2", None, None, 2), ("x", "1", "2026-04-30", 3), ("y", "1", "2026-04-30T10:00:00Z", 4)),
        _pay(spark, ("n3", "1", None, 5), ("x", "1", "2026-05-04", 6), ("y", "2", "2026-04-30T10:00:00-03:00", 7))])
    assert out.count() == 5
    assert _stored(out) == {"n1": ("1", None, 1.0), "n2": (None, None, 2.0), "n3": ("1", None, 5.0),
                            "x": ("1", "2026-05-04", 6.0), "y": ("2", "2026-04-30", 7.0)}


def test_backlog_keeps_the_later_pull_and_the_first_row_of_a_pull(spark, tmp_dir):
    out = ingest.feed_ingest(spark, tmp_dir, schemas.PAYMENTS, ["id"], "date", [[
        _pay(spark, ("a", "1", "2026-04-01", 1)).coalesce(1),
        _pay(spark, ("a", "1", "2026-04-02", 2), ("a", "1", "2026-04-03", 3)).coalesce(1)]])
    assert _stored(out) == {"a": ("1", "2026-04-02", 2.0)}


def test_unparsable_time_goes_to_quarantine(spark, tmp_dir):
    out = ingest.feed_ingest(spark, tmp_dir, schemas.PAYMENTS, ["id"], "date",
                             [_pay(spark, ("a", "1", "2026-04-01T00:00:00+02:00", 1), ("b", "1", "yesterday", 2), ("c", "1", "1704067200", 3))])
    assert _stored(out) == {"a": ("1", "2026-03-31", 1.0), "c": ("1", "2024-01-01", 3.0)}
    assert spark.read.json(os.path.join(tmp_dir, "quarantine")).count() == 1


def test_crash_before_the_commit_leaves_the_old_version(spark, tmp_dir, monkeypatch):
    ingest.feed_ingest(spark, tmp_dir, schemas.PAYMENTS, ["id"], "date", [_pay(spark, ("a", "1", "2026-04-01", 1), ("b", "1", "2026-04-02", 1))])
    table = _table(spark, os.path.join(tmp_dir, "table"))
    ingest.land(_pay(spark, ("a", "2", "2026-05-01", 9)), os.path.join(tmp_dir, "landing"))
    body = ingest.monthly_upsert_writer(table.root, schemas.PAYMENTS, ["id"], "date")

    def crash(self, kept, rows):
        self._placed(rows).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("month", "slice") \
            .parquet(f"{self.root}/data/v=2")
        raise RuntimeError("lost")

    run = lambda: ingest.run_available(spark, os.path.join(tmp_dir, "landing"), schemas.PAYMENTS,
                                       os.path.join(tmp_dir, "stream-ckpt"), body)
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", crash)
        with pytest.raises(Exception):
            run()
    assert _stored(table.read()) == {"a": ("1", "2026-04-01", 1.0), "b": ("1", "2026-04-02", 1.0)}
    run()
    assert _stored(table.read()) == {"a": ("2", "2026-05-01", 9.0), "b": ("1", "2026-04-02", 1.0)}


def test_retention_deletes_and_vacuum(spark, tmp_dir):
    table = _table(spark, os.path.join(tmp_dir, "t"))
    pays = testdata.payments(spark, SF_SMALL).dropDuplicates(["id"]).orderBy("id").limit(50)
    table.upsert(pays, order=F.lit(1))
    table.upsert(pays.withColumn("date", F.lit(dt.datetime(2026, 1, 5)).cast("timestamp_ntz")), order=F.lit(1))
    table.upsert(pays.orderBy("id").limit(1).withColumns({"id": F.lit("none"), "date": F.lit(None).cast("timestamp_ntz")}), order=F.lit(1))
    assert table.read().count() == 51
    table.retain(dt.datetime(2026, 5, 1))
    assert [r.id for r in table.read().collect()] == ["none"]
    assert table.vacuum() > 0 and [r.id for r in table.read().collect()] == ["none"]
    table.delete(spark.createDataFrame([("none",)], "id string"))
    assert table.read().count() == 0


def test_first_pull_is_written_by_all_tasks(spark, tmp_dir):
    """A row comes before its copy in one part file, and the pull has many part files."""
    from molarflow.plans.q_stream import _with_copies
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _with_copies(spark.range(400).selectExpr("id", "CAST(id % 7 AS INT) AS status")).write.json(f"{tmp_dir}/pull")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = {}
    for r in spark.read.json(f"{tmp_dir}/pull").selectExpr("id", "status", "_metadata.file_name AS f",
                                                           "monotonically_increasing_id() AS n").orderBy("n").collect():
        files.setdefault(r.f, []).append((r.id, r.status))
    assert len(files) > 1 and sum(map(len, files.values())) == 500
    seen = {}
    for rows in files.values():
        here = {}
        for i, status in rows:
            here.setdefault(i, []).append(status)
        assert not here.keys() & seen.keys()
        seen |= here
    assert all(seen[i] == ([i % 7, 99] if i % 4 == 0 else [i % 7]) for i in range(400))
