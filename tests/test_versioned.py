"""Versioned tables: two writers, the key locator, reading through the lake surface."""

import os

from pyspark.sql import functions as F

from molarflow.sinks import versioned as V

SCHEMA = "id bigint, clinic_id string, date timestamp_ntz, amount bigint"


def _table(spark, path, **options):
    return V.VersionedTable(spark, path, SCHEMA, ["id"], "date", "clinic_id", **options)


def _rows(spark, first, n, amount=0, shift=0):
    return spark.range(first, first + n).selectExpr(
        "id", "CAST(id % 5 AS STRING) AS clinic_id",
        f"CAST(TIMESTAMP '2026-01-01' + make_dt_interval(CAST(id % 90 + {shift} AS INT)) AS TIMESTAMP_NTZ) AS date",
        f"CAST({amount} AS BIGINT) AS amount")


def _stored(table):
    return {r.id: (r.clinic_id, r.date, r.amount) for r in table.read().collect()}


def test_two_writers_lose_nothing(spark, tmp_dir, monkeypatch):
    """The second writer reads version 1, is held there, and commits after the first one."""
    path = os.path.join(tmp_dir, "t")
    first, second = _table(spark, path), _table(spark, path, slices=3)
    first.upsert(_rows(spark, 0, 100), order=F.lit(1))
    held = second.snapshot()
    seen = iter([held])
    own = second.snapshot
    monkeypatch.setattr(second, "snapshot", lambda: next(seen, None) or own())
    first.upsert(_rows(spark, 100, 100, 1), order=F.lit(1))
    second.upsert(_rows(spark, 150, 150, 2), order=F.lit(1))
    got = _stored(_table(spark, path))
    assert len(got) == 300 and [got[i][2] for i in (0, 149, 150, 299)] == [0, 1, 2, 2]
    assert first.versions() == [1, 2, 3]


def test_a_version_is_created_once(spark, tmp_dir):
    table = _table(spark, os.path.join(tmp_dir, "t"))
    table._publish(1, [])
    try:
        table._publish(1, [("rows", "x", "none", 0)])
        raise AssertionError("a second manifest of one version")
    except V.CommitConflict:
        pass
    assert table.snapshot().entries == [] and table.versions() == [1]


def test_small_batch_reads_a_part_of_the_keys(spark, tmp_dir, monkeypatch):
    table = _table(spark, os.path.join(tmp_dir, "t"), key_buckets=64)
    table.upsert(_rows(spark, 0, 5000), order=F.lit(1))
    read = []
    own = table.locator
    monkeypatch.setattr(table, "locator", lambda entries, buckets=None: read.append(
        own(entries, buckets)) or read[-1])
    before = table.snapshot()
    table.upsert(_rows(spark, 7, 10, amount=9, shift=40), order=F.lit(1))  # moved to other months
    files = [set(df.inputFiles()) for df in read]
    assert files and all(0 < len({f.rsplit("/", 2)[1] for f in fs}) <= 10 for fs in files)
    assert sum(df.count() for df in read[:1]) < 5000 / 4
    after = table.snapshot()
    kept = {e for e in before.entries if e[0] == "keys"} & set(after.entries)
    assert len(kept) >= 54
    got = _stored(table)
    assert len(got) == 5000 and sum(a == 9 for _, _, a in got.values()) == 10
    places = {r.id: (r.month, r.slice) for r in own(after.entries).collect()}
    true = {r.id: (r.month, r.slice) for r in table._load([e for e in after.entries if e[0] == "rows"]).collect()}
    assert places == true


def test_emptied_and_refilled(spark, tmp_dir):
    table = _table(spark, os.path.join(tmp_dir, "t"))
    table.upsert(_rows(spark, 0, 20), order=F.lit(1))
    table.delete(_rows(spark, 0, 20))
    assert table.read().count() == 0
    table.upsert(_rows(spark, 0, 0), order=F.lit(1))
    table.upsert(_rows(spark, 0, 3), order=F.lit(1))
    assert sorted(_stored(table)) == [0, 1, 2] and table.vacuum() > 0 and sorted(_stored(table)) == [0, 1, 2]


def test_slices_follow_the_size(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(V, "SLICE_ROWS", 100)
    monkeypatch.setattr(V, "BUCKET_KEYS", 50)
    table = _table(spark, os.path.join(tmp_dir, "t"))
    table.upsert(_rows(spark, 0, 900), order=F.lit(1))
    assert (table.slices, table.key_buckets) == (4, 18)  # 310 rows in the largest month
    before = _stored(table)
    table.reslice(slices=2)
    assert (table.slices, table.key_buckets) == (2, 18) and _stored(table) == before
    table.upsert(_rows(spark, 0, 10, amount=5, shift=70), order=F.lit(1))
    got = _stored(_table(spark, table.root))
    assert len(got) == 900 and sum(a == 5 for _, _, a in got.values()) == 10
