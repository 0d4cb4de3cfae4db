"""What a merge writes: rows dealt once by folder, places appended, compressed pulls, one upsert a run."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from molarflow.sinks import versioned as V
from molarflow.streaming import ingest
from molarflow.streaming.pull import WatermarkPull

SCHEMA = "id bigint, clinic_id string, date timestamp_ntz, amount bigint"


def _rows(spark, *rows):
    return spark.createDataFrame([(i, c, dt.datetime(2026, m, 1), a, o) for i, c, m, a, o in rows], SCHEMA + ", o int")


def test_keys_that_move_and_come_twice_in_large_folders(spark, tmp_dir, monkeypatch):
    """Folders in parts, keys with several places in one batch, and buckets written as one now and then."""
    monkeypatch.setattr(V, "SLICE_ROWS", 7)
    monkeypatch.setattr(V, "MAX_PIECES", 2)
    table, want = V.VersionedTable(spark, os.path.join(tmp_dir, "t"), SCHEMA, ["id"], "date", "clinic_id", slices=2), {}
    for step in range(4):
        batch = [(i, str(i % 3), 1 + (i + step) % 2, step, 1) for i in range(step, 40, step + 1)]
        batch += [(i, str(i % 3), 1 + (i + step) % 4, 10 + step, 2) for i in range(0, 40, 5)]
        table.upsert(_rows(spark, *batch), order=F.col("o"))
        for i, c, m, a, _ in batch:
            want[i] = (c, m, a)
        places = [e for e in table.snapshot().entries if e[0] == V.KEYS]
        assert max(sum(e[3] == b for e in places) for b in {e[3] for e in places}) <= 2
    table.delete(_rows(spark, (3, "0", 1, 0, 0)))
    del want[3]
    got = table.read().collect()
    assert len(got) == len(want) and {r.id: (r.clinic_id, r.date.month, r.amount) for r in got} == want
    entries = table.snapshot().entries
    at = {(r.id, r.month, r.slice) for r in table.locator(entries).collect()}
    assert at == {(r.id, r.month, r.slice) for r in table._load([e for e in entries if e[0] == V.ROWS]).collect()}


def test_an_upsert_appends_the_places_of_its_keys(spark, tmp_dir):
    table = V.VersionedTable(spark, os.path.join(tmp_dir, "t"), SCHEMA, ["id"], "date", "clinic_id", key_buckets=1)
    table.upsert(_rows(spark, *[(i, "1", 1, 0, 0) for i in range(50)]), order=F.lit(1))
    before = {e for e in table.snapshot().entries if e[0] == V.KEYS}
    table.upsert(_rows(spark, (7, "1", 2, 1, 0)), order=F.lit(1))
    after = {e for e in table.snapshot().entries if e[0] == V.KEYS}
    assert before < after and table.locator(list(after - before)).count() == 1


def test_pulls_are_compressed_and_batches_go_after_the_merge(spark, tmp_dir):
    kept = os.path.join(spark.conf.get("spark.checkpoint.dir"), "stored", "*")
    rows = _rows(spark, (1, "1", 1, 5, 0), (2, "2", 2, 6, 0)).drop("o")
    before = set(glob.glob(kept))
    assert ingest.feed_ingest(spark, tmp_dir, SCHEMA, ["id"], "date", [rows, rows]).count() == 2
    files = glob.glob(f"{tmp_dir}/landing/*/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    assert set(glob.glob(kept)) == before


def test_a_run_upserts_its_pages_once(spark, tmp_dir):
    path = f"{tmp_dir}/feed"
    day = dt.datetime(2026, 5, 9)
    rows = spark.range(12).selectExpr("id", "'1' AS clinic_id", "id AS amount").withColumn("date", F.lit(day).cast("timestamp_ntz"))
    rows.withColumn("updated_at", F.col("date")).write.parquet(path)
    pull = WatermarkPull(spark, f"{tmp_dir}/p", "feed", SCHEMA + ", updated_at timestamp_ntz", ["id"], "date", f"{tmp_dir}/state", page_rows=4)
    assert pull.run(spark.read.parquet(path), spark.createDataFrame([("1",)], "clinic_id string"), day + dt.timedelta(hours=1)) == 3
    assert pull.table.read().count() == 12 and pull.table.versions() == [1]
    assert not os.path.exists(f"{tmp_dir}/p/runs/000000/staged")
