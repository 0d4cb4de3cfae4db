"""Merge, partial merge, reconcile, retention and JSONL edge rows (SNK1-7, JOI9, SRC2)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from molarflow.operators import leads as ld
from molarflow.sinks import merge
from molarflow.sources.jsonl import read_jsonl

D = dt.datetime


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_order_rules(spark):
    stored = spark.createDataFrame([(1, "old1", "keep"), (2, "old2", "keep2")], "id long, v string, w string")
    batch = spark.createDataFrame([
        (1, "b1-first", None, 5, 0), (1, "b1-second", None, 5, 1),   # same batch: first wins
        (2, "b5", "x", 5, 0), (2, "b6", "y", 6, 0),                   # later batch wins
        (3, "new", None, 5, 0), (None, "nokey", None, 5, 0),          # insert; null key dropped
    ], "id long, v string, w string, b long, o long")
    out = merge.upsert(stored, batch, ["id"], batch_col="b", ordinal_col="o")
    assert _rows(out, "id", "v", "w") == [(1, "b1-first", None), (2, "b6", "y"), (3, "new", None)]


def test_upsert_missing_column_and_preserve(spark):
    stored = spark.createDataFrame([(1, "a", D(2026, 4, 1))], "id long, v string, created timestamp_ntz")
    batch = spark.createDataFrame([(1, "b", D(2026, 5, 1)), (2, "c", D(2026, 5, 2))],
                                  "id long, v string, created timestamp_ntz")
    out = merge.upsert(stored, batch, ["id"], preserve=["created"])
    assert _rows(out, "id", "v", "created") == [(1, "b", D(2026, 4, 1)), (2, "c", D(2026, 5, 2))]
    # a batch without a column writes null there (whole-row overwrite of the live path)
    out2 = merge.upsert(stored, batch.select("id", "v"), ["id"])
    assert _rows(out2, "id", "v", "created") == [(1, "b", None), (2, "c", None)]


def test_upsert_idempotent(spark):
    stored = spark.createDataFrame([(1, "a")], "id long, v string")
    batch = spark.createDataFrame([(1, "b"), (2, "c")], "id long, v string")
    once = merge.upsert(stored, batch, ["id"])
    twice = merge.upsert(once, batch, ["id"])
    assert _rows(once, "id", "v") == _rows(twice, "id", "v")


def test_partial_merge_provided_columns(spark):
    stored = spark.createDataFrame([("f", "1", "ok", "old err", 10)],
                                   "feed string, clinic_id string, status string, err string, total long")
    batch = spark.createDataFrame([("f", "1", "error", None, 99, ["status", "err"]),
                                   ("f", "2", "ok", None, 5, ["status", "err", "total"])],
                                  "feed string, clinic_id string, status string, err string, total long, "
                                  "_provided array<string>")
    out = merge.partial_merge(stored, batch, ["feed", "clinic_id"])
    # explicit null err overwrites; total not provided keeps 10
    assert _rows(out, "clinic_id", "status", "err", "total") == [("1", "error", None, 10), ("2", "ok", None, 5)]


def test_sync_state_merge(spark):
    state = spark.createDataFrame([("p", "1", D(2026, 4, 1), D(2026, 4, 1), "ok", None, 10),
                                   ("p", "2", D(2026, 4, 1), D(2026, 4, 1), "ok", None, 7)],
                                  "feed string, clinic_id string, last_updated_at timestamp_ntz, "
                                  "last_run_at timestamp_ntz, last_run_status string, last_run_error string, "
                                  "rows_synced_total long")
    run = spark.createDataFrame([("p", "1", 3, D(2026, 4, 3), None), ("p", "2", 4, D(2026, 4, 4), "e" * 700)],
                                "feed string, clinic_id string, rows long, max_updated_at timestamp_ntz, error string")
    out = {r.clinic_id: r for r in merge.sync_state_merge(state, run, D(2026, 4, 5)).collect()}
    assert out["1"].rows_synced_total == 13 and out["1"].last_updated_at == D(2026, 4, 3)
    assert out["2"].rows_synced_total == 7 and out["2"].last_updated_at == D(2026, 4, 1)
    assert out["2"].last_run_status == "error" and len(out["2"].last_run_error) == 500


def test_retention_boundaries(spark):
    now = D(2026, 5, 20, 10, 0)
    assert merge.retention_cutoff(now) == D(2026, 3, 1)
    assert merge.retention_cutoff(D(2026, 1, 5)) == D(2025, 11, 1)
    df = spark.createDataFrame([(1, D(2026, 3, 1)), (2, D(2026, 2, 28, 23, 59, 59)), (3, None)],
                               "id long, d timestamp_ntz")
    assert _rows(merge.retention_keep(df, "d", now), "id") == [(1,), (3,)]


def _leads(spark, rows):
    return spark.createDataFrame(rows, "account_id long, id long, labels array<string>")


def test_reconcile_guards(spark):
    stored = _leads(spark, [(1, 10, ["campanha"]), (1, 11, ["campanha"]), (2, 20, ["campanha"]),
                            (3, 30, ["campanha"]), (1, 12, ["other"])])
    seen = spark.createDataFrame([(1, 10), (3, 30)], "account_id long, id long")
    stale = ld.stale_leads(stored, seen)
    assert _rows(stale, "account_id", "id") == [(1, 11)]        # account 2 saw nothing: untouched
    failed = spark.createDataFrame([(1,)], "account_id long")
    assert ld.stale_leads(stored, seen, failed).count() == 0    # a failed source deletes nothing
    empty = spark.createDataFrame([], "account_id long, id long")
    assert ld.stale_leads(stored, empty).count() == 0           # nothing seen: no delete
    kept = ld.delete_keys(stored, stale)
    assert kept.count() == 4


def test_watermark_cut_strict(spark):
    from molarflow.operators.filters import watermark_cut
    df = spark.createDataFrame([(1, D(2026, 4, 1)), (2, D(2026, 4, 2)), (3, None)], "id long, t timestamp_ntz")
    assert _rows(df.where(watermark_cut(D(2026, 4, 1), "t")), "id") == [(2,)]


def test_jsonl_quarantine(spark, tmp_dir):
    path = os.path.join(tmp_dir, "contacts.jsonl")
    with open(path, "w") as f:
        f.write('{"id": 1, "name": "a"}\n\n{"id": 2, "name": \n{"name": "no id"}\n{"id": 3, "name": "c"}\n')
    good, bad = read_jsonl(spark, path, "id long, name string")
    assert _rows(good, "id") == [(1,), (3,)]
    assert bad.count() == 2
