"""Trigram search, mergeable sketches and fields outside the schema."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from molarflow import schemas
from molarflow.operators import sketches
from molarflow.operators.filters import search_filter
from molarflow.operators.search_index import SearchIndex, grams_of, search_patterns
from molarflow.streaming import ingest

SCHEMA = "id bigint, patient_name_norm string, phone_norm string"


def _people(spark, n=400):
    r = random.Random(5)
    names = ["joao silva", "maria souza", "ana", "jo", "", None, "joao  duplo", "zé 100%", "a_b c"]
    rows = [(i, r.choice(names), r.choice([None, "12", f"119{r.randrange(10**8):08}", f"5511{r.randrange(10**8):08}", "1187654321"])) for i in range(n)]
    rows += [(1000, "rara pessoa", "11987654321"), (1001, "outra rara", "551187654321")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("raw", ["rara", "  RÁRA (pessoa)", "11 98765-4321", "(11) 8765-4321", "551187654321", "jo", "", "joao", "100%", "a_b",
                                 "nobody here", "12", "98765", "rara 4321"])
def test_same_rows_as_the_scan(spark, tmp_dir, raw):
    df = _people(spark)
    index = SearchIndex(spark, os.path.join(tmp_dir, "i"), buckets=4)
    index.add(df.where("id < 1000"))
    index.add(df.where("id >= 1000"))
    wanted = search_filter(raw)
    want = df if wanted is None else df.where(wanted)
    assert sorted(r.id for r in index.search(df, raw).collect()) == sorted(r.id for r in want.collect())


def test_rare_texts_use_the_index_and_others_the_scan(spark, tmp_dir):
    df = _people(spark)
    index = SearchIndex(spark, os.path.join(tmp_dir, "i"))
    assert index.candidates("rara") is None  # nothing indexed yet
    index.add(df)
    assert sorted(r.id for r in index.candidates("rara pessoa").collect()) == [1000]
    assert index.candidates("jo") is None and index.candidates("joao") is None
    assert index.candidates("nobody").count() == 0
    assert grams_of("abab") == ["aba", "bab"]
    assert search_patterns("11 8765-4321") == [("patient_name_norm", "11 8765-4321"), ("phone_norm", "1187654321"), ("phone_norm", "11987654321")]


def test_changed_rows_are_found_and_old_entries_do_no_harm(spark, tmp_dir):
    df = _people(spark)
    index = SearchIndex(spark, os.path.join(tmp_dir, "i"))
    index.add(df)
    after = df.withColumn("patient_name_norm", F.when(F.col("id") == 1000, F.lit("nova alcunha")).otherwise(F.col("patient_name_norm")))
    index.add(after.where("id = 1000"))
    assert [r.id for r in index.search(after, "alcunha").collect()] == [1000]
    assert index.candidates("rara pessoa").count() == 1 and index.search(after, "rara pessoa").count() == 0
    index.rebuild(after)
    assert len(index._segments()) == 1 and index.candidates("rara pessoa").count() == 0
    plan = index.candidates("alcunha")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan


def test_sketch_error_and_merging(spark):
    start = dt.date(2026, 1, 1)
    rows = spark.range(60000).selectExpr("id % 20011 AS who", "CAST(id % 3 AS STRING) AS clinic",
                                         "CAST(DATE'2026-01-01' + CAST(id % 90 AS INT) AS TIMESTAMP_NTZ) AS at")
    daily = sketches.daily_sketches(rows, "who", "at", "clinic")
    assert daily.count() == 90
    for days, dims in ((90, ["clinic"]), (30, ["clinic"]), (90, []), (1, [])):
        inside = rows.where(F.col("at") < F.lit(start + dt.timedelta(days=days)).cast("timestamp_ntz"))
        exact = {tuple(r[:-2]): (r.d, r.n) for r in inside.groupBy(*dims).agg(F.count_distinct("who").alias("d"), F.count("*").alias("n")).collect()}
        got = sketches.distinct_in_period(daily, start, start + dt.timedelta(days=days), *dims).collect()
        assert len(got) == len(exact)
        for r in got:
            d, n = exact[tuple(r[:-2])]
            assert r.n == n and abs(r.distinct_estimate - d) <= max(1, d * sketches.MAX_ERROR)
    twice = sketches.merged(sketches.merged(daily, "clinic", "day"), "clinic").select(F.hll_sketch_estimate("sketch")).collect()
    assert sorted(twice) == sorted(sketches.merged(daily, "clinic").select(F.hll_sketch_estimate("sketch")).collect())


def test_fields_outside_the_schema_are_kept(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing", "pull-1")
    os.makedirs(landing)
    row = {"id": "a", "patient_id": 1, "clinic_id": "1", "date": "2026-04-01T00:00:00", "amount": 1.5, "is_confirmed": True}
    lines = [row, row | {"id": "b", "tip": 2.5, "deep": {"x": [1, 2]}}, row | {"id": "c", "tip": None}, row | {"id": "d", "tip": "no number"},
             row | {"id": None, "tip": 1}]
    with open(os.path.join(landing, "part-00000.json"), "w") as f:
        f.write("\n".join(map(json.dumps, lines)) + "\n\nnot json\n")
    schema = schemas.PAYMENTS + ", extra variant"
    body = ingest.monthly_upsert_writer(os.path.join(tmp_dir, "table"), schema, ["id"], "date")
    ingest.run_available(spark, os.path.join(tmp_dir, "landing"), schema, os.path.join(tmp_dir, "ckpt"), body,
                         quarantine_dir=os.path.join(tmp_dir, "quarantine"))
    from molarflow.sinks.versioned import VersionedTable
    table = VersionedTable(spark, os.path.join(tmp_dir, "table"), schema, ["id"], "date", "clinic_id").read()
    got = {r.id: r for r in ingest.promote(table, "tip", "double").withColumn("extra", F.to_json("extra")).collect()}
    assert sorted(got) == ["a", "b", "c", "d"] and got["a"].extra is None
    assert json.loads(got["b"].extra) == lines[1] and (got["b"].tip, got["c"].tip, got["d"].tip) == (2.5, None, None)
    assert str(got["a"].date) == "2026-04-01 00:00:00" and float(got["a"].amount) == 1.5
    assert {r.column: (r.filled, r.total) for r in ingest.extra_fields(table, schemas.PAYMENTS).collect()} == {"tip": (2, 4), "deep": (1, 4)}
    assert spark.read.schema("raw_line string").json(os.path.join(tmp_dir, "quarantine")).count() == 2
