"""Seek paging: walks by cursor give the offset form's pages."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from molarflow.operators.filters import order_columns, page
from molarflow.operators.paging import BadCursor, Order, seek
from molarflow.plans import api
from molarflow.plans.params import ParamError
from molarflow.plans.registry import Tables
from molarflow.sources.tables import LakeTables

from paths import SF_SMALL

ROWS = [(i, [None, "a", "b", "é", 'q"uote'][i * 7 % 5], i % 3) for i in range(23)]


def _walk(df, order, size, backward):
    seen, cursor = [], None
    while True:
        rows = seek(df, order, size, cursor, backward).collect()
        if not rows:
            return seen
        seen = [rows, *seen] if backward else [*seen, rows]
        cursor = rows[0 if backward else -1].cursor


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("backward", [True, False])
def test_walking_all_pages_equals_the_offset_form(spark, ascending, backward):
    df = spark.createDataFrame(ROWS, "id bigint, name string, account_id bigint").repartition(3).checkpoint()
    pages = _walk(df, Order("name", ascending), 4, backward)
    got = [r.id for p in pages for r in p]
    want = [r.id for n in range(1, 7) for r in page(df, order_columns("name", ascending), n, 4).collect()]
    assert got == want and len(got) == 23 and len(pages) == 6


def test_ties_over_two_ids_and_times(spark):
    t = dt.datetime(2026, 1, 1, 0, 0, 0, 5)
    rows = [(i % 4, i % 3, None if i % 5 == 0 else t) for i in range(12)]
    df = spark.createDataFrame(rows, "id bigint, account_id bigint, at timestamp_ntz")
    order = Order("at", False, ("id", "account_id"))
    got = [(r.id, r.account_id) for p in _walk(df, order, 5, False) for r in p]
    assert got == [(r.id, r.account_id) for r in df.orderBy(*order.columns()).collect()] and len(set(got)) == 12


def test_a_page_keeps_its_rows_per_task_and_reaches_the_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(1000).selectExpr("id", "CAST(id / 10 AS BIGINT) AS v").write.parquet(path)
    df, order = spark.read.parquet(path), Order("v", True)
    cursor = seek(df.where("id <= 899"), order, 10, None, True).collect()[-1].cursor
    last = seek(df, order, 10, cursor)
    assert [r.id for r in last.collect()] == list(range(900, 910))
    plan = spark._jvm.PythonSQLUtils.explainString(last._jdf.queryExecution(), "formatted")
    assert "TakeOrderedAndProject" in plan and "PushedFilters" in plan and "GreaterThan(v,89)" in plan


def test_unknown_cursors_are_refused(spark):
    df = spark.createDataFrame(ROWS, "id bigint, name string, account_id bigint")
    for bad in ("x", "!!!", "bm9uZQ==", "W10=", "WyJhIl0=", "WyJhIiwgMV0="):
        with pytest.raises(BadCursor):
            seek(df, Order("name", True), 5, bad)
    with pytest.raises(ParamError):
        api.appointments(Tables(spark, SF_SMALL), {"start": "1997-01-01", "end": "1997-04-01", "cursor": "x"})


def test_api_pages_by_cursor(spark):
    t = Tables(spark, SF_SMALL)
    q = {"start": "1997-01-01", "end": "1997-04-01", "pp": "10"}
    first = api.appointments(t, q | {"cursor": ""})["data"].collect()
    second = api.appointments(t, q | {"cursor": first[-1].cursor})["data"].collect()
    assert [r.id for r in second] == [r.id for r in api.appointments(t, q | {"page": "2"})["data"].collect()]
    back = api.appointments(t, q | {"cursor": second[0].cursor, "direction": "prev"})["data"].collect()
    assert [r.id for r in back] == [r.id for r in first]
    f = {"start": "1995-06-01", "end": "1995-08-30", "min_lead_created_at": "1995-06-01", "stage": "leads", "limit": "10"}
    a = api.funnel_detail(t, f | {"cursor": ""}).collect()
    b = api.funnel_detail(t, f | {"cursor": a[-1].cursor}).collect()
    assert [r.id for r in b] == [r.id for r in api.funnel_detail(t, f | {"offset": "10"}).collect()]


def test_lake_reads_the_version_that_the_stream_wrote(spark, tmp_dir):
    from molarflow import schemas
    from molarflow.streaming import ingest
    t = Tables(spark, SF_SMALL)
    rows = t.appointments.where("id % 4 = 0").drop("created_by_name_norm", "patient_name_norm", "phone_norm")
    for delivery in (rows, rows.where("id % 8 = 0").withColumn("status", F.lit(99))):
        ingest.feed_ingest(spark, os.path.join(tmp_dir, "appointments"), schemas.APPOINTMENTS, ["id"], "start_time", [delivery])
    lake = LakeTables(spark, tmp_dir)
    assert lake.appointments.count() == rows.count()
    got = api.appointments(lake, {"start": "1990-01-01", "end": "2010-01-01", "only_status": "99", "pp": "100"})
    assert got["pagination"].first().total == rows.where("id % 8 = 0").count() > 0
