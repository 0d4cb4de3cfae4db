"""The request surface: parameters as strings, scope, validation, same numbers as the queries."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from molarflow.plans import api
from molarflow.plans.params import ParamError
from molarflow.plans.registry import Tables
from molarflow.sources.tables import LakeTables

from paths import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_appointments_endpoint_matches_query(spark):
    t = Tables(spark, SF_SMALL)
    out = api.appointments(t, {"start": "1997-01-01", "end": "1997-04-01", "clinic_ids": "1,2,3,5,8,13,21",
                               "status_codes": "7,8,4,abc", "sort_by": "patient_name", "sort_order": "asc",
                               "page": "2", "pp": "25"})
    assert _rows(out["data"]) == _rows(E.queries()["appointments_page"](spark, SF_SMALL))
    p = out["pagination"].first()
    assert p.page == 2 and p.pp == 25 and p.total_pages == max(1, -(-p.total // 25))


def test_scope_and_validation(spark):
    t = Tables(spark, SF_SMALL)
    with pytest.raises(ParamError):
        api.appointments(t, {"start": "1997-01-01"})
    with pytest.raises(ParamError):
        api.stats(spark, t, {"start": "1997-01-01", "end": "1997-06-01"})        # > 92 days
    with pytest.raises(ParamError):
        api.stats(spark, t, {"start": "1997-01-01", "end": "1997-02-01", "agent_mode": "X"})
    out = api.appointments(t, {"start": "1997-01-01", "end": "1997-04-01", "clinic_ids": "9"}, allowed=["1"])
    assert out["data"].count() == 0 and out["pagination"].first().total_pages == 0
    ev = api.audit_events(t, {"start": "1997-01-01", "end": "1997-04-01"}, allowed=["1", "2"])
    assert ev["data"].where(~F.col("clinic_id").isin("1", "2")).count() == 0
    scanned = api.data(t, "appointment_logs", allowed=["1"]).select("appointment_id").distinct()
    clinics = t.appointments.join(scanned, t.appointments["id"] == scanned["appointment_id"]).select("clinic_id")
    assert {r.clinic_id for r in clinics.distinct().collect()} <= {"1"}
    with pytest.raises(ParamError):
        api.data(t, "users")


def test_stats_endpoint_matches_bundle_query(spark):
    from molarflow.plans.q_dashboard import CLINICS
    t = Tables(spark, SF_SMALL)
    got = api.stats(spark, t, {"start": "1997-01-01", "end": "1997-04-01", "clinic_ids": ",".join(CLINICS),
                               "agent_mode": "MC"})
    assert _rows(got) == _rows(E.queries()["dashboard_bundle"](spark, SF_SMALL))


def test_funnel_endpoints(spark):
    t = Tables(spark, SF_SMALL)
    base = {"start": "1995-06-01", "end": "1995-08-30", "min_lead_created_at": "1995-06-01"}
    total = api.funnel(t, base).first()
    assert total.leads > 0
    none = api.funnel(t, dict(base, clinic_ids="99"), allowed=["1"]).first()
    assert none.leads == 0
    per = api.funnel_detail(t, dict(base, stage="agendados", limit="500"))
    assert per.count() == total.scheduled
    by_origin = api.funnel_detail(t, dict(base, stage="leads", origem="Instagram", limit="500"))
    assert by_origin.count() <= total.leads
    with pytest.raises(Exception):
        api.funnel_detail(t, dict(base, stage="paid"))


def test_lookups_scoped(spark):
    look = api.lookups(spark, Tables(spark, SF_SMALL), allowed=["1", "3"])
    assert {r.id for r in look["clinics"].collect()} == {"1", "3"}
    assert look["statuses"].count() == 12 and look["specialties"].count() > 0


def test_lake_tables_surface(spark, tmp_dir):
    t = Tables(spark, SF_SMALL)
    for feed, col in (("appointments", "start_time"), ("payments", "date"), ("appointment_logs", "change_date")):
        getattr(t, feed).withColumn("month", F.date_format(col, "yyyy-MM")).write.partitionBy("month") \
            .parquet(os.path.join(tmp_dir, feed))
    lake = LakeTables(spark, tmp_dir)
    q = {"start": "1997-01-01", "end": "1997-04-01", "search": "jose"}
    assert _rows(api.appointments(lake, q)["data"]) == _rows(api.appointments(t, q)["data"])
