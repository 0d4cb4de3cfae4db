"""Bucketed tables: joins and aggregations on the bucket key have no exchange."""

import os

import pytest
from pyspark.sql import functions as F

from molarflow import schemas
from molarflow.operators import kpi
from molarflow.plans.q_index import bucketed_tables
from molarflow.plans.registry import Tables
from molarflow.sinks.bucketed import register, write_bucketed

from paths import SF_SMALL


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_on_the_bucketed_sides(spark, no_broadcast):
    appointments, logs, by_patient = bucketed_tables(spark, SF_SMALL)
    owners = _plan(kpi.action_ownership(appointments, logs))
    assert "SortMergeJoin" in owners and "hashpartitioning(appointment_id" not in owners and "hashpartitioning(id" not in owners
    origins = kpi.first_appointment_origin(by_patient)
    assert "Exchange" not in _plan(origins)
    joined = _plan(by_patient.join(origins, "patient_id"))
    assert "SortMergeJoin" in joined and "Exchange" not in joined
    plain = Tables(spark, SF_SMALL)
    assert "hashpartitioning(appointment_id" in _plan(kpi.action_ownership(plain.appointments, plain.appointment_logs))


def test_a_later_session_registers_the_files(spark, tmp_dir, no_broadcast):
    path = os.path.join(tmp_dir, "p")
    p = Tables(spark, SF_SMALL).payments
    first = write_bucketed(p, "payments_first_session", path, "patient_id", 4)
    assert first.count() == p.count()
    again = register(spark, "payments_later_session", schemas.PAYMENTS, path, "patient_id", 4)
    total = again.groupBy("patient_id").agg(F.sum("amount").alias("a"))
    assert "Exchange" not in _plan(total)
    assert sorted(total.collect()) == sorted(p.groupBy("patient_id").agg(F.sum("amount").alias("a")).collect())
    for name in ("payments_first_session", "payments_later_session"):
        spark.sql(f"DROP TABLE {name}")
    assert os.path.exists(path)
