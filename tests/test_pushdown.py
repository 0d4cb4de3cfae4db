"""Filters and column pruning reach the Parquet scans."""

import __spark_entry__ as E

from paths import SF_SMALL
from molarflow.plans.registry import Tables


def _plan(spark, name):
    return E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_period_filter_pushed_to_orders_scan(spark):
    plan = _plan(spark, "appointments_page")
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_flagship_reads_only_needed_lineitem_columns(spark):
    plan = _plan(spark, "attribution_v4_by_clinic_month")
    for unused in ("l_quantity", "l_tax"):
        assert unused not in plan
    assert "EqualTo(l_linestatus,F)" in plan        # confirmed payments filter reaches the scan


def test_funnel_reads_appointments_from_the_first_lead_on(spark):
    import datetime as dt
    from molarflow.operators import funnel
    t = Tables(spark, SF_SMALL)
    st = funnel.lead_stages(t.leads, t.appointments, t.appointment_logs, t.payments, dt.datetime(1996, 1, 1),
                            dt.datetime(1996, 4, 1), dt.datetime(1996, 1, 15))
    assert "1996-01-15" in st._jdf.queryExecution().optimizedPlan().toString()


def test_reconcile_scans_each_input_once(spark):
    from molarflow.operators import leads as ld
    stored = spark.range(5).selectExpr("id", "id % 2 AS account_id", "array('campanha') AS labels")
    seen = spark.range(3).selectExpr("id", "id % 2 AS account_id")
    plan = ld.reconcile_audit(stored, seen)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 2 and "Join" not in plan
