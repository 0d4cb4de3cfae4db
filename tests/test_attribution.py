"""Revenue attribution on the FIXTURES edge rows, invariants and plan shape."""

import datetime as dt

from pyspark.sql import functions as F

from molarflow.operators import attribution as att
from molarflow.sources import testdata

from paths import SF_SMALL

D = dt.datetime
PAY_T = D(2026, 4, 30, 12, 0, 0)

APPT_DDL = "id long, patient_id long, start_time timestamp_ntz, status int, speciality_id string, channel_id string"
LOG_DDL = "id string, appointment_id long, user_id string, to_status int"
PAY_DDL = "id string, patient_id long, clinic_id string, date timestamp_ntz, amount decimal(18,2)"


def _run(spark, appts, logs, pays):
    a = spark.createDataFrame(appts, APPT_DDL)
    lg = spark.createDataFrame(logs, LOG_DDL)
    p = spark.createDataFrame(pays, PAY_DDL)
    return {r.id: r.owner for r in att.attribute_v4(p, a, lg).collect()}


def test_v4_window_edges(spark):
    from decimal import Decimal
    amt = Decimal("100.00")
    appts = [
        (1, 1, PAY_T - dt.timedelta(days=30), 7, "eval", "mc_channel"),                    # exactly 30 d before: in
        (2, 2, PAY_T, 8, "eval", "mc_channel"),                                             # at payment time: in
        (3, 3, PAY_T - dt.timedelta(days=30, seconds=1), 7, "eval", "mc_channel"),          # 30 d + 1 s: out
        (4, 4, PAY_T - dt.timedelta(days=1), 5, "eval", "mc_channel"),                      # not attended: out
        (5, 5, PAY_T - dt.timedelta(days=1), 7, "sp1", "mc_channel"),                       # other specialty: out
        (6, 6, PAY_T - dt.timedelta(days=1), 7, "eval", "front_desk"),                      # touched via log: in
        (7, 7, PAY_T - dt.timedelta(days=2), 7, "eval", "mc_channel"),                      # two matches: once
        (8, 7, PAY_T - dt.timedelta(days=3), 8, "eval", "mc_channel"),
        (9, None, PAY_T - dt.timedelta(days=1), 7, "eval", "mc_channel"),                   # null patient
        (10, 10, PAY_T + dt.timedelta(seconds=1), 7, "eval", "mc_channel"),                 # after payment: out
        (11, 11, PAY_T - dt.timedelta(days=1), 7, "eval", "front_desk"),                    # untouched: out
    ]
    logs = [("g1", 6, "mc", 4), ("g2", 11, "op1", 4), ("g3", 11, None, 4)]
    pays = [(f"p{i}", i, "1", PAY_T, amt) for i in (1, 2, 3, 4, 5, 6, 7, 10, 11)] + [("pn", None, "1", PAY_T, amt)]
    got = _run(spark, appts, logs, pays)
    assert got == {"p1": "agent", "p2": "agent", "p3": "operators", "p4": "operators", "p5": "operators",
                   "p6": "agent", "p7": "agent", "p10": "operators", "p11": "operators", "pn": "operators"}


def test_v4_bucket_boundary(spark):
    """Appointment and payment in different 30-day buckets still match."""
    from decimal import Decimal
    for days in range(0, 31, 3):
        for shift in (0, 0.5, 1, 29.5):
            pay_t = D(2026, 1, 1) + dt.timedelta(days=shift + days * 7)
            appt_t = pay_t - dt.timedelta(days=days)
            got = _run(spark, [(1, 1, appt_t, 7, "eval", "mc_channel")], [], [("p", 1, "1", pay_t, Decimal("1.00"))])
            assert got == {"p": "agent"}, (days, shift)


def test_invariant_agent_plus_operators_equals_total(spark):
    pay = testdata.payments(spark, SF_SMALL)
    appts, logs = testdata.appointments(spark, SF_SMALL), testdata.appointment_logs(spark, SF_SMALL)
    paid = att.confirmed_payments(pay)
    out = att.revenue_by_owner(att.attribute_v4(paid.select("id", "patient_id", "clinic_id", "date", "amount"),
                                                appts, logs))
    parts = {r.owner: (r.revenue, r.payments) for r in out.collect()}
    total = paid.agg(F.sum("amount").cast("double").alias("r"), F.count(F.lit(1)).alias("n")).first()
    assert abs(sum(v[0] for v in parts.values()) - total.r) < 1e-6
    assert sum(v[1] for v in parts.values()) == total.n
    assert set(parts) <= {"agent", "operators"}


def test_v4_plan_has_no_nested_loop_or_cartesian(spark):
    q = att.attribution_by_clinic_month(testdata.payments(spark, SF_SMALL), testdata.appointments(spark, SF_SMALL),
                                        testdata.appointment_logs(spark, SF_SMALL))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_v2_latest_decides(spark):
    from decimal import Decimal
    a = spark.createDataFrame([
        (1, 1, PAY_T - dt.timedelta(days=10), 7, "eval", "mc_channel"),
        (2, 1, PAY_T - dt.timedelta(days=2), 8, "sp1", "front_desk"),     # latest: operator
        (3, 2, PAY_T - dt.timedelta(days=2), 7, "sp1", "mc_channel"),     # latest: agent
        (4, 3, PAY_T - dt.timedelta(days=40), 7, "sp1", "mc_channel"),    # none within 30 d
    ], APPT_DDL)
    lg = spark.createDataFrame([], LOG_DDL)
    p = spark.createDataFrame([(f"p{i}", i, "1", PAY_T, Decimal("1.00")) for i in (1, 2, 3)], PAY_DDL)
    got = {r.id: r.owner for r in att.attribute_v2(p, a, lg).collect()}
    assert got == {"p1": "operators", "p2": "agent", "p3": "unattributed"}
