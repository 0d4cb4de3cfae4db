"""Property tests: the bucketed as-of window equals brute force; funnel invariants."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from molarflow.operators import attribution as att
from molarflow.operators import funnel
from molarflow.sources import testdata

from paths import SF_SMALL

BASE = dt.datetime(2026, 1, 1)
W = dt.timedelta(days=30)

minutes = st.integers(min_value=0, max_value=200 * 24 * 60)
appt_st = st.tuples(st.integers(1, 4), minutes, st.booleans())          # patient, start offset, qualifies
pay_st = st.tuples(st.one_of(st.none(), st.integers(1, 4)), minutes)     # patient (or none), date offset


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(appt_st, max_size=25), st.lists(pay_st, min_size=1, max_size=25))
def test_v4_window_equals_brute_force(spark, appts, pays):
    a_rows = [(i, p, BASE + dt.timedelta(minutes=m), 7 if q else 5, "eval", "mc_channel")
              for i, (p, m, q) in enumerate(appts)]
    p_rows = [(f"p{i}", p, "1", BASE + dt.timedelta(minutes=m), Decimal("1.00")) for i, (p, m) in enumerate(pays)]
    a = spark.createDataFrame(a_rows, "id long, patient_id long, start_time timestamp_ntz, status int, "
                                      "speciality_id string, channel_id string")
    p = spark.createDataFrame(p_rows, "id string, patient_id long, clinic_id string, date timestamp_ntz, "
                                      "amount decimal(18,2)")
    lg = spark.createDataFrame([], "id string, appointment_id long, user_id string, to_status int")
    got = {r.id: r.owner for r in att.attribute_v4(p, a, lg).collect()}
    want = {}
    for pid, pat, d, _ in [(r[0], r[1], r[3], r[4]) for r in p_rows]:
        hit = pat is not None and any(ap == pat and st_ == 7 and d - W <= t <= d
                                      for _, ap, t, st_, _, _ in a_rows)
        want[pid] = "agent" if hit else "operators"
    assert got == want


def test_funnel_invariants(spark):
    stages = funnel.lead_stages(testdata.leads(spark, SF_SMALL), testdata.appointments(spark, SF_SMALL),
                                testdata.appointment_logs(spark, SF_SMALL), testdata.payments(spark, SF_SMALL),
                                dt.datetime(1995, 6, 1), dt.datetime(1995, 12, 31), None)
    bad = stages.where((F.col("attended") & ~F.col("confirmed")) | (F.col("confirmed") & ~F.col("scheduled"))
                       | (F.col("sold") & ~F.col("scheduled")))
    assert bad.count() == 0
    c = funnel.funnel_counts(stages).first()
    assert c.leads >= c.scheduled >= c.confirmed >= c.attended
    assert c.leads > 0


def test_funnel_request_validation(spark):
    import pytest
    from molarflow.plans.params import FunnelRequest, ParamError
    r = FunnelRequest(start="2026-04-01", end="2026-05-01", limit="5000", offset="-1")
    assert (r.limit, r.offset) == (500, 0) and r.min_lead == dt.datetime(2026, 4, 6)
    assert (lambda b: (b[1] - b[0]).days)(FunnelRequest(start="2026-01-01", end="2026-12-01").bounds) == 334
    with pytest.raises(ParamError):
        _ = FunnelRequest(start="2026-06-01", end="2026-01-01").bounds
    stages = spark.createDataFrame([], "id long, account_id long, name string, phone_raw string, "
                                       "created_at_cw timestamp_ntz, scheduled boolean, confirmed boolean, "
                                       "attended boolean, sold boolean")
    with pytest.raises(funnel.UnknownStage):
        funnel.funnel_detail(stages, "paid")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(appt_st, max_size=20), st.lists(pay_st, min_size=1, max_size=20), st.sampled_from([1, 4, 7, 30, 45]))
def test_v4_any_bucket_width_equals_brute_force(spark, appts, pays, width):
    """Narrower buckets (more appointment copies, smaller hot partitions) give the same answer."""
    a_rows = [(i, p, BASE + dt.timedelta(minutes=m), 7 if q else 5, "eval", "mc_channel")
              for i, (p, m, q) in enumerate(appts)]
    p_rows = [(f"p{i}", p, "1", BASE + dt.timedelta(minutes=m), Decimal("1.00")) for i, (p, m) in enumerate(pays)]
    a = spark.createDataFrame(a_rows, "id long, patient_id long, start_time timestamp_ntz, status int, "
                                      "speciality_id string, channel_id string")
    p = spark.createDataFrame(p_rows, "id string, patient_id long, clinic_id string, date timestamp_ntz, "
                                      "amount decimal(18,2)")
    lg = spark.createDataFrame([], "id string, appointment_id long, user_id string, to_status int")
    got = {r.id: r.is_agent for r in att.attribute_v4(p, a, lg, bucket_days=width).collect()}
    want = {pid: pat is not None and any(ap == pat and s_ == 7 and d - W <= t <= d for _, ap, t, s_, _, _ in a_rows)
            for pid, pat, _, d, _ in p_rows}
    assert got == want
