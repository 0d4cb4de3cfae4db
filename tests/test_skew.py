"""Hot keys: one patient / one phone holding a large share of the rows."""

import bisect
import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from molarflow.operators import attribution as att
from molarflow.operators import funnel

BASE = dt.datetime(2025, 1, 1)


def test_hot_patient_attribution_matches_brute_force(spark):
    rnd = random.Random(7)
    appts, pays = [], []
    for i in range(3000):                       # patient 1 holds most rows, over two years
        pat = 1 if i % 3 else rnd.randint(2, 50)
        appts.append((i, pat, BASE + dt.timedelta(minutes=rnd.randint(0, 730 * 1440)),
                      7 if rnd.random() < 0.2 else 5, "eval", "mc_channel"))
    for i in range(3000):
        pat = 1 if i % 3 else rnd.randint(2, 50)
        pays.append((f"p{i}", pat, "1", BASE + dt.timedelta(minutes=rnd.randint(0, 730 * 1440)), Decimal("2.50")))
    a = spark.createDataFrame(appts, "id long, patient_id long, start_time timestamp_ntz, status int, "
                                     "speciality_id string, channel_id string")
    p = spark.createDataFrame(pays, "id string, patient_id long, clinic_id string, date timestamp_ntz, "
                                    "amount decimal(18,2)")
    lg = spark.createDataFrame([], "id string, appointment_id long, user_id string, to_status int")
    got = {r.id: r.is_agent for r in att.attribute_v4(p, a, lg).collect()}

    by_patient: dict[int, list] = {}
    for _, pat, t, status, _, _ in appts:
        if status == 7:
            by_patient.setdefault(pat, []).append(t)
    for v in by_patient.values():
        v.sort()
    want = {}
    for pid, pat, _, d, _ in pays:
        ts = by_patient.get(pat, [])
        k = bisect.bisect_right(ts, d)            # latest qualifying start <= d
        want[pid] = k > 0 and ts[k - 1] >= d - dt.timedelta(days=30)
    assert got == want


def test_hot_phone_does_not_multiply_leads(spark):
    hot = "+55 11 98765-4321"
    appts = [(i, 1000 + i, hot, BASE + dt.timedelta(days=i % 50), 7 if i % 2 else 1) for i in range(300)]
    appts += [(900, 2000, "(21) 3333-4444", BASE, 7)]
    a = spark.createDataFrame(appts, "id long, patient_id long, phone string, created_at timestamp_ntz, status int")
    leads = [(i, 1, "Lead", "11 8765-4321", ["campanha"], BASE + dt.timedelta(days=i)) for i in range(100)]
    ld = spark.createDataFrame(leads, "id long, account_id long, name string, phone_raw string, "
                                      "labels array<string>, created_at_cw timestamp_ntz")
    logs = spark.createDataFrame([], "appointment_id long, to_status int")
    pays = spark.createDataFrame([("x", 1001, BASE + dt.timedelta(days=80), True, None)],
                                 "id string, patient_id long, date timestamp_ntz, is_confirmed boolean, "
                                 "deleted_at timestamp_ntz")
    st = funnel.lead_stages(ld, a, logs, pays, BASE, BASE + dt.timedelta(days=120), None)
    rows = {r.id: r for r in st.collect()}
    assert len(rows) == 100                     # one row per lead, whatever the fan-out of the phone
    last_created = max(r[3] for r in appts[:300])
    last_attended = max(r[3] for r in appts[:300] if r[4] == 7)
    for i, r in rows.items():
        c = BASE + dt.timedelta(days=i)
        assert r.scheduled == (last_created >= c)
        assert r.attended == (last_attended >= c)
        # patient 1001 (appointment 1, created day 1) paid on day 80
        assert r.sold == (BASE + dt.timedelta(days=1) >= c)
    assert st.where(F.col("sold")).count() == 2
