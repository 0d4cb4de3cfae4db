"""FIXTURES.md §3 edge rows for origin, reschedules, leads and campaign counts."""

import datetime as dt

from molarflow.operators import kpi, leads as ld

D = dt.datetime


def test_origin_first_appointment_and_tie(spark):
    a = spark.createDataFrame([
        (1, 1, D(2026, 1, 1), "cmp"), (2, 1, D(2026, 2, 1), None),        # first has token -> campaign
        (3, 2, D(2026, 1, 1), None), (4, 2, D(2026, 2, 1), "cmp"),        # first without -> organic
        (6, 3, D(2026, 1, 1), "cmp"), (5, 3, D(2026, 1, 1), None),        # equal start: smaller id (5) decides
        (7, 4, None, "cmp"), (8, 4, D(2026, 3, 1), None),                 # null start sorts last
        (9, 5, D(2026, 1, 1), "  "),                                     # blank token is no token
    ], "id long, patient_id long, start_time timestamp_ntz, campaign_token string")
    got = {r.patient_id: r.origin for r in kpi.first_appointment_origin(a).collect()}
    assert got == {1: "campaign", 2: "organic", 3: "organic", 4: "organic", 5: "organic"}


def test_reschedule_two_levels(spark):
    appts = spark.createDataFrame([
        (1, "1", D(2026, 4, 2), D(2026, 4, 1)),                           # exactly 24 h: not > 24 h
        (2, "1", D(2026, 4, 2, 0, 0, 1), D(2026, 4, 1)),                  # 24 h + 1 s
        (3, "2", D(2026, 4, 1), None),
    ], "id long, clinic_id string, start_time timestamp_ntz, scheduled_start_time timestamp_ntz")
    no_logs = spark.createDataFrame([], "appointment_id long, to_status int, is_reschedule boolean")
    r = {x.clinic_id: x for x in kpi.reschedules_two_level(appts, no_logs, "clinic_id").collect()}
    assert r["1"].strategy == "heuristic" and r["1"].reschedules == 1 and r["2"].reschedules == 0
    logs = spark.createDataFrame([(1, 4, None), (1, 3, False), (3, 5, True), (9, 3, True)],
                                 "appointment_id long, to_status int, is_reschedule boolean")
    r = {x.clinic_id: x for x in kpi.reschedules_two_level(appts, logs, "clinic_id").collect()}
    # to_status 3 with flag false counts, null flag without status 3 does not; log of unknown appt dropped
    assert r["1"].strategy == "logs" and r["1"].reschedules == 1 and r["2"].reschedules == 1


CONTACT_DDL = ("id long, account_id long, name string, email string, phone_number string, identifier string, "
               "contact_inboxes array<struct<inbox:struct<id:int>>>, created_at long, last_activity_at long, "
               "labels array<string>, custom_attributes map<string,string>")
CONV_DDL = ("id long, account_id long, created_at string, last_activity_at long, contact_id long, inbox_id int, "
            "labels array<string>, meta struct<sender:struct<id:bigint,name:string,email:string,"
            "phone_number:string,identifier:string>>")
UNITS_DDL = "clinic_id string, name string, regional string, account_id bigint"


def _units(spark):
    return spark.createDataFrame([("c1", "one", "X", 1)], UNITS_DDL)


def test_lead_union_precedence_and_mapping(spark):
    t0 = 1775000000
    contacts = spark.createDataFrame([
        (7, 1, "Ana", "", "11987654321", None, [((3,),), ((None,),), ((0,),)], t0, 0, ["campanha"], {"anuncio_de_origem": "ad1"}),
        (8, 1, "", "b@x", None, None, [], 0, None, ["campanha"], {}),
    ], CONTACT_DDL)
    convs = spark.createDataFrame([
        (100, 1, str(t0 + 50), t0 + 60, 7, 4, ["campanha"], ((7, "Ana C", None, "119", None),)),
        (101, 1, "2026-04-01T10:00:00", None, 9, 5, ["campanha"], ((9, "Bia", None, None, None),)),
        (102, 1, "2026-04-01T11:00:00", None, 9, 5, ["campanha"], ((9, "Bia 2", None, None, None),)),
        (103, 1, str(t0), None, 11, 5, ["campanha"], (None,)),                  # no sender: skipped
        (104, 1, str(t0), None, 12, 5, ["other"], ((12, "Cid", None, None, None),)),
    ], CONV_DDL)
    got = {r.id: r for r in ld.lead_union(contacts, convs, _units(spark)).collect()}
    assert set(got) == {7, 8, 9}
    assert got[7].source == 3 and got[7].inbox_ids == [3] and got[7].email is None  # one person, three sources
    assert got[7].last_activity_at is None and got[7].erp_clinic_id == "c1"       # epoch 0 -> unknown
    assert got[8].name is None and got[8].created_at_cw is None and got[8].source == 1
    assert got[9].source == 2 and got[9].name == "Bia 2"                             # latest conversation wins
    assert got[9].created_at_cw == D(2026, 4, 1, 11) and got[9].last_activity_at == D(2026, 4, 1, 11)


def test_lead_cutoff_equal_is_out(spark):
    t = int(D(2026, 4, 1, tzinfo=dt.timezone.utc).timestamp())
    contacts = spark.createDataFrame([
        (1, 1, "a", None, None, None, [], t - 10, t, ["campanha"], {}),         # equal to cutoff: out
        (2, 1, "b", None, None, None, [], t - 10, t + 1, ["campanha"], {}),     # after: in
        (3, 1, "c", None, None, None, [], t + 5, None, ["x"], {"anuncio_de_origem": "ad"}),  # src 3 falls back to created
    ], CONTACT_DDL)
    got = sorted(r.id for r in ld.lead_union(contacts, None, _units(spark), cutoff=D(2026, 4, 1)).collect())
    assert got == [2, 3]


def test_campaign_counts_epoch_iso_and_missing_sender(spark):
    convs = spark.createDataFrame([
        (1, 1, "1775001600", None, 50, 1, ["campanha"], ((50, None, None, None, None),)),   # epoch
        (2, 1, "2026-04-02T00:00:00", None, 50, 1, ["campanha"], ((50, None, None, None, None),)),  # ISO, same contact
        (3, 1, "2026-04-03T00:00:00", None, 60, 1, ["campanha"], (None,)),                   # sender missing
        (4, 1, "2026-04-03T00:00:00", None, 70, 1, ["other"], (None,)),
    ], CONV_DDL)
    r = ld.campaign_contacts(convs, _units(spark)).collect()
    assert len(r) == 1 and r[0].year_month == "2026-04"
    assert (r[0].contacts_count, r[0].conversations_count) == (2, 3)
