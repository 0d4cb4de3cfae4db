"""Scope (FLT15, JOI10) and audit-list filters/paging (FLT1-9, SRT1, LIM1-2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from molarflow.operators import audit, filters, scope
from molarflow.plans.params import AppointmentRequest, ParamError, validate_period, page_params, drill_params
from molarflow.sources.testdata import appointments as appt_adapter

from paths import SF_SMALL


def test_resolve_clinics_rules():
    assert scope.resolve_clinics(None, None) is None                    # unrestricted, nothing asked
    assert scope.resolve_clinics(None, ["1", ""]) == ["1"]               # requested only
    assert scope.resolve_clinics(["1", "2"], None) == ["1", "2"]         # explicit scope
    assert scope.resolve_clinics(["1", "2"], ["2", "9"]) == ["2"]        # intersection
    assert scope.resolve_clinics(["1", "2"], ["9"]) == []                # empty intersection -> none
    assert scope.resolve_clinics([" ", ""], None) == []                  # blanks only -> none (fail closed)


def test_user_scopes_precedence(spark):
    users = spark.createDataFrame([
        ("root", True, None, None, True, None, []),
        ("exp", True, None, "ASIA", False, ["1", "", "2"], []),
        ("blank", True, None, None, False, [""], []),
        ("reg", True, None, " ASIA ", False, None, []),
        ("acc", True, None, None, False, None,
         [(10, "administrator", "active"), (11, "agent", "active"), (12, "administrator", "inactive")]),
        ("off", False, None, None, True, None, []),
        ("none", True, None, None, False, [], []),
    ], "id string, active boolean, role string, regional string, unrestricted boolean, "
       "allowed_clinic_ids array<string>, accounts array<struct<id:bigint,role:string,status:string>>")
    units = spark.createDataFrame([("1", "a", "ASIA", 10), ("2", "b", "EUROPE", 11), ("3", "c", "ASIA", 12),
                                   (None, "d", "ASIA", 13)], "clinic_id string, name string, regional string, account_id bigint")
    got = {(r.user_id, r.clinic_id, r.rule) for r in scope.user_scopes(users, units).collect()}
    assert got == {("root", None, "unrestricted"), ("exp", "1", "explicit"), ("exp", "2", "explicit"),
                   ("reg", "1", "regional"), ("reg", "3", "regional"), ("acc", "1", "accounts")}


def test_apply_clinics_empty_means_none(spark):
    df = spark.createDataFrame([("1",), ("2",)], "clinic_id string")
    assert scope.apply_clinics(df, None).count() == 2
    assert scope.apply_clinics(df, []).count() == 0
    assert scope.apply_clinics(df, ["2"]).count() == 1


def test_period_validation():
    s, e = validate_period("2026-04-01", "2026-07-02")
    assert (e - s).days == 92
    with pytest.raises(ParamError):
        validate_period("2026-04-01", "2026-07-03")
    with pytest.raises(ParamError):
        validate_period("2026-04-02", "2026-04-01")
    with pytest.raises(ParamError):
        validate_period("2026/04/01", "2026-04-02")
    assert page_params("0", "7") == (1, 10) and page_params(None, "500") == (1, 100)
    assert drill_params("5", "-3") == (10, 0) and drill_params(None, None) == (100, 0)


def _appts(spark):
    rows = [
        (1, "1", dt.datetime(2026, 4, 1), 7, "Paulo Simão", "José Silva", "11987654321", "Instagram"),
        (2, "1", dt.datetime(2026, 4, 30, 23, 59, 59), 4, "Paulo Simao", "Inês Souza", "1187654321", "Google"),
        (3, "2", dt.datetime(2026, 5, 1), 7, " Bruna", "Ana (Maria)", None, "Instagram"),
        (4, "2", dt.datetime(2026, 3, 31, 23, 59, 59), 8, None, "Zé", "5511987654321", None),
        (5, "3", None, 3, "Carla  Dias", None, "123", "Google"),
    ]
    df = spark.createDataFrame(rows, "id long, clinic_id string, start_time timestamp_ntz, status int, "
                               "created_by_name string, patient_name string, phone string, patient_channel_name string")
    from molarflow.functions.text import fold_name, phone_digits
    return (df.withColumn("created_by_name_norm", fold_name("created_by_name"))
            .withColumn("patient_name_norm", fold_name("patient_name"))
            .withColumn("phone_norm", phone_digits("phone"))
            .withColumn("speciality_id", F.lit("eval")).withColumn("patient_subchannel_name", F.lit(None).cast("string")))


def _ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_half_open_range_and_creators(spark):
    df = _appts(spark)
    req = AppointmentRequest(start="2026-04-01", end="2026-05-01")
    assert _ids(filters.all_of(df, filters.appointment_predicates(req))) == [1, 2]
    req = AppointmentRequest(start="2026-03-01", end="2026-06-01", creators="paulo simão|")
    assert _ids(filters.all_of(df, filters.appointment_predicates(req))) == [1, 2]
    req = AppointmentRequest(start="2026-03-01", end="2026-06-01", status_codes="7,8,x", only_status="7")
    assert _ids(filters.all_of(df, filters.appointment_predicates(req))) == [1, 3]


def test_search_rules(spark):
    df = _appts(spark)

    def hits(q):
        req = AppointmentRequest(start="2026-01-01", end="2026-12-01", search=q)
        return _ids(filters.all_of(df, filters.appointment_predicates(req)))

    assert hits("jose") == [1]                      # accent-insensitive
    assert hits("(11) 8765-4321") == [1, 2, 4]      # 10 digits -> also the 9-variant
    assert hits("()") == [1, 2, 3, 4]               # nothing left -> no filter
    assert hits("ana (maria") == []                 # '(' becomes a space: "ana  maria" does not match
    assert hits("ana") == [3]                       # substring of the folded name only


def test_pages_cover_unpaged_result(spark):
    """Invariant: the union of all pages equals the unpaged filtered set, no overlap."""
    appts = appt_adapter(spark, SF_SMALL)
    base = AppointmentRequest(start="1997-01-01", end="1997-07-01", sort_by="patient_name", sort_order="asc", pp=10)
    full, _ = audit.filtered_appointments(appts, base)
    total = full.count()
    seen = []
    for p in range(1, total // 10 + 2):
        req = AppointmentRequest(start=base.start, end=base.end, sort_by="patient_name", sort_order="asc", page=p, pp=10)
        seen += _ids(audit.appointments_page(appts, req))
    assert sorted(seen) == _ids(full) and len(seen) == len(set(seen))


def test_page_totals_and_empty_scope(spark):
    appts = appt_adapter(spark, SF_SMALL)
    req = AppointmentRequest(start="1997-01-01", end="1997-07-01", clinic_ids="1", pp=10)
    r = audit.appointments_total(appts, req).first()
    assert r.total_pages == max(1, -(-r.total // 10))
    r = audit.appointments_total(appts, req, allowed=["2"]).first()
    assert (r.total, r.total_pages) == (0, 0)


def test_is_mc_false_excludes_null_users(spark):
    from molarflow.plans.params import LogRequest
    logs = spark.createDataFrame([
        ("l1", 1, "mc", 1, 4, None, dt.datetime(2026, 4, 2)),
        ("l2", 1, None, 1, 4, None, dt.datetime(2026, 4, 3)),
        ("l3", 1, "op1", 1, 4, False, dt.datetime(2026, 4, 4)),
        ("l4", 1, "op1", 1, 3, True, dt.datetime(2026, 4, 5)),
    ], "id string, appointment_id long, user_id string, from_status int, to_status int, is_reschedule boolean, "
       "change_date timestamp_ntz")
    appts = _appts(spark).withColumn("scheduled_start_time", F.col("start_time"))
    for c in ("doctor_name", "type", "campaign_token", "channel_name"):
        appts = appts.withColumn(c, F.lit(None).cast("string"))
    appts = appts.withColumn("patient_id", F.col("id"))
    req = LogRequest(start="2026-04-01", end="2026-05-01", is_mc="false")
    got = audit.log_events(logs, appts, req).collect()
    assert [r.log_id for r in got] == ["l3"] and got[0].is_mc is False and len(got[0]) == 22
    req = LogRequest(start="2026-04-01", end="2026-05-01", kind="reschedule")
    assert [r.log_id for r in audit.log_events(logs, appts, req).collect()] == ["l4"]
