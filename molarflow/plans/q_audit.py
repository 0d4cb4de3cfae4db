"""Audit lists and scope queries (PRJ1, PRJ4, FLT1-9, FLT15, SRT1, LIM1-2, JOI1, JOI2, JOI10)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from molarflow.operators import audit, scope
from molarflow.plans.oracle_views import with_views
from molarflow.plans.params import AppointmentRequest, LogRequest
from molarflow.plans.registry import Tables, register

_APPT_COLS = ", ".join(audit.APPOINTMENT_COLUMNS)

PAGE_REQ = AppointmentRequest(start="1997-01-01", end="1997-04-01", clinic_ids="1,2,3,5,8,13,21",
                              status_codes="7,8,4,abc", sort_by="patient_name", sort_order="asc", page=2, pp=25)


@register("appointments_page", with_views(["appointments"], f"""
    SELECT {_APPT_COLS} FROM appointments
    WHERE start_time >= TIMESTAMP '1997-01-01' AND start_time < TIMESTAMP '1997-04-01'
      AND clinic_id IN ('1','2','3','5','8','13','21') AND status IN (7, 8, 4)
    ORDER BY patient_name ASC NULLS LAST, id ASC LIMIT 25 OFFSET 25"""), "PRJ1 FLT1 FLT3 SRT1 LIM1")
def appointments_page(spark, sf_dir):
    return audit.appointments_page(Tables(spark, sf_dir).appointments, PAGE_REQ)


SEEK_REQ = AppointmentRequest(start="1997-01-01", end="1997-07-01", sort_by="status", sort_order="desc", pp=100)


@register("appointments_page_cursor", with_views(["appointments"], f"""
    SELECT 'next' AS walk, {_APPT_COLS} FROM (
      SELECT *, row_number() OVER (ORDER BY status DESC NULLS FIRST, id) AS n, count(*) OVER () AS total FROM appointments
      WHERE start_time >= TIMESTAMP '1997-01-01' AND start_time < TIMESTAMP '1997-07-01') x
    WHERE n <= 400
    UNION ALL
    SELECT 'prev', {_APPT_COLS} FROM (
      SELECT *, row_number() OVER (ORDER BY status DESC NULLS FIRST, id) AS n, count(*) OVER () AS total FROM appointments
      WHERE start_time >= TIMESTAMP '1997-01-01' AND start_time < TIMESTAMP '1997-07-01') x
    WHERE n > total - 200 AND n <= total"""), "LIM1 SRT1")
def appointments_page_cursor(spark, sf_dir):
    """Walks by cursor: the first four pages forward, the last two backward, over long ties."""
    a = Tables(spark, sf_dir).appointments
    pages = []
    for walk, steps in (("next", 4), ("prev", 2)):
        cursor = None
        for _ in range(steps):
            page = audit.appointments_seek(a, SEEK_REQ, None, cursor, walk == "prev").checkpoint(eager=True)
            ends = [r.cursor for r in page.select("cursor").collect()]  # one page
            cursor = (ends[-1] if walk == "next" else ends[0]) if ends else cursor
            pages.append(page.drop("cursor").withColumn("walk", F.lit(walk)))
    return reduce(lambda x, y: x.unionByName(y), pages)


TOTAL_REQ = AppointmentRequest(start="1996-01-01", end="1996-07-01", clinic_ids="3,4,9",
                               creators="Paulo Simão| carla  DIAS |", only_status="7", status_codes="7,8",
                               origins=" Instagram ,Google", pp=7)
TOTAL_ALLOWED = ["1", "2", "3", "4", " "]


@register("appointments_page_total", with_views(["appointments"], """
    SELECT 1 AS page, 10 AS pp, COUNT(*) AS total, CAST(GREATEST(1, CEIL(COUNT(*) / 10)) AS BIGINT) AS total_pages
    FROM appointments
    WHERE start_time >= TIMESTAMP '1996-01-01' AND start_time < TIMESTAMP '1996-07-01'
      AND clinic_id IN ('3','4') AND status IN (7, 8) AND status = 7
      AND patient_channel_name IN ('Instagram', 'Google')
      AND created_by_name_norm IN ('paulo simao', 'carla dias')"""), "FLT2-6 FLT15 LIM2 MTH1")
def appointments_page_total(spark, sf_dir):
    return audit.appointments_total(Tables(spark, sf_dir).appointments, TOTAL_REQ, allowed=TOTAL_ALLOWED)


SEARCH_PHONE = AppointmentRequest(start="1995-01-01", end="2002-01-01", search="(16) 0103-9598")


@register("appointments_search", with_views(["appointments"], f"""
    SELECT {_APPT_COLS} FROM appointments
    WHERE start_time >= TIMESTAMP '1995-01-01' AND start_time < TIMESTAMP '2002-01-01'
      AND (instr(patient_name_norm, '16  0103-9598') > 0 OR instr(phone_norm, '1601039598') > 0
           OR instr(phone_norm, '16901039598') > 0)"""), "FLT7 STR2 STR3 STR5 STR6")
def appointments_search(spark, sf_dir):
    df, _ = audit.filtered_appointments(Tables(spark, sf_dir).appointments, SEARCH_PHONE)
    return df.select(*audit.APPOINTMENT_COLUMNS)


SEARCH_NAME = AppointmentRequest(start="1998-01-01", end="1998-03-01", search="  JOÃO*")


@register("appointments_search_name", with_views(["appointments"], f"""
    SELECT {_APPT_COLS} FROM appointments
    WHERE start_time >= TIMESTAMP '1998-01-01' AND start_time < TIMESTAMP '1998-03-01'
      AND instr(patient_name_norm, 'joao') > 0"""), "FLT7 STR1 STR2")
def appointments_search_name(spark, sf_dir):
    df, _ = audit.filtered_appointments(Tables(spark, sf_dir).appointments, SEARCH_NAME)
    return df.select(*audit.APPOINTMENT_COLUMNS)


_LOG_SELECT = """
    SELECT l.id AS log_id, l.appointment_id, l.user_id, COALESCE(l.user_id = 'mc', FALSE) AS is_mc,
           l.from_status, l.to_status, COALESCE(l.is_reschedule, FALSE) AS is_reschedule, l.change_date AS action_at,
           a.patient_id, a.patient_name, a.clinic_id, a.start_time, a.scheduled_start_time, a.doctor_name,
           a.speciality_id, a.phone, a.created_by_name, a.type, a.campaign_token, a.channel_name,
           a.patient_channel_name, a.patient_subchannel_name
    FROM appointment_logs l JOIN appointments a ON l.appointment_id = a.id"""

CONF_REQ = LogRequest(start="1998-01-01", end="1998-03-01", kind="confirmation", is_mc="false", page=3, pp=50)


@register("audit_confirmations", with_views(["appointments", "appointment_logs"], _LOG_SELECT + """
    WHERE l.to_status = 4 AND l.change_date >= TIMESTAMP '1998-01-01' AND l.change_date < TIMESTAMP '1998-03-01'
      AND l.user_id <> 'mc'
    ORDER BY action_at DESC NULLS FIRST, log_id ASC LIMIT 50 OFFSET 100"""), "JOI1 PRJ4 FLT8 FLT9 LIM1")
def audit_confirmations(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return audit.log_events_page(t.appointment_logs, t.appointments, CONF_REQ)


RESCH_REQ = LogRequest(start="1996-01-01", end="1996-07-01", kind="reschedule", creators="Paulo Simão| paulo  SIMAO ",
                       is_mc="true", origins="Instagram, Google", clinic_ids="0,1,2,3,4,5,6,7,8,9,10,11,12")


@register("audit_reschedules", with_views(["appointments", "appointment_logs"], _LOG_SELECT + """
    WHERE l.is_reschedule AND l.change_date >= TIMESTAMP '1996-01-01' AND l.change_date < TIMESTAMP '1996-07-01'
      AND l.user_id = 'mc' AND a.created_by_name_norm = 'paulo simao'
      AND a.patient_channel_name IN ('Instagram', 'Google')
      AND a.clinic_id IN ('0','1','2','3','4','5','6','7','8','9','10','11','12')"""), "JOI1 PRJ4 FLT6 FLT8 FLT9")
def audit_reschedules(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return audit.log_events(t.appointment_logs, t.appointments, RESCH_REQ)


_SCOPE_SQL = {
    "u": """SELECT id AS user_id, allowed_clinic_ids, accounts, trim(regional) AS regional,
                   CASE WHEN COALESCE(unrestricted, FALSE) THEN 'unrestricted'
                        WHEN allowed_clinic_ids IS NOT NULL AND len(allowed_clinic_ids) > 0 THEN 'explicit'
                        WHEN trim(regional) <> '' THEN 'regional' ELSE 'accounts' END AS rule
            FROM users WHERE active""",
    "acc": "SELECT user_id, rule, unnest(accounts) AS a FROM u WHERE rule = 'accounts'",
    "scope": """
        SELECT user_id, CAST(NULL AS VARCHAR) AS clinic_id, rule FROM u WHERE rule = 'unrestricted'
        UNION
        SELECT user_id, c AS clinic_id, rule FROM (
            SELECT user_id, rule, unnest(list_filter(allowed_clinic_ids, lambda x: x IS NOT NULL AND trim(x) <> '')) AS c
            FROM u WHERE rule = 'explicit') e
        UNION
        SELECT u.user_id, un.clinic_id, u.rule FROM u JOIN units un ON un.regional = u.regional
        WHERE u.rule = 'regional' AND un.clinic_id IS NOT NULL
        UNION
        SELECT acc.user_id, un.clinic_id, acc.rule FROM acc JOIN units un ON un.account_id = acc.a.id
        WHERE acc.a.status = 'active' AND acc.a.role = 'administrator' AND un.clinic_id IS NOT NULL""",
}


@register("scope_by_user", with_views(["units", "users"], "SELECT user_id, clinic_id, rule FROM scope",
                                      extra=_SCOPE_SQL), "JOI10 FLT15")
def scope_by_user(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return scope.user_scopes(t.users, t.units)


@register("scoped_logs", with_views(["units", "users", "appointments", "appointment_logs"], """
    SELECT s.user_id, l.to_status, COUNT(*) AS logs
    FROM appointment_logs l JOIN appointments a ON l.appointment_id = a.id
    JOIN (SELECT DISTINCT user_id, clinic_id FROM scope) s
      ON s.clinic_id = a.clinic_id OR s.clinic_id IS NULL
    GROUP BY ALL""", extra=_SCOPE_SQL), "JOI2 FLT15")
def scoped_logs(spark, sf_dir):
    """Logs visible to every active user, per to_status (logs carry no clinic, so they
    are scoped through their appointment)."""
    t = Tables(spark, sf_dir)
    return scope.visible_log_counts(t.appointment_logs, t.appointments, scope.user_scopes(t.users, t.units))


ORIGIN_REQ = AppointmentRequest(start="1999-01-01", end="1999-03-01", specialty_ids="eval, sp1,",
                                suborigins=" Ads ,Friend", sort_by="status", sort_order="desc", page=1, pp=100)


@register("appointments_by_origin", with_views(["appointments"], f"""
    SELECT {_APPT_COLS} FROM appointments
    WHERE start_time >= TIMESTAMP '1999-01-01' AND start_time < TIMESTAMP '1999-03-01'
      AND speciality_id IN ('eval', 'sp1') AND patient_subchannel_name IN ('Ads', 'Friend')
    ORDER BY status DESC NULLS FIRST, id ASC LIMIT 100"""), "FLT3 FLT5 SRT1 LIM1")
def appointments_by_origin(spark, sf_dir):
    return audit.appointments_page(Tables(spark, sf_dir).appointments, ORIGIN_REQ)


RESCH_STATUS_REQ = LogRequest(start="1997-01-01", end="1997-07-01", kind="reschedule", reschedule_rule="status",
                              user_ids="op2, op3,op5, op6", sort_order="asc", page=1, pp=20)


@register("audit_reschedules_by_status", with_views(["appointments", "appointment_logs"], _LOG_SELECT + """
    WHERE l.to_status = 3 AND l.change_date >= TIMESTAMP '1997-01-01' AND l.change_date < TIMESTAMP '1997-07-01'
      AND l.user_id IN ('op2', 'op3', 'op5', 'op6')
    ORDER BY action_at ASC NULLS LAST, log_id ASC LIMIT 20"""), "FLT8 FLT9 (documented to_status rule) LIM1")
def audit_reschedules_by_status(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return audit.log_events_page(t.appointment_logs, t.appointments, RESCH_STATUS_REQ)
