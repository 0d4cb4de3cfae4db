"""Dashboard KPI queries (AGG1-3, AGG5-7, AGG10-13, WIN1, WIN2, WIN5, SET2, PRJ5, PRJ6, FLT14)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from molarflow.config import STATUS_NAMES
from molarflow.operators import kpi
from molarflow.operators.filters import in_period, year_or_null
from molarflow.plans.oracle_views import fold_sql, sql_str, with_views
from molarflow.plans.registry import Tables, register

S, E = dt.datetime(1997, 1, 1), dt.datetime(1997, 4, 1)
_PER_A = "start_time >= TIMESTAMP '1997-01-01' AND start_time < TIMESTAMP '1997-04-01'"
_PER_P = "date >= TIMESTAMP '1997-01-01' AND date < TIMESTAMP '1997-04-01'"
_PAID = "is_confirmed AND deleted_at IS NULL"
_ORIGIN = """SELECT patient_id,
                 CASE WHEN campaign_token IS NOT NULL AND trim(campaign_token) <> '' THEN 'campaign' ELSE 'organic' END AS origin
             FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY start_time ASC NULLS LAST, id ASC) AS rn
                   FROM appointments WHERE patient_id IS NOT NULL) z WHERE rn = 1"""


@register("unique_patients", with_views(["appointments"], f"""
    SELECT clinic_id, COUNT(DISTINCT patient_id) AS unique_patients, COUNT(*) AS appointments
    FROM appointments WHERE {_PER_A} GROUP BY clinic_id"""), "AGG1")
def unique_patients(spark, sf_dir):
    a = Tables(spark, sf_dir).appointments.where(in_period("start_time", S, E))
    return kpi.unique_patients(a, "clinic_id")


@register("revenue_period", with_views(["payments"], f"""
    SELECT clinic_id, CAST(SUM(amount) AS DOUBLE) AS revenue, COUNT(*) AS payments
    FROM payments WHERE {_PAID} AND {_PER_P} GROUP BY clinic_id"""), "AGG2 FLT12")
def revenue_period(spark, sf_dir):
    p = Tables(spark, sf_dir).payments.where(in_period("date", S, E))
    return kpi.revenue(p, "clinic_id")


@register("best_month", with_views(["payments"], f"""
    SELECT clinic_id, month AS best_month, CAST(rev AS DOUBLE) AS revenue FROM (
        SELECT *, row_number() OVER (PARTITION BY clinic_id ORDER BY rev DESC, month ASC) AS rn FROM (
            SELECT clinic_id, strftime(date, '%Y-%m') AS month, SUM(amount) AS rev
            FROM payments WHERE {_PAID} GROUP BY ALL) m) r
    WHERE rn = 1"""), "AGG3")
def best_month(spark, sf_dir):
    return kpi.best_month(Tables(spark, sf_dir).payments, "clinic_id")


MS, ME = dt.datetime(1996, 2, 15), dt.datetime(1996, 5, 10)


@register("monthly_series", with_views(["appointments", "payments"], """
    SELECT cal.month, COALESCE(a.appointments, 0) AS appointments, COALESCE(a.unique_patients, 0) AS unique_patients,
           COALESCE(p.revenue, 0.0) AS revenue
    FROM cal LEFT JOIN a USING (month) LEFT JOIN p USING (month)""", extra={
    "cal": """SELECT strftime(d, '%Y-%m') AS month
              FROM generate_series(TIMESTAMP '1996-02-01', TIMESTAMP '1996-05-01', INTERVAL 1 MONTH) t(d)""",
    "a": """SELECT strftime(start_time, '%Y-%m') AS month, COUNT(*) AS appointments,
                   COUNT(DISTINCT patient_id) AS unique_patients
            FROM appointments WHERE start_time >= TIMESTAMP '1996-02-15' AND start_time < TIMESTAMP '1996-05-10'
            GROUP BY 1""",
    "p": f"""SELECT strftime(date, '%Y-%m') AS month, CAST(SUM(amount) AS DOUBLE) AS revenue
             FROM payments WHERE {_PAID} AND date >= TIMESTAMP '1996-02-15' AND date < TIMESTAMP '1996-05-10'
             GROUP BY 1""",
}), "AGG10")
def monthly_series(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return kpi.monthly_series(spark, MS, ME, t.appointments, t.payments)


@register("patient_origin", with_views(["appointments"], f"""
    SELECT a.clinic_id, o.origin, COUNT(DISTINCT a.patient_id) AS patients
    FROM appointments a JOIN o USING (patient_id) WHERE {_PER_A} GROUP BY ALL""", extra={"o": _ORIGIN}),
    "WIN1 AGG5 CND1")
def patient_origin(spark, sf_dir):
    t = Tables(spark, sf_dir)
    appts = t.appointments
    return kpi.origin_mix(appts.where(in_period("start_time", S, E)), kpi.first_appointment_origin(appts), "clinic_id")


@register("sales_first_vs_followup", with_views(["appointments", "payments"], f"""
    SELECT CASE WHEN p.specialty_id = 'eval' THEN 'first_consultation'
                ELSE 'follow_up_' || COALESCE(o.origin, 'unclassified') END AS category,
           CAST(SUM(p.amount) AS DOUBLE) AS revenue, COUNT(*) AS payments
    FROM payments p LEFT JOIN o USING (patient_id) WHERE {_PAID} AND {_PER_P} GROUP BY ALL""",
    extra={"o": _ORIGIN}), "AGG6")
def sales_first_vs_followup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return kpi.sales_split(t.payments.where(in_period("date", S, E)), kpi.first_appointment_origin(t.appointments))


@register("reschedules_two_level", with_views(["appointments", "appointment_logs"], """
    SELECT clinic_id, heuristic_reschedules, log_reschedules, strategy,
           CASE WHEN strategy = 'logs' THEN log_reschedules ELSE heuristic_reschedules END AS reschedules
    FROM (SELECT COALESCE(h.clinic_id, l.clinic_id) AS clinic_id,
                 COALESCE(h.heuristic_reschedules, 0) AS heuristic_reschedules,
                 COALESCE(l.log_reschedules, 0) AS log_reschedules,
                 CASE WHEN MAX(COALESCE(l.log_reschedules, 0)) OVER () > 0 THEN 'logs' ELSE 'heuristic' END AS strategy
          FROM h FULL JOIN l ON h.clinic_id = l.clinic_id) x""", extra={
    "ap": f"SELECT * FROM appointments WHERE {_PER_A}",
    "l": """SELECT a.clinic_id, COUNT(*) AS log_reschedules FROM appointment_logs g JOIN ap a ON g.appointment_id = a.id
            WHERE (COALESCE(g.is_reschedule, FALSE) OR g.to_status = 3)
              AND g.change_date >= TIMESTAMP '1997-01-01' AND g.change_date < TIMESTAMP '1997-04-01'
            GROUP BY ALL""",
    "h": """SELECT clinic_id, COUNT(*) FILTER (WHERE abs(epoch(start_time) - epoch(scheduled_start_time)) > 86400)
                   AS heuristic_reschedules FROM ap GROUP BY ALL""",
}), "AGG7 DAT4")
def reschedules_two_level(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = t.appointments.where(in_period("start_time", S, E))
    lg = t.appointment_logs.where(in_period("change_date", S, E))
    return kpi.reschedules_two_level(a, lg, "clinic_id")


@register("reschedules_heuristic", with_views(["appointments"], f"""
    SELECT COUNT(*) FILTER (WHERE abs(epoch(start_time) - epoch(scheduled_start_time)) > 86400) AS reschedules,
           'heuristic' AS strategy FROM appointments WHERE {_PER_A}"""), "AGG7 DAT4")
def reschedules_heuristic(spark, sf_dir):
    """Reschedules of a scope whose logs carry no reschedule at all: counted by the gap between the two starts."""
    t = Tables(spark, sf_dir)
    silent = t.appointment_logs.where((F.col("to_status") != 3) & ~F.coalesce(F.col("is_reschedule"), F.lit(False)))
    a = t.appointments.where(in_period("start_time", S, E))
    return kpi.reschedules_two_level(a, silent.where(in_period("change_date", S, E))).select("reschedules", "strategy")


def _last_sql(cond: str) -> str:
    return f"""SELECT appointment_id, user_id FROM (
                 SELECT *, row_number() OVER (PARTITION BY appointment_id ORDER BY change_date DESC NULLS LAST, id DESC) AS rn
                 FROM lg WHERE {cond}) z WHERE rn = 1"""


_ACTOR = "CASE WHEN COALESCE({c} = 'mc', FALSE) THEN 'agent' ELSE 'operators' END"


@register("action_ownership", with_views(["appointments", "appointment_logs"], f"""
    SELECT kind, actor, COUNT(*) AS appointments FROM (
        SELECT 'creation' AS kind, {_ACTOR.format(c='created_by_id')} AS actor FROM ap
        UNION ALL SELECT 'confirmation', {_ACTOR.format(c='user_id')} FROM conf
        UNION ALL SELECT 'reschedule', {_ACTOR.format(c='user_id')} FROM resch) x
    GROUP BY ALL""", extra={
    "ap": f"SELECT id, created_by_id FROM appointments WHERE {_PER_A}",
    "lg": "SELECT * FROM appointment_logs WHERE appointment_id IN (SELECT id FROM ap)",
    "conf": _last_sql("to_status = 4"),
    "resch": _last_sql("COALESCE(is_reschedule, FALSE) OR to_status = 3"),
}), "AGG11 WIN2")
def action_ownership(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return kpi.action_ownership(t.appointments.where(in_period("start_time", S, E)), t.appointment_logs)


@register("rescue_candidates", with_views(["appointments"], """
    SELECT l.patient_id, l.id AS appointment_id, l.start_time, p.status AS prior_status,
           (epoch(l.start_time) - epoch(p.start_time)) / 86400.0 AS gap_days
    FROM r l JOIN r p ON l.patient_id = p.patient_id AND l.rn = 1 AND p.rn = 2
    WHERE p.status IN (5, 11) AND (epoch(l.start_time) - epoch(p.start_time)) / 86400.0 > 60""", extra={
    "r": """SELECT patient_id, id, start_time, status,
                   row_number() OVER (PARTITION BY patient_id ORDER BY start_time DESC NULLS LAST, id DESC) AS rn
            FROM appointments WHERE patient_id IS NOT NULL""",
}), "WIN5")
def rescue_candidates(spark, sf_dir):
    return kpi.rescue_candidates(Tables(spark, sf_dir).appointments, 60)


FILL_COLUMNS = ("patient_name", "doctor_name", "created_by_name", "phone", "campaign_token",
                "patient_subchannel_name", "created_by_name_norm", "phone_norm")


@register("fill_profile", with_views(["appointments"], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT({c}) AS filled, COUNT(*) AS total FROM appointments" for c in FILL_COLUMNS)),
    "AGG13")
def fill_profile(spark, sf_dir):
    return kpi.fill_profile(Tables(spark, sf_dir).appointments, list(FILL_COLUMNS))


@register("specialty_dim", with_views(["payments"], f"""
    SELECT specialty_id, specialty_name, sort_key FROM (
        SELECT specialty_id, specialty_name, {fold_sql('specialty_name')} AS sort_key,
               row_number() OVER (PARTITION BY specialty_id
                                  ORDER BY {fold_sql('specialty_name')} ASC NULLS LAST, specialty_name ASC NULLS LAST) AS rn
        FROM payments WHERE specialty_id IS NOT NULL) z WHERE rn = 1"""), "SET2 SRT2")
def specialty_dim(spark, sf_dir):
    return kpi.specialty_dim(Tables(spark, sf_dir).payments)


@register("clinic_dim", with_views(["units"], """
    SELECT clinic_id, name, COALESCE(CASE WHEN regional <> '' THEN regional END, 'SP') AS regional
    FROM units WHERE clinic_id IS NOT NULL"""), "PRJ5 SRT2 SRC4")
def clinic_dim(spark, sf_dir):
    return kpi.clinic_dim(Tables(spark, sf_dir).units)


_STATUS_VALUES = ", ".join(f"({i}, {sql_str(n)})" for i, n in STATUS_NAMES)


@register("status_dim", with_views(["appointments"], f"""
    SELECT a.status, COALESCE(s.name, 'unknown') AS status_name, COUNT(*) AS appointments
    FROM appointments a LEFT JOIN (VALUES {_STATUS_VALUES}) s(id, name) ON a.status = s.id GROUP BY ALL"""), "PRJ6")
def status_dim(spark, sf_dir):
    return kpi.status_counts(spark, Tables(spark, sf_dir).appointments)


@register("year_filter", with_views(["payments"], """
    SELECT strftime(date, '%Y') AS year, COUNT(*) AS payments, CAST(SUM(amount) AS DOUBLE) AS amount
    FROM payments WHERE deleted_at IS NULL OR year(deleted_at) = 1997 GROUP BY 1"""), "FLT14")
def year_filter(spark, sf_dir):
    p = Tables(spark, sf_dir).payments.where(year_or_null("deleted_at", 1997))
    return p.groupBy(F.date_format("date", "yyyy").alias("year")).agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount").cast("double").alias("amount"))
