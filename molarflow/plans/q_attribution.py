"""Attribution queries (JOI5-8, AGG4, FLT12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from molarflow.config import DEFAULT_DOMAIN as D
from molarflow.functions.misc import year_month
from molarflow.operators import attribution as att
from molarflow.plans.oracle_views import with_views
from molarflow.plans.registry import Tables, register

_QUALIFYING = f"""
    SELECT a.id, a.patient_id, a.start_time FROM appointments a
    WHERE a.speciality_id = '{D.eval_specialty_id}' AND a.status IN (7, 8)
      AND a.patient_id IS NOT NULL AND a.start_time IS NOT NULL
      AND (a.channel_id IN ('mc_channel')
           OR EXISTS (SELECT 1 FROM appointment_logs l WHERE l.appointment_id = a.id AND l.user_id = '{D.agent_user_id}'))"""

_PAID = "SELECT id, patient_id, clinic_id, date, amount FROM payments WHERE is_confirmed AND deleted_at IS NULL"

SQL_FLAGSHIP = with_views(["appointments", "appointment_logs", "payments"], """
    SELECT clinic_id, strftime(date, '%Y-%m') AS month,
           CASE WHEN is_agent THEN 'agent' ELSE 'operators' END AS owner,
           CAST(SUM(amount) AS DOUBLE) AS revenue, COUNT(*) AS payments
    FROM f GROUP BY ALL""", extra={
    "q": _QUALIFYING,
    "p": _PAID,
    "f": """SELECT p.*, EXISTS (SELECT 1 FROM q WHERE q.patient_id = p.patient_id
                 AND q.start_time BETWEEN p.date - INTERVAL 30 DAY AND p.date) AS is_agent FROM p""",
})


@register("attribution_v4_by_clinic_month", SQL_FLAGSHIP, "JOI5 JOI6 AGG4 FLT12")
def attribution_v4_by_clinic_month(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return att.attribution_by_clinic_month(t.payments, t.appointments, t.appointment_logs)


# V2: latest attended appointment (any specialty) within the window decides.
SQL_V2 = with_views(["appointments", "appointment_logs", "payments"], """
    SELECT clinic_id, strftime(date, '%Y-%m') AS month, owner,
           CAST(SUM(amount) AS DOUBLE) AS revenue, COUNT(*) AS payments
    FROM f GROUP BY ALL""", extra={
    "t": f"""SELECT a.id, a.patient_id, a.start_time,
                (a.channel_id IN ('mc_channel') OR EXISTS (SELECT 1 FROM appointment_logs l
                   WHERE l.appointment_id = a.id AND l.user_id = '{D.agent_user_id}')) AS touched
             FROM appointments a WHERE a.status IN (7, 8) AND a.patient_id IS NOT NULL AND a.start_time IS NOT NULL""",
    "p": _PAID,
    "g": """SELECT p.*, (SELECT arg_max(t.touched, t.start_time::VARCHAR || '|' || lpad(t.id::VARCHAR, 20, '0'))
                          FROM t WHERE t.patient_id = p.patient_id
                            AND t.start_time BETWEEN p.date - INTERVAL 30 DAY AND p.date) AS last_touched
            FROM p""",
    "f": """SELECT *, CASE WHEN last_touched IS NULL THEN 'unattributed' WHEN last_touched THEN 'agent'
                          ELSE 'operators' END AS owner FROM g""",
})


@register("attribution_v2_asof", SQL_V2, "JOI7")
def attribution_v2_asof(spark, sf_dir):
    t = Tables(spark, sf_dir)
    paid = att.confirmed_payments(t.payments).select("patient_id", "clinic_id", "date", "amount")
    a = att.attribute_v2(paid, t.appointments, t.appointment_logs).withColumn("month", year_month("date"))
    return att.revenue_by_owner(a, "clinic_id", "month")


# V1/V3/V4 side by side per month (comparison report).
SQL_COMPARE = with_views(["appointments", "appointment_logs", "payments"], """
    SELECT rule, strftime(date, '%Y-%m') AS month, owner, CAST(SUM(amount) AS DOUBLE) AS revenue, COUNT(*) AS payments
    FROM (
      SELECT 'v1' AS rule, p.date, p.amount,
             CASE WHEN fc.agent AND fc.start_time <= p.date THEN 'agent' ELSE 'operators' END AS owner
      FROM p LEFT JOIN fc ON fc.patient_id = p.patient_id
      UNION ALL
      SELECT 'v3', p.date, p.amount,
             CASE WHEN EXISTS (SELECT 1 FROM anyt WHERE anyt.patient_id = p.patient_id
                  AND anyt.start_time BETWEEN p.date - INTERVAL 30 DAY AND p.date) THEN 'agent' ELSE 'operators' END
      FROM p
      UNION ALL
      SELECT 'v4', p.date, p.amount,
             CASE WHEN EXISTS (SELECT 1 FROM q WHERE q.patient_id = p.patient_id
                  AND q.start_time BETWEEN p.date - INTERVAL 30 DAY AND p.date) THEN 'agent' ELSE 'operators' END
      FROM p) x
    GROUP BY ALL""", extra={
    "q": _QUALIFYING,
    "p": _PAID,
    "touch": f"""SELECT a.id, a.patient_id, a.start_time, a.status,
                   (a.channel_id IN ('mc_channel') OR EXISTS (SELECT 1 FROM appointment_logs l
                      WHERE l.appointment_id = a.id AND l.user_id = '{D.agent_user_id}')) AS agent
                 FROM appointments a WHERE a.patient_id IS NOT NULL AND a.start_time IS NOT NULL""",
    "anyt": "SELECT * FROM touch WHERE agent",
    "fc": """SELECT patient_id, start_time, agent FROM (
               SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY start_time, id) AS rn
               FROM touch WHERE status = 8) z WHERE rn = 1""",
})


@register("attribution_rules_compare", SQL_COMPARE, "JOI8 (V1, V3 vs V4)")
def attribution_rules_compare(spark, sf_dir):
    t = Tables(spark, sf_dir)
    paid = att.confirmed_payments(t.payments).select("patient_id", "clinic_id", "date", "amount")
    appts, logs = t.appointments, t.appointment_logs
    names = ("v1", "v3", "v4")
    rules = F.explode(F.array(*[F.struct(F.lit(v).alias("rule"), F.col(f"owner_{v}").alias("owner")) for v in names]))
    u = att.attribute_rules(paid, appts, logs, rules=names).select("date", "amount", rules.alias("_r"))
    u = u.select("date", "amount", "_r.rule", "_r.owner").withColumn("month", year_month("date"))
    return att.revenue_by_owner(u, "rule", "month")


@register("attribution_v4_seams", SQL_FLAGSHIP, "JOI5 JOI6 AGG4: patients of any size split by range partitions with seams")
def attribution_v4_seams(spark, sf_dir):
    t = Tables(spark, sf_dir)
    paid = att.confirmed_payments(t.payments).select("patient_id", "clinic_id", "date", "amount")
    owned = att.attribute_v4(paid, t.appointments, t.appointment_logs, seams=True).withColumn("month", year_month("date"))
    return att.revenue_by_owner(owned, "clinic_id", "month")


@register("attribution_v2_seams", SQL_V2, "JOI7: patients of any size split by range partitions with seams")
def attribution_v2_seams(spark, sf_dir):
    t = Tables(spark, sf_dir)
    paid = att.confirmed_payments(t.payments).select("patient_id", "clinic_id", "date", "amount")
    a = att.attribute_v2(paid, t.appointments, t.appointment_logs, seams=True).withColumn("month", year_month("date"))
    return att.revenue_by_owner(a, "clinic_id", "month")
