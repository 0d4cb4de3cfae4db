"""Funnel queries (JOI3, JOI4, AGG9, LIM3, FLT10, FLT16, STR4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from molarflow.operators import funnel
from molarflow.plans.oracle_views import fold_sql, phone_key_sql, with_views
from molarflow.plans.params import FunnelRequest
from molarflow.plans.registry import Tables, register

REQ = FunnelRequest(start="1996-01-01", end="1996-04-01", min_lead_created_at="1996-01-15",
                    stage="attended", limit=50, offset=10)
(S, E), MIN_LEAD = REQ.bounds, REQ.min_lead

def funnel_ctes(start: str, end: str, min_lead: str | None) -> dict[str, str]:
    """DuckDB CTEs of the lead stage flags for one period (dates as 'YYYY-MM-DD')."""
    lo = max(start, min_lead) if min_lead else start
    return {
        "ld": f"""SELECT *, {phone_key_sql('phone_raw')} AS pk FROM leads
                  WHERE list_contains(labels, 'campanha')
                    AND created_at_cw >= TIMESTAMP '{lo}' AND created_at_cw < TIMESTAMP '{end}'""",
        "ap": f"""SELECT a.id, a.patient_id, a.created_at, a.status, {phone_key_sql('a.phone')} AS pk,
                         (a.status IN (7, 8) OR EXISTS (SELECT 1 FROM appointment_logs l
                                                       WHERE l.appointment_id = a.id AND l.to_status = 4)) AS conf
                  FROM appointments a WHERE a.created_at IS NOT NULL""",
        "paid": f"""SELECT patient_id, date FROM payments
                    WHERE is_confirmed AND deleted_at IS NULL AND patient_id IS NOT NULL
                      AND date >= TIMESTAMP '{start}' AND date < TIMESTAMP '{end}'""",
        "fl": """SELECT ld.*,
                   EXISTS (SELECT 1 FROM ap WHERE ap.pk = ld.pk AND ap.created_at >= ld.created_at_cw) AS scheduled,
                   EXISTS (SELECT 1 FROM ap WHERE ap.pk = ld.pk AND ap.created_at >= ld.created_at_cw
                           AND ap.conf) AS confirmed,
                   EXISTS (SELECT 1 FROM ap WHERE ap.pk = ld.pk AND ap.created_at >= ld.created_at_cw
                           AND ap.status IN (7, 8)) AS attended,
                   EXISTS (SELECT 1 FROM ap JOIN paid ON paid.patient_id = ap.patient_id
                           WHERE ap.pk = ld.pk AND ap.created_at >= ld.created_at_cw
                             AND paid.date >= ld.created_at_cw) AS sold
                 FROM ld""",
    }


_FUNNEL_CTES = funnel_ctes("1996-01-01", "1996-04-01", "1996-01-15")

_PCT = ", ".join(f"ROUND(100.0 * COUNT(*) FILTER (WHERE {s}) / NULLIF(COUNT(*), 0), 2) AS {s}_pct"
                 for s in funnel.STAGES[1:])


@register("funnel_counts", with_views(["appointments", "appointment_logs", "payments", "leads"], f"""
    SELECT COUNT(*) AS leads, COUNT(*) FILTER (WHERE scheduled) AS scheduled,
           COUNT(*) FILTER (WHERE confirmed) AS confirmed, COUNT(*) FILTER (WHERE attended) AS attended,
           COUNT(*) FILTER (WHERE sold) AS sold, {_PCT}
    FROM fl""", extra=_FUNNEL_CTES), "JOI3 JOI4 AGG9 FLT10 FLT16 STR4")
def funnel_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    st = funnel.lead_stages(t.leads, t.appointments, t.appointment_logs, t.payments, S, E, MIN_LEAD)
    return funnel.funnel_counts(st)


@register("funnel_detail_stage", with_views(["appointments", "appointment_logs", "payments", "leads"], """
    SELECT id, account_id, name, phone_raw, created_at_cw, scheduled, confirmed, attended, sold FROM fl
    WHERE attended ORDER BY created_at_cw DESC NULLS FIRST, id ASC, account_id ASC LIMIT 50 OFFSET 10""",
    extra=_FUNNEL_CTES), "LIM3")
def funnel_detail_stage(spark, sf_dir):
    t = Tables(spark, sf_dir)
    st = funnel.lead_stages(t.leads, t.appointments, t.appointment_logs, t.payments, S, E, MIN_LEAD)
    return funnel.funnel_detail(st, REQ.stage, limit=REQ.limit, offset=REQ.offset)


SEARCH_REQ = FunnelRequest(start="1995-06-01", end="1995-08-30", min_lead_created_at=None, stage="leads",
                           search="21 0107-9193")
DS, DE = SEARCH_REQ.bounds


@register("funnel_detail_search", with_views(["appointments", "appointment_logs", "payments", "leads"], f"""
    SELECT id, account_id, name, phone_raw, created_at_cw, scheduled, confirmed, attended, sold FROM fl
    WHERE instr({fold_sql('name')}, '21 0107-9193') > 0
       OR instr(regexp_replace(phone_raw, '[^0-9]', '', 'g'), '2101079193') > 0
       OR instr(regexp_replace(phone_raw, '[^0-9]', '', 'g'), '21901079193') > 0
    ORDER BY created_at_cw DESC NULLS FIRST, id ASC, account_id ASC LIMIT 100""",
    extra=funnel_ctes("1995-06-01", "1995-08-30", None)), "LIM3 FLT7 FLT16")
def funnel_detail_search(spark, sf_dir):
    """Drill-down of the 'leads' stage with a phone search (no bulk-import cut)."""
    t = Tables(spark, sf_dir)
    st = funnel.lead_stages(t.leads, t.appointments, t.appointment_logs, t.payments, DS, DE, SEARCH_REQ.min_lead)
    return funnel.funnel_detail(st, SEARCH_REQ.stage, search=SEARCH_REQ.search, limit=SEARCH_REQ.limit,
                                offset=SEARCH_REQ.offset)


_ORIGIN_CTES = funnel_ctes("1995-06-01", "1995-08-30", "1995-06-01")
_ORIGIN_CTES["ld"] += " AND erp_clinic_id IN ('1','2','3','4','5','6','7','8','9','10')"
_ORIGIN_CTES["ap"] = _ORIGIN_CTES["ap"].replace("SELECT a.id, a.patient_id,",
                                                "SELECT a.id, a.patient_id, a.patient_channel_name,")
ORIGIN_PARAMS = {"start": "1995-06-01", "end": "1995-08-30", "min_lead_created_at": "1995-06-01",
                 "stage": "leads", "origem": "Instagram, Google", "clinic_ids": "1,2,3,4,5,6,7,8,9,10",
                 "limit": "100"}


@register("funnel_detail_origin", with_views(["appointments", "appointment_logs", "payments", "leads"], """
    SELECT id, account_id, name, phone_raw, created_at_cw, scheduled, confirmed, attended, sold FROM fl
    WHERE EXISTS (SELECT 1 FROM ap WHERE ap.pk = fl.pk AND ap.created_at >= fl.created_at_cw
                    AND ap.patient_channel_name IN ('Instagram', 'Google'))
    ORDER BY created_at_cw DESC NULLS FIRST, id ASC, account_id ASC LIMIT 100""", extra=_ORIGIN_CTES),
    "LIM3 FLT5 FLT15 (drill-down through the request surface)")
def funnel_detail_origin(spark, sf_dir):
    """The drill-down as the dashboard calls it: clinic scope, origin filter, limit."""
    from molarflow.plans import api
    return api.funnel_detail(Tables(spark, sf_dir), ORIGIN_PARAMS)


@register("funnel_year", with_views(["appointments", "appointment_logs", "payments", "leads"], """
    SELECT COUNT(*) AS leads, COUNT(*) FILTER (WHERE scheduled) AS scheduled, COUNT(*) FILTER (WHERE sold) AS sold,
           COUNT(*) FILTER (WHERE length(pk) < 8) AS short_phones FROM fl""",
    extra=funnel_ctes("1995-07-01", "1996-05-30", None)), "AGG9 FLT2 STR4")
def funnel_year(spark, sf_dir):
    """A funnel over 334 days, phones of under eight digits included."""
    t = Tables(spark, sf_dir)
    req = FunnelRequest(start="1995-07-01", end="1996-05-30", min_lead_created_at=None)
    st = funnel.lead_stages(t.leads, t.appointments, t.appointment_logs, t.payments, *req.bounds, req.min_lead)
    return st.agg(F.count(F.lit(1)).alias("leads"), F.count_if("scheduled").alias("scheduled"), F.count_if("sold").alias("sold"),
                  F.count_if(F.length("phone_key") < 8).alias("short_phones"))
