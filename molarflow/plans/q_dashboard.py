"""Dashboard bundle query (AGG12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from molarflow.functions.misc import plus_days
from molarflow.operators.dashboard import build_snapshots, dashboard_bundle as bundle
from molarflow.plans.oracle_views import with_views
from molarflow.plans.params import KpiRequest
from molarflow.plans.q_attribution import _QUALIFYING
from molarflow.plans.q_kpi import _ORIGIN
from molarflow.plans.registry import Tables, register

CLINICS = [str(i) for i in range(1, 13)]
REQS = {mode: KpiRequest(start="1997-01-01", end="1997-04-01", clinic_ids=CLINICS, agent_mode=mode)
        for mode in ("all", "agent", "operators")}
REQ = REQS["agent"]
FILTERED = KpiRequest(start="1997-01-01", end="1997-04-01", clinic_ids=CLINICS, specialty_ids=["eval", "economy"],
                      status_codes=[7, 8], creators=["Paulo Simão", "Auto Agent"])
_IN = "(" + ", ".join(f"'{c}'" for c in CLINICS) + ")"
_PER = "{c} >= TIMESTAMP '1997-01-01' AND {c} < TIMESTAMP '1997-04-01'"

_TOUCHED = """(a.channel_id = 'mc_channel' OR EXISTS (SELECT 1 FROM appointment_logs g
                WHERE g.appointment_id = a.id AND g.user_id = 'mc'))"""


def _sql(mode: str, appointment_filter: str = "TRUE", payment_filter: str = "TRUE") -> str:
    touch = {"all": "TRUE", "agent": _TOUCHED, "operators": f"NOT {_TOUCHED}"}[mode]
    mine = "TRUE" if mode == "all" else f"owner = '{mode}'"
    return with_views(["appointments", "appointment_logs", "payments"], _BODY.replace("@MODE@", mode), extra=_ctes(
        touch, mine, appointment_filter, payment_filter))


def _ctes(touch: str, mine: str, appointment_filter: str, payment_filter: str) -> dict[str, str]:
    return {
    "ap": f"""SELECT * FROM appointments a WHERE {_PER.format(c='start_time')} AND clinic_id IN {_IN}
              AND {appointment_filter} AND {touch}""",
    "pa": f"SELECT * FROM payments WHERE clinic_id IN {_IN} AND {payment_filter}",
    "p": f"""SELECT id, patient_id, clinic_id, date, amount, specialty_id FROM pa
             WHERE is_confirmed AND deleted_at IS NULL AND {_PER.format(c='date')}""",
    "q": _QUALIFYING,
    "att": """SELECT p.*, CASE WHEN EXISTS (SELECT 1 FROM q WHERE q.patient_id = p.patient_id
                     AND q.start_time BETWEEN p.date - INTERVAL 30 DAY AND p.date) THEN 'agent' ELSE 'operators' END AS owner
              FROM p""",
    "mine": f"SELECT * FROM att WHERE {mine}",
    "o": _ORIGIN,
    "bm": """SELECT month, rev FROM (
               SELECT month, rev, row_number() OVER (ORDER BY rev DESC, month ASC) AS rn FROM (
                 SELECT strftime(date, '%Y-%m') AS month, SUM(amount) AS rev FROM pa
                 WHERE is_confirmed AND deleted_at IS NULL GROUP BY 1) m) r WHERE rn = 1""",
    "rs": f"""SELECT (SELECT COUNT(*) FROM appointment_logs g JOIN ap a ON g.appointment_id = a.id
                      WHERE (COALESCE(g.is_reschedule, FALSE) OR g.to_status = 3)
                        AND {_PER.format(c='g.change_date')}) AS lr,
                     (SELECT COUNT(*) FROM ap WHERE abs(epoch(start_time) - epoch(scheduled_start_time)) > 86400) AS hr""",
    "cal": """SELECT strftime(d, '%Y-%m') AS month
              FROM generate_series(TIMESTAMP '1997-01-01', TIMESTAMP '1997-03-01', INTERVAL 1 MONTH) t(d)""",
    "ma": "SELECT strftime(start_time, '%Y-%m') AS month, COUNT(*) AS n FROM ap GROUP BY 1",
    "mp": "SELECT strftime(date, '%Y-%m') AS month, SUM(amount) AS rev FROM mine GROUP BY 1",
    }

_BODY = """
    SELECT 'appointments' AS metric, 'all' AS dim, CAST(COUNT(*) AS DOUBLE) AS value FROM ap
    UNION ALL SELECT 'unique_patients', 'all', CAST(COUNT(DISTINCT patient_id) AS DOUBLE) FROM ap
    UNION ALL SELECT 'revenue_total', 'all', CAST(COALESCE(SUM(amount), 0) AS DOUBLE) FROM att
    UNION ALL SELECT 'revenue_by_owner', owner, CAST(SUM(amount) AS DOUBLE) FROM att GROUP BY owner
    UNION ALL SELECT 'revenue', '@MODE@', CAST(COALESCE(SUM(amount), 0) AS DOUBLE) FROM mine
    UNION ALL SELECT 'best_month', month, CAST(rev AS DOUBLE) FROM bm
    UNION ALL SELECT 'origin', o.origin, CAST(COUNT(DISTINCT ap.patient_id) AS DOUBLE)
              FROM ap JOIN o USING (patient_id) GROUP BY o.origin
    UNION ALL SELECT 'sales', CASE WHEN p.specialty_id = 'eval' THEN 'first_consultation'
                                   ELSE 'follow_up_' || COALESCE(o.origin, 'unclassified') END,
                     CAST(SUM(p.amount) AS DOUBLE) FROM mine p LEFT JOIN o USING (patient_id) GROUP BY 2
    UNION ALL SELECT 'reschedules', CASE WHEN lr > 0 THEN 'logs' ELSE 'heuristic' END,
                     CAST(CASE WHEN lr > 0 THEN lr ELSE hr END AS DOUBLE) FROM rs
    UNION ALL SELECT 'monthly_revenue', cal.month, CAST(COALESCE(mp.rev, 0) AS DOUBLE)
              FROM cal LEFT JOIN mp USING (month)
    UNION ALL SELECT 'monthly_appointments', cal.month, CAST(COALESCE(ma.n, 0) AS DOUBLE)
              FROM cal LEFT JOIN ma USING (month)"""

SQL = _sql("agent")


@register("dashboard_bundle", SQL, "AGG12 AGG1-7 AGG10")
def dashboard_bundle(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return bundle(spark, REQ, t.appointments, t.appointment_logs, t.payments)


def _mode_query(mode: str):
    @register(f"dashboard_bundle_{mode}", _sql(mode), "AGG12 agent mode")
    def run(spark, sf_dir):
        t = Tables(spark, sf_dir)
        return bundle(spark, REQS[mode], t.appointments, t.appointment_logs, t.payments)


_mode_query("all")
_mode_query("operators")


@register("dashboard_bundle_filtered", _sql(
    "all", """speciality_id IN ('eval', 'economy') AND status IN (7, 8)
              AND strip_accents(lower(trim(created_by_name))) IN ('paulo simao', 'auto agent')""",
    "specialty_id IN ('eval', 'economy')"), "AGG12 FLT3 FLT6")
def dashboard_bundle_filtered(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return bundle(spark, FILTERED, t.appointments, t.appointment_logs, t.payments)


@register("dashboard_bundle_snapshots", SQL, "AGG12 with whole-history inputs from snapshot tables")
def dashboard_bundle_snapshots(spark, sf_dir):
    """The same bundle, served from snapshot tables written first (in a fresh
    folder under the shared checkpoint folder): same numbers as on the fly."""
    from molarflow.streaming.ingest import new_run_dir
    t = Tables(spark, sf_dir)
    snaps = build_snapshots(spark, t.appointments, t.appointment_logs, t.payments, new_run_dir(spark, "snapshots"))
    return bundle(spark, REQ, t.appointments, t.appointment_logs, t.payments, snapshots=snaps)


@register("dashboard_bundle_live_snapshots", SQL, "AGG12 AGG3 WIN1 SNK1: snapshots that follow the changes of each merge")
def dashboard_bundle_live_snapshots(spark, sf_dir):
    """The bundle from snapshots kept by merges: every feed first comes with every fifth row wrong (moved dates, other
    patients, flipped confirmations, foreign agent logs), then a second merge puts these rows right."""
    from molarflow import schemas
    from molarflow.session import passing
    from molarflow.sinks.versioned import VersionedTable
    from molarflow.streaming.ingest import new_run_dir
    from molarflow.streaming.snapshots import LiveSnapshots, changed_rows
    t = Tables(spark, sf_dir)
    base = new_run_dir(spark, "live-snapshots")
    live = LiveSnapshots(spark, f"{base}/snapshots")
    pick = F.pmod(F.xxhash64("id"), F.lit(5)) == 0

    def wrong(df, **values):
        return df.withColumns({c: F.when(pick, v).otherwise(F.col(c)) for c, v in values.items()})

    feeds = {
        "appointments": (t.appointments, "start_time", "clinic_id", dict(
            start_time=plus_days("start_time", -400), patient_id=F.col("patient_id") + 1, campaign_token=F.lit("x"), status=F.lit(8))),
        "appointment_logs": (t.appointment_logs.dropDuplicates(["id"]), "change_date", None, dict(
            user_id=F.when(F.col("user_id") == "mc", F.lit("op1")).otherwise(F.lit("mc")))),
        "payments": (t.payments.dropDuplicates(["id"]), "date", "clinic_id", dict(
            date=plus_days("date", 45), is_confirmed=~F.col("is_confirmed"), specialty_id=F.lit(None).cast("string"))),
    }
    stored = {}
    for name, (rows, date_col, unit_col, values) in feeds.items():
        stored[name] = VersionedTable(spark, f"{base}/{name}", schemas.FEEDS[name][0], ["id"], date_col, unit_col)
        for change, batch in enumerate((wrong(rows, **values), rows.where(pick)), 1):
            with passing(spark) as keep:
                old, new = changed_rows(stored[name], keep(batch, "merged"), F.lit(1), f"{base}/changes/{name}-{change}")
                if name == "payments":
                    live.payments_changed(change, old, new)
                elif name == "appointments":
                    live.appointments_changed(old, new)
                else:
                    live.logs_changed(old, new)
    return bundle(spark, REQ, stored["appointments"].read(), stored["appointment_logs"].read(), stored["payments"].read(),
                  snapshots=live.read())
