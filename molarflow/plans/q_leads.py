"""Lead ingestion, merge, reconcile and sync-state queries (SET1, SET3, PRJ2, PRJ3, WIN3, WIN4,
SNK1-3, SNK5-7, ARR2, FLT11, FLT13, JOI9, AGG8, AGG14-16, STR8, DAT1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from molarflow.functions.misc import lookback_bound
from molarflow.operators import leads as ld
from molarflow.operators.filters import in_period
from molarflow.plans.oracle_views import with_views
from molarflow.plans.registry import Tables, register
from molarflow.sinks import merge

_LEAD_COLS = ", ".join(ld.LEAD_COLUMNS)


def _blank(x: str) -> str:
    return f"CASE WHEN {x} <> '' THEN {x} END"


def _epoch(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL AND {x} <> 0 THEN make_timestamp(CAST({x} AS BIGINT) * 1000000) END"


_INBOX = "CASE WHEN inbox_id IS NOT NULL AND inbox_id <> 0 THEN [inbox_id] ELSE CAST([] AS INTEGER[]) END"
_CONV_CREATED = ("CASE WHEN regexp_full_match(trim(created_at), '-?[0-9]+([.][0-9]+)?') "
                 "THEN make_timestamp(CAST(CAST(trim(created_at) AS DOUBLE) AS BIGINT) * 1000000) "
                 "ELSE TRY_CAST(trim(created_at) AS TIMESTAMP) END")


def _contact_lead(src: int, where: str) -> str:
    return f"""SELECT id, account_id, {_blank('name')} AS name, {_blank('email')} AS email,
                      {_blank('phone_number')} AS phone_raw, {_blank('identifier')} AS identifier,
                      ['campanha'] AS labels, {_epoch('created_at')} AS created_at_cw,
                      {_epoch('last_activity_at')} AS last_activity_at, {_INBOX} AS inbox_ids, {src} AS source
               FROM crm_contacts WHERE {where}"""


def _conversation_ctes(suffix: str, where: str) -> dict[str, str]:
    """CTEs cv, cv2 and s2 (+ suffix): leads of the tagged conversations that satisfy `where`."""
    return {
        f"cv{suffix}": f"""SELECT *, {_CONV_CREATED} AS created_ts FROM crm_conversations
              WHERE list_contains(labels, 'campanha') AND sender_id IS NOT NULL AND sender_id <> 0 AND {where}""",
        f"cv2{suffix}": f"""SELECT *, COALESCE({_epoch('last_activity_at')}, created_ts) AS last_ts,
                      row_number() OVER (PARTITION BY account_id, sender_id
                                         ORDER BY COALESCE({_epoch('last_activity_at')}, created_ts) DESC NULLS LAST,
                                                  id DESC) AS rn
               FROM cv{suffix}""",
        f"s2{suffix}": f"""SELECT sender_id AS id, account_id, {_blank('sender_name')} AS name, {_blank('sender_email')} AS email,
                     {_blank('sender_phone')} AS phone_raw, {_blank('sender_identifier')} AS identifier,
                     ['campanha'] AS labels, created_ts AS created_at_cw, last_ts AS last_activity_at,
                     {_INBOX} AS inbox_ids, 2 AS source
              FROM cv2{suffix} WHERE rn = 1""",
    }


UNION_CTES = {
    "s1": _contact_lead(1, "list_contains(labels, 'campanha')"),
    "s3": _contact_lead(3, "ad_origin IS NOT NULL AND trim(ad_origin) <> ''"),
    **_conversation_ctes("", "TRUE"),
    "un": """SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY id, account_id ORDER BY source DESC) AS rk
                FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3) a) b WHERE rk = 1""",
    "lu": """SELECT un.id, un.account_id, units.clinic_id AS erp_clinic_id, un.name, un.email, un.phone_raw,
                    un.identifier, un.labels, un.created_at_cw, un.last_activity_at, un.inbox_ids, un.source
             FROM un LEFT JOIN units ON units.account_id = un.account_id""",
}
_UNION_VIEWS = ["units", "crm_contacts", "crm_conversations"]


def _union(t):
    return ld.lead_union(t.crm_contacts, t.crm_conversations, t.units)


@register("leads_union_latest", with_views(_UNION_VIEWS, f"SELECT {_LEAD_COLS}, source FROM lu", extra=UNION_CTES),
          "SET1 PRJ2 PRJ3 WIN3 WIN4 ARR1 NUL1 DAT1")
def leads_union_latest(spark, sf_dir):
    return _union(Tables(spark, sf_dir))


@register("leads_upsert", with_views(_UNION_VIEWS + ["leads"], """
    SELECT COALESCE(n.id, o.id) AS id, COALESCE(n.account_id, o.account_id) AS account_id,
           CASE WHEN n.id IS NOT NULL THEN n.erp_clinic_id ELSE o.erp_clinic_id END AS erp_clinic_id,
           CASE WHEN n.id IS NOT NULL THEN n.name ELSE o.name END AS name,
           CASE WHEN n.id IS NOT NULL THEN n.email ELSE o.email END AS email,
           CASE WHEN n.id IS NOT NULL THEN n.phone_raw ELSE o.phone_raw END AS phone_raw,
           CASE WHEN n.id IS NOT NULL THEN n.identifier ELSE o.identifier END AS identifier,
           CASE WHEN n.id IS NOT NULL THEN n.labels ELSE o.labels END AS labels,
           CASE WHEN o.id IS NOT NULL THEN o.created_at_cw ELSE n.created_at_cw END AS created_at_cw,
           CASE WHEN n.id IS NOT NULL THEN n.last_activity_at ELSE o.last_activity_at END AS last_activity_at,
           CASE WHEN n.id IS NOT NULL THEN n.inbox_ids ELSE o.inbox_ids END AS inbox_ids
    FROM leads o FULL JOIN lu n ON o.id = n.id AND o.account_id = n.account_id""", extra=UNION_CTES),
    "SNK1 SNK3")
def leads_upsert(spark, sf_dir):
    """Full-refresh batch merged into the stored leads; created_at_cw is insert-only."""
    t = Tables(spark, sf_dir)
    batch = _union(t).drop("source")
    return merge.upsert(t.leads.select(*ld.LEAD_COLUMNS), batch, ["id", "account_id"], preserve=["created_at_cw"])


@register("leads_to_tag", with_views(["crm_contacts"], """
    SELECT account_id, id, labels AS labels_before, list_concat(labels, ['campanha']) AS labels_after
    FROM crm_contacts
    WHERE ad_origin IS NOT NULL AND trim(ad_origin) <> '' AND NOT list_contains(labels, 'campanha')"""),
    "ARR2 FLT11 MAP1")
def leads_to_tag(spark, sf_dir):
    return ld.leads_to_tag(Tables(spark, sf_dir).crm_contacts)


_RECON_CTES = dict(UNION_CTES)
_RECON_CTES.update({
    "seen": "SELECT DISTINCT account_id, id FROM lu",
    "stored": "SELECT account_id, id FROM leads WHERE list_contains(labels, 'campanha')",
    "stale": """SELECT s.account_id, s.id FROM stored s
                WHERE s.account_id IN (SELECT account_id FROM seen)
                  AND NOT EXISTS (SELECT 1 FROM seen x WHERE x.account_id = s.account_id AND x.id = s.id)""",
})


def _recon_inputs(t):
    seen = _union(t).select("account_id", "id").distinct()
    stored = t.leads
    return seen, stored, ld.stale_leads(stored, seen)


@register("stale_leads", with_views(_UNION_VIEWS + ["leads"], "SELECT account_id, id FROM stale",
                                    extra=_RECON_CTES), "JOI9 SET3 SNK5")
def stale_leads(spark, sf_dir):
    _, _, stale = _recon_inputs(Tables(spark, sf_dir))
    return stale


@register("reconcile_audit", with_views(_UNION_VIEWS + ["leads"], """
    SELECT account_id, SUM(source_count) AS source_count, SUM(stored_count) AS stored_count,
           SUM(stale_count) AS stale_count, SUM(deleted) AS deleted
    FROM (SELECT COALESCE(a.account_id, b.account_id) AS account_id, COALESCE(b.n, 0) AS source_count,
                 COALESCE(a.n, 0) AS stored_count, COALESCE(c.n, 0) AS stale_count,
                 CASE WHEN COALESCE(b.n, 0) > 0 THEN COALESCE(c.n, 0) ELSE 0 END AS deleted
          FROM (SELECT account_id, COUNT(*) AS n FROM stored GROUP BY 1) a
          FULL JOIN (SELECT account_id, COUNT(*) AS n FROM seen GROUP BY 1) b ON a.account_id = b.account_id
          LEFT JOIN (SELECT account_id, COUNT(*) AS n FROM stale GROUP BY 1) c
                 ON c.account_id = COALESCE(a.account_id, b.account_id)) x
    GROUP BY ROLLUP (account_id)""", extra=_RECON_CTES), "AGG15")
def reconcile_audit(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return ld.reconcile_audit(t.leads, _union(t).select("account_id", "id").distinct())


@register("leads_after_reconcile", with_views(_UNION_VIEWS + ["leads"], """
    SELECT account_id, COUNT(*) AS leads FROM leads l
    WHERE NOT EXISTS (SELECT 1 FROM stale s WHERE s.account_id = l.account_id AND s.id = l.id)
    GROUP BY 1""", extra=_RECON_CTES), "SNK5 STM4")
def leads_after_reconcile(spark, sf_dir):
    """Full refresh + reconcile (STM4 in batch form): the stored table after the key delete."""
    t = Tables(spark, sf_dir)
    _, stored, stale = _recon_inputs(t)
    kept = ld.delete_keys(stored, stale)
    return kept.groupBy("account_id").agg(F.count(F.lit(1)).alias("leads"))


WM_PREV = dt.datetime(1997, 1, 1)


@register("activity_watermark", with_views(_UNION_VIEWS + ["leads"], """
    SELECT COALESCE(p.account_id, b.account_id) AS account_id, p.last_activity_seen AS previous, b.batch_max,
           greatest(p.last_activity_seen, b.batch_max) AS last_activity_seen
    FROM prev p FULL JOIN (
        SELECT lu.account_id, MAX(lu.last_activity_at) AS batch_max
        FROM lu LEFT JOIN prev ON prev.account_id = lu.account_id
        WHERE prev.last_activity_seen IS NULL
           OR COALESCE(lu.last_activity_at, TIMESTAMP '1970-01-01') > prev.last_activity_seen
        GROUP BY 1) b ON p.account_id = b.account_id""", extra=dict(UNION_CTES, prev="""
        SELECT account_id, MAX(last_activity_at) AS last_activity_seen FROM leads
        WHERE last_activity_at < TIMESTAMP '1997-01-01' GROUP BY 1""")), "AGG16 FLT13 STM3")
def activity_watermark(spark, sf_dir):
    """Per-account watermark after one incremental batch: the batch is cut at each
    account's previous watermark (strict, null activity = epoch 0), then
    greatest(previous, batch max)."""
    t = Tables(spark, sf_dir)
    prev = (t.leads.where(F.col("last_activity_at") < F.lit(WM_PREV).cast("timestamp_ntz"))
            .groupBy("account_id").agg(F.max("last_activity_at").alias("last_activity_seen")))
    batch = _union(t).join(prev.select("account_id", F.col("last_activity_seen").alias("_wm")), "account_id", "left")
    act = F.coalesce(F.col("last_activity_at"), F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz"))
    batch = batch.where(F.col("_wm").isNull() | (act > F.col("_wm")))
    return ld.activity_watermark(prev, batch)


@register("campaign_contacts_month", with_views(["units", "crm_conversations"], f"""
    SELECT units.clinic_id, strftime(created_ts, '%Y-%m') AS year_month,
           COUNT(DISTINCT COALESCE(sender_id, contact_id)) AS contacts_count,
           COUNT(DISTINCT c.id) AS conversations_count, 'campanha' AS campaign_tag
    FROM (SELECT *, {_CONV_CREATED} AS created_ts FROM crm_conversations
          WHERE list_contains(labels, 'campanha')) c
    JOIN units ON units.account_id = c.account_id
    WHERE created_ts IS NOT NULL GROUP BY ALL"""), "AGG8 DAT1 DAT2 STM6")
def campaign_contacts_month(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return ld.campaign_contacts(t.crm_conversations, t.units)


RUN_START, RUN_END = dt.datetime(1998, 1, 1), dt.datetime(1998, 2, 1)
FAILED_CLINICS = ("3", "6", "9")
ERROR_TEXT = "upstream timeout " + "x" * 600

_FEED_ROWS_SQL = """
    SELECT 'appointments' AS feed, clinic_id, start_time AS ts FROM appointments
    UNION ALL SELECT 'payments', clinic_id, date FROM payments
    UNION ALL SELECT 'appointment_logs', a.clinic_id, l.change_date FROM appointment_logs l
              JOIN appointments a ON l.appointment_id = a.id"""


def _feed_rows(t):
    a = t.appointments.select(F.lit("appointments").alias("feed"), "clinic_id", F.col("start_time").alias("ts"))
    p = t.payments.select(F.lit("payments").alias("feed"), "clinic_id", F.col("date").alias("ts"))
    appt = t.appointments.select(F.col("id").alias("_aid"), "clinic_id")
    lg = t.appointment_logs.join(appt, F.col("appointment_id") == F.col("_aid")).select(
        F.lit("appointment_logs").alias("feed"), "clinic_id", F.col("change_date").alias("ts"))
    return a.unionByName(p).unionByName(lg)


@register("state_partial_merge", with_views(["appointments", "appointment_logs", "payments"], f"""
    SELECT COALESCE(o.feed, r.feed) AS feed, COALESCE(o.clinic_id, r.clinic_id) AS clinic_id,
           CASE WHEN r.feed IS NOT NULL AND r.error IS NULL THEN greatest(o.last_updated_at, r.max_updated_at)
                ELSE o.last_updated_at END AS last_updated_at,
           CASE WHEN r.feed IS NOT NULL THEN TIMESTAMP '1998-02-01' ELSE o.last_run_at END AS last_run_at,
           CASE WHEN r.feed IS NOT NULL THEN (CASE WHEN r.error IS NULL THEN 'ok' ELSE 'error' END)
                ELSE o.last_run_status END AS last_run_status,
           CASE WHEN r.feed IS NOT NULL THEN substr(r.error, 1, 500) ELSE o.last_run_error END AS last_run_error,
           CASE WHEN r.feed IS NOT NULL AND r.error IS NULL THEN COALESCE(o.rows_synced_total, 0) + r.rows
                ELSE o.rows_synced_total END AS rows_synced_total
    FROM old o FULL JOIN run r ON o.feed = r.feed AND o.clinic_id = r.clinic_id""", extra={
    "fr": _FEED_ROWS_SQL,
    "old": """SELECT feed, clinic_id, MAX(ts) AS last_updated_at, TIMESTAMP '1998-01-01' AS last_run_at,
                     'ok' AS last_run_status, CAST(NULL AS VARCHAR) AS last_run_error, COUNT(*) AS rows_synced_total
              FROM fr WHERE ts < TIMESTAMP '1998-01-01' GROUP BY 1, 2""",
    "run": f"""SELECT feed, clinic_id, COUNT(*) AS rows, MAX(ts) AS max_updated_at,
                      CASE WHEN clinic_id IN {FAILED_CLINICS} THEN '{ERROR_TEXT}' END AS error
               FROM fr WHERE ts >= TIMESTAMP '1998-01-01' AND ts < TIMESTAMP '1998-02-01' GROUP BY 1, 2""",
}), "SNK2 SNK7 STR8 STM5")
def state_partial_merge(spark, sf_dir):
    t = Tables(spark, sf_dir)
    before = F.col("ts") < F.lit(RUN_START).cast("timestamp_ntz")
    during = in_period("ts", RUN_START, RUN_END)
    # one pass over the feeds gives both the prior state and this run's outcome
    agg = (_feed_rows(t).where(before | during).groupBy("feed", "clinic_id")
           .agg(F.max(F.when(before, F.col("ts"))).alias("last_updated_at"),
                F.count_if(before).alias("rows_synced_total"),
                F.count_if(during).alias("rows"), F.max(F.when(during, F.col("ts"))).alias("max_updated_at")))
    old = (agg.where(F.col("rows_synced_total") > 0)
           .select("feed", "clinic_id", "last_updated_at",
                   F.lit(RUN_START).cast("timestamp_ntz").alias("last_run_at"), F.lit("ok").alias("last_run_status"),
                   F.lit(None).cast("string").alias("last_run_error"), "rows_synced_total"))
    run = (agg.where(F.col("rows") > 0).select("feed", "clinic_id", "rows", "max_updated_at")
           .withColumn("error", F.when(F.col("clinic_id").isin(list(FAILED_CLINICS)), F.lit(ERROR_TEXT))))
    return merge.sync_state_merge(old, run, RUN_END)


@register("sync_totals", with_views(["appointments", "appointment_logs", "payments"], f"""
    SELECT feed, SUM(rows) AS rows, COUNT(DISTINCT clinic_id) AS clinics, COUNT(*) FILTER (WHERE error) AS errors
    FROM (SELECT feed, clinic_id, COUNT(*) AS rows, clinic_id IN {FAILED_CLINICS} AS error FROM fr
          WHERE ts >= TIMESTAMP '1998-01-01' AND ts < TIMESTAMP '1998-02-01' GROUP BY 1, 2) r
    GROUP BY ROLLUP (feed)""", extra={"fr": _FEED_ROWS_SQL}), "AGG14")
def sync_totals(spark, sf_dir):
    """Rows, clinics and failed clinics per feed in one sync run, and the grand total (feed null)."""
    run = (_feed_rows(Tables(spark, sf_dir)).where(in_period("ts", RUN_START, RUN_END)).groupBy("feed", "clinic_id")
           .agg(F.count(F.lit(1)).alias("rows"))
           .withColumn("error", F.when(F.col("clinic_id").isin(list(FAILED_CLINICS)), F.lit(ERROR_TEXT))))
    return merge.sync_totals(run)


@register("state_top", with_views(["appointments", "appointment_logs", "payments"], """
    SELECT feed, clinic_id, COUNT(*) AS rows_synced_total FROM fr WHERE ts < TIMESTAMP '1998-01-01'
    GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""", extra={"fr": _FEED_ROWS_SQL}), "SRT3")
def state_top(spark, sf_dir):
    """The ten states with the most rows."""
    state = (_feed_rows(Tables(spark, sf_dir)).where(F.col("ts") < F.lit(RUN_START).cast("timestamp_ntz"))
             .groupBy("feed", "clinic_id").agg(F.count(F.lit(1)).alias("rows_synced_total")))
    return merge.state_listing(state, 10)


@register("lookback_logs", with_views(["appointment_logs"], """
    SELECT to_status, COUNT(*) AS logs FROM appointment_logs
    WHERE change_date >= TIMESTAMP '1998-01-25' AND change_date < TIMESTAMP '1998-01-31' GROUP BY 1"""), "DAT3 FLT13")
def lookback_logs(spark, sf_dir):
    """Logs of the last ten days, a lookback that is cut to six."""
    now = dt.datetime(1998, 1, 31)
    lg = Tables(spark, sf_dir).appointment_logs.where(in_period("change_date", lookback_bound(now, 240), now))
    return lg.groupBy("to_status").agg(F.count(F.lit(1)).alias("logs"))


@register("numeric_lead_ids", with_views(["leads"], """
    SELECT id, account_id FROM leads WHERE id % 4 <> 0"""), "PRJ7")
def numeric_lead_ids(spark, sf_dir):
    """Lead ids that come as text: numbers are kept as numbers, anything else is dropped."""
    text = F.when(F.col("id") % 4 == 0, F.concat(F.lit("x"), F.col("id").cast("string"))).otherwise(F.col("id").cast("string"))
    return ld.numeric_ids(Tables(spark, sf_dir).leads.select(text.alias("id"), "account_id"))


RET_NOW = dt.datetime(1998, 3, 15, 12, 0)


@register("retention_keep", with_views(["appointments", "appointment_logs", "payments"], """
    SELECT feed, COUNT(*) FILTER (WHERE ts IS NULL OR ts >= TIMESTAMP '1998-01-01') AS kept,
           COUNT(*) FILTER (WHERE ts < TIMESTAMP '1998-01-01') AS dropped
    FROM (SELECT 'appointments' AS feed, start_time AS ts FROM appointments
          UNION ALL SELECT 'appointment_logs', change_date FROM appointment_logs
          UNION ALL SELECT 'payments', date FROM payments) x GROUP BY 1"""), "SNK6")
def retention_keep(spark, sf_dir):
    """Rolling retention (current month + 2 previous, null dates kept): kept and dropped rows per table."""
    t = Tables(spark, sf_dir)
    parts = [merge.retention_split(df, col, RET_NOW).withColumn("feed", F.lit(name))
             for name, df, col in (("appointments", t.appointments, "start_time"),
                                   ("appointment_logs", t.appointment_logs, "change_date"),
                                   ("payments", t.payments, "date"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("feed", "kept", "dropped")
