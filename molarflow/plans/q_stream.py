"""Streaming ingest queries (STM1-STM5, SRC2, SRC6, SNK1, WIN4, FLT13, AGG16).

Each call lands deliveries derived from the test tables into a fresh folder
under the shared checkpoint folder, runs the file-source stream to completion
after every delivery (`availableNow`), and returns the stored result. The
oracle SQL is the batch equivalent of the final table (stream = batch).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from molarflow import schemas
from molarflow.functions.misc import plus_days, year_month
from molarflow.operators import filters as flt
from molarflow.operators import leads as ld
from molarflow.plans import api
from molarflow.plans.oracle_views import with_views
from molarflow.plans.q_leads import UNION_CTES, _contact_lead, _conversation_ctes
from molarflow.plans.registry import REGISTRY, Tables, register
from molarflow.session import stored
from molarflow.sinks.versioned import VersionedTable
from molarflow.sources.tables import LakeTables
from molarflow.streaming import ingest


@register("stream_feed_upsert", with_views(["payments"], """
    SELECT clinic_id, strftime(date, '%Y-%m') AS month, COUNT(*) AS payments,
           COUNT(*) FILTER (WHERE CASE WHEN year(date) = 1998 THEN NOT is_confirmed ELSE is_confirmed END) AS confirmed,
           CAST(SUM(amount) AS DOUBLE) AS amount
    FROM payments GROUP BY ALL"""), "STM1 STM2 STM5 SRC2 SRC6 SNK1 WIN4")
def stream_feed_upsert(spark, sf_dir):
    """Four pulls of the payments feed: up to 1997; then, as one backlog in one micro-batch,
    1998-1999 and a re-pull of 1998 in which every row changed its confirmation flag; then
    2000 onwards. The later pull must win, and nothing is duplicated."""
    p = Tables(spark, sf_dir).payments
    y = F.year("date")
    deliveries = [
        p.where(y <= 1997),
        [p.where(y.isin(1998, 1999)), p.where(y == 1998).withColumn("is_confirmed", ~F.col("is_confirmed"))],
        p.where(y >= 2000),
    ]
    base = ingest.new_run_dir(spark, "payments")
    table = ingest.feed_ingest(spark, base, schemas.PAYMENTS, ["id"], "date", deliveries)
    return (table.groupBy("clinic_id", year_month("date").alias("month"))
            .agg(F.count(F.lit(1)).alias("payments"), F.count_if("is_confirmed").alias("confirmed"),
                 F.sum("amount").cast("double").alias("amount")))


_MOVED = """
    SELECT id, patient_id, created_by_name, patient_name, status,
           CASE WHEN id % 11 = 0 THEN NULL WHEN id % 5 = 0 THEN start_time + INTERVAL 40 DAY ELSE start_time END AS start_time,
           CASE WHEN id % 10 = 0 THEN CAST((CAST(clinic_id AS INTEGER) + 1) % 25 AS VARCHAR) ELSE clinic_id END AS clinic_id
    FROM appointments"""


@register("stream_appointments_upsert", with_views(["appointments"], """
    SELECT clinic_id, strftime(start_time, '%Y-%m') AS month, COUNT(*) AS appointments, COUNT(DISTINCT id) AS ids,
           COUNT(*) FILTER (WHERE status = 99) AS duplicates_won
    FROM moved GROUP BY ALL""", extra={"moved": _MOVED}), "STM1 SNK1 SNK4 WIN3 WIN4 SRC2")
def stream_appointments_upsert(spark, sf_dir):
    """The appointments feed: a first pull in which every fourth row comes twice (the second
    with status 99: the first must win), with zoned time stamps; then a backlog of two pulls in
    which every fifth start moves 40 days, every tenth clinic changes and every eleventh start
    is cleared. Each row must be stored once, where it is now, and rows without a date kept."""
    table = _appointments_table(spark, sf_dir)
    return (table.groupBy("clinic_id", year_month("start_time").alias("month"))
            .agg(F.count(F.lit(1)).alias("appointments"), F.count_distinct("id").alias("ids"),
                 F.count_if(F.col("status") == 99).alias("duplicates_won")))


def _with_copies(a):
    """`a` and a copy with status 99 of every fourth row; a row and its copy come in order in one part file."""
    statuses = F.when(F.col("id") % 4 == 0, F.array(F.col("status"), F.lit(99))).otherwise(F.array(F.col("status")))
    return a.withColumn("status", F.explode(statuses)).select(*a.columns)


def _appointments_table(spark, sf_dir, base=None):
    a = Tables(spark, sf_dir).appointments.drop("created_by_name_norm", "patient_name_norm", "phone_norm")
    i = F.col("id")
    first = _with_copies(a).withColumn("start_time", F.concat(F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ss"),
                                                    F.when(i % 2 == 0, F.lit("Z")).otherwise(F.lit("+00:00"))))
    clinic = F.when(i % 10 == 0, ((F.col("clinic_id").cast("int") + 1) % 25).cast("string")).otherwise(F.col("clinic_id"))
    early = a.where(i % 5 == 0).withColumn("start_time", plus_days("start_time", 3))
    late = a.where((i % 5 == 0) | (i % 11 == 0)).withColumns({
        "start_time": F.when(i % 11 == 0, F.lit(None)).when(i % 5 == 0, plus_days("start_time", 40)).otherwise(F.col("start_time")),
        "clinic_id": clinic})
    return ingest.feed_ingest(spark, base or ingest.new_run_dir(spark, "appointments"), schemas.APPOINTMENTS, ["id"], "start_time",
                              [first, [early, late]])


@register("lake_creator_filter", with_views(["appointments"], f"""
    SELECT clinic_id, COUNT(*) AS appointments FROM moved
    WHERE trim(regexp_replace(strip_accents(lower(created_by_name)), '\\s+', ' ', 'g')) IN ('paulo simao', 'bruna')
    GROUP BY 1""", extra={"moved": _MOVED}), "FLT6 STR1 SRC1")
def lake_creator_filter(spark, sf_dir):
    """The creator filter over a table that the stream wrote: its search columns are derived at merge."""
    t = _appointments_table(spark, sf_dir).where(flt.creators_filter(" PAULO  Simão| bruna"))
    return t.groupBy("clinic_id").agg(F.count(F.lit(1)).alias("appointments"))


@register("lake_search", with_views(["appointments"], """
    SELECT id, patient_name FROM moved WHERE contains(strip_accents(lower(patient_name)), 'lucia')""",
                                    extra={"moved": _MOVED}), "FLT7 STR2 SRC1")
def lake_search(spark, sf_dir):
    """Free-text search over a table that the stream wrote."""
    t = _appointments_table(spark, sf_dir)
    return t.where(flt.search_filter("LÚCIA", "patient_name_norm", "phone_norm")).select("id", "patient_name")


@register("lake_api_page", with_views(["appointments"], """
    SELECT id, patient_name, clinic_id, start_time, status FROM moved
    WHERE start_time >= TIMESTAMP '1997-01-01' AND start_time < TIMESTAMP '1998-01-01' AND clinic_id IN ('2', '3', '5')
    ORDER BY start_time DESC NULLS FIRST, id LIMIT 100 OFFSET 100""", extra={"moved": _MOVED}), "SRC1 LIM1 FLT1 FLT15 SRT1")
def lake_api_page(spark, sf_dir):
    """A page of the audit list, asked of the request API over the lake that the stream writes."""
    root = ingest.new_run_dir(spark, "lake")
    _appointments_table(spark, sf_dir, f"{root}/appointments")
    page = api.appointments(LakeTables(spark, root), {"start": "1997-01-01", "end": "1998-01-01", "page": "2", "pp": "100"}, ["2", "3", "5"])
    return page["data"].select("id", "patient_name", "clinic_id", "start_time", "status")


@register("stream_logs_upsert", with_views(["appointment_logs"], """
    SELECT CASE WHEN appointment_id % 6 = 0 THEN NULL ELSE strftime(change_date, '%Y-%m') END AS month, to_status,
           COUNT(*) AS logs, COUNT(DISTINCT id) AS ids
    FROM appointment_logs GROUP BY ALL"""), "STM1 SNK1")
def stream_logs_upsert(spark, sf_dir):
    """The logs feed (no clinic column): everything, then a re-pull that clears every sixth appointment's dates."""
    lg = stored(Tables(spark, sf_dir).appointment_logs.dropDuplicates(["id"]), "logs")
    again = lg.where(F.col("appointment_id") % 6 == 0).withColumn("change_date", F.lit(None).cast("timestamp_ntz"))
    table = ingest.feed_ingest(spark, ingest.new_run_dir(spark, "logs"), schemas.APPOINTMENT_LOGS, ["id"], "change_date",
                               [lg, again], unit_col=None)
    return (table.groupBy(year_month("change_date").alias("month"), "to_status")
            .agg(F.count(F.lit(1)).alias("logs"), F.count_distinct("id").alias("ids")))


@register("retention_apply", with_views(["payments"], """
    SELECT strftime(date, '%Y-%m') AS month, COUNT(*) AS payments FROM payments
    WHERE date IS NULL OR date >= TIMESTAMP '1998-03-01' GROUP BY 1"""), "SNK6")
def retention_apply(spark, sf_dir):
    """Retention as of May 1998 on a stored table: older months go, then their files; read back."""
    p = Tables(spark, sf_dir).payments
    base = ingest.new_run_dir(spark, "retention")
    ingest.feed_ingest(spark, base, schemas.PAYMENTS, ["id"], "date", [p])
    table = VersionedTable(spark, f"{base}/table", schemas.PAYMENTS, ["id"], "date", "clinic_id")
    table.retain(dt.datetime(1998, 5, 10))
    table.vacuum()
    return table.read().groupBy(year_month("date").alias("month")).agg(F.count(F.lit(1)).alias("payments"))


_EPOCH0 = "TIMESTAMP '1970-01-01'"
_LEAD_COLS = ", ".join(ld.LEAD_COLUMNS)


def _cut(src: str, acts: str) -> str:
    return (f"SELECT {src}.* FROM {src} LEFT JOIN wm1 ON wm1.account_id = {src}.account_id "
            f"WHERE wm1.last_activity_seen IS NULL OR COALESCE({acts}, {_EPOCH0}) > wm1.last_activity_seen")


_INC_CTES = {
    "a1": _contact_lead(1, "list_contains(labels, 'campanha') AND id % 2 = 0"),
    "a3": _contact_lead(3, "ad_origin IS NOT NULL AND trim(ad_origin) <> '' AND id % 2 = 0"),
    **_conversation_ctes("a", "id % 2 = 1"),
    "u1": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, account_id ORDER BY source DESC) AS rk
                            FROM (SELECT * FROM a1 UNION ALL SELECT * FROM s2a UNION ALL SELECT * FROM a3) x) y WHERE rk = 1""",
    "wm1": "SELECT account_id, MAX(last_activity_at) AS last_activity_seen FROM u1 GROUP BY 1",
    "b1": _contact_lead(1, "list_contains(labels, 'campanha')"),
    "b3": _contact_lead(3, "ad_origin IS NOT NULL AND trim(ad_origin) <> ''"),
    **_conversation_ctes("b", "TRUE"),
    "c2": _cut("s2b", "s2b.last_activity_at"),
    "c1": _cut("b1", "b1.last_activity_at"),
    "c3": _cut("b3", "b3.last_activity_at, b3.created_at_cw"),
    "u2": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, account_id ORDER BY source DESC) AS rk
                            FROM (SELECT * FROM c1 UNION ALL SELECT * FROM c2 UNION ALL SELECT * FROM c3) x) y WHERE rk = 1""",
    "fin": """SELECT * FROM u2 UNION ALL
              SELECT * FROM u1 WHERE NOT EXISTS (SELECT 1 FROM u2 WHERE u2.id = u1.id AND u2.account_id = u1.account_id)""",
}


_INC_VIEWS = ["units", "crm_contacts", "crm_conversations"]
_RUNS = (dt.datetime(2026, 5, 1, 6), dt.datetime(2026, 5, 1, 7))


def _lead_run(spark, sf_dir):
    """Two pulls of contacts and conversations through the lead streams: even contacts and odd
    conversations first, then everything again."""
    t = Tables(spark, sf_dir)
    contacts, conversations, units = t.crm_contacts, t.crm_conversations, t.units

    def to_leads(batch, talks, state):
        return ld.lead_union(batch, talks, units, watermarks=state)

    deliveries = [(contacts.where(F.col("id") % 2 == 0), conversations.where(F.col("id") % 2 == 1)), (contacts, conversations)]
    return ingest.lead_ingest(spark, ingest.new_run_dir(spark, "leads"), schemas.CONTACTS_RAW + ", account_id bigint",
                              schemas.CONVERSATIONS_RAW + ", account_id bigint", schemas.LEADS + ", source int",
                              to_leads, units, deliveries, _RUNS)


@register("stream_leads_incremental", with_views(_INC_VIEWS, f"""
    SELECT f.id, f.account_id, units.clinic_id AS erp_clinic_id, f.name, f.email, f.phone_raw, f.identifier,
           f.labels, f.created_at_cw, f.last_activity_at, f.inbox_ids, f.source
    FROM fin f LEFT JOIN units ON units.account_id = f.account_id""", extra=_INC_CTES),
    "STM3 FLT13 AGG16 SNK1 PRJ2 PRJ3 SET1")
def stream_leads_incremental(spark, sf_dir):
    """All three lead sources, twice. The second pass keeps only rows newer than each
    account's watermark (strict), so older contacts first seen in pass two wait for the
    weekly full refresh."""
    return _lead_run(spark, sf_dir)[0]


@register("lead_state_after_run", with_views(_INC_VIEWS, """
    SELECT units.account_id, units.clinic_id AS erp_clinic_id, TIMESTAMP '2026-05-01 07:00:00' AS last_synced_at,
           greatest((SELECT max(last_activity_at) FROM u1 WHERE u1.account_id = units.account_id),
                    (SELECT max(last_activity_at) FROM u2 WHERE u2.account_id = units.account_id)) AS last_activity_seen,
           (SELECT count(*) FROM u1 WHERE u1.account_id = units.account_id)
           + (SELECT count(*) FROM u2 WHERE u2.account_id = units.account_id) AS rows_synced_total,
           'ok' AS last_run_status, CAST(NULL AS VARCHAR) AS last_run_error, CAST(NULL AS TIMESTAMP) AS full_refresh_at
    FROM units WHERE units.account_id IS NOT NULL""", extra=_INC_CTES), "SNK7 STM5 AGG16")
def lead_state_after_run(spark, sf_dir):
    return _lead_run(spark, sf_dir)[1]


@register("full_refresh_reconcile", with_views(["units", "crm_contacts", "crm_conversations", "leads"], """
    SELECT COALESCE(n.id, o.id) AS id, COALESCE(n.account_id, o.account_id) AS account_id,
           CASE WHEN n.id IS NOT NULL THEN n.name ELSE o.name END AS name,
           CASE WHEN o.id IS NOT NULL THEN o.created_at_cw ELSE n.created_at_cw END AS created_at_cw
    FROM (SELECT * FROM lu WHERE account_id <> 4) n
    FULL JOIN leads o ON o.id = n.id AND o.account_id = n.account_id
    WHERE n.id IS NOT NULL OR o.account_id IN (4, 7)""", extra=UNION_CTES), "STM4 SNK3 SNK5 SET3 JOI9")
def full_refresh_reconcile(spark, sf_dir):
    """Full refresh as a write: stored leads, then everything seen upserted and the unseen deleted.
    Account 4 has nothing seen and account 7 a failed source: both keep their leads."""
    t = Tables(spark, sf_dir)
    table = VersionedTable(spark, ingest.new_run_dir(spark, "refresh"), schemas.LEADS, ["id", "account_id"], None, "account_id")
    table.upsert(t.leads, order=F.lit(1))
    union = ld.lead_union(t.crm_contacts, t.crm_conversations, t.units).where("account_id <> 4")
    ingest.full_refresh(spark, table, union, spark.range(7, 8).select(F.col("id").alias("account_id")))
    return table.read().select("id", "account_id", "name", "created_at_cw")


@register("stream_campaign_counts", REGISTRY["campaign_contacts_month"].sql, "STM6 AGG8 DAT1")
def stream_campaign_counts(spark, sf_dir):
    """Campaign counts kept live by a stream over two conversation pulls (odd ids,
    then everything again): exact, and equal to the batch counts."""
    from molarflow.streaming.campaign import campaign_counts_ingest
    t = Tables(spark, sf_dir)
    conv = t.crm_conversations
    conv_schema = schemas.CONVERSATIONS_RAW + ", account_id bigint"
    base = ingest.new_run_dir(spark, "campaign")
    out = campaign_counts_ingest(spark, base, conv_schema, t.units, [conv.where(F.col("id") % 2 == 1), conv])
    return out.select("clinic_id", "year_month", "contacts_count", "conversations_count", "campaign_tag")
