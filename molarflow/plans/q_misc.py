"""Scalar-function and source-level queries (STR1, STR4, HSH1, SRC3, SRC5, SRC6)."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from molarflow.functions.misc import digest
from molarflow.functions.phone import phone_key
from molarflow.functions.text import fold_name
from molarflow.operators.filters import in_period
from molarflow.plans.oracle_views import fold_sql, phone_key_sql, with_views
from molarflow.plans.q_leads import _FEED_ROWS_SQL, _feed_rows
from molarflow.plans.registry import Tables, register
from molarflow.sources import tables as src


@register("phone_keys", with_views(["appointments"], f"""
    SELECT pk AS phone_key, COUNT(*) AS appointments, COUNT(DISTINCT patient_id) AS patients
    FROM (SELECT {phone_key_sql('phone')} AS pk, patient_id FROM appointments) x
    WHERE pk IS NOT NULL GROUP BY 1"""), "STR3 STR4")
def phone_keys(spark, sf_dir):
    a = Tables(spark, sf_dir).appointments.select(phone_key("phone").alias("phone_key"), "patient_id")
    return (a.where(F.col("phone_key").isNotNull()).groupBy("phone_key")
            .agg(F.count(F.lit(1)).alias("appointments"), F.count_distinct("patient_id").alias("patients")))


@register("folded_names", with_views(["appointments"], f"""
    SELECT {fold_sql('created_by_name')} AS name_norm, COUNT(*) AS appointments,
           COUNT(DISTINCT created_by_name) AS spellings
    FROM appointments GROUP BY 1"""), "STR1 FLT6")
def folded_names(spark, sf_dir):
    a = Tables(spark, sf_dir).appointments
    return a.groupBy(fold_name("created_by_name").alias("name_norm")).agg(
        F.count(F.lit(1)).alias("appointments"), F.count_distinct("created_by_name").alias("spellings"))


@register("phone_pseudonyms", with_views(["leads"], f"""
    SELECT id, account_id, sha256({phone_key_sql('phone_raw')}) AS pseudonym
    FROM leads WHERE {phone_key_sql('phone_raw')} IS NOT NULL"""), "HSH1 STR4")
def phone_pseudonyms(spark, sf_dir):
    ld = Tables(spark, sf_dir).leads.withColumn("_pk", phone_key("phone_raw")).where(F.col("_pk").isNotNull())
    return ld.select("id", "account_id", digest("_pk").alias("pseudonym"))


@register("generic_scan", with_views(["payments"], """
    SELECT id, clinic_id, date, amount, is_confirmed FROM payments
    WHERE is_confirmed = TRUE AND date >= TIMESTAMP '1999-01-01' AND date < TIMESTAMP '1999-02-01'
      AND clinic_id IN ('1', '2', '3')
    ORDER BY amount DESC NULLS FIRST, id ASC NULLS LAST LIMIT 40 OFFSET 5"""), "SRC3 PRJ1 SRT1 LIM1")
def generic_scan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    allow = {"appointments": t.appointments, "appointment_logs": t.appointment_logs, "payments": t.payments}
    return src.scan(allow, "payments", select=["id", "clinic_id", "date", "amount", "is_confirmed"],
                    filters=[("is_confirmed", "eq", True), ("date", "gte", dt.datetime(1999, 1, 1)),
                             ("date", "lt", dt.datetime(1999, 2, 1)), ("clinic_id", "in", ["1", "2", "3"])],
                    order=[("amount", "desc"), ("id", "asc")], offset=5, limit=40)


WS, WE, WD = dt.datetime(1998, 1, 1), dt.datetime(1998, 3, 1), 15
FEEDS = ("appointments", "appointment_logs", "payments")


@register("extract_work_list", with_views(["units", "appointments", "appointment_logs", "payments"], """
    SELECT w.feed, w.clinic_id, w.period_start, w.period_end FROM w
    WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.feed = w.feed AND d.clinic_id = w.clinic_id
                        AND d.period_start = w.period_start)""", extra={
    "fr": _FEED_ROWS_SQL,
    "w": """SELECT f.feed, u.clinic_id, p.ps AS period_start,
                   least(p.ps + INTERVAL 15 DAY, TIMESTAMP '1998-03-01') AS period_end
            FROM units u, (VALUES ('appointments'), ('appointment_logs'), ('payments')) f(feed),
                 generate_series(TIMESTAMP '1998-01-01', TIMESTAMP '1998-02-28', INTERVAL 15 DAY) p(ps)
            WHERE u.clinic_id IS NOT NULL""",
    "done": """SELECT DISTINCT feed, clinic_id,
                      TIMESTAMP '1998-01-01' + to_days(CAST(floor((epoch(ts) - epoch(TIMESTAMP '1998-01-01'))
                                                                  / 86400 / 15) * 15 AS INTEGER)) AS period_start
               FROM fr WHERE ts >= TIMESTAMP '1998-01-01' AND ts < TIMESTAMP '1998-03-01'""",
}), "SRC4 SRC5 SRC6")
def extract_work_list(spark, sf_dir):
    """Units of extraction work (feed x clinic x <=15-day period) over two months,
    minus those already done (here: periods that already hold rows)."""
    t = Tables(spark, sf_dir)
    work = src.work_list(src.active_units(t.units), FEEDS, WS, WE, WD)
    fr = _feed_rows(t).where(in_period("ts", WS, WE))
    days = F.floor((F.unix_seconds(F.col("ts").cast("timestamp")) - int(WS.replace(tzinfo=dt.timezone.utc)
                                                                        .timestamp())) / 86400 / WD) * WD
    done = fr.select("feed", "clinic_id",
                     (F.lit(WS).cast("timestamp_ntz") + F.make_dt_interval(days.cast("int"))).alias("period_start"))
    return src.pending_work(work, done)


BF_START, BF_END = dt.datetime(1998, 1, 1), dt.datetime(1998, 3, 1)


@register("backfill_landing", with_views(["appointments", "payments"], """
    SELECT feed, clinic_id, strftime(TIMESTAMP '1998-01-01' + to_days(CAST(floor((epoch(ts)
                 - epoch(TIMESTAMP '1998-01-01')) / 86400 / 15) * 15 AS INTEGER)), '%Y%m%d') AS period,
           COUNT(*) AS rows
    FROM (SELECT 'appointments' AS feed, clinic_id, start_time AS ts FROM appointments
          UNION ALL SELECT 'payments', clinic_id, date FROM payments) x
    WHERE ts >= TIMESTAMP '1998-01-01' AND ts < TIMESTAMP '1998-03-01'
    GROUP BY ALL"""), "SRC5 SRC6 SNK4 (backfill landing)")
def backfill_landing(spark, sf_dir):
    """Backfill two months of two feeds into per-unit JSON folders in two passes
    (the second pass skips the units the first one wrote), then count the rows
    landed per unit by reading the landing back."""
    from molarflow.sources.backfill import land_backfill
    from molarflow.streaming.ingest import new_run_dir
    t = Tables(spark, sf_dir)
    root = new_run_dir(spark, "backfill")
    feeds = {"appointments": (t.appointments.select("id", "clinic_id", "start_time", "status"), "start_time"),
             "payments": (t.payments.select("id", "clinic_id", "date", "amount"), "date")}
    # pass 1: January only; pass 2: the whole window, skipping units already landed
    land_backfill(feeds, BF_START, dt.datetime(1998, 1, 31), root)
    landed = None
    for name in feeds:
        got = (spark.read.schema("id string, clinic_id string, period string").json(os.path.join(root, name))
               .select(F.lit(name).alias("feed"), "clinic_id", "period").distinct())
        landed = got if landed is None else landed.unionByName(got)
    land_backfill(feeds, BF_START, BF_END, root, done=landed.checkpoint(eager=True))
    out = None
    for name, ddl in (("appointments", "id bigint, start_time timestamp_ntz, status int"),
                      ("payments", "id string, date timestamp_ntz, amount decimal(18,2)")):
        df = (spark.read.schema(ddl + ", clinic_id string, period string").json(os.path.join(root, name))
              .groupBy("clinic_id", "period").agg(F.count(F.lit(1)).alias("rows"))
              .withColumn("feed", F.lit(name)))
        out = df if out is None else out.unionByName(df)
    return out.select("feed", "clinic_id", "period", "rows")
