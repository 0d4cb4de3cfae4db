"""Dashboard KPIs (AGG1-3, AGG5-7, AGG10-13, WIN1, WIN2, WIN5, SET2, PRJ5, PRJ6).

Per-entity "first"/"last" questions are aggregations (`min`/`max_by` over a
struct key), not windows: partial aggregation runs map-side, so a very active
patient or appointment costs one row per task, not a sort of its whole history
in one task. Where two ranks are needed (WIN5), `row_number() <= 2` lets Spark
insert a partial `WindowGroupLimit` before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from molarflow.config import (DEFAULT_DOMAIN, DEFAULT_REGIONAL, RESCHEDULE_GAP_SECONDS, RESCHEDULED_STATUS,
                              RESCUE_PRIOR_STATUSES, STATUS_NAMES, CONFIRMED_STATUS, Domain)
from molarflow.functions.misc import abs_gap_seconds, origin_label, owner_label, year_month
from molarflow.functions.text import fold_name
from molarflow.operators.attribution import confirmed_payments
from molarflow.operators.filters import in_period


def unique_patients(appointments: DataFrame, *dims: str) -> DataFrame:
    """AGG1: COUNT(DISTINCT patient_id) (and appointment count) over filtered appointments."""
    return appointments.groupBy(*dims).agg(F.count_distinct("patient_id").alias("unique_patients"),
                                           F.count(F.lit(1)).alias("appointments"))


def revenue(payments: DataFrame, *dims: str) -> DataFrame:
    """AGG2: sum of confirmed, undeleted payments (decimal sum, reported as double)."""
    return (confirmed_payments(payments).groupBy(*dims)
            .agg(F.sum("amount").cast("double").alias("revenue"), F.count(F.lit(1)).alias("payments")))


def best_month(payments: DataFrame, *dims: str) -> DataFrame:
    """AGG3: the month with the largest confirmed revenue over the whole dataset
    (ignores the period filter); ties go to the earliest month."""
    return best_month_from_monthly(monthly_revenue(payments, *dims), *dims)


def monthly_revenue(payments: DataFrame, *dims: str) -> DataFrame:
    """Confirmed revenue per (dims, month) as an exact decimal: the small rollup
    that best-month and monthly charts can read instead of every payment."""
    return (confirmed_payments(payments).withColumn("month", year_month("date"))
            .groupBy(*dims, "month").agg(F.sum("amount").alias("rev"), F.count(F.lit(1)).alias("payments")))


def best_month_from_monthly(monthly: DataFrame, *dims: str) -> DataFrame:
    """AGG3 over a (dims.., month, rev) rollup; ties go to the earliest month."""
    m = monthly.groupBy(*dims, "month").agg(F.sum("rev").alias("rev"))
    best = m.where(F.col("rev").isNotNull()).groupBy(*dims).agg(
        F.max(F.struct(F.col("rev"), (-F.regexp_replace("month", "-", "").cast("int")).alias("neg"),
                       F.col("month"))).alias("b"))
    return best.where(F.col("b").isNotNull()).select(*dims, F.col("b.month").alias("best_month"),
                                                     F.col("b.rev").cast("double").alias("revenue"))


def first_appointment_origin(appointments: DataFrame) -> DataFrame:
    """WIN1: per patient, the oldest appointment (start_time asc, nulls last, then id)
    decides the origin: campaign if it carries a campaign_token, else organic."""
    key = F.struct(F.col("start_time").isNull().alias("n"), F.col("start_time").alias("t"), F.col("id").alias("i"),
                   (F.col("campaign_token").isNotNull() & (F.trim("campaign_token") != "")).alias("c"))
    first = (appointments.where(F.col("patient_id").isNotNull())
             .groupBy("patient_id").agg(F.min(key).alias("_f")))
    return first.select("patient_id", origin_label(F.col("_f.c")).alias("origin"))


def origin_mix(appointments_in_period: DataFrame, origins: DataFrame, *dims: str) -> DataFrame:
    """AGG5: distinct patients per origin among the period's appointments."""
    j = appointments_in_period.select(*dims, "patient_id").join(origins, "patient_id")
    return j.groupBy(*dims, "origin").agg(F.count_distinct("patient_id").alias("patients"))


def sales_split(payments_in_period: DataFrame, origins: DataFrame, domain: Domain = DEFAULT_DOMAIN) -> DataFrame:
    """AGG6: first consultation (evaluation specialty) vs follow-up, follow-ups split
    by patient origin; a patient with no appointment is 'unclassified'."""
    p = confirmed_payments(payments_in_period).select("patient_id", "specialty_id", "amount")
    j = p.join(origins, "patient_id", "left")
    cat = (F.when(F.col("specialty_id") == domain.eval_specialty_id, F.lit("first_consultation"))
           .otherwise(F.concat(F.lit("follow_up_"), F.coalesce(F.col("origin"), F.lit("unclassified")))))
    return (j.groupBy(cat.alias("category"))
            .agg(F.sum("amount").cast("double").alias("revenue"), F.count(F.lit(1)).alias("payments")))


def reschedules_two_level(appointments_in_period: DataFrame, logs_in_period: DataFrame, *dims: str) -> DataFrame:
    """AGG7: reschedules from logs (is_reschedule OR to_status = 3) when the logs of
    the result set carry the fact at all; otherwise appointments whose start and
    scheduled start differ by more than 24 h. `strategy` says which was used.

    Both counts come from ONE aggregation over a union of appointment rows (gap
    flag) and matched log rows (log flag), so no join of the two aggregates is
    needed; the strategy is then decided over the (small) aggregated result."""
    rl = logs_in_period.where(F.coalesce(F.col("is_reschedule"), F.lit(False))
                              | (F.col("to_status") == RESCHEDULED_STATUS))
    appt_dims = appointments_in_period.select(F.col("id").alias("_aid"), *dims)
    log_rows = (rl.join(appt_dims, rl["appointment_id"] == appt_dims["_aid"])
                .select(*dims, F.lit(0).alias("_gap"), F.lit(1).alias("_log")))
    gap = F.coalesce(abs_gap_seconds("start_time", "scheduled_start_time") > RESCHEDULE_GAP_SECONDS, F.lit(False))
    appt_rows = appointments_in_period.select(*dims, gap.cast("int").alias("_gap"), F.lit(0).alias("_log"))
    j = (appt_rows.unionByName(log_rows).groupBy(*dims)
         .agg(F.coalesce(F.sum("_gap"), F.lit(0)).cast("bigint").alias("heuristic_reschedules"),
              F.coalesce(F.sum("_log"), F.lit(0)).cast("bigint").alias("log_reschedules")))
    # one strategy for the whole result set: a scalar subquery over the (small,
    # per-dimension-value) aggregate, evaluated once
    any_logs = j.select((F.max("log_reschedules") > 0).alias("_any")).scalar()
    return (j.withColumn("strategy", F.when(any_logs, F.lit("logs")).otherwise(F.lit("heuristic")))
            .withColumn("reschedules", F.when(F.col("strategy") == "logs", F.col("log_reschedules"))
                        .otherwise(F.col("heuristic_reschedules"))))


def action_ownership(appointments_in_period: DataFrame, logs: DataFrame,
                     domain: Domain = DEFAULT_DOMAIN) -> DataFrame:
    """AGG11/WIN2: who created, last confirmed and last rescheduled each appointment: the user of
    the last log of each kind (by change_date, then id), both kinds from one aggregation."""
    ids = appointments_in_period.select(F.col("id").alias("appointment_id"), "created_by_id")
    lg = logs.join(ids.select("appointment_id"), "appointment_id", "left_semi")
    kinds = {"confirmation": F.col("to_status") == CONFIRMED_STATUS,
             "reschedule": F.coalesce(F.col("is_reschedule"), F.lit(False)) | (F.col("to_status") == RESCHEDULED_STATUS)}
    rank = F.struct(F.col("change_date").alias("at"), F.col("id").alias("id"), F.col("user_id").alias("user_id"))
    last = (lg.where(kinds["confirmation"] | kinds["reschedule"]).groupBy("appointment_id")
            .agg(*[F.max(F.when(c, rank)).alias(k) for k, c in kinds.items()]))

    def actor(user: Column) -> Column:
        return owner_label(F.coalesce(user == domain.agent_user_id, F.lit(False)))

    acted = F.explode(F.filter(F.array(*[F.when(F.col(k).isNotNull(), F.struct(
        F.lit(k).alias("kind"), actor(F.col(f"{k}.user_id")).alias("actor"))) for k in kinds]), lambda x: x.isNotNull()))
    created = ids.select(F.lit("creation").alias("kind"), actor(F.col("created_by_id")).alias("actor"))
    return (created.unionByName(last.select(acted.alias("a")).select("a.*")).groupBy("kind", "actor")
            .agg(F.count(F.lit(1)).alias("appointments")))


def rescue_candidates(appointments: DataFrame, min_gap_days: int = 60) -> DataFrame:
    """WIN5 (suggested rule, off by default in the reference): the patient's latest
    appointment is preceded by one in status 5 or 11 that started more than N days earlier."""
    w = Window.partitionBy("patient_id").orderBy(F.col("start_time").desc_nulls_last(), F.col("id").desc())
    top2 = (appointments.where(F.col("patient_id").isNotNull())
            .select("patient_id", "id", "start_time", "status")
            .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 2))
    pair = top2.groupBy("patient_id").agg(
        F.max_by(F.struct("id", "start_time", "status"), -F.col("_rn")).alias("last"),
        F.max_by(F.struct("id", "start_time", "status"), F.col("_rn")).alias("prev"),
        F.count(F.lit(1)).alias("_n"))
    gap_days = (F.unix_seconds(F.col("last.start_time").cast("timestamp"))
                - F.unix_seconds(F.col("prev.start_time").cast("timestamp"))) / 86400.0
    return (pair.where((F.col("_n") == 2) & F.col("prev.status").isin(list(RESCUE_PRIOR_STATUSES))
                       & (gap_days > min_gap_days))
            .select("patient_id", F.col("last.id").alias("appointment_id"), F.col("last.start_time").alias("start_time"),
                    F.col("prev.status").alias("prior_status"), gap_days.alias("gap_days")))


def calendar_months(spark: SparkSession, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """The months that intersect [start, end)."""
    last_day = end - dt.timedelta(days=1)
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(dt.date(start.year, start.month, 1)), F.lit(dt.date(last_day.year, last_day.month, 1)),
        F.expr("INTERVAL 1 MONTH"))).alias("d")).select(F.date_format("d", "yyyy-MM").alias("month"))


def monthly_series(spark: SparkSession, start: dt.datetime, end: dt.datetime, appointments: DataFrame,
                   payments: DataFrame) -> DataFrame:
    """AGG10: per-month metrics, only months that intersect [start, end); months
    without data still appear (calendar from `sequence`)."""
    cal = calendar_months(spark, start, end)
    a = (appointments.where(in_period("start_time", start, end)).withColumn("month", year_month("start_time"))
         .groupBy("month").agg(F.count(F.lit(1)).alias("appointments"),
                               F.count_distinct("patient_id").alias("unique_patients")))
    p = (confirmed_payments(payments).where(in_period("date", start, end)).withColumn("month", year_month("date"))
         .groupBy("month").agg(F.sum("amount").cast("double").alias("revenue")))
    return (cal.join(a, "month", "left").join(p, "month", "left")
            .fillna(0, subset=["appointments", "unique_patients"]).fillna(0.0, subset=["revenue"]))


def fill_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """AGG13: rows with a value per column, in one pass, then unpivoted."""
    cols = columns or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count(F.col(c)).alias(c) for c in cols])
    long = wide.unpivot("_total", cols, "column", "filled")
    return long.select("column", "filled", F.col("_total").alias("total"))


def specialty_dim(payments: DataFrame) -> DataFrame:
    """SET2: one name per specialty id, first in accent-insensitive name order
    (whole table, no 1000-row truncation)."""
    return (payments.where(F.col("specialty_id").isNotNull())
            .groupBy("specialty_id")
            .agg(F.min(F.struct(F.col("specialty_name").isNull().alias("z"), fold_name("specialty_name").alias("k"),
                                F.col("specialty_name").alias("n"))).alias("m"))
            .select("specialty_id", F.col("m.n").alias("specialty_name"), F.col("m.k").alias("sort_key")))


def clinic_dim(units: DataFrame) -> DataFrame:
    """PRJ5/SRT2: clinics with regional defaulting to SP, ordered by regional then name."""
    reg = F.coalesce(F.when(F.col("regional") != "", F.col("regional")), F.lit(DEFAULT_REGIONAL))
    return (units.where(F.col("clinic_id").isNotNull())
            .select("clinic_id", "name", reg.alias("regional"))
            .orderBy(F.col("regional").asc_nulls_last(), F.col("name").asc_nulls_last(), "clinic_id"))


def status_dim(spark: SparkSession) -> DataFrame:
    """PRJ6: the 12 fixed status rows (size-bounded, safe to broadcast)."""
    return spark.createDataFrame(list(STATUS_NAMES), "id int, name string")


def status_counts(spark: SparkSession, appointments: DataFrame) -> DataFrame:
    """Appointments per status with the status name (aggregate first, then a
    broadcast join against the fixed 12-row dimension)."""
    counts = appointments.groupBy("status").agg(F.count(F.lit(1)).alias("appointments"))
    dim = F.broadcast(status_dim(spark))
    return counts.join(dim, counts["status"] == dim["id"], "left").select(
        "status", F.coalesce(F.col("name"), F.lit("unknown")).alias("status_name"), "appointments")
