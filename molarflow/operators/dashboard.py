"""Dashboard bundle (AGG12): every KPI for the 7 dashboard parameters as tidy
(metric, dim, value) rows — a few KB, like the reference's stats response.

The period's appointments (with the patient's origin) and payments (with owner and
origin) are materialised once, at period size, and every metric reads those two. The
mode (`agent`, `operators`) keeps the appointments the agent touched or did not, and the
payments of that owner, for every metric but the two totals that show the split and the
best month, which spans the whole history.

Three inputs span the whole history rather than the period: patient origin
(first appointment ever), the agent-touched evaluations behind V4, and the
monthly revenue behind "best month". At scale they are maintained as small
snapshot tables (`build_snapshots`, e.g. nightly) and passed in, so a request
only scans its period; without snapshots they are computed on the fly.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molarflow.config import DEFAULT_DOMAIN, Domain
from molarflow.functions.misc import year_month
from molarflow.functions.text import fold_text
from molarflow.operators import kpi
from molarflow.operators.attribution import attribute_v4, confirmed_payments, qualifying_evaluations, with_agent_touch
from molarflow.operators.filters import in_period
from molarflow.operators.scope import apply_clinics, resolve_clinics
from molarflow.session import ensure_checkpoint_dir

if TYPE_CHECKING:
    from molarflow.plans.params import KpiRequest

MODES = ("all", "agent", "operators")


@dataclass
class KpiSnapshots:
    """Whole-history inputs of the bundle, precomputed."""

    patient_origin: DataFrame      # patient_id, origin
    agent_evaluations: DataFrame   # patient_id, start_time, id (V4-qualifying appointments)
    monthly_revenue: DataFrame     # clinic_id, specialty_id, month, rev (decimal), payments


SNAPSHOT_SCHEMAS = {
    "patient_origin": "patient_id bigint, origin string",
    "agent_evaluations": "id bigint, patient_id bigint, start_time timestamp_ntz",
    "monthly_revenue": "clinic_id string, specialty_id string, month string, rev decimal(28,2), payments bigint",
}


def build_snapshots(spark: SparkSession, appointments: DataFrame, logs: DataFrame, payments: DataFrame,
                    root: str, domain: Domain = DEFAULT_DOMAIN) -> KpiSnapshots:
    """Write the three whole-history tables under `root` (a shared folder) and
    return them read back from storage."""
    frames = {
        "patient_origin": kpi.first_appointment_origin(appointments),
        "agent_evaluations": qualifying_evaluations(appointments, logs, domain).select("id", "patient_id",
                                                                                       "start_time"),
        "monthly_revenue": kpi.monthly_revenue(payments, "clinic_id", "specialty_id"),
    }
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(os.path.join(root, name))
    return KpiSnapshots(**{n: spark.read.schema(SNAPSHOT_SCHEMAS[n]).parquet(os.path.join(root, n))
                           for n in frames})


def _metric(df: DataFrame, metric: str, dim, value: str) -> DataFrame:
    d = F.lit(dim) if isinstance(dim, str) else dim
    return df.select(F.lit(metric).alias("metric"), d.cast("string").alias("dim"), F.col(value).cast("double").alias("value"))


def dashboard_bundle(spark: SparkSession, req: KpiRequest, appointments: DataFrame, logs: DataFrame,
                     payments: DataFrame, allowed: list[str] | None = None,
                     domain: Domain = DEFAULT_DOMAIN, snapshots: KpiSnapshots | None = None) -> DataFrame:
    if req.agent_mode not in MODES:
        raise ValueError(f"agent_mode must be one of {MODES}")
    start, end = req.bounds
    clinics = resolve_clinics(allowed, req.clinic_ids)

    scoped = apply_clinics(appointments, clinics).where(in_period("start_time", start, end))
    if req.specialty_ids:
        scoped = scoped.where(F.col("speciality_id").isin(req.specialty_ids))
    if req.status_codes:
        scoped = scoped.where(F.col("status").isin(req.status_codes))
    if req.creators:
        scoped = scoped.where(F.col("created_by_name_norm").isin([fold_text(c) for c in req.creators]))
    scoped = scoped.select("id", "patient_id", "start_time", "scheduled_start_time", "channel_id")

    pay_all = apply_clinics(payments, clinics)
    if req.specialty_ids:
        pay_all = pay_all.where(F.col("specialty_id").isin(req.specialty_ids))
    pay = confirmed_payments(pay_all).where(in_period("date", start, end))

    # Everything of the period, once: two frames of period size that every metric reads.
    origins = snapshots.patient_origin if snapshots else kpi.first_appointment_origin(appointments)
    if snapshots:
        evaluations = snapshots.agent_evaluations
    else:  # a payment of the period only meets evaluations of the period and the window before it
        evaluations = qualifying_evaluations(
            appointments.where(F.col("start_time") >= F.lit(start - dt.timedelta(days=domain.window_days)).cast("timestamp_ntz"))
            .where(F.col("start_time") < F.lit(end).cast("timestamp_ntz")), logs, domain)
    ensure_checkpoint_dir(spark)
    att = attribute_v4(pay.select("patient_id", "date", "amount", "specialty_id"), None, None, domain, qualifying=evaluations)
    att = att.join(origins, "patient_id", "left").drop("is_agent").checkpoint(eager=True)
    if req.agent_mode != "all":
        scoped = with_agent_touch(scoped, logs, domain).where(F.col("agent_touched") == (req.agent_mode == "agent"))
    appts = scoped.join(origins, "patient_id", "left").checkpoint(eager=True)

    # One aggregation by the payment's owner, origin, month and specialty kind, one by patient.
    first = F.coalesce(F.col("specialty_id") == domain.eval_specialty_id, F.lit(False))
    paid = (att.groupBy("owner", "origin", year_month("date").alias("month"), first.alias("first"))
            .agg(F.sum("amount").alias("revenue")).checkpoint(eager=True))
    mine = paid if req.agent_mode == "all" else paid.where(F.col("owner") == req.agent_mode)

    def revenue(df: DataFrame, metric: str, dim) -> DataFrame:
        d = F.lit(dim) if isinstance(dim, str) else dim
        total = F.coalesce(F.sum("revenue"), F.lit(0))
        out = df.agg(total.alias("value")) if isinstance(dim, str) else df.groupBy(d.alias("dim")).agg(total.alias("value"))
        return _metric(out, metric, dim if isinstance(dim, str) else F.col("dim"), "value")

    parts = [revenue(paid, "revenue_total", "all"), revenue(paid, "revenue_by_owner", F.col("owner")),
             revenue(mine, "revenue", req.agent_mode)]
    kind = F.when(F.col("first"), F.lit("first_consultation")).otherwise(
        F.concat(F.lit("follow_up_"), F.coalesce("origin", F.lit("unclassified"))))
    parts.append(revenue(mine, "sales", kind))

    up = kpi.unique_patients(appts)
    parts.append(_metric(up, "appointments", "all", "appointments"))
    parts.append(_metric(up, "unique_patients", "all", "unique_patients"))
    by_origin = appts.where("origin IS NOT NULL").groupBy("origin").agg(F.count_distinct("patient_id").alias("patients"))
    parts.append(_metric(by_origin, "origin", F.col("origin"), "patients"))

    if snapshots:
        monthly = apply_clinics(snapshots.monthly_revenue, clinics)
        if req.specialty_ids:
            monthly = monthly.where(F.col("specialty_id").isin(req.specialty_ids))
        bm = kpi.best_month_from_monthly(monthly)
    else:
        bm = kpi.best_month(pay_all)
    parts.append(_metric(bm, "best_month", F.col("best_month"), "revenue"))

    rs = kpi.reschedules_two_level(appts, logs.where(in_period("change_date", start, end)))
    parts.append(_metric(rs, "reschedules", F.col("strategy"), "reschedules"))

    months = kpi.calendar_months(spark, start, end)
    by_month = appts.groupBy(year_month("start_time").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    paid_month = mine.groupBy("month").agg(F.sum("revenue").alias("revenue"))
    ms = months.join(by_month, "month", "left").join(paid_month, "month", "left").fillna(0)
    both = F.explode(F.array(F.struct(F.lit("monthly_revenue").alias("metric"), F.col("revenue").cast("double").alias("value")),
                             F.struct(F.lit("monthly_appointments").alias("metric"), F.col("n").cast("double").alias("value"))))
    parts.append(ms.select("month", both.alias("m")).select("m.metric", F.col("month").alias("dim"), "m.value"))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
