"""Revenue attribution between the automated agent and human operators (JOI5-8, AGG4).

V4 (current rule): a confirmed payment belongs to the agent iff the same
patient has an initial-evaluation appointment, attended (7/8), touched by the
agent (agent channel, or any log written by the agent user), whose start_time
lies in the closed window [payment.date - 30 days, payment.date].

Plan shape (no range join at all): the window question "is there a qualifying
appointment in [d - W, d]?" equals "is the latest qualifying appointment at or
before d no older than d - W?". Payments and qualifying appointments are
unioned into one event stream and a running max over a window sorted by time
answers it in O(n log n), whatever the per-patient fan-out. The window is
partitioned by (patient_id, time bucket of W days), and each appointment is
copied into its own and the next bucket, so one very active patient spreads
over many tasks instead of one, and a payment still sees every appointment
that can match it. Payments never fan out, so agent + operators = total by
construction.

A patient whose rows of one bucket are too many for a task is split by the other form, `operators.asof`:
range partitions of (patient, time) with seams, at the price of storing the event stream once. The rule
comparison always takes it, V2 and V4 with `seams=True` (or `Domain.asof_seams`).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from molarflow.config import CONCLUDED_STATUS, DEFAULT_DOMAIN, Domain
from molarflow.functions.misc import owner_label, year_month
from molarflow.operators.asof import Lookup, asof, within


def confirmed_payments(payments: DataFrame) -> DataFrame:
    """FLT12: confirmed and not soft-deleted."""
    return payments.where(F.col("is_confirmed") & F.col("deleted_at").isNull())


def agent_log_appointments(logs: DataFrame, domain: Domain = DEFAULT_DOMAIN) -> DataFrame:
    """Distinct appointment ids with at least one log written by the agent (partial
    aggregation runs map-side, so only distinct ids cross the shuffle)."""
    return (logs.where(F.col("user_id") == domain.agent_user_id)
            .select(F.col("appointment_id").alias("_touched_id")).distinct())


def with_agent_touch(appointments: DataFrame, logs: DataFrame, domain: Domain = DEFAULT_DOMAIN) -> DataFrame:
    """JOI6: adds `agent_touched` = agent channel OR any agent log (existence, no fan-out)."""
    touched = agent_log_appointments(logs, domain).withColumn("_has_log", F.lit(True))
    j = appointments.join(touched, appointments["id"] == touched["_touched_id"], "left")
    return (j.withColumn("agent_touched",
                         F.col("channel_id").isin(list(domain.agent_channel_ids)) | F.coalesce(F.col("_has_log"), F.lit(False)))
            .drop("_touched_id", "_has_log"))


def qualifying_evaluations(appointments: DataFrame, logs: DataFrame, domain: Domain = DEFAULT_DOMAIN) -> DataFrame:
    """Appointments that can give a payment to the agent under V4."""
    base = appointments.where((F.col("speciality_id") == domain.eval_specialty_id)
                              & F.col("status").isin(list(domain.attended))
                              & F.col("patient_id").isNotNull() & F.col("start_time").isNotNull())
    return with_agent_touch(base.select("id", "patient_id", "start_time", "channel_id"), logs, domain) \
        .where(F.col("agent_touched"))


NULL_PATIENT_SPREAD = 1024


def _bucket(ts: Column, days: int) -> Column:
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(days * 86400)).cast("bigint")


def _asof_multi(payments: DataFrame, appts: DataFrame, rules: dict[str, tuple[Column, Column]],
                days: int, bucket_days: int | None = None) -> DataFrame:
    """For every payment row and every rule `name -> (condition, value)`, the latest
    appointment (by start_time, then id) of the same patient with start_time <=
    date that satisfies `condition`, kept only if at most `days` days older than
    the payment. Adds `_asof_<name>` = struct(t, id, v=value) or null.

    All rules share one shuffle on (patient_id, bucket) and one sort; each rule
    is one `last(..., ignorenulls)` over the same window. `appts` needs
    patient_id, start_time, id and whatever the rule columns reference.

    Buckets are `bucket_days` wide (default: the window). A payment in bucket b
    can only match appointments of buckets b - ceil(W/B) .. b, so each candidate
    appointment is copied into its own bucket and the next ceil(W/B). Narrower
    buckets split a very active patient into more, smaller window partitions at
    the price of more appointment copies (payments are never copied).
    """
    width = bucket_days or days
    ahead = -(-days // width)
    pay_cols = payments.columns
    ev_type = "struct<t:timestamp_ntz,id:bigint,v:boolean>"
    # Payments without a patient can never match; instead of a second scan for
    # them, they get negative buckets (spread by a row hash, no appointment lives
    # there), so they neither form one hot window partition nor need a branch.
    bucket = F.when(F.col("patient_id").isNotNull(), _bucket(F.col("date"), width)).otherwise(
        -1 - F.pmod(F.xxhash64(*[F.col(c) for c in pay_cols]), F.lit(NULL_PATIENT_SPREAD)))
    pay_ev = payments.select(
        *pay_cols, F.col("date").alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast("bigint").alias("_aid"),
        bucket.alias("_b"), *[F.lit(None).cast(ev_type).alias(f"_ev_{n}") for n in rules])
    any_rule = None
    for cond, _ in rules.values():
        any_rule = cond if any_rule is None else (any_rule | cond)
    a = appts.where(F.col("patient_id").isNotNull() & F.col("start_time").isNotNull() & any_rule).select(
        F.col("patient_id"), F.col("start_time").alias("_t"), F.col("id").cast("bigint").alias("_aid"),
        *[F.when(cond, F.struct(F.col("start_time").alias("t"), F.col("id").cast("bigint").alias("id"),
                                val.cast("boolean").alias("v"))).alias(f"_ev_{n}")
          for n, (cond, val) in rules.items()],
        F.explode(F.sequence(_bucket(F.col("start_time"), width),
                             _bucket(F.col("start_time"), width) + F.lit(ahead).cast("bigint"))).alias("_b"),
    ).withColumn("_kind", F.lit(0))
    ev = pay_ev.unionByName(a, allowMissingColumns=True)
    w = (Window.partitionBy("patient_id", "_b").orderBy("_t", "_kind", "_aid")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lo = F.col("date") - F.make_dt_interval(F.lit(days))
    out = ev.select(*pay_cols, "_kind", *[F.last(f"_ev_{n}", ignorenulls=True).over(w).alias(f"_l_{n}")
                                          for n in rules])
    out = out.where(F.col("_kind") == 1)
    return out.select(*pay_cols, *[F.when(F.col(f"_l_{n}.t") >= lo, F.col(f"_l_{n}")).alias(f"_asof_{n}")
                                   for n in rules])


def _asof_latest(payments: DataFrame, appts: DataFrame, value: Column, days: int,
                 bucket_days: int | None = None) -> DataFrame:
    """Single-rule form of `_asof_multi` (every row of `appts` qualifies)."""
    return _asof_multi(payments, appts, {"r": (F.lit(True), value)}, days, bucket_days) \
        .withColumnRenamed("_asof_r", "_asof")


def attribute_v4(payments: DataFrame, appointments: DataFrame | None, logs: DataFrame | None,
                 domain: Domain = DEFAULT_DOMAIN, qualifying: DataFrame | None = None,
                 bucket_days: int | None = None, seams: bool | None = None) -> DataFrame:
    """JOI5: payments + `is_agent` + `owner` ('agent' / 'operators'). `qualifying`
    (patient_id, start_time, id) may come precomputed (a snapshot table)."""
    q = qualifying if qualifying is not None else qualifying_evaluations(appointments, logs, domain)
    if domain.asof_seams if seams is None else seams:
        found = asof(payments, q, {"_asof": Lookup(F.lit(True), F.lit(True))}, "patient_id", "date", "start_time")
        is_agent = within("_asof", "date", domain.window_days).isNotNull()
        return found.withColumn("is_agent", is_agent).withColumn("owner", owner_label(is_agent)).drop("_asof")
    flagged = _asof_latest(payments, q, F.lit(True), domain.window_days, bucket_days or domain.asof_bucket_days)
    is_agent = F.col("_asof").isNotNull()
    return flagged.withColumn("is_agent", is_agent).withColumn("owner", owner_label(is_agent)).drop("_asof")


def attribute_v2(payments: DataFrame, appointments: DataFrame, logs: DataFrame,
                 domain: Domain = DEFAULT_DOMAIN, seams: bool | None = None) -> DataFrame:
    """JOI7 (superseded rule, kept for comparison): the latest attended appointment
    (any specialty) within [date - 30 d, date] decides: agent if the agent touched
    it, else operators; no such appointment -> 'unattributed'. Ties on start_time
    go to the larger appointment id."""
    attended = appointments.where(F.col("status").isin(list(domain.attended))
                                  & F.col("patient_id").isNotNull() & F.col("start_time").isNotNull())
    touched = with_agent_touch(attended.select("id", "patient_id", "start_time", "channel_id"), logs, domain)
    if domain.asof_seams if seams is None else seams:
        found = asof(payments, touched, {"_asof": Lookup(F.lit(True), F.col("agent_touched"))}, "patient_id", "date", "start_time")
        found = found.withColumn("_asof", within("_asof", "date", domain.window_days))
    else:
        found = _asof_latest(payments, touched, F.col("agent_touched"), domain.window_days, domain.asof_bucket_days)
    return found.withColumn("owner", _v2_owner(F.col("_asof"))).drop("_asof")


def _v2_owner(found: Column) -> Column:
    return F.when(found.isNull(), F.lit("unattributed")).when(found["v"], F.lit("agent")).otherwise(F.lit("operators"))


def attribute_v1(payments: DataFrame, appointments: DataFrame, logs: DataFrame,
                 domain: Domain = DEFAULT_DOMAIN) -> DataFrame:
    """JOI8/V1 (superseded): agent iff the patient's first concluded (status 8)
    appointment was touched by the agent, and it started at or before the payment.
    One row per patient (min over (start_time, id)), then an equi-join on patient."""
    concluded = appointments.where((F.col("status") == CONCLUDED_STATUS) & F.col("patient_id").isNotNull()
                                   & F.col("start_time").isNotNull())
    touched = with_agent_touch(concluded.select("id", "patient_id", "start_time", "channel_id"), logs, domain)
    first = (touched.groupBy("patient_id")
             .agg(F.min(F.struct("start_time", "id", "agent_touched")).alias("_first"))
             .select(F.col("patient_id").alias("_pid"), F.col("_first.start_time").alias("_first_t"),
                     F.col("_first.agent_touched").alias("_first_agent")))
    j = payments.join(first, payments["patient_id"] == first["_pid"], "left")
    is_agent = F.coalesce(F.col("_first_agent") & (F.col("_first_t") <= F.col("date")), F.lit(False))
    return j.withColumn("owner", owner_label(is_agent)).drop("_pid", "_first_t", "_first_agent")


def attribute_rules(payments: DataFrame, appointments: DataFrame, logs: DataFrame,
                    domain: Domain = DEFAULT_DOMAIN, rules: Sequence[str] = ("v1", "v2", "v3", "v4")) -> DataFrame:
    """The rules in ONE pass: one scan of each input, one event stream. V1 is the patient's first concluded
    appointment so far, the others are the latest ones within the window. Adds owner_v1 to owner_v4 (as asked for)."""
    appts = appointments.where(F.col("patient_id").isNotNull() & F.col("start_time").isNotNull())
    touched = with_agent_touch(appts.select("id", "patient_id", "start_time", "channel_id", "status",
                                            "speciality_id"), logs, domain)
    attended = F.col("status").isin(list(domain.attended))
    agent = F.col("agent_touched")
    lookups = {
        "v1": Lookup(F.col("status") == CONCLUDED_STATUS, agent, first=True),
        "v2": Lookup(attended, agent),
        "v3": Lookup(agent, F.lit(True)),
        "v4": Lookup(attended & (F.col("speciality_id") == domain.eval_specialty_id) & agent, F.lit(True)),
    }
    f = asof(payments, touched, {f"_{r}": lookups[r] for r in rules}, "patient_id", "date", "start_time")

    def owner(rule: str) -> Column:
        found = within(f"_{rule}", "date", domain.window_days)
        if rule == "v1":
            return owner_label(F.coalesce(F.col("_v1.v"), F.lit(False)))
        return _v2_owner(found) if rule == "v2" else owner_label(found.isNotNull())

    return f.withColumns({f"owner_{r}": owner(r) for r in rules}).drop(*[f"_{r}" for r in rules])


def revenue_by_owner(attributed: DataFrame, *dims: str) -> DataFrame:
    """AGG4: revenue and payment count per owner (and optional dimensions)."""
    return (attributed.groupBy(*dims, "owner")
            .agg(F.sum("amount").cast("double").alias("revenue"), F.count(F.lit(1)).alias("payments")))


def attribution_by_clinic_month(payments: DataFrame, appointments: DataFrame, logs: DataFrame,
                                domain: Domain = DEFAULT_DOMAIN) -> DataFrame:
    """Flagship: V4 owner revenue per clinic and payment month over confirmed payments."""
    paid = confirmed_payments(payments).select("patient_id", "clinic_id", "date", "amount")
    att = attribute_v4(paid, appointments, logs, domain).withColumn("month", year_month("date"))
    return revenue_by_owner(att, "clinic_id", "month")
