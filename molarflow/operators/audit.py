"""Audit lists: appointments page and log-with-appointment pages (JOI1, PRJ1, PRJ4, FLT8-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from molarflow.config import CONFIRMED_STATUS, DEFAULT_DOMAIN, RESCHEDULED_STATUS, Domain
from molarflow.functions.text import parse_list
from molarflow.operators import filters as flt
from molarflow.operators.paging import Order, seek
from molarflow.operators.scope import apply_clinics, resolve_clinics

# PRJ1: the audit list's column list.
APPOINTMENT_COLUMNS = ("id", "patient_id", "patient_name", "clinic_id", "doctor_name", "start_time",
                       "scheduled_start_time", "status", "speciality_id", "channel_id", "created_by_name",
                       "phone", "type", "campaign_token", "channel_name", "patient_channel_name",
                       "patient_subchannel_name")

# PRJ4: flattened log + appointment row (22 columns).
LOG_COLUMNS = ("log_id", "appointment_id", "user_id", "is_mc", "from_status", "to_status", "is_reschedule",
               "action_at", "patient_id", "patient_name", "clinic_id", "start_time", "scheduled_start_time",
               "doctor_name", "speciality_id", "phone", "created_by_name", "type", "campaign_token",
               "channel_name", "patient_channel_name", "patient_subchannel_name")


def filtered_appointments(appointments: DataFrame, req, allowed: list[str] | None = None) -> tuple[DataFrame, bool]:
    """Scope + every request predicate. Returns (frame, scope_is_empty)."""
    clinics = resolve_clinics(allowed, req.clinics)
    empty = clinics is not None and len(clinics) == 0
    df = apply_clinics(appointments, clinics)
    return flt.all_of(df, flt.appointment_predicates(req)), empty


def appointments_page(appointments: DataFrame, req, allowed: list[str] | None = None) -> DataFrame:
    df, _ = filtered_appointments(appointments, req, allowed)
    df = df.select(*APPOINTMENT_COLUMNS)
    return flt.page(df, flt.order_columns(req.sort_column, req.ascending), req.page, req.pp)


def appointments_seek(appointments: DataFrame, req, allowed: list[str] | None = None, cursor: str | None = None,
                      backward: bool = False) -> DataFrame:
    """The page behind (or before) the row of `cursor`, each row with its own cursor."""
    df, _ = filtered_appointments(appointments, req, allowed)
    return seek(df.select(*APPOINTMENT_COLUMNS), Order(req.sort_column, req.ascending), req.pp, cursor, backward)


def appointments_total(appointments: DataFrame, req, allowed: list[str] | None = None) -> DataFrame:
    df, empty = filtered_appointments(appointments, req, allowed)
    return flt.page_totals(df, req.page, req.pp, empty_scope=empty)


def log_events(logs: DataFrame, appointments: DataFrame, req, allowed: list[str] | None = None,
               domain: Domain = DEFAULT_DOMAIN) -> DataFrame:
    """JOI1 + PRJ4: logs of one kind in [start, end) on change_date, inner-joined to
    their appointment; appointment-side filters are applied before the join so
    they prune the appointment scan, log-side filters prune the log scan."""
    start, end = req.bounds
    if req.kind == "reschedule":
        # FLT9: the code tests the flag; the older rule texts say to_status = 3. Both exposed.
        kind = (F.col("to_status") == RESCHEDULED_STATUS if req.reschedule_rule == "status"
                else F.coalesce(F.col("is_reschedule"), F.lit(False)))
    else:  # any other type is a confirmation
        kind = F.col("to_status") == CONFIRMED_STATUS
    lg = logs.where(kind & flt.in_period("change_date", start, end))
    users = parse_list(req.user_ids)
    if users:
        lg = lg.where(F.col("user_id").isin(users))
    elif req.is_mc == "true":
        lg = lg.where(F.col("user_id") == domain.agent_user_id)
    elif req.is_mc == "false":
        lg = lg.where(F.col("user_id") != domain.agent_user_id)  # nulls drop out, as `neq` does

    clinics = resolve_clinics(allowed, req.clinics)
    ap = apply_clinics(appointments, clinics)
    ap = flt.all_of(ap, [
        flt.creators_filter(req.creators),
        flt.in_list("patient_channel_name", parse_list(req.origins)),
        flt.in_list("patient_subchannel_name", parse_list(req.suborigins)),
    ])
    ap = ap.select(F.col("id").alias("_aid"), "patient_id", "patient_name", "clinic_id", "start_time",
                   "scheduled_start_time", "doctor_name", "speciality_id", "phone", "created_by_name", "type",
                   "campaign_token", "channel_name", "patient_channel_name", "patient_subchannel_name")
    j = lg.join(ap, lg["appointment_id"] == ap["_aid"], "inner")
    return j.select(
        F.col("id").alias("log_id"), "appointment_id", "user_id",
        F.coalesce(F.col("user_id") == domain.agent_user_id, F.lit(False)).alias("is_mc"),
        "from_status", "to_status",
        F.coalesce(F.col("is_reschedule"), F.lit(False)).alias("is_reschedule"),
        F.col("change_date").alias("action_at"),
        *LOG_COLUMNS[8:],
    )


def log_events_page(logs: DataFrame, appointments: DataFrame, req, allowed=None,
                    domain: Domain = DEFAULT_DOMAIN) -> DataFrame:
    df = log_events(logs, appointments, req, allowed, domain)
    asc = req.sort_order == "asc"
    return flt.page(df, flt.order_columns("action_at", asc, tiebreak="log_id"), req.page, req.pp)
