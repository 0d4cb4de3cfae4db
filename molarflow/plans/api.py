"""The dashboard's request surface as DataFrame functions.

Each function takes a source of domain tables (anything with `appointments`,
`appointment_logs`, `payments`, `leads`, `units` attributes: the test
adapters in `plans.registry.Tables`, or `sources.tables.LakeTables` over a
feed lake), the request's query-string parameters as a dict of strings, and
the caller's allowed clinic ids (None = unrestricted). Validation errors raise
`ParamError` (the reference's HTTP 400). Results are lazy DataFrames; the
caller decides how to collect or write them.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molarflow.functions.text import parse_int_list, parse_list
from molarflow.operators import audit, funnel as fnl, kpi
from molarflow.operators.filters import order_columns, page, page_totals
from molarflow.operators.dashboard import KpiSnapshots, dashboard_bundle
from molarflow.operators.paging import BadCursor
from molarflow.operators.scope import apply_clinics, resolve_clinics, scoped_by_appointment
from molarflow.plans.params import (AppointmentRequest, FunnelRequest, KpiRequest, LogRequest, ParamError,
                                    parse_day)
from molarflow.sources.tables import scan

# The dashboard's agent-mode switch values, mapped to ours.
AGENT_MODES = {"ALL": "all", "MC": "agent", "HUM": "operators"}


def _require_dates(params: Mapping[str, str]) -> tuple[str, str]:
    start, end = params.get("start"), params.get("end")
    if not start or not end:
        raise ParamError("start and end are required")
    parse_day(start), parse_day(end)
    return start, end


def _seeking(fn, *args, **options) -> DataFrame:
    try:
        return fn(*args, **options)
    except BadCursor as e:
        raise ParamError("unknown cursor") from e


def _backward(params: Mapping[str, str]) -> bool:
    direction = params.get("direction") or "next"
    if direction not in ("next", "prev"):
        raise ParamError("direction must be next or prev")
    return direction == "prev"


def appointments(src, params: Mapping[str, str], allowed: list[str] | None = None) -> dict[str, DataFrame]:
    """Audit list of appointments: one page plus its pagination row. With `cursor` (a row's, or empty for
    the first page) pages are found by place instead of number, `direction` next or prev."""
    start, end = _require_dates(params)
    req = AppointmentRequest(
        start=start, end=end, clinic_ids=params.get("clinic_ids", ""), specialty_ids=params.get("specialty_ids", ""),
        status_codes=params.get("status_codes", ""), only_status=params.get("only_status"),
        origins=params.get("origem", ""), suborigins=params.get("suborigem", ""),
        creators=params.get("creators", ""), search=params.get("search", ""),
        sort_by=params.get("sort_by", "start_time"), sort_order=params.get("sort_order", "desc"),
        page=params.get("page", 1), pp=params.get("pp", 25))
    if "cursor" in params:
        data = _seeking(audit.appointments_seek, src.appointments, req, allowed, params["cursor"] or None, _backward(params))
    else:
        data = audit.appointments_page(src.appointments, req, allowed)
    return {"data": data, "pagination": audit.appointments_total(src.appointments, req, allowed)}


def audit_events(src, params: Mapping[str, str], allowed: list[str] | None = None) -> dict[str, DataFrame]:
    """Confirmation / reschedule logs with their appointment: one page plus pagination."""
    start, end = _require_dates(params)
    req = LogRequest(
        start=start, end=end, kind=params.get("type", "confirmation"), clinic_ids=params.get("clinic_ids", ""),
        creators=params.get("creators", ""), user_ids=params.get("user_ids", ""), is_mc=params.get("is_mc"),
        origins=params.get("origem", ""), suborigins=params.get("suborigem", ""),
        sort_order=params.get("sort_order", "desc"), page=params.get("page", 1), pp=params.get("pp", 25))
    events = audit.log_events(src.appointment_logs, src.appointments, req, allowed)
    clinics = resolve_clinics(allowed, req.clinics)
    empty = clinics is not None and len(clinics) == 0
    return {"data": page(events, order_columns("action_at", req.sort_order == "asc", tiebreak="log_id"),
                         req.page, req.pp),
            "pagination": page_totals(events, req.page, req.pp, empty_scope=empty)}


def stats(spark: SparkSession, src, params: Mapping[str, str], allowed: list[str] | None = None,
          snapshots: KpiSnapshots | None = None) -> DataFrame:
    """Every KPI of the dashboard as (metric, dim, value) rows; period <= 92 days."""
    start, end = _require_dates(params)
    mode = AGENT_MODES.get(str(params.get("agent_mode") or "ALL").upper())
    if mode is None:
        raise ParamError("agent_mode must be ALL, MC or HUM")
    req = KpiRequest(start=start, end=end,
                     clinic_ids=parse_list(params.get("clinic_ids")) or None,
                     specialty_ids=parse_list(params.get("specialty_ids")) or None,
                     status_codes=parse_int_list(params.get("status_codes")) or None,
                     creators=parse_list(params.get("creators"), sep="|") or None,
                     agent_mode=mode)
    req.bounds  # validates the 92-day limit before any work is planned
    return dashboard_bundle(spark, req, src.appointments, src.appointment_logs, src.payments,
                            allowed=allowed, snapshots=snapshots)


def _funnel_stages(src, req: FunnelRequest, params: Mapping[str, str], allowed, origins=None) -> DataFrame:
    start, end = req.bounds
    clinics = resolve_clinics(allowed, parse_list(params.get("clinic_ids")) or None)
    return fnl.lead_stages(src.leads, src.appointments, src.appointment_logs, src.payments, start, end,
                           req.min_lead, clinics=clinics, origins=origins)


def funnel(src, params: Mapping[str, str], allowed: list[str] | None = None) -> DataFrame:
    """Funnel counts and conversion percentages for the period."""
    start, end = _require_dates(params)
    req = FunnelRequest(start=start, end=end,
                        min_lead_created_at=params.get("min_lead_created_at") or FunnelRequest.min_lead_created_at)
    return fnl.funnel_counts(_funnel_stages(src, req, params, allowed))


def funnel_detail(src, params: Mapping[str, str], allowed: list[str] | None = None) -> DataFrame:
    """Leads of one stage, with search, origin filter, limit and offset."""
    start, end = _require_dates(params)
    req = FunnelRequest(start=start, end=end,
                        min_lead_created_at=params.get("min_lead_created_at") or FunnelRequest.min_lead_created_at,
                        stage=params.get("stage") or "leads", search=params.get("search") or "",
                        limit=params.get("limit"), offset=params.get("offset"))
    origins = parse_list(params.get("origem")) or None
    stages = _funnel_stages(src, req, params, allowed, origins)
    if "cursor" in params:
        return _seeking(fnl.funnel_detail_seek, stages, req.stage, req.search, req.limit, params["cursor"] or None, _backward(params),
                        by_origin=bool(origins))
    return fnl.funnel_detail(stages, req.stage, req.search, req.limit, req.offset, by_origin=bool(origins))


def lookups(spark: SparkSession, src, allowed: list[str] | None = None) -> dict[str, DataFrame]:
    """Dimension lists for the filters: clinics in scope, statuses, specialties."""
    clinics = kpi.clinic_dim(apply_clinics(src.units, resolve_clinics(allowed, None))).select(
        F.col("clinic_id").alias("id"), "name", "regional")
    specialties = kpi.specialty_dim(src.payments).orderBy("sort_key", "specialty_id").select(
        F.col("specialty_id").alias("id"), F.col("specialty_name").alias("name"))
    return {"clinics": clinics, "statuses": kpi.status_dim(spark), "specialties": specialties}


ALLOWED_TABLES = ("appointments", "appointment_logs", "payments")


def data(src, table: str, select=None, filters=(), order=(), offset: int = 0, limit: int | None = None,
         allowed: list[str] | None = None) -> DataFrame:
    """Generic scan over the allowlisted tables, always inside the caller's scope;
    logs (no clinic column) are scoped through their appointment."""
    if table not in ALLOWED_TABLES:
        raise ParamError(f"table {table!r} not allowed")
    scope = resolve_clinics(allowed, None)
    frames = {"appointments": apply_clinics(src.appointments, scope),
              "payments": apply_clinics(src.payments, scope)}
    logs = src.appointment_logs
    frames["appointment_logs"] = (logs if scope is None
                                  else scoped_by_appointment(logs, frames["appointments"]))
    return scan(frames, table, select=select, filters=filters, order=order, offset=offset, limit=limit)
