"""Request parameters, validated on the driver (FLT2, FLT3, STR7, MTH1).

Everything here is O(request size): parsing strings into small lists that later
become `isin` predicates pushed into the Parquet scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from molarflow.config import (DRILL_LIMIT_DEFAULT, DRILL_LIMIT_MAX, DRILL_LIMIT_MIN, MAX_PERIOD_DAYS,
                              PAGE_SIZE_DEFAULT, PAGE_SIZE_MAX, PAGE_SIZE_MIN)
from molarflow.functions.misc import clamp
from molarflow.functions.text import parse_list


class ParamError(ValueError):
    """A request the reference would answer with HTTP 400."""


def parse_day(s: str | dt.date) -> dt.date:
    if isinstance(s, dt.date):
        return s
    try:
        return dt.datetime.strptime(str(s), "%Y-%m-%d").date()
    except ValueError as e:
        raise ParamError(f"bad date {s!r}, expected YYYY-MM-DD") from e


def validate_period(start, end, max_days: int = MAX_PERIOD_DAYS) -> tuple[dt.datetime, dt.datetime]:
    """FLT2: both dates required, end >= start, at most `max_days` days apart.
    Returns the half-open bounds [start 00:00, end 00:00) as naive UTC datetimes."""
    if not start or not end:
        raise ParamError("start and end are required")
    s, e = parse_day(start), parse_day(end)
    if e < s:
        raise ParamError("end before start")
    if max_days is not None and (e - s).days > max_days:
        raise ParamError(f"period longer than {max_days} days")
    return dt.datetime.combine(s, dt.time()), dt.datetime.combine(e, dt.time())


def page_params(page=None, pp=None) -> tuple[int, int]:
    """LIM1: page >= 1; page size clamped to 10..100, default 25."""
    try:
        p = max(1, int(page or 1))
    except ValueError:
        p = 1
    try:
        size = clamp(int(pp or PAGE_SIZE_DEFAULT), PAGE_SIZE_MIN, PAGE_SIZE_MAX)
    except ValueError:
        size = PAGE_SIZE_DEFAULT
    return p, size


def drill_params(limit=None, offset=None) -> tuple[int, int]:
    """LIM3: limit clamped to 10..500 (default 100), offset >= 0."""
    try:
        lim = clamp(int(limit or DRILL_LIMIT_DEFAULT), DRILL_LIMIT_MIN, DRILL_LIMIT_MAX)
    except ValueError:
        lim = DRILL_LIMIT_DEFAULT
    try:
        off = max(0, int(offset or 0))
    except ValueError:
        off = 0
    return lim, off


SORT_COLUMNS = {"datetime": "start_time", "patient_name": "patient_name", "clinic_id": "clinic_id",
                "status": "status"}


@dataclass
class AppointmentRequest:
    """Parameters of the appointment audit list (FLT1, FLT3-7, SRT1, LIM1)."""

    start: str
    end: str
    clinic_ids: str = ""
    specialty_ids: str = ""
    status_codes: str = ""
    only_status: str | None = None
    origins: str = ""
    suborigins: str = ""
    creators: str = ""
    search: str = ""
    sort_by: str = "start_time"
    sort_order: str = "desc"
    page: int = 1
    pp: int = PAGE_SIZE_DEFAULT

    def __post_init__(self):
        self.page, self.pp = page_params(self.page, self.pp)
        if self.only_status not in (None, ""):
            try:
                int(str(self.only_status).strip())
            except ValueError as e:
                raise ParamError(f"only_status {self.only_status!r} is no number") from e

    @property
    def bounds(self):
        return validate_period(self.start, self.end, max_days=None)

    @property
    def clinics(self) -> list[str] | None:
        v = parse_list(self.clinic_ids)
        return v or None

    @property
    def sort_column(self) -> str:
        return SORT_COLUMNS.get(self.sort_by, "start_time")

    @property
    def ascending(self) -> bool:
        return self.sort_order == "asc"


@dataclass
class LogRequest:
    """Parameters of the confirmation / reschedule audit (FLT8, FLT9, JOI1)."""

    start: str
    end: str
    kind: str = "confirmation"
    reschedule_rule: str = "flag"   # "flag": is_reschedule = true (code); "status": to_status = 3 (older docs)
    clinic_ids: str = ""
    creators: str = ""
    user_ids: str = ""
    is_mc: str | None = None
    origins: str = ""
    suborigins: str = ""
    sort_order: str = "desc"
    page: int = 1
    pp: int = PAGE_SIZE_DEFAULT

    def __post_init__(self):
        self.page, self.pp = page_params(self.page, self.pp)

    @property
    def bounds(self):
        return validate_period(self.start, self.end, max_days=None)

    @property
    def clinics(self) -> list[str] | None:
        v = parse_list(self.clinic_ids)
        return v or None


@dataclass
class KpiRequest:
    """The 7 dashboard parameters (AGG12): period, clinics, specialties, statuses, creators, mode."""

    start: str
    end: str
    clinic_ids: list[str] | None = None
    specialty_ids: list[str] | None = None
    status_codes: list[int] | None = None
    creators: list[str] | None = None
    agent_mode: str = "all"  # all | agent | operators
    extra: dict = field(default_factory=dict)

    @property
    def bounds(self):
        return validate_period(self.start, self.end)


DEFAULT_MIN_LEAD_CREATED_AT = "2026-04-06"  # bulk-import cut (FLT16); a request may override it


@dataclass
class FunnelRequest:
    """Funnel counts / drill-down (AGG9, LIM3): any period, bulk-import cut,
    stage and search for the drill-down, limit 10..500 (default 100), offset >= 0."""

    start: str
    end: str
    min_lead_created_at: str | None = DEFAULT_MIN_LEAD_CREATED_AT
    stage: str = "leads"
    search: str = ""
    limit: int | None = None
    offset: int | None = None

    def __post_init__(self):
        self.limit, self.offset = drill_params(self.limit, self.offset)

    @property
    def bounds(self):
        return validate_period(self.start, self.end, max_days=None)

    @property
    def min_lead(self) -> dt.datetime | None:
        return dt.datetime.combine(parse_day(self.min_lead_created_at), dt.time()) if self.min_lead_created_at else None

