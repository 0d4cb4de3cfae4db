"""Dates, hashes, fallbacks, arrays and labels (DAT*, HSH1, NUL1, ARR*, MAP1, CND1, MTH1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- DAT ----

def epoch_or_iso_to_ts(c: Column | str) -> Column:
    """DAT1: a string or number holding epoch seconds or an ISO timestamp -> timestamp_ntz (UTC)."""
    s = F.trim(_col(c).cast("string"))
    secs = F.when(s.rlike(r"^-?\d+(\.\d+)?$"), s.cast("double").cast("bigint"))
    from_epoch = F.timestamp_seconds(secs)
    from_iso = F.try_to_timestamp(s)
    return F.coalesce(from_epoch, from_iso).cast("timestamp_ntz")


def year_month(c: Column | str) -> Column:
    """DAT2: 'yyyy-MM' of a UTC timestamp."""
    return F.date_format(_col(c), "yyyy-MM")


def month_start(c: Column | str) -> Column:
    """DAT2: first instant of the month, kept as timestamp_ntz."""
    return F.date_trunc("month", _col(c)).cast("timestamp_ntz")


def plus_days(c: Column | str, days) -> Column:
    """timestamp_ntz + n days (n may be a Column)."""
    n = days if isinstance(days, Column) else F.lit(int(days))
    return _col(c) + F.make_dt_interval(n)


def lookback_bound(now: dt.datetime, hours: int, cap_hours: int = 6 * 24) -> dt.datetime:
    """DAT3: now - N hours, never further back than the cap (driver-side parameter)."""
    return now - dt.timedelta(hours=min(hours, cap_hours))


def abs_gap_seconds(a: Column | str, b: Column | str) -> Column:
    """DAT4: |a - b| in seconds."""
    return F.abs(F.unix_timestamp(_col(a).cast("timestamp")) - F.unix_timestamp(_col(b).cast("timestamp")))


# ---- NUL / ARR / MAP ----

def blank_to_null(c: Column | str) -> Column:
    """NUL1: empty string -> null (as `value || null`: whitespace is a value)."""
    x = _col(c)
    return F.when(x != "", x)


def non_null_ids(arr: Column | str, field: str) -> Column:
    """ARR1: ids out of an array of structs, nulls dropped."""
    return F.filter(F.transform(_col(arr), lambda e: e.getField(field)), lambda x: x.isNotNull())


def with_label(arr: Column | str, label: str) -> Column:
    """ARR2: add a label without removing the others."""
    return F.array_union(F.coalesce(_col(arr), F.array().cast("array<string>")), F.array(F.lit(label)))


def attribute_present(m: Column | str, key: str) -> Column:
    """MAP1/FLT11: the key exists and its value is not blank."""
    return F.coalesce(F.map_contains_key(_col(m), F.lit(key)) & (F.trim(F.element_at(_col(m), F.lit(key))) != ""),
                      F.lit(False))


# ---- HSH / CND / MTH ----

def digest(c: Column | str) -> Column:
    """HSH1: SHA-256 in hex."""
    return F.sha2(_col(c).cast("string"), 256)


def origin_label(has_campaign: Column) -> Column:
    """CND1: campaign / organic."""
    return F.when(has_campaign, F.lit("campaign")).otherwise(F.lit("organic"))


def owner_label(is_agent: Column) -> Column:
    """CND1: agent / operators."""
    return F.when(is_agent, F.lit("agent")).otherwise(F.lit("operators"))


def clamp(v: int, lo: int, hi: int) -> int:
    """MTH1 on request parameters."""
    return max(lo, min(hi, v))


def total_pages(total: Column, pp: int) -> Column:
    """MTH1/LIM2: max(1, ceil(total / pp))."""
    return F.greatest(F.lit(1), F.ceil(total / F.lit(pp))).cast("bigint")
