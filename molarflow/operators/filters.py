"""Audit-list predicates, ordering and paging (FLT1-9, FLT14, SRT1-3, LIM1-2).

Every predicate is a plain Column so Catalyst pushes it below joins and into
the Parquet scan (`PushedFilters`). Request-side strings are parsed once on the
driver (`plans.params`); the executors only see literals.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molarflow.functions.phone import phone_variants
from molarflow.functions.text import parse_int_list, parse_list, search_text
from molarflow.functions.misc import total_pages


def in_period(column: str, start: dt.datetime, end: dt.datetime) -> Column:
    """FLT1: half-open [start, end)."""
    c = F.col(column)
    return (c >= F.lit(start).cast("timestamp_ntz")) & (c < F.lit(end).cast("timestamp_ntz"))


def in_list(column: str, values) -> Column | None:
    """FLT3/FLT5: membership; None when the list is empty (= no filter)."""
    vals = [v for v in (values or []) if v is not None and v != ""]
    return F.col(column).isin(vals) if vals else None


def creators_filter(raw: str, column: str = "created_by_name_norm") -> Column | None:
    """FLT6: pipe-separated names (a name may hold commas), folded like the stored column."""
    names = parse_list(raw, sep="|", fold=True)
    if not names:
        return None
    return F.col(column) == names[0] if len(names) == 1 else F.col(column).isin(names)


def search_filter(raw: str, name_col: str = "patient_name_norm", phone_col: str = "phone_norm") -> Column | None:
    """FLT7: folded-name contains OR phone digits contain any variant (>= 4 digits).
    Literal matching (`%`/`_` are not wildcards). Empty after cleaning -> no filter."""
    raw = (raw or "").strip()
    if not raw:
        return None
    digits = "".join(ch for ch in raw if ch.isdigit() and ch.isascii())
    name = search_text(raw)
    parts: list[Column] = []
    if name:
        parts.append(F.instr(F.col(name_col), name) > 0)
    for v in phone_variants(digits):
        parts.append(F.instr(F.col(phone_col), v) > 0)
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def all_of(df: DataFrame, preds) -> DataFrame:
    """AND every non-null predicate (FLT4: repeated filters AND together)."""
    for p in preds:
        if p is not None:
            df = df.where(p)
    return df


def appointment_predicates(req) -> list[Column | None]:
    """FLT1, FLT3-7 for an `AppointmentRequest` (clinic scope applied separately)."""
    start, end = req.bounds
    preds = [
        in_period("start_time", start, end),
        in_list("speciality_id", parse_list(req.specialty_ids)),
        in_list("status", parse_int_list(req.status_codes)),
        (F.col("status") == int(str(req.only_status).strip())) if req.only_status not in (None, "") else None,
        in_list("patient_channel_name", parse_list(req.origins)),
        in_list("patient_subchannel_name", parse_list(req.suborigins)),
        creators_filter(req.creators),
        search_filter(req.search),
    ]
    return preds


def order_columns(column: str, ascending: bool, tiebreak: str = "id") -> list[Column]:
    """SRT1: Postgres null order (ASC -> nulls last, DESC -> nulls first) + a unique tie-breaker."""
    c = F.col(column)
    main = c.asc_nulls_last() if ascending else c.desc_nulls_first()
    return [main, F.col(tiebreak).asc_nulls_last()]


def page(df: DataFrame, order: list[Column], page_no: int, pp: int) -> DataFrame:
    """LIM1: one page. `orderBy + limit` plans as a distributed top-K
    (TakeOrderedAndProject): each task keeps page_no*pp rows, no global sort."""
    return df.orderBy(*order).offset((page_no - 1) * pp).limit(pp)


def page_totals(df: DataFrame, page_no: int, pp: int, empty_scope: bool = False) -> DataFrame:
    """LIM2: exact total, max(1, ceil(total/pp)) pages; an empty scope gives 0 pages."""
    agg = df.agg(F.count(F.lit(1)).alias("total"))
    pages = F.lit(0).cast("bigint") if empty_scope else total_pages(F.col("total"), pp)
    return agg.select(F.lit(page_no).alias("page"), F.lit(pp).alias("pp"), "total", pages.alias("total_pages"))


def year_or_null(column: str, year: int) -> Column:
    """FLT14: keep rows of one year, or with no date."""
    c = F.col(column)
    return c.isNull() | (F.year(c) == year)


def watermark_cut(cutoff: dt.datetime | None, *cols: str) -> Column | None:
    """FLT13: strict `coalesce(cols..., epoch 0) > cutoff`; no cutoff -> no filter."""
    if cutoff is None:
        return None
    ts = F.coalesce(*[F.col(c) for c in cols], F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz"))
    return ts > F.lit(cutoff).cast("timestamp_ntz")
