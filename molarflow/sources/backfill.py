"""Backfill extraction as one distributed job (SRC5, SRC6, SNK4).

The reference walks (feed, clinic, period) units one by one and writes one
JSON-lines file per unit, skipping units already on disk. Here every feed row
is assigned its unit with column arithmetic, units already done are removed
with an anti-join, and one write per feed lays the rows out as
`root/<feed>/clinic_id=<c>/period=<yyyyMMdd>/part-*.json`; dynamic partition
overwrite replaces exactly the units being rewritten (the per-unit truncate).
"""

from __future__ import annotations

import datetime as dt
import os
from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molarflow.operators.filters import in_period


def period_start(ts: Column, start: dt.datetime, period_days: int) -> Column:
    """First instant of the <= period_days-long period of [start, ...) holding ts."""
    origin = int(start.replace(tzinfo=dt.timezone.utc).timestamp())
    k = F.floor((F.unix_seconds(ts.cast("timestamp")) - F.lit(origin)) / F.lit(period_days * 86400))
    return F.lit(start).cast("timestamp_ntz") + F.make_dt_interval((k * period_days).cast("int"))


def assign_units(rows: DataFrame, date_col: str, start: dt.datetime, end: dt.datetime,
                 period_days: int = 15) -> DataFrame:
    """Rows of one feed inside [start, end), tagged with their unit's period."""
    return (rows.where(in_period(date_col, start, end))
            .withColumn("period", F.date_format(period_start(F.col(date_col), start, period_days), "yyyyMMdd")))


def land_backfill(feeds: Mapping[str, tuple[DataFrame, str]], start: dt.datetime, end: dt.datetime, root: str,
                  period_days: int = 15, done: DataFrame | None = None) -> None:
    """Write every (feed, clinic, period) unit of [start, end) not listed in `done`
    (columns feed, clinic_id, period) under `root/<feed>/`."""
    for name, (rows, date_col) in feeds.items():
        units = assign_units(rows, date_col, start, end, period_days)
        if done is not None:
            skip = done.where(F.col("feed") == name).select("clinic_id", "period").distinct()
            units = units.join(skip, ["clinic_id", "period"], "left_anti")
        (units.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("clinic_id", "period").json(os.path.join(root, name)))
