"""As-of lookups over range partitions with seams (JOI5, JOI7, JOI8).

For every left row the latest (or the first) event of the same entity at or before its time. Left
rows and events form one stream, range-partitioned by (entity, time, ...) and stored once; inside a
partition a running value answers most rows. An entity that crosses partitions carries its value
over: the last event of every partition goes through a small seam table, with two entities a
partition at most, to the partitions behind it. So an entity with a third of all rows, or all of them
at one instant, is worked on by many tasks, and no row is copied.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from molarflow.session import stored


@dataclass(frozen=True)
class Lookup:
    """What is looked up: of the events for which `condition` holds, the latest one (or the first one), with
    a flag `value` of it."""

    condition: Column
    value: Column
    first: bool = False


def asof(left: DataFrame, events: DataFrame, lookups: dict[str, Lookup], entity: str, left_time: str, event_time: str,
         event_id: str = "id") -> DataFrame:
    """`left` with a column struct(t, id, v) or null per lookup; ties on the time go by event id (the
    latest is the largest id). An event at the very time of a row counts. Rows without entity or time find nothing."""
    rows = left.select(
        F.col(entity).alias("_entity"), F.col(left_time).alias("_t"), F.lit(1).alias("_kind"),
        F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]).alias("_id"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"))
    wanted = F.lit(False)
    for x in lookups.values():
        wanted = wanted | x.condition
    seen = events.where(F.col(entity).isNotNull() & F.col(event_time).isNotNull() & wanted).select(
        F.col(entity).alias("_entity"), F.col(event_time).alias("_t"), F.lit(0).alias("_kind"), F.col(event_id).cast("bigint").alias("_id"),
        *[F.when(x.condition, F.coalesce(x.value.cast("boolean"), F.lit(False))).alias(f"_v_{n}") for n, x in lookups.items()])
    order = ["_t", "_kind", "_id"]
    dealt = stored(rows.unionByName(seen, allowMissingColumns=True).repartitionByRange("_entity", *order)
                   .withColumn("_part", F.spark_partition_id()), "asof")

    def running(n: str, x: Lookup, window) -> Column:
        """The value is null on rows that are no such event."""
        found = F.when(F.col(f"_v_{n}").isNotNull(), F.struct(F.col("_t").alias("t"), F.col("_id").alias("id"), F.col(f"_v_{n}").alias("v")))
        return (F.first if x.first else F.last)(found, ignorenulls=True).over(window)

    inside = Window.partitionBy("_part", "_entity").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = dealt.select("_part", "_entity", "_kind", "_row", *[running(n, x, inside).alias(f"_l_{n}") for n, x in lookups.items()])
    carried = _seams(dealt, lookups)
    met = local.where("_kind = 1").join(F.broadcast(carried), ["_part", "_entity"], "left")
    found = [(F.coalesce(f"_c_{n}", f"_l_{n}") if x.first else F.coalesce(f"_l_{n}", f"_c_{n}")).alias(n) for n, x in lookups.items()]
    return met.select("_row.*", *found)


def _seams(dealt: DataFrame, lookups: dict[str, Lookup]) -> DataFrame:
    """(part, entity, values carried into the part): the entities at the borders of partitions, so two rows a partition at most."""
    ends = dealt.where("_entity IS NOT NULL").groupBy("_part").agg(F.min("_entity").alias("lowest"), F.max("_entity").alias("highest"))
    border = ends.select(F.explode(F.array("lowest", "highest")).alias("_entity")).distinct()
    last = (dealt.where("_kind = 0").join(F.broadcast(border), "_entity", "left_semi").groupBy("_part", "_entity").agg(*[
        (F.min_by if x.first else F.max_by)(F.struct(F.col("_t").alias("t"), F.col("_id").alias("id"), F.col(f"_v_{n}").alias("v")),
                                            F.when(F.col(f"_v_{n}").isNotNull(), F.struct("_t", "_id"))).alias(f"_e_{n}")
        for n, x in lookups.items()]))
    parts = dealt.where("_kind = 1").join(F.broadcast(border), "_entity", "left_semi").select("_part", "_entity").distinct()
    last = parts.join(last, ["_part", "_entity"], "full")
    before = Window.partitionBy("_entity").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return last.select("_part", "_entity", *[
        (F.first if x.first else F.last)(f"_e_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n, x in lookups.items()])


def within(found: str, time: str, days: int) -> Column:
    """The found event if it is at most `days` days older than the row."""
    return F.when(F.col(f"{found}.t") >= F.col(time) - F.make_dt_interval(F.lit(days)), F.col(found))
