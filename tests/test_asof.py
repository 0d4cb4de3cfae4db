"""As-of lookups by range partitions with seams: equal to brute force, no task holds a hot entity."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from molarflow.operators import asof as A
from molarflow.operators import attribution as att
from molarflow.plans.registry import Tables

from paths import SF_SMALL

BASE = dt.datetime(2026, 1, 1)
LEFT = "id string, who bigint, at timestamp_ntz, t string, `_id` string"
EVENTS = "id bigint, who bigint, at timestamp_ntz, flag boolean, wanted boolean"


def _brute(left, events, first):
    out = {}
    for i, who, at, *_ in left:
        hits = [(t, e, bool(f)) for e, w, t, f, want in events
                if want and who is not None and at is not None and w == who and t is not None and t <= at]
        out[i] = (min if first else max)(hits, key=lambda h: h[:2]) if hits else None
    return out


def _rows(seed, n, minutes):
    r = random.Random(seed)
    who = lambda: r.choice([1] * 8 + [2, 3, 4, None])  # noqa: E731 - entity 1 holds two thirds
    when = lambda: None if r.random() < 0.03 else BASE + dt.timedelta(minutes=r.randrange(minutes))
    left = [(f"p{i}", who(), when(), "x", "y") for i in range(n)]
    events = [(i, who(), when(), r.choice([True, False, None]), r.random() < 0.5) for i in range(n)]
    return left, events


@pytest.mark.parametrize("seed,minutes", [(1, 40), (2, 100_000), (3, 1)])
def test_latest_and_first_equal_brute_force(spark, seed, minutes):
    left, events = _rows(seed, 300, minutes)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = A.asof(spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(events, EVENTS).repartition(2), {
            "late": A.Lookup(F.col("wanted"), F.col("flag")), "early": A.Lookup(F.col("wanted"), F.col("flag"), first=True)},
            "who", "at", "at").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert sorted(r.id for r in got) == sorted(x[0] for x in left)
    for name, first in (("late", False), ("early", True)):
        assert {r.id: tuple(r[name]) if r[name] else None for r in got} == _brute(left, events, first)


def test_an_entity_with_a_third_of_the_rows_is_split(spark, monkeypatch):
    left = [(f"p{i}", 1 if i % 3 == 0 else i, BASE + dt.timedelta(minutes=0 if i % 2 else i), "x", "y") for i in range(4000)]
    events = [(i, 1 if i % 3 == 0 else i, BASE, True, True) for i in range(4000)]
    kept = []
    own = A.stored
    monkeypatch.setattr(A, "stored", lambda df, name: kept.append(own(df, name)) or kept[-1])
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = A.asof(spark.createDataFrame(left, LEFT).repartition(4), spark.createDataFrame(events, EVENTS).repartition(4),
                     {"late": A.Lookup(F.col("wanted"), F.col("flag"))}, "who", "at", "at")
        assert out.where("late IS NOT NULL").count() == 4000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    sizes = sorted(Counter(r[0] for r in kept[0].select("_part").collect()).values())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    hot = {r[0] for r in kept[0].where("_entity = 1").select("_part").distinct().collect()}
    assert len(hot) >= 3
    groups = Counter((r[0], r[1]) for r in kept[0].select("_part", "_entity").collect())
    assert max(groups.values()) <= 2 * sizes[len(sizes) // 2]


def test_empty_sides(spark):
    left, events = _rows(4, 20, 50)
    look = {"late": A.Lookup(F.col("wanted"), F.col("flag"))}
    a, b = spark.createDataFrame(left, LEFT), spark.createDataFrame(events, EVENTS)
    assert A.asof(a, b.where("false"), look, "who", "at", "at").where("late IS NULL").count() == 20
    assert A.asof(a.where("false"), b, look, "who", "at", "at").count() == 0


def test_rules_in_one_pass_equal_each_rule_alone(spark):
    t = Tables(spark, SF_SMALL)
    paid = att.confirmed_payments(t.payments).select("id", "patient_id", "date", "amount")
    both = att.attribute_rules(paid, t.appointments, t.appointment_logs)
    one = {r.id: r for r in both.collect()}
    for rule, df in (("v1", att.attribute_v1(paid, t.appointments, t.appointment_logs)),
                     ("v2", att.attribute_v2(paid, t.appointments, t.appointment_logs)),
                     ("v4", att.attribute_v4(paid, t.appointments, t.appointment_logs))):
        assert {r.id: r.owner for r in df.collect()} == {i: r[f"owner_{rule}"] for i, r in one.items()}
