"""Campaign counts in native streaming state."""

import os

from pyspark.sql import functions as F

from molarflow import schemas
from molarflow.operators import leads as ld
from molarflow.plans.registry import Tables
from molarflow.streaming import campaign
from molarflow.streaming.ingest import land

from paths import SF_SMALL

SCHEMA = schemas.CONVERSATIONS_RAW + ", account_id bigint"


def _counts(df):
    return {(r.clinic_id, r.year_month): (r.contacts_count, r.conversations_count) for r in df.collect()}


def _batch(conversations, units):
    keys = campaign.campaign_keys(conversations, units).distinct()
    rows = keys.groupBy("clinic_id", "year_month").agg(F.count_if(F.col("kind") == "contact").alias("contacts_count"),
                                                       F.count_if(F.col("kind") == "conversation").alias("conversations_count"))
    return _counts(rows)


def _size(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(root) for f in files)


def test_equal_to_the_batch_after_every_delivery(spark, tmp_dir):
    t = Tables(spark, SF_SMALL)
    conv = t.crm_conversations
    deliveries = [conv.where("id % 3 = 0"), conv.where("id % 2 = 0"), conv.where("id % 2 = 0"), conv]
    seen = None
    for d in deliveries:
        seen = d if seen is None else seen.unionByName(d)
        got = _counts(campaign.campaign_counts_ingest(spark, tmp_dir, SCHEMA, t.units, [d]))
        assert got == _batch(seen, t.units) and got
    old = {(r.clinic_id, r.year_month): r for r in ld.campaign_contacts(conv, t.units).collect()}
    assert {k: (r.contacts_count, r.conversations_count) for k, r in old.items()} == got


def test_state_written_grows_with_the_batch_only(spark, tmp_dir):
    units = spark.createDataFrame([("c1", "n", "r", 1)], schemas.UNITS)

    def talks(first, n):
        return spark.range(first, first + n).selectExpr(
            "id", "'1767225600' AS created_at", "id + 7 AS contact_id", "array('campanha') AS labels", "CAST(1 AS BIGINT) AS account_id")

    campaign.campaign_counts_ingest(spark, tmp_dir, SCHEMA, units, [talks(0, 20000)])
    first = _size(os.path.join(tmp_dir, "counts-ckpt", "state"))
    land(spark.createDataFrame([("no json",)], "v string").select(F.lit("{broken").alias("x")), os.path.join(tmp_dir, "landing"))
    got = _counts(campaign.campaign_counts_ingest(spark, tmp_dir, SCHEMA, units, [talks(19999, 11)]))
    second = _size(os.path.join(tmp_dir, "counts-ckpt", "state")) - first
    assert got == {("c1", "2026-01"): (20010, 20010)}
    assert second < first / 10
    assert spark.read.json(os.path.join(tmp_dir, "quarantine")).count() == 1
