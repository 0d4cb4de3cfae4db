"""CRM leads: mapping raw payloads to leads, the three-source union, watermarks,
reconciliation and campaign counts (PRJ2, PRJ3, PRJ7, SET1, SET3, FLT11, FLT13,
ARR1, ARR2, JOI9, AGG8, AGG15, AGG16, SNK5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molarflow.config import AD_ORIGIN_ATTRIBUTE, CAMPAIGN_LABEL
from molarflow.functions.misc import attribute_present, blank_to_null, epoch_or_iso_to_ts, non_null_ids, with_label
from molarflow.operators.filters import watermark_cut

LEAD_COLUMNS = ("id", "account_id", "erp_clinic_id", "name", "email", "phone_raw", "identifier", "labels",
                "created_at_cw", "last_activity_at", "inbox_ids")


def _epoch_ts(c: Column) -> Column:
    """Epoch seconds -> timestamp_ntz; 0 and null mean 'unknown' (JS falsy)."""
    return F.when(c.isNotNull() & (c != 0), F.timestamp_seconds(c).cast("timestamp_ntz"))


def numeric_ids(df: DataFrame, column: str = "id") -> DataFrame:
    """PRJ7: coerce an id to bigint, dropping rows where it is not a number."""
    return df.withColumn(column, F.expr(f"try_cast({column} AS bigint)")).where(F.col(column).isNotNull())


def contacts_to_leads(contacts: DataFrame, label: str = CAMPAIGN_LABEL) -> DataFrame:
    """PRJ2: raw contact -> lead row (blank -> null, epoch -> timestamp, constant
    label, inbox ids = non-null contact_inboxes[].inbox.id)."""
    return contacts.select(
        "id", "account_id",
        blank_to_null("name").alias("name"), blank_to_null("email").alias("email"),
        blank_to_null("phone_number").alias("phone_raw"), blank_to_null("identifier").alias("identifier"),
        F.array(F.lit(label)).alias("labels"),
        _epoch_ts(F.col("created_at")).alias("created_at_cw"),
        _epoch_ts(F.col("last_activity_at")).alias("last_activity_at"),
        F.filter(non_null_ids(F.transform("contact_inboxes", lambda e: e.getField("inbox")), "id"),
                 lambda x: x != 0).alias("inbox_ids"),
    )


def conversations_to_leads(conversations: DataFrame, label: str = CAMPAIGN_LABEL) -> DataFrame:
    """PRJ3: lead from each tagged conversation's sender; created_at is the
    conversation's, last activity falls back to it. One row per sender: its
    latest-activity conversation (page order in the reference is activity-desc)."""
    created = epoch_or_iso_to_ts("created_at")
    last = F.coalesce(_epoch_ts(F.col("last_activity_at")), created)
    s = F.col("meta.sender")
    c = (conversations.where(F.array_contains("labels", label) & s.isNotNull() & s.getField("id").isNotNull()
                             & (s.getField("id") != 0))
         .select("account_id", s.getField("id").alias("id"),
                 blank_to_null(s.getField("name")).alias("name"), blank_to_null(s.getField("email")).alias("email"),
                 blank_to_null(s.getField("phone_number")).alias("phone_raw"),
                 blank_to_null(s.getField("identifier")).alias("identifier"),
                 F.array(F.lit(label)).alias("labels"), created.alias("created_at_cw"), last.alias("last_activity_at"),
                 F.when(F.col("inbox_id").isNotNull() & (F.col("inbox_id") != 0), F.array("inbox_id"))
                 .otherwise(F.array().cast("array<int>")).alias("inbox_ids"),
                 F.col("id").alias("_conv_id")))
    best = c.groupBy("account_id", "id").agg(
        F.max_by(F.struct(*[x for x in c.columns if x not in ("account_id", "id")]),
                 F.struct(F.col("last_activity_at"), F.col("_conv_id"))).alias("_b"))
    return best.select("id", "account_id", "_b.*").drop("_conv_id")


def ad_origin_contacts(contacts: DataFrame, attribute: str = AD_ORIGIN_ATTRIBUTE) -> DataFrame:
    """FLT11: contacts carrying a non-blank ad-origin custom attribute."""
    return contacts.where(attribute_present("custom_attributes", attribute))


def _cut_per_account(df: DataFrame, watermarks: DataFrame, *cols: str) -> DataFrame:
    """FLT13 with one watermark per account: keep coalesce(cols, epoch 0) > watermark
    (strict); accounts without a watermark keep everything."""
    wm = watermarks.select("account_id", F.col("last_activity_seen").alias("_wm"))
    act = F.coalesce(*[F.col(c) for c in cols], F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz"))
    return df.join(wm, "account_id", "left").where(F.col("_wm").isNull() | (act > F.col("_wm"))).drop("_wm")


def lead_union(contacts: DataFrame, conversations: DataFrame | None, units: DataFrame,
               cutoff: dt.datetime | None = None, label: str = CAMPAIGN_LABEL,
               watermarks: DataFrame | None = None) -> DataFrame:
    """SET1: tagged contacts (rank 1), senders of tagged conversations (rank 2),
    ad-origin contacts (rank 3); on (id, account_id) conflict the higher rank
    wins, as the sources are written in that order, and inside a source the row with
    the latest activity, then creation. FLT13 cuts each
    source at its own activity column when a cutoff (one instant) or per-account
    `watermarks` (account_id, last_activity_seen) are given (incremental run)."""
    tagged = contacts.where(F.array_contains("labels", label))
    parts = [(contacts_to_leads(tagged, label).withColumn("source", F.lit(1)), ("last_activity_at",))]
    if conversations is not None:
        parts.append((conversations_to_leads(conversations, label).withColumn("source", F.lit(2)),
                      ("last_activity_at",)))
    parts.append((contacts_to_leads(ad_origin_contacts(contacts), label).withColumn("source", F.lit(3)),
                  ("last_activity_at", "created_at_cw")))
    u = None
    for df, cols in parts:
        if cutoff is not None:
            df = df.where(watermark_cut(cutoff, *cols))
        if watermarks is not None:
            df = _cut_per_account(df, watermarks, *cols)
        u = df if u is None else u.unionByName(df)
    cols = [c for c in u.columns if c not in ("id", "account_id")]
    win = u.groupBy("id", "account_id").agg(F.max_by(F.struct(*cols), F.struct("source", "last_activity_at", "created_at_cw")).alias("_w"))
    clinic = units.select(F.col("account_id").alias("_acc"), F.col("clinic_id").alias("erp_clinic_id"))
    out = win.select("id", "account_id", "_w.*")
    out = out.join(clinic, out["account_id"] == clinic["_acc"], "left").drop("_acc")
    return out.select(*LEAD_COLUMNS, "source")


def leads_to_tag(contacts: DataFrame, label: str = CAMPAIGN_LABEL) -> DataFrame:
    """ARR2: ad-origin contacts missing the campaign label, with their target label
    set (label added, others kept). The write back to the CRM is not built."""
    c = ad_origin_contacts(contacts).where(~F.coalesce(F.array_contains("labels", label), F.lit(False)))
    return c.select("account_id", "id", F.col("labels").alias("labels_before"),
                    with_label("labels", label).alias("labels_after"))


def seen_ids(union: DataFrame) -> DataFrame:
    """Ids seen by a full refresh, per account (output of `lead_union`)."""
    return union.select("account_id", "id").distinct()


def presence(stored: DataFrame, seen: DataFrame, label: str = CAMPAIGN_LABEL) -> DataFrame:
    """One row per (account_id, id) of the stored tagged leads and the seen ids, with 0/1 flags
    `stored` and `seen`: both inputs are read and shuffled once."""
    have = stored.where(F.array_contains("labels", label)).select("account_id", "id", F.lit(1).alias("stored"), F.lit(0).alias("seen"))
    found = seen.select("account_id", "id", F.lit(0).alias("stored"), F.lit(1).alias("seen"))
    return have.unionByName(found).groupBy("account_id", "id").agg(F.max("stored").alias("stored"), F.max("seen").alias("seen"))


def stale_leads(stored: DataFrame, seen: DataFrame, failed_accounts: DataFrame | None = None,
                label: str = CAMPAIGN_LABEL) -> DataFrame:
    """JOI9/SET3: stored tagged leads of an account that the full refresh did not see.
    Guards: an account with nothing seen, or with a failed source, deletes nothing."""
    both = presence(stored, seen, label)
    accounts = both.groupBy("account_id").agg(F.max("seen").alias("any")).where("any = 1").select("account_id")
    if failed_accounts is not None:
        accounts = accounts.join(failed_accounts.select("account_id"), "account_id", "left_anti")
    return both.where("stored = 1 AND seen = 0").select("account_id", "id").join(accounts, "account_id", "left_semi")


def delete_keys(table: DataFrame, keys: DataFrame, key_cols=("account_id", "id")) -> DataFrame:
    """SNK5: the table without the listed keys (anti-join rewrite)."""
    return table.join(keys.select(*key_cols), list(key_cols), "left_anti")


def reconcile_audit(stored: DataFrame, seen: DataFrame, failed_accounts: DataFrame | None = None,
                    label: str = CAMPAIGN_LABEL) -> DataFrame:
    """AGG15: per account source / stored / stale / deleted counts (stale under the guards of
    `stale_leads`), plus a totals row (account_id null) from `rollup`."""
    per = presence(stored, seen, label).groupBy("account_id").agg(
        F.sum("seen").alias("source_count"), F.sum("stored").alias("stored_count"),
        F.sum(F.expr("stored * (1 - seen)")).alias("missing"))
    guard = F.col("source_count") > 0
    if failed_accounts is not None:
        per = per.join(failed_accounts.select("account_id", F.lit(True).alias("_failed")), "account_id", "left")
        guard = guard & F.col("_failed").isNull()
    per = per.withColumn("stale_count", F.when(guard, F.col("missing")).otherwise(0))
    return (per.rollup("account_id")
            .agg(F.sum("source_count").alias("source_count"), F.sum("stored_count").alias("stored_count"),
                 F.sum("stale_count").alias("stale_count"), F.sum("stale_count").alias("deleted")))


def activity_watermark(previous: DataFrame, batch: DataFrame) -> DataFrame:
    """AGG16: per account, greatest(old watermark, max activity of the batch);
    the old value stays when nothing newer arrived."""
    b = batch.groupBy("account_id").agg(F.max("last_activity_at").alias("batch_max"))
    j = previous.join(b, "account_id", "full")
    return j.select("account_id", F.col("last_activity_seen").alias("previous"), "batch_max",
                    F.greatest("last_activity_seen", "batch_max").alias("last_activity_seen"))


def campaign_contacts(conversations: DataFrame, units: DataFrame, label: str = CAMPAIGN_LABEL) -> DataFrame:
    """AGG8: per clinic and month, distinct tagged conversations and distinct
    contacts (sender id, else the conversation's contact id). Every month, not
    just the current one."""
    created = epoch_or_iso_to_ts("created_at")
    c = conversations.where(F.array_contains("labels", label)).select(
        "account_id", F.col("id").alias("conv_id"), F.date_format(created, "yyyy-MM").alias("year_month"),
        F.coalesce(F.col("meta.sender.id"), F.col("contact_id")).alias("contact"))
    c = c.where(F.col("year_month").isNotNull())
    clinic = units.select(F.col("account_id"), F.col("clinic_id"))
    keys = F.explode(F.array(F.struct(F.lit("contact").alias("kind"), F.col("contact").alias("key")),
                             F.struct(F.lit("conversation").alias("kind"), F.col("conv_id").alias("key"))))
    # distinct keys first (one aggregation, combined map-side), then a plain count per kind
    distinct = (c.join(clinic, "account_id").select("clinic_id", "year_month", keys.alias("k"))
                .select("clinic_id", "year_month", "k.kind", "k.key").distinct())
    return (distinct.groupBy("clinic_id", "year_month")
            .agg(F.count_if((F.col("kind") == "contact") & F.col("key").isNotNull()).alias("contacts_count"),
                 F.count_if((F.col("kind") == "conversation") & F.col("key").isNotNull()).alias("conversations_count"))
            .withColumn("campaign_tag", F.lit(label)))
