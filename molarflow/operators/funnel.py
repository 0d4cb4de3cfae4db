"""Lead-to-sale funnel (JOI3, JOI4, AGG9, LIM3, FLT10, FLT16).

Stages of a lead (label `campanha`, created in [max(start, min_lead), end)):
  scheduled  an appointment with the same phone key, created at/after the lead;
  confirmed  such an appointment has a confirmation log (to_status 4) or ended attended (7/8);
  attended   such an appointment ended attended (7/8);
  sold       the patient of such an appointment has a confirmed payment in [start, end)
             dated at/after the lead.
Only the lead count is limited to the period; stage events are not (except sold).
The funnel need not be monotone (sold does not require attended).

Plan shape: the appointment side is reduced to ONE row per phone key before it
meets the leads (max created_at per stage; for `sold`, the max over the key's
patients of least(last appointment, last payment)), so a phone shared by many
patients or leads never multiplies rows: each lead joins at most one row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molarflow.config import CAMPAIGN_LABEL, CONFIRMED_STATUS, DEFAULT_DOMAIN, Domain
from molarflow.functions.phone import phone_key
from molarflow.functions.text import fold_name
from molarflow.operators.attribution import confirmed_payments
from molarflow.operators.filters import in_period, search_filter
from molarflow.operators.paging import Order, seek

STAGES = ("leads", "scheduled", "confirmed", "attended", "sold")

# Stage names as the dashboard sends them, mapped to ours.
STAGE_ALIASES = {"leads": "leads", "agendados": "scheduled", "confirmados": "confirmed",
                 "compareceram": "attended", "venderam": "sold"}


#: Newest first.
DETAIL_ORDER = Order("created_at_cw", False, ("id", "account_id"))
_DETAIL_COLUMNS = ("id", "account_id", "name", "phone_raw", "created_at_cw", *STAGES[1:])


class UnknownStage(ValueError):
    pass


def campaign_leads(leads: DataFrame, start: dt.datetime, end: dt.datetime,
                   min_lead_created_at: dt.datetime | None, label: str = CAMPAIGN_LABEL) -> DataFrame:
    """FLT10 + FLT16 + period: tagged leads created in [max(start, min_lead), end)."""
    lo = max(start, min_lead_created_at) if min_lead_created_at else start
    return leads.where(F.array_contains("labels", label) & in_period("created_at_cw", lo, end))


def _max_if(cond: Column, value: str = "created_at") -> Column:
    return F.max(F.when(cond, F.col(value)))


def phone_stage_index(appointments: DataFrame, logs: DataFrame, payments: DataFrame,
                      start: dt.datetime, end: dt.datetime, domain: Domain = DEFAULT_DOMAIN,
                      origins: list[str] | None = None, since: dt.datetime | None = None) -> DataFrame:
    """One row per phone key over appointments created from `since` on (a lead only meets
    appointments created after it): latest created_at of any / confirmed / attended
    appointment, and `sold_until` = max over the key's patients of
    least(patient's last appointment created_at, patient's last paid date)."""
    origin_ok = F.col("patient_channel_name").isin(origins) if origins else F.lit(False)
    if since is not None:
        appointments = appointments.where(F.col("created_at") >= F.lit(since).cast("timestamp_ntz"))
    a = (appointments.select("id", "patient_id", "created_at", "status", phone_key("phone").alias("phone_key"),
                             origin_ok.alias("_origin_ok"))
         .where(F.col("phone_key").isNotNull() & F.col("created_at").isNotNull()))
    confirmed_ids = (logs.where(F.col("to_status") == CONFIRMED_STATUS).select(F.col("appointment_id").alias("_cid")).distinct()
                     .withColumn("_conf", F.lit(True)))
    a = a.join(confirmed_ids, a["id"] == confirmed_ids["_cid"], "left")
    attended = F.col("status").isin(list(domain.attended))
    paid = (confirmed_payments(payments).where(in_period("date", start, end) & F.col("patient_id").isNotNull())
            .groupBy("patient_id").agg(F.max("date").alias("last_paid")))
    # one row per patient on the right: appointments never fan out here
    ap = a.join(paid, "patient_id", "left")
    # max over a patient's appointments of least(created_at, last_paid) equals
    # least(patient's last created_at, last_paid), so the per-key maximum needs
    # no per-(key, patient) step
    sold_until = F.when(F.col("last_paid").isNotNull(), F.least("created_at", "last_paid"))
    return ap.groupBy("phone_key").agg(
        F.max("created_at").alias("last_created"),
        _max_if(attended | F.coalesce(F.col("_conf"), F.lit(False))).alias("last_confirmed"),
        _max_if(attended).alias("last_attended"),
        F.max(sold_until).alias("sold_until"),
        _max_if(F.col("_origin_ok")).alias("last_origin"))


def lead_stages(leads: DataFrame, appointments: DataFrame, logs: DataFrame, payments: DataFrame,
                start: dt.datetime, end: dt.datetime, min_lead_created_at: dt.datetime | None,
                domain: Domain = DEFAULT_DOMAIN, clinics: list[str] | None = None,
                origins: list[str] | None = None) -> DataFrame:
    """Every period lead with boolean stage flags (JOI3 + JOI4 as equi-join on phone key).
    `clinics` limits leads to their clinic (FLT15; None = all, [] = none); with
    `origins`, `origin_match` says whether a matched appointment (created at/after
    the lead) has one of those patient origins (the drill-down's origin filter)."""
    ld = campaign_leads(leads, start, end, min_lead_created_at, domain.campaign_label)
    if clinics is not None:
        ld = ld.where(F.col("erp_clinic_id").isin(clinics)) if clinics else ld.where(F.lit(False))
    ld = ld.withColumn("phone_key", phone_key("phone_raw"))
    since = max(start, min_lead_created_at) if min_lead_created_at else start
    idx = phone_stage_index(appointments, logs, payments, start, end, domain, origins, since)
    j = ld.join(idx, "phone_key", "left")
    lc = F.col("created_at_cw")

    def reached(c: str) -> Column:
        return F.coalesce(F.col(c) >= lc, F.lit(False))

    return j.select(*ld.columns, reached("last_created").alias("scheduled"),
                    reached("last_confirmed").alias("confirmed"), reached("last_attended").alias("attended"),
                    reached("sold_until").alias("sold"), reached("last_origin").alias("origin_match"))


def funnel_counts(stages: DataFrame) -> DataFrame:
    """AGG9: one row of stage counts and conversion % (stage / leads)."""
    leads_n = F.count(F.lit(1))
    aggs = [leads_n.alias("leads")] + [F.count_if(F.col(s)).alias(s) for s in STAGES[1:]]
    out = stages.agg(*aggs)
    for s in STAGES[1:]:
        out = out.withColumn(f"{s}_pct", F.round(F.try_divide(F.col(s) * 100.0, F.col("leads")), 2))
    return out


def funnel_detail(stages: DataFrame, stage: str, search: str = "", limit: int = 100, offset: int = 0,
                  by_origin: bool = False) -> DataFrame:
    """LIM3: leads that reached `stage` (our names or the dashboard's), optional FLT7
    search on name/phone and origin filter, newest first."""
    return (_stage_rows(stages, stage, search, by_origin).orderBy(*DETAIL_ORDER.columns()).offset(offset).limit(limit)
            .select(*_DETAIL_COLUMNS))


def funnel_detail_seek(stages: DataFrame, stage: str, search: str = "", limit: int = 100, cursor: str | None = None,
                       backward: bool = False, by_origin: bool = False) -> DataFrame:
    """LIM3 by cursor: the leads behind (or before) the row of `cursor`, each with its own cursor."""
    return seek(_stage_rows(stages, stage, search, by_origin).select(*_DETAIL_COLUMNS), DETAIL_ORDER, limit, cursor, backward)


def _stage_rows(stages: DataFrame, stage: str, search: str, by_origin: bool) -> DataFrame:
    stage = STAGE_ALIASES.get(stage, stage)
    if stage not in STAGES:
        raise UnknownStage(stage)
    df = stages if stage == "leads" else stages.where(F.col(stage))
    if by_origin:
        df = df.where(F.col("origin_match"))
    df = df.withColumn("_name_norm", fold_name("name")).withColumn(
        "_phone_digits", F.regexp_replace("phone_raw", "[^0-9]", ""))
    pred = search_filter(search, "_name_norm", "_phone_digits")
    if pred is not None:
        df = df.where(pred)
    return df
