"""Adapters: domain-shaped tables derived from the driver's star-schema tables.

The test tables are TPC-H-like (orders, lineitem, customer ...), so each domain
table is a deterministic projection of them. Every expression here has a twin
in `molarflow.plans.oracle_views` written in DuckDB SQL; keep them in step.

All adapters are lazy DataFrames: Catalyst prunes the columns a query does not
use and pushes its filters into the Parquet scan, so a query over
`appointments` reading only `clinic_id` and `start_time` scans only
`o_orderdate`, `o_custkey` and `c_nationkey`.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from molarflow.functions.misc import plus_days
from molarflow.functions.text import fold_name, phone_digits

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Invented first names (with accents) given to patients by key % 8.
FIRST_NAMES = ("José", "Inês", "João", "Ana", "Mário", "Cecília", "André", "Lúcia")

# Invented staff names by key % 7 (null for 6): accent pair,
# double inner space, leading space.
CREATOR_NAMES = ("Auto Agent", "Paulo Simão", "Paulo Simao", "Carla  Dias", " Bruna", "Fábio Núñez", None)

LEAD_EPOCH = "1995-06-01 00:00:00"


# Explicit schemas of the driver's tables the adapters read (never inferred:
# no footer-inference job per read, and a changed file fails loudly).
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC1 on the driver's layout: one parquet file per table, explicit schema."""
    reader = spark.read.schema(RAW_SCHEMAS[name]) if name in RAW_SCHEMAS else spark.read
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _pick(key: Column, values: tuple, mod: int) -> Column:
    """CASE key % mod WHEN i THEN values[i] ... (portable with the SQL twin)."""
    k = key % mod
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        expr = F.when(k == i, lit) if expr is None else expr.when(k == i, lit)
    return expr


def phone_text(key: Column, shift: int = 0) -> Column:
    """One Brazilian mobile per key, written in 4 formats chosen by (key+shift) % 4;
    every 37th key has no phone and every 41st has a junk 3-digit phone."""
    ddd = (F.lit(11) + key % 89).cast("string")
    num8 = F.lpad(((key * 7919 + 1000003) % 100000000).cast("string"), 8, "0")
    fmt = (key + shift) % 4
    spelled = (
        F.when(fmt == 0, F.concat(F.lit("("), ddd, F.lit(") 9"), F.substring(num8, 1, 4), F.lit("-"),
                                  F.substring(num8, 5, 4)))
        .when(fmt == 1, F.concat(F.lit("+55 "), ddd, F.lit(" 9"), num8))
        .when(fmt == 2, F.concat(ddd, num8))
        .otherwise(F.concat(F.lit("55"), ddd, num8))
    )
    return F.when(key % 37 == 0, F.lit(None).cast("string")).when(key % 41 == 0, F.lit("123")).otherwise(spelled)


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = raw(spark, sf_dir, "nation"), raw(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("clinic_id"),
        F.col("n_name").alias("name"),
        F.when(F.col("n_nationkey") % 7 == 3, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("regional"),
        F.col("n_nationkey").cast("bigint").alias("account_id"),
    )


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = raw(spark, sf_dir, "orders"), raw(spark, sf_dir, "customer")
    k, ck = F.col("o_orderkey"), F.col("c_custkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit(7) + k % 2)
        .when(F.col("o_orderstatus") == "P", F.when(k % 3 == 0, 4).when(k % 3 == 1, 3).otherwise(1))
        .otherwise(F.when(k % 2 == 0, 5).otherwise(11))
    ).cast("int")
    patient_name = F.concat(_pick(ck, FIRST_NAMES, 8), F.lit(" "), F.col("c_name"))
    creator = _pick(k, CREATOR_NAMES, 7)
    phone = phone_text(ck, 0)
    return o.join(c, o.o_custkey == c.c_custkey).select(
        k.alias("id"),
        F.col("o_custkey").alias("patient_id"),
        patient_name.alias("patient_name"),
        F.col("c_nationkey").cast("string").alias("clinic_id"),
        F.concat(F.lit("Dr "), (k % 17).cast("string")).alias("doctor_name"),
        F.col("o_orderdate").alias("start_time"),
        plus_days("o_orderdate", k % 3).alias("scheduled_start_time"),
        plus_days("o_orderdate", -(k % 10)).alias("created_at"),
        status.alias("status"),
        F.when(k % 2 == 0, F.lit("eval")).otherwise(F.concat(F.lit("sp"), (k % 5).cast("string"))).alias("speciality_id"),
        F.when(k % 5 == 0, F.lit("mc_channel")).otherwise(F.lit("front_desk")).alias("channel_id"),
        F.when(k % 5 == 0, F.lit("Agent")).otherwise(F.lit("Front desk")).alias("channel_name"),
        F.when(k % 7 == 0, F.lit("mc")).otherwise(F.concat(F.lit("op"), (k % 13).cast("string"))).alias("created_by_id"),
        creator.alias("created_by_name"),
        phone.alias("phone"),
        F.when(k % 4 == 0, F.lit("return")).otherwise(F.lit("first")).alias("type"),
        F.when(k % 3 == 0, F.concat(F.lit("cmp"), (k % 4).cast("string"))).alias("campaign_token"),
        F.when(ck % 3 == 0, F.lit("Instagram")).when(ck % 3 == 1, F.lit("Google"))
        .otherwise(F.lit("Indicação")).alias("patient_channel_name"),
        F.when(ck % 4 == 0, F.lit("Ads")).when(ck % 4 == 1, F.lit("Organic"))
        .when(ck % 4 == 2, F.lit("Friend")).alias("patient_subchannel_name"),
        fold_name(creator).alias("created_by_name_norm"),
        fold_name(patient_name).alias("patient_name_norm"),
        phone_digits(phone).alias("phone_norm"),
    )


def _line_id() -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])


def appointment_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = raw(spark, sf_dir, "lineitem")
    s, ln = F.col("l_suppkey"), F.col("l_linenumber")
    to_status = (F.when(ln == 1, 4).when(ln == 2, 3).when(ln == 3, 4).when(ln == 4, 7)
                 .when(ln == 5, 8).when(ln == 6, 5).otherwise(1)).cast("int")
    return li.select(
        _line_id().alias("id"),
        F.col("l_orderkey").alias("appointment_id"),
        F.when(s % 4 == 0, F.lit("mc")).when(s % 17 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("op"), s.cast("string"))).alias("user_id"),
        F.lit(1).alias("from_status"),
        to_status.alias("to_status"),
        F.when(F.col("l_returnflag") == "R", F.lit(True)).when(F.col("l_returnflag") == "N", F.lit(False))
        .alias("is_reschedule"),
        F.col("l_shipdate").alias("change_date"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, o = raw(spark, sf_dir, "lineitem"), raw(spark, sf_dir, "orders")
    c, p = raw(spark, sf_dir, "customer"), raw(spark, sf_dir, "part")
    amount = (F.col("l_extendedprice").cast("decimal(18,2)")
              * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,2)")
    orders = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_custkey", "c_nationkey")  # the narrow side first
    j = (li.join(orders, li.l_orderkey == F.col("o_orderkey"))
         .join(p, li.l_partkey == p.p_partkey))
    return j.select(
        _line_id().alias("id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("c_nationkey").cast("string").alias("clinic_id"),
        F.col("l_shipdate").alias("date"),
        amount.alias("amount"),
        (F.col("l_linestatus") == "F").alias("is_confirmed"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("deleted_at"),
        F.when(F.col("p_type") == "PROMO", F.lit("eval")).otherwise(F.lower("p_type")).alias("specialty_id"),
        F.when(F.col("p_type") == "PROMO", F.lit("Avaliação Inicial")).otherwise(F.col("p_type")).alias("specialty_name"),
    )


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored CRM leads: customers with even keys (plus every 7th+1, which the CRM no
    longer tags: reconcile fodder), a phone spelled differently
    from the appointment's, and a creation date that walks one day per key."""
    c = raw(spark, sf_dir, "customer").where((F.col("c_custkey") % 2 == 0) | (F.col("c_custkey") % 7 == 1))
    ck = F.col("c_custkey")
    created = plus_days(F.lit(LEAD_EPOCH).cast("timestamp_ntz"), ck % 1500)
    return c.select(
        ck.alias("id"),
        F.col("c_nationkey").cast("bigint").alias("account_id"),
        F.col("c_nationkey").cast("string").alias("erp_clinic_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), ck.cast("string"), F.lit("@example.org")).alias("email"),
        phone_text(ck, 1).alias("phone_raw"),
        F.lit(None).cast("string").alias("identifier"),
        F.array(F.lit("campanha")).alias("labels"),
        created.alias("created_at_cw"),
        (created + F.make_dt_interval(F.lit(0), (ck % 97).cast("int"))).alias("last_activity_at"),
        F.array(F.col("c_nationkey").cast("int")).alias("inbox_ids"),
    )


def crm_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CRM contacts (SRC2 payload shape) per account: every customer; half
    tagged with the campaign label, a third carrying an ad-origin attribute."""
    c = raw(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    created = F.unix_seconds(F.lit(LEAD_EPOCH).cast("timestamp")) + (ck % 1500) * 86400
    ad = (F.when(ck % 3 == 0, F.concat(F.lit("ad"), (ck % 7).cast("string")))
          .when(ck % 5 == 0, F.lit(" ")))
    return c.select(
        ck.alias("id"),
        F.col("c_nationkey").cast("bigint").alias("account_id"),
        F.col("c_name").alias("name"),
        F.when(ck % 6 == 0, F.lit("")).otherwise(F.concat(F.lit("c"), ck.cast("string"), F.lit("@example.org")))
        .alias("email"),
        phone_text(ck, 2).alias("phone_number"),
        F.lit(None).cast("string").alias("identifier"),
        F.array(F.struct(F.struct(F.col("c_nationkey").cast("int").alias("id")).alias("inbox"))).alias("contact_inboxes"),
        created.cast("bigint").alias("created_at"),
        F.when(ck % 11 == 0, F.lit(None).cast("bigint")).otherwise(created + (ck % 97) * 3600).alias("last_activity_at"),
        F.when(ck % 2 == 0, F.array(F.lit("campanha"))).otherwise(F.array(F.lit("other"))).alias("labels"),
        F.when(ad.isNotNull(), F.create_map(F.lit("anuncio_de_origem"), ad))
        .otherwise(F.create_map().cast("map<string,string>")).alias("custom_attributes"),
    )


def crm_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CRM conversations from `events`: created_at alternates epoch / ISO
    text; every 10th has no sender (the contact id stands in)."""
    e = raw(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    secs = F.unix_seconds(F.col("ts").cast("timestamp"))
    tagged = F.col("event_type").isin("purchase", "signup")
    sender = F.struct(
        uid.alias("id"),
        F.concat(F.lit("Sender "), uid.cast("string")).alias("name"),
        F.lit(None).cast("string").alias("email"),
        phone_text(uid, 3).alias("phone_number"),
        F.lit(None).cast("string").alias("identifier"),
    )
    return e.select(
        eid.alias("id"),
        (uid % 25).cast("bigint").alias("account_id"),
        F.when(eid % 2 == 0, secs.cast("string"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("created_at"),
        F.when(eid % 9 == 0, F.lit(None).cast("bigint")).otherwise(secs + (eid % 120) * 60).alias("last_activity_at"),
        uid.alias("contact_id"),
        (uid % 25).cast("int").alias("inbox_id"),
        F.when(tagged, F.array(F.lit("campanha"), F.col("event_type"))).otherwise(F.array(F.col("event_type")))
        .alias("labels"),
        F.struct(F.when(eid % 10 == 0, F.lit(None)).otherwise(sender).alias("sender")).alias("meta"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashboard users from `supplier` covering every scope rule (JOI10)."""
    s = (raw(spark, sf_dir, "supplier")
         .join(raw(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
         .join(raw(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    k, nk = F.col("s_suppkey"), F.col("s_nationkey")
    explicit = (F.when(k % 10 == 1, F.array(nk.cast("string"), ((nk + 1) % 25).cast("string"), F.lit("")))
                .when(k % 10 == 3, F.array(F.lit(""))))
    regional = F.when(k % 10 == 2, F.col("r_name"))
    acct = F.struct(nk.cast("bigint").alias("id"), F.lit("administrator").alias("role"),
                    F.when(k % 7 == 0, F.lit("inactive")).otherwise(F.lit("active")).alias("status"))
    acct2 = F.struct(((nk + 5) % 25).cast("bigint").alias("id"),
                     F.when(k % 9 == 0, F.lit("agent")).otherwise(F.lit("administrator")).alias("role"),
                     F.lit("active").alias("status"))
    return s.select(
        F.concat(F.lit("u"), k.cast("string")).alias("id"),
        (k % 13 != 0).alias("active"),
        F.when(k % 50 == 0, F.lit("admin")).otherwise(F.lit("leader")).alias("role"),
        regional.alias("regional"),
        (k % 50 == 0).alias("unrestricted"),
        explicit.alias("allowed_clinic_ids"),
        F.when(k % 10 == 4, F.array().cast("array<struct<id:bigint,role:string,status:string>>"))
        .otherwise(F.array(acct, acct2)).alias("accounts"),
    )


ADAPTERS = {
    "units": units,
    "appointments": appointments,
    "appointment_logs": appointment_logs,
    "payments": payments,
    "leads": leads,
    "crm_contacts": crm_contacts,
    "crm_conversations": crm_conversations,
    "users": users,
}


def domain(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ADAPTERS[name](spark, sf_dir)
