"""Row-level clinic scope (FLT15, JOI10, JOI2).

Rule used everywhere (fail closed): `None` = no restriction, an empty list =
no rows. The reference treats an empty allowed list as unrestricted in every
copy of this logic; here one function decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_clinics(allowed: list[str] | None, requested: list[str] | None) -> list[str] | None:
    """FLT15 on request parameters: scope ∩ requested; no scope -> requested (or all)."""
    req = [c for c in (requested or []) if c] or None
    if allowed is None:
        return req
    allowed_clean = [c for c in allowed if c and str(c).strip()]
    if req is None:
        return allowed_clean
    keep = set(allowed_clean)
    return [c for c in req if c in keep]


def apply_clinics(df: DataFrame, clinics: list[str] | None, column: str = "clinic_id") -> DataFrame:
    """Filter by a resolved clinic list; an `isin` literal reaches the Parquet scan
    as a pushed `In` filter (and prunes clinic partitions on partitioned tables)."""
    if clinics is None:
        return df
    if len(clinics) == 0:
        return df.where(F.lit(False))
    return df.where(F.col(column).isin(clinics))


def user_scopes(users: DataFrame, units: DataFrame) -> DataFrame:
    """JOI10: (user_id, clinic_id, rule) for every active user.

    Precedence: unrestricted -> one row with clinic_id NULL (= all clinics, no
    user x unit product); explicit list (blanks dropped; nothing left -> no
    rows); regional -> units of that regional; else clinics of the user's
    active administrator accounts. Users matching nothing get no rows (deny).
    """
    u = users.where(F.col("active"))
    explicit = F.filter(F.coalesce(F.col("allowed_clinic_ids"), F.array().cast("array<string>")),
                        lambda x: x.isNotNull() & (F.trim(x) != ""))
    has_explicit = F.col("allowed_clinic_ids").isNotNull() & (F.size("allowed_clinic_ids") > 0)
    regional = F.trim(F.col("regional"))
    has_regional = regional.isNotNull() & (regional != "")
    rule = (F.when(F.coalesce(F.col("unrestricted"), F.lit(False)), F.lit("unrestricted"))
            .when(has_explicit, F.lit("explicit"))
            .when(has_regional, F.lit("regional"))
            .otherwise(F.lit("accounts")))
    u = u.select(F.col("id").alias("user_id"), rule.alias("rule"), explicit.alias("_explicit"),
                 regional.alias("_regional"), "accounts")

    unrestricted = u.where(F.col("rule") == "unrestricted").select(
        "user_id", F.lit(None).cast("string").alias("clinic_id"), "rule")
    explicit_rows = (u.where(F.col("rule") == "explicit")
                     .select("user_id", F.explode("_explicit").alias("clinic_id"), "rule"))
    units_ok = units.where(F.col("clinic_id").isNotNull())
    by_regional = (u.where(F.col("rule") == "regional")
                   .join(units_ok.select(F.col("regional").alias("_regional"), "clinic_id"), "_regional")
                   .select("user_id", "clinic_id", "rule"))
    accts = (u.where(F.col("rule") == "accounts")
             .select("user_id", "rule", F.explode("accounts").alias("a"))
             .where((F.col("a.status") == "active") & (F.col("a.role") == "administrator"))
             .select("user_id", "rule", F.col("a.id").alias("_account")))
    by_account = (accts.join(units_ok.select(F.col("account_id").alias("_account"), "clinic_id"), "_account")
                  .select("user_id", "clinic_id", "rule"))
    return (unrestricted.unionByName(explicit_rows).unionByName(by_regional).unionByName(by_account)
            .dropDuplicates(["user_id", "clinic_id"]))


def scoped_by_appointment(logs: DataFrame, appointments: DataFrame) -> DataFrame:
    """JOI2: keep logs whose appointment survives the (already scoped) appointment frame."""
    ids = appointments.select(F.col("id").alias("_appt_id"))
    return logs.join(ids, logs["appointment_id"] == ids["_appt_id"], "left_semi")


def visible_log_counts(logs: DataFrame, appointments: DataFrame, scopes: DataFrame) -> DataFrame:
    """Per (user, to_status): logs whose appointment's clinic the user may see.

    Logs are aggregated to (clinic, to_status) *before* meeting the scope, with a
    rollup level keyed '*' serving unrestricted users, so the scope join is
    between two small frames and no log row is copied per user."""
    per_clinic = (logs.select("appointment_id", "to_status")
                  .join(appointments.select(F.col("id").alias("appointment_id"), "clinic_id"), "appointment_id")
                  .rollup("to_status", "clinic_id")
                  .agg(F.count(F.lit(1)).alias("logs"), F.grouping("to_status").alias("_gs"),
                       F.grouping("clinic_id").alias("_gc"))
                  .where(F.col("_gs") == 0)
                  .select("to_status", "logs",
                          F.when(F.col("_gc") == 1, F.lit("*")).otherwise(F.col("clinic_id")).alias("_key")))
    keys = (scopes.select("user_id", F.coalesce(F.col("clinic_id"), F.lit("*")).alias("_key"))
            .dropDuplicates(["user_id", "_key"]))
    return (keys.join(per_clinic, "_key").groupBy("user_id", "to_status")
            .agg(F.sum("logs").alias("logs")))
