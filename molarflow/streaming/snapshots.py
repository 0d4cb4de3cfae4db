"""The dashboard's whole-history inputs, kept up to date by every merge (AGG12, AGG3, WIN1).

`operators.dashboard.build_snapshots` computes three tables from the whole history: each patient's
origin, the evaluations behind the attribution, and the revenue per clinic, specialty and month. Here
they follow the changes of a merge instead: the old and the new row of each changed key.

* Revenue: the old row's amount is taken back from its (clinic, specialty, month), the new row's is
  added. One commit holds the sums and the number of the last change, so none counts twice.
* Origin: the smallest appointment of a patient cannot be taken back from a minimum, so a narrow copy
  of the appointments is kept in slices by patient; the touched patients' slices are read and
  their origins computed anew.
* Evaluations: a narrow copy of the agent's logs is kept in slices by appointment; for touched
  appointments (changed themselves, or with a changed log) it is decided anew whether they qualify.

Reads grow with the folders that hold what changed, not with the history, and so do the joins: their sides are
broadcast by number of rows, as the stored files of very many keys are small. All but the sums are
absolute values, so a change that is applied again after a crash changes nothing.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from molarflow.config import DEFAULT_DOMAIN, Domain
from molarflow.operators import kpi
from molarflow.operators.attribution import qualifying_evaluations
from molarflow.operators.dashboard import KpiSnapshots
from molarflow.session import BROADCAST_ROWS, ensure_checkpoint_dir, join_side, passing
from molarflow.sinks.versioned import VersionedTable
from molarflow.streaming.ingest import path_exists

_VISITS = "id bigint, patient_id bigint, start_time timestamp_ntz, status int, speciality_id string, channel_id string, campaign_token string"
_AGENT_LOGS = "id string, appointment_id bigint, user_id string"
_REVENUE = "key string, clinic_id string, specialty_id string, year_month string, rev decimal(28,2), payments bigint"
#: The row of the revenue table that names the last change in its column `payments`.
_APPLIED = "#applied"


def changed_rows(table: VersionedTable, batch: DataFrame, order: Column | None, changes: str) -> tuple[DataFrame, DataFrame]:
    """Upsert `batch`; the old and the new rows of its keys. The old ones are stored under `changes` before the
    merge, so that a merge repeated after a crash still knows them."""
    spark, keys = table.spark, batch.select(*table.keys).distinct()
    path = os.path.join(changes, "old")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        table.rows_of(keys).write.mode("overwrite").option("compression", "zstd").parquet(path)
    table.upsert(batch, order=order)
    return spark.read.schema(table.schema).parquet(path), table.rows_of(keys)


class LiveSnapshots:
    def __init__(self, spark: SparkSession, root: str, domain: Domain = DEFAULT_DOMAIN):
        ensure_checkpoint_dir(spark)

        def table(name: str, schema: str, key: str, unit: str | None = None) -> VersionedTable:
            return VersionedTable(spark, os.path.join(root, name), schema, [key], None, unit)

        self.spark, self.domain = spark, domain
        self.visits = table("visits", _VISITS, "id", "patient_id")
        self.agent_logs = table("agent_logs", _AGENT_LOGS, "id", "appointment_id")
        self.origins = table("patient_origin", "patient_id bigint, origin string", "patient_id")
        self.evaluations = table("agent_evaluations", "id bigint, patient_id bigint, start_time timestamp_ntz", "id")
        self.revenue = table("monthly_revenue", _REVENUE, "key")

    def read(self) -> KpiSnapshots:
        monthly = self.revenue.read().where(F.col("key") != _APPLIED).where("payments > 0")
        return KpiSnapshots(self.origins.read().hint("merge"), self.evaluations.read(), monthly.drop("key").withColumnRenamed("year_month", "month"))

    # ---- payments ----

    def _signed(self, rows: DataFrame, sign: int) -> DataFrame:
        return (kpi.monthly_revenue(rows, "clinic_id", "specialty_id").withColumnRenamed("month", "year_month")
                .withColumns({"rev": (F.col("rev") * sign).cast("decimal(28,2)"), "payments": F.col("payments") * sign}))

    def payments_changed(self, change: int, old: DataFrame, new: DataFrame) -> None:
        """`change` numbers the changes, rising."""
        applied = self.revenue.rows_of(self.spark.createDataFrame([(_APPLIED,)], "key string")).first()
        if applied and applied.payments >= change:
            return
        delta = (self._signed(old, -1).unionByName(self._signed(new, 1))
                 .withColumn("key", F.to_json(F.struct("clinic_id", "specialty_id", "year_month"))))
        mark = self.spark.createDataFrame([(_APPLIED, None, None, None, None, 0)], _REVENUE)
        delta = delta.select(mark.columns).unionByName(mark).checkpoint(eager=True)
        sums = (self.revenue.rows_of(delta).unionByName(delta).groupBy("key", "clinic_id", "specialty_id", "year_month")
                .agg(F.sum("rev").cast("decimal(28,2)").alias("rev"), F.sum("payments").alias("payments"))
                .withColumn("payments", F.when(F.col("key") == _APPLIED, F.lit(change)).otherwise(F.col("payments"))))
        self.revenue.upsert(sums.checkpoint(eager=True), order=F.lit(1))

    # ---- appointments and logs ----

    def appointments_changed(self, old: DataFrame, new: DataFrame) -> None:
        names = [f.split()[0] for f in _VISITS.split(", ")]
        with passing(self.spark) as keep:
            new = keep(new.select(*names), "visits")
            new = join_side(new, new.count())
            patients = keep(old.select("patient_id").union(new.select("patient_id")).where("patient_id IS NOT NULL").distinct(), "patients")
            self.visits.upsert(new, order=F.lit(1))
            self._delete(self.visits, old.select("id").join(new, "id", "left_anti"))
            origins = keep(kpi.first_appointment_origin(self.visits.rows_of_units(patients)), "origins")
            origins = join_side(origins, origins.count())
            self.origins.upsert(origins, order=F.lit(1))
            self._delete(self.origins, patients.join(origins, "patient_id", "left_anti"))
            self._judge(old.select("id").union(new.select("id")))

    def _delete(self, table: VersionedTable, keys: DataFrame) -> None:
        """Remove `keys` from `table`; no commit, and no folder read, if there are none."""
        with passing(self.spark) as keep:
            keys = keep(keys, "gone")
            if not keys.isEmpty():
                table.delete(keys)

    def logs_changed(self, old: DataFrame, new: DataFrame) -> None:
        agent = F.col("user_id") == self.domain.agent_user_id
        names = [f.split()[0] for f in _AGENT_LOGS.split(", ")]
        with passing(self.spark) as keep:
            mine = keep(new.where(agent).select(*names), "agent-logs")
            mine = join_side(mine, mine.count())
            self.agent_logs.upsert(mine, order=F.lit(1))
            self._delete(self.agent_logs, old.where(agent).select("id").join(mine, "id", "left_anti"))
            self._judge(old.where(agent).select("appointment_id").union(mine.select("appointment_id")))

    def _judge(self, ids: DataFrame) -> None:
        """Whether the appointments of these ids qualify now."""
        with passing(self.spark) as keep:
            ids = keep(ids.toDF("id").where("id IS NOT NULL").distinct(), "judged")
            logs = self.agent_logs.rows_of_units(ids.withColumnRenamed("id", "appointment_id"))
            if ids.count() > BROADCAST_ROWS:
                logs = logs.hint("merge")
            good = keep(qualifying_evaluations(self.visits.rows_of(ids), logs, self.domain).select("id", "patient_id", "start_time"), "good")
            good = join_side(good, good.count())
            self.evaluations.upsert(good, order=F.lit(1))
            self._delete(self.evaluations, ids.join(good, "id", "left_anti"))
