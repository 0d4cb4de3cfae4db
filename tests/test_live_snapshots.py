"""Snapshots that follow the changes of merges equal a rebuild from the whole history."""

import os

import pytest
from pyspark.sql import functions as F

from molarflow import schemas
from molarflow.functions.misc import plus_days
from molarflow.operators.dashboard import build_snapshots
from molarflow.plans.registry import Tables
from molarflow.sinks import versioned as V
from molarflow.streaming.snapshots import LiveSnapshots, changed_rows

from paths import SF_SMALL

NAMES = ("patient_origin", "agent_evaluations", "monthly_revenue")


def _canon(snapshots):
    out = {}
    for n in NAMES:
        df = getattr(snapshots, n)
        out[n] = sorted(map(repr, (r.asDict() for r in df.select(*sorted(df.columns)).collect())))
    return out


@pytest.fixture()
def lake(spark, tmp_dir):
    def table(name, date_col, unit_col):
        return V.VersionedTable(spark, os.path.join(tmp_dir, name), schemas.FEEDS[name][0], ["id"], date_col, unit_col)

    class Lake:
        tables = {"appointments": table("appointments", "start_time", "clinic_id"), "payments": table("payments", "date", "clinic_id"),
                  "appointment_logs": table("appointment_logs", "change_date", None)}
        live = LiveSnapshots(spark, os.path.join(tmp_dir, "live"))
        changes = 0

        def merge(self, name, batch):
            self.changes += 1
            old, new = changed_rows(self.tables[name], batch, F.lit(1), os.path.join(tmp_dir, "changes", str(self.changes)))
            if name == "payments":
                self.live.payments_changed(self.changes, old, new)
            elif name == "appointments":
                self.live.appointments_changed(old, new)
            else:
                self.live.logs_changed(old, new)
            return old, new

        def rebuilt(self):
            return _canon(build_snapshots(spark, *(self.tables[n].read() for n in ("appointments", "appointment_logs", "payments")),
                                          os.path.join(tmp_dir, f"rebuilt-{self.changes}")))

    return Lake()


def test_equal_a_rebuild_after_every_kind_of_change(spark, lake, monkeypatch):
    monkeypatch.setattr(V, "SLICE_ROWS", 100)  # many slices for few rows
    t = Tables(spark, SF_SMALL)
    a = t.appointments.where("patient_id % 3 = 0 AND year(start_time) >= 2000").checkpoint()
    lake.merge("appointments", a)
    lake.merge("appointment_logs", t.appointment_logs.dropDuplicates(["id"]).join(a.select(F.col("id").alias("appointment_id")), "appointment_id"))
    lake.merge("payments", t.payments.dropDuplicates(["id"]).where("patient_id % 3 = 0 AND year(date) = 2000"))
    assert _canon(lake.live.read()) == lake.rebuilt()

    one = a.where("campaign_token IS NOT NULL").orderBy("start_time", "id").limit(1).checkpoint()
    lake.merge("appointments", one.withColumn("start_time", plus_days("start_time", 900)))  # a date moves
    pay = lake.tables["payments"].read().where("is_confirmed AND deleted_at IS NULL").orderBy("id").limit(2).checkpoint()
    lake.merge("payments", pay.withColumn("is_confirmed", F.lit(False)))  # payments are unconfirmed
    lake.merge("payments", pay.withColumns({"date": plus_days("date", 40), "specialty_id": F.lit(None).cast("string")}))
    lake.merge("appointments", a.where("id % 7 = 0").withColumns({"patient_id": F.lit(10**9).cast("bigint"), "status": F.lit(5)}))
    mine = lake.tables["appointment_logs"].read().where("user_id = 'mc'").limit(20).checkpoint()
    lake.merge("appointment_logs", mine.withColumn("user_id", F.lit(None).cast("string")))
    assert _canon(lake.live.read()) == lake.rebuilt()
    lake.merge("appointments", a.where("id % 7 = 0"))  # the patient of the last change has no appointment left
    assert _canon(lake.live.read()) == lake.rebuilt()


def test_a_change_counts_once_and_reads_no_history(spark, lake, monkeypatch):
    monkeypatch.setattr(V, "SLICE_ROWS", 50)
    t = Tables(spark, SF_SMALL)
    lake.merge("payments", t.payments.dropDuplicates(["id"]).where("year(date) = 2000"))
    lake.merge("appointments", t.appointments.where("year(start_time) >= 1999"))
    batch = lake.tables["payments"].read().where("is_confirmed").orderBy("id").limit(1).withColumn("amount", F.lit(5).cast("decimal(18,2)")).checkpoint()
    old, new = lake.merge("payments", batch)
    once = _canon(lake.live.read())
    lake.live.payments_changed(lake.changes, old, new)  # again after a crash
    assert _canon(lake.live.read()) == once == lake.rebuilt()

    loaded, own = [], V.VersionedTable._load
    monkeypatch.setattr(V.VersionedTable, "_load", lambda self, e: loaded.append((self.root.rsplit("/", 1)[1], len(e))) or own(self, e))
    total = len([e for e in lake.live.visits.snapshot().entries if e[0] == V.ROWS])
    first = t.appointments.where("year(start_time) >= 1999").orderBy("id").limit(1).checkpoint()
    lake.merge("appointments", first.withColumn("status", F.lit(8)))
    assert total > 10 and max(n for name, n in loaded if name == "visits") <= 2
    assert max(n for name, n in loaded if name == "appointments") <= 2
