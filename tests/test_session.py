"""The shared checkpoint folder: stored tables, and taking them away again."""

import os

from molarflow.session import clear_stored, ensure_checkpoint_dir, stored


def test_stored_tables_are_read_back_and_cleared_by_age(spark):
    df = stored(spark.range(10).selectExpr("id", "CAST(NULL AS STRING) AS s"), "test")
    assert df.count() == 10 and df.schema.names == ["id", "s"]
    folder = os.path.dirname(df.inputFiles()[0].replace("file://", ""))
    assert folder.startswith(ensure_checkpoint_dir(spark).replace("file://", ""))
    clear_stored(spark, hours=1, kinds=("stored",))
    assert df.count() == 10
    os.utime(folder, (1, 1))
    assert clear_stored(spark, hours=1, kinds=("stored",)) == 1 and not os.path.exists(folder)
