"""JSON-lines landing files (SRC2) and their per-unit sink layout (SNK4).

Blank lines are skipped by Spark's JSON reader; an unparsable line lands in
`_corrupt_record` and goes to a quarantine frame instead of failing the job;
rows without an id are dropped (the backfill scripts do the same).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def _with_corrupt(schema) -> StructType:
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])


def read_jsonl(spark: SparkSession, path: str, schema, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Return (rows, quarantine). `rows` keeps parsable lines with a non-null id."""
    df = (spark.read.schema(_with_corrupt(schema))
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
          .json(path))
    # cache-free split: Spark forbids filtering on the corrupt column of a raw JSON
    # scan unless another column is referenced too, so test both.
    good = df.where(F.col(CORRUPT).isNull() & F.col(id_col).isNotNull()).drop(CORRUPT)
    bad = df.where(F.col(CORRUPT).isNotNull() | F.col(id_col).isNull())
    return good, bad


def write_units(df: DataFrame, root: str, partition_cols=("feed", "clinic_id", "period")) -> None:
    """SNK4: one folder per unit of work; re-running a unit replaces only its folder
    (dynamic partition overwrite), other units stay untouched."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).json(root))
