"""Tables bucketed by a join key in the session catalog (JOI1, JOI5, AGG11, WIN1).

Appointments and logs bucketed by appointment, appointments and payments by patient: joins and
aggregations on that key read co-partitioned files and need no exchange. The files lie in a shared
folder; a later session registers them again with `register`, without reading them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """`df` as table `name` at `path`, in `buckets` sorted buckets of `key`. One file a bucket: rows are dealt by
    the key first, as each task else writes a file into every bucket."""
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path)
     .mode("overwrite").saveAsTable(name))
    return df.sparkSession.table(name)


def register(spark: SparkSession, name: str, schema: str, path: str, key: str, buckets: int) -> DataFrame:
    """The table that `write_bucketed` wrote, in a session that does not know it."""
    quoted = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{quoted}'")
    return spark.table(name)
