"""molarflow — clinic-operations analytics written as plain PySpark DataFrame functions.

Layout:
  functions/  pure Column expressions (name folding, phone keys, dates, hashes)
  sources/    scans: feed tables, JSONL landing files, allowlisted scans, test-table adapters
  sinks/      upsert / partial merge / key deletes / retention / run accounting
  operators/  DataFrame -> DataFrame business operators (scope, filters, attribution, funnel, KPIs, leads)
  plans/      request parameters, the named queries and their DuckDB oracle SQL
  streaming/  Structured Streaming twins of the incremental feeds
"""

from molarflow.config import Domain, DEFAULT_DOMAIN  # noqa: F401
from molarflow.session import get_spark, checkpoint_dir  # noqa: F401
