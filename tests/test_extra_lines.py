"""Lines with fields outside the schema: each is parsed once for its columns, and its names are read without its values."""

import os

from molarflow.streaming import ingest

SCHEMA = "id string, clinic_id string, date timestamp_ntz, extra variant"
LINES = {
    '{"id":"a","clinic_id":"1","date":"2026-01-01T00:00:00"}': None,
    '{"id":"b","date":null,"new":{"x":[1,{"y":2}]},"clinic_id":"1"}': '{"clinic_id":"1","date":null,"id":"b","new":{"x":[1,{"y":2}]}}',
    '{"new":null,"id":"c"}': '{"id":"c","new":null}',
    '{"":1,"id":"d"}': '{"":1,"id":"d"}',
    '{"id":"e","clinic_id":"{\\"new\\":1}"}': None,
    '{"id":"f","new":1': None,
    '[{"id":"g","new":1}]': None,
    '{"id":"h","new":1,"new":2}': None,
    "{'id':'i','new':1}": None,
    '"text"': None,
}


def test_names_are_read_without_values(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/landing/pull-1")
    with open(f"{tmp_dir}/landing/pull-1/part-00000.json", "w") as f:
        f.write("\n".join(LINES))
    plan = ingest.landed(spark, f"{tmp_dir}/landing", SCHEMA)._jdf.queryExecution().analyzed().toString()
    assert plan.count("from_json(") == 1
    found = {}
    ingest.run_available(spark, f"{tmp_dir}/landing", SCHEMA, f"{tmp_dir}/ckpt", lambda batch, n: found.update(
        {r.id: r.e for r in batch.selectExpr("id", "to_json(extra) AS e").collect()}))
    want = {line.split("id")[1][3]: extra for line, extra in LINES.items() if '"id":"' in line and line.endswith("}")}
    assert {i: e for i, e in found.items() if i in want} == want
    assert not any(e for i, e in found.items() if i not in want)
