import random

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from molarflow.llm import queries
from tools.oracle_check import compare, duck

SMALL = "/root/testdata/sf0.001"


def test_stage_names_and_columns(spark):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "toxicity", "line_dedup", "simhash_near_dedup", "packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    n = docs.count()
    for name, stage in P.STAGES[:-1]:
        out = P.stored(stage(spark, docs, SMALL), f"test-{name}")
        assert out.columns == docs.columns
        assert (out.count() == docs.count()) if name == "line_dedup" else (0 < out.count() <= docs.count())
        docs = out
    packed = P.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == docs.count() < n


def test_run_equals_the_stages_by_brute_force(spark, docs_of, tmp_dir):
    """A small corpus whose outcome is known: junk goes, recurring lines go, copies go, the rest is packed."""
    r = random.Random(0)
    text = lambda k: " ".join(f"w{r.randrange(10 ** 6)}{'x' * (k % 3)}" for _ in range(70))
    texts = [text(i) for i in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100, "too short"), (101, "# " * 80), (102, texts[0]), (103, texts[1] + "\n" + texts[2]), (104, None)]
    docs_of(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    out = P.run(spark, tmp_dir).collect()
    # 102 loses its only line, 103 both of its lines: two empty texts, of which one stays
    assert sorted(x.doc_id for x in out) == [*range(30), 102]
    assert [x.doc_tokens for x in out if x.doc_id == 102] == [1]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_their_sql(spark, name):
    res = compare(spark, duck(SMALL), name, E.queries()[name], E.oracle_sql()[name], SMALL)
    assert res["ok"], res


def test_all_eleven_are_registered():
    names = E.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
