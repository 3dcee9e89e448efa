import os

import pytest
from compare import connect, spark_rows, sql_rows

import corpus_pipeline
from knockwatch.llm.checks import CHECKS
from knockwatch.llm.queries import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == sql_rows(connect(SF_DIR), CHECKS[name])


@pytest.mark.parametrize("name", ["op1_pii", "op2_decontaminate", "op6_mixing"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("EvalPython", "InPandas", "InArrow", "NestedLoop", "Cartesian"))


def test_pipeline_stages_apply_their_operators(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = QUERIES["op5_host_rules"](spark, SF_DIR).filter("kept").select("doc_id")
    kept = corpus_pipeline.quality_rules(spark, docs, SF_DIR)
    assert sorted(kept.select("doc_id").collect()) == sorted(good.collect())
    single = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
    firsts = QUERIES["op10_simhash_dedup"](spark, SF_DIR).filter("doc_id = component_id").select("doc_id")
    assert sorted(single.select("doc_id").collect()) == sorted(firsts.collect())
    clean = corpus_pipeline.decontamination(spark, docs, SF_DIR)
    free = QUERIES["op2_decontaminate"](spark, SF_DIR).filter("not contaminated").select("doc_id")
    assert sorted(clean.select("doc_id").collect()) == sorted(free.collect())
    for table in (kept, single, clean, corpus_pipeline.personal_data(spark, docs, SF_DIR)):
        assert table.columns == docs.columns
    mixed = corpus_pipeline.run(spark, SF_DIR)
    assert mixed.columns == [*docs.columns, "epoch"] and mixed.count() > 0
    assert "@" not in "".join(r.text for r in mixed.select("text").collect())
