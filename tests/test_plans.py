"""Registered queries: smoke, invariants and plan shape."""

from conftest import SF001

import __spark_entry__ as entry


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["sample_id", "gen_idx", "syntax_score", "execution_score", "semantic_score", "score"]
    assert df.count() == 600


def test_every_query_has_oracle_or_is_listed():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert {n for n in set(qs) - set(sql) if not n.startswith("op") and n != "pipeline"} == set()


def test_scores_in_range_and_self_score(spark):
    q = entry.queries()
    assert q["score_range_check"](spark, SF001).first()["out_of_range"] == 0
    gt = q["ground_truth_check"](spark, SF001)
    assert gt.where("score <> 1.0").count() == 0


def test_flagship_plan_is_jvm_only(spark):
    df = entry.queries()["sql_score"](spark, SF001)
    p = plan_text(df)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "SinglePartition" not in p


def test_scan_pruned(spark):
    df = entry.queries()["sql_score"](spark, SF001)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in p
    assert "ReadSchema: struct<c_custkey:bigint>" in p
