"""Sinks, sources and metrics that other jobs go on from."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from sqlscore.operators import dataset as D
from sqlscore.operators import evaluate as E
from sqlscore.operators import score as C
from sqlscore.operators.ranking import seeded_hash
from sqlscore.sources import tables as S

from conftest import SF001, SF01


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_readers_of_one_member_read_its_columns_only(spark, tmp_path):
    from sqlscore.plans.catalog import outcome
    scored = C.with_details(outcome(spark, SF001).withColumn("gen_seconds", F.lit(0.25)))
    scored.select("sample_id", "gen_idx", "score", "scored", "details", "metadata").write.parquet(f"{tmp_path}/s")
    back = spark.read.parquet(f"{tmp_path}/s")
    one = back.select(F.col("details.reward_1_execution.details.similarity"), F.col("metadata.num_components"))
    schema = plan_of(one).split("ReadSchema: ")[1]
    assert "similarity" in schema and "extracted_sql" not in schema and "reward_0_syntax" not in schema and "seconds" not in schema
    row = back.where("details.reward_1_execution.details.seconds is not null").first()
    assert row["metadata"]["num_components"] == 3 and row["metadata"]["seconds"] == 0.25
    parts = [row["details"][f"reward_{i}_{n}"] for i, n in enumerate(("syntax", "execution", "semantic"))]
    assert [p["weight"] for p in parts] == [0.2, 0.6, 0.2] and row["score"] == 0.0 + sum(p["weighted_score"] for p in parts)
    assert all(p["weighted_score"] == p["score"] * p["weight"] for p in parts)


def test_shards_in_name_order_are_the_shuffle(spark, tmp_path):
    orders = spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_custkey")
    S.write_shuffled(orders, "o_orderkey", f"{tmp_path}/s", shards=5)
    names = sorted(p.name for p in (tmp_path / "s").glob("part-*.parquet"))
    assert len(names) == 5
    in_order = [r["o_orderkey"] for n in names for r in spark.read.parquet(f"{tmp_path}/s/{n}").collect()]
    assert in_order == [r["o_orderkey"] for r in orders.orderBy(seeded_hash("o_orderkey", 42), "o_orderkey").collect()]
    read = S.read_shuffled(spark, f"{tmp_path}/s")
    want = D.seeded_shuffle(orders, "o_orderkey")
    assert read.exceptAll(want.select(read.columns)).count() == 0 and read.count() == 15_000
    S.write_shuffled(orders.limit(0), "o_orderkey", f"{tmp_path}/empty", shards=3)
    assert S.read_shuffled(spark, f"{tmp_path}/empty").count() == 0


def test_json_lines_that_do_not_fit_are_kept_apart(spark, tmp_path):
    lines = ['{"id": 1, "text": "a"}', '{"id": "x", "text": "b"}', '{"id": 2', "", '{"id": 3, "text": null, "more": 5}', '{"text": "ü"}', "[1]"]
    (tmp_path / "in.json").write_text("\n".join(lines), encoding="utf-8")
    good, bad = S.split_bad(S.read_json(spark, f"{tmp_path}/in.json", "id long, text string").cache())
    assert sorted(((r["id"], r["text"]) for r in good.collect()), key=str) == sorted([(1, "a"), (3, None), (None, "ü")], key=str)
    assert sorted(r["bad_line"] for r in bad.collect()) == sorted([lines[1], lines[2], lines[6]])


def test_moments_of_parts_merge_to_those_of_all_rows(spark, tmp_path):
    rng = random.Random(4)
    values = [(k % 3, 1e6 + rng.random()) for k in range(300)] + [(7, 0.7)]  # far from zero: sums of squares would lose digits
    df = spark.createDataFrame(values, "g int, best_reward double")
    for run in range(4):
        E.append_moments(E.moments(df.where(F.pmod(F.xxhash64("best_reward"), F.lit(4)) == run), ["g"]), f"{tmp_path}/m", f"r{run}")
    E.append_moments(E.moments(df.where(F.pmod(F.xxhash64("best_reward"), F.lit(4)) == 2), ["g"]), f"{tmp_path}/m", "r2")
    got = {r["g"]: r for r in E.summary_of_moments(E.merge_moments(spark.read.parquet(f"{tmp_path}/m"), ["g"])).collect()}
    for g in (0, 1, 2):
        own = [v for k, v in values if k == g]
        assert got[g]["n"] == 100 and got[g]["mean"] == pytest.approx(statistics.fmean(own), rel=1e-12)
        assert got[g]["std"] == pytest.approx(statistics.stdev(own), rel=1e-6)
    assert got[7]["std"] is None and got[7]["success_rate"] == 1.0 and got[7]["perfect_rate"] == 0.0


def test_observed_checks_equal_the_checks(spark, tmp_path):
    df = spark.createDataFrame([("p", "", 0.5, True, "train"), (" \t", "a", 2.0, True, "test"), (None, "b", -1.0, False, "train"), ("q", None, None, False, None)],
                               "prompt string, answer string, score double, scored boolean, split string")
    rows, seen = D.observed(df.repartition(3), "n", score="score", scored="scored", split_col="split")
    rows.write.parquet(f"{tmp_path}/o")
    got = seen.get
    checks = {**D.non_empty_fields(df).first().asDict(), **D.score_range_check(df).first().asDict(), **C.reward_statistics(df).first().asDict()}
    assert got["num_rows"] == 4 and got["empty_prompt"] == checks["empty_prompt"] == 2 and got["empty_answer"] == checks["empty_answer"] == 2
    assert got["out_of_range"] == checks["out_of_range"] == 1 and got["num_scores"] == 3
    assert got["call_count"] == checks["call_count"] == 2 and got["total_reward"] == checks["total_reward"] == 2.5
    assert (got["rows_train"], got["rows_test"]) == (2, 1)
    assert spark.read.parquet(f"{tmp_path}/o").count() == 4


def test_evaluation_is_written_with_and_without_details(spark, tmp_path):
    records = spark.createDataFrame([(1, [0.5, 1.0], 1.0), (2, [], None)], "sample_id long, rewards array<double>, best_reward double")
    summary = spark.createDataFrame([(2, "much")], "num_samples long, detailed_results string")
    S.write_evaluation(records, summary, f"{tmp_path}/e")
    assert spark.read.parquet(f"{tmp_path}/e/details").count() == 2
    assert spark.read.json(f"{tmp_path}/e/summary").columns == ["num_samples"]
