"""Splits, slices and formatting."""

from pyspark.sql import functions as F

from sqlscore.operators import dataset as D
from sqlscore.operators import ranking as R
from sqlscore.params import DataParams


def orders(spark):
    from conftest import SF01
    return spark.read.parquet(f"{SF01}/orders.parquet").select("o_orderkey", "o_custkey")


def test_first_k_equals_sort_limit(spark):
    o = orders(spark).withColumn("h", R.seeded_hash("o_orderkey", 42))
    k = 4321
    got = R.first_k(o, "h", "o_orderkey", k).select("o_orderkey")
    want = o.orderBy("h", "o_orderkey").limit(k).select("o_orderkey")
    assert got.count() == k and got.exceptAll(want).count() == 0


def test_split_exact_disjoint_stable(spark):
    o = orders(spark)
    p = DataParams()
    a = D.prepare_splits(o, "o_orderkey", p)
    b = D.prepare_splits(o.repartition(13), "o_orderkey", p)
    counts = {r["split"]: r["num_rows"] for r in D.split_counts(a).collect()}
    assert counts == {"train": 10_000, "test": 2_500}
    assert a.select("o_orderkey").distinct().count() == 12_500
    assert a.exceptAll(b).count() == 0


def test_split_when_source_smaller(spark):
    from conftest import SF001
    o = spark.read.parquet(f"{SF001}/orders.parquet").select("o_orderkey")
    s = D.prepare_splits(o, "o_orderkey", DataParams())
    counts = {r["split"]: r["num_rows"] for r in D.split_counts(s).collect()}
    assert counts == {"train": 1200, "test": 300}


def test_positions_and_slices(spark):
    o = orders(spark)
    pos = D.seeded_shuffle(o, "o_orderkey")
    assert pos.agg(F.min("shuffle_pos"), F.max("shuffle_pos"), F.count_distinct("shuffle_pos")).first() == (0, 14_999, 15_000)
    sl = D.holdout_slice(o, "o_orderkey", 100, 110, "pos").orderBy("pos").collect()
    want = o.orderBy("o_orderkey").collect()[100:110]
    assert [r["o_orderkey"] for r in sl] == [r["o_orderkey"] for r in want]


def test_prompt_formats(spark):
    df = spark.createDataFrame([("How many?", "CREATE TABLE t (a int);", "SELECT count(*) FROM t")],
                               "question string, context string, answer string")
    p = D.build_prompt(df).first()
    assert p["prompt"] == ("Question: How many?\n\nSchema:\nCREATE TABLE t (a int);\n\n"
                           "Generate the SQL query to answer this question.")
    assert p["original_question"] == "How many?"
    m = D.build_messages(df).first()["messages"]
    assert [x["role"] for x in m] == ["system", "user", "assistant"]
    assert m[0]["content"].endswith("SCHEMA:\nCREATE TABLE t (a int);")
    text = D.render_chat(D.build_messages(df)).first()["text"]
    assert text.startswith("<|im_start|>system\n") and text.endswith("SELECT count(*) FROM t<|im_end|>\n")
    xml = D.system_prompt(F.lit("S"), use_xml_format=True)
    assert spark.range(1).select(xml).first()[0].endswith("<answer>Your SQL query here</answer>")


def test_missing_fields_become_empty(spark):
    df = spark.createDataFrame([("q",)], "question string")
    p = D.build_prompt(df).first()
    assert p["answer"] == "" and "Schema:\n\n" in p["prompt"]


def test_checks(spark):
    df = spark.createDataFrame([("p", ""), (" ", "a")], "prompt string, answer string")
    assert D.required_columns(df) == []
    assert D.required_columns(df.drop("answer")) == ["answer"]
    r = D.non_empty_fields(df).first()
    assert (r["empty_prompt"], r["empty_answer"]) == (1, 1)
    assert D.non_empty_dataset(df.where("false")).first()["has_rows"] is False


def test_exact_positions_any_order(spark):
    o = orders(spark).repartition(7)
    got = R.exact_positions(o, [F.col("o_custkey"), F.col("o_orderkey")], "pos")
    want = [r["o_orderkey"] for r in o.orderBy("o_custkey", "o_orderkey").collect()]
    rows = got.orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(len(want)))
    assert [r["o_orderkey"] for r in rows] == want


def test_slices_rank_no_rows_in_one_partition(spark):
    plan = D.holdout_slice(orders(spark), "o_orderkey", 100, 110)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan.split("LogicalRDD")[0] or "_n" in plan  # windows see one row a partition only


def test_group_positions(spark):
    o = orders(spark).repartition(5)
    got = {(r["o_custkey"], r["pos"]): r["o_orderkey"] for r in R.group_positions(o, ["o_custkey"], ["o_orderkey"], "pos").collect()}
    by = {}
    for r in o.orderBy("o_orderkey").collect():
        by.setdefault(r["o_custkey"], []).append(r["o_orderkey"])
    assert got == {(c, i + 1): k for c, ks in by.items() for i, k in enumerate(ks)}


def test_non_empty_first_only(spark):
    df = spark.createDataFrame([(2, "p", "a"), (1, "", "a")], "id long, prompt string, answer string")
    assert D.non_empty_fields(df, first_only=True, order_col="id").first()["empty_prompt"] == 1
    assert D.non_empty_fields(df).first()["num_rows"] == 2
