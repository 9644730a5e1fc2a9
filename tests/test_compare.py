"""Result-set comparison on DataFrames."""

from sqlscore.operators import compare as X


def test_compare_results_numbers_equal_across_types(spark):
    g = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    r = spark.createDataFrame([(1.0, "a"), (2.0, None)], "x double, y string")
    row = X.compare_results(g, r).first()
    assert row["exact_match"] is True and row["similarity"] == 1.0


def test_compare_results_string_not_number(spark):
    g = spark.createDataFrame([(1,)], "x int")
    r = spark.createDataFrame([("1",)], "x string")
    assert X.compare_results(g, r).first()["exact_match"] is False


def test_cells_keep_every_digit(spark):
    def cell(sql):
        from sqlscore.functions.cells import row_cells
        df = spark.sql(f"SELECT {sql} AS v")
        return df.select(row_cells(df).alias("c")).first()["c"][0]
    assert cell("1e-11D") != cell("0.0D") and cell("CAST(0 AS DOUBLE)") == cell("0") == cell("-0.0D")
    assert cell("CAST('0.123456789012' AS DECIMAL(20,12))") != cell("CAST('0.123456789013' AS DECIMAL(20,12))")
    assert cell("1e30D") == cell("CAST('1000000000000000000000000000000' AS DECIMAL(38,0))")
    assert cell("CAST('99999999999999999999999999999999999999' AS DECIMAL(38,0))") == "n:99999999999999999999999999999999999999e0"
    assert cell("1") == cell("1.0D") == cell("1.00") == cell("true") == "n:1e0" and cell("'1'") == "s:1"
    assert cell("-2.50") == cell("-2.5D") == "n:-25e-1" and cell("double('NaN')") == "n:NaN"


def test_unequal_counts_use_whole_results(spark):
    rows = spark.range(1500).selectExpr("0 AS k", "'ref' AS side", "id AS cell").unionByName(
        spark.range(1100).selectExpr("0 AS k", "'gen' AS side", "id AS cell"))
    status = spark.sql("SELECT 0 AS k, true AS gen_success, true AS ref_success")
    row = X.compare_pairs(status, rows, ["k"]).first()
    assert (row["gen_rows"], row["ref_rows"], row["exact_match"]) == (1100, 1500, False)
    assert abs(row["similarity"] - 0.3 * 1100 / 1500) < 1e-12


def test_compare_results_failed_side(spark):
    g = spark.createDataFrame([(1,)], "x int")
    row = X.compare_results(g, g, ref_ok=False).first()
    assert (row["exact_match"], row["similarity"]) == (False, 0.0)


def test_ordered_compare(spark):
    g = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    r = spark.createDataFrame([(1, 10), (2, 21)], "k int, v int")
    assert X.compare_results(g, g, order_matters=True, order_by=["k"]).first()["exact_match"] is True
    assert X.compare_results(g, r, order_matters=True, order_by=["k"]).first()["exact_match"] is False


def test_hot_key_is_combined_before_shuffle(spark):
    """One pair holding most rows: plan keeps partial aggregation (no per-key collect)."""
    from pyspark.sql import functions as F
    rows = spark.range(200_000).select(F.when(F.col("id") < 150_000, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                       F.when(F.col("id") % 2 == 0, F.lit("gen")).otherwise(F.lit("ref")).alias("side"),
                                       (F.floor(F.col("id") / 2) % 1000).alias("cell"))
    st = X.pair_stats(rows, ["k"])
    plan = st._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan or "partial" in plan
    hot = st.where("k = 0").first()
    assert (hot["gen_rows"], hot["ref_rows"], hot["uni"], hot["inter"]) == (75_000, 75_000, 1000, 1000)


def test_multisets_are_compared_by_count_and_empty_pairs_are_told_apart(spark):
    status = spark.createDataFrame([(1, True, True), (2, True, True), (3, True, True), (4, True, False), (5, True, True)],
                                   "k int, gen_success boolean, ref_success boolean")
    rows = spark.createDataFrame([(k, side, c) for k, gen, ref in ((1, "aab", "abb"), (2, "aab", "baa"), (5, "aa", "ab"))
                                  for side, cells in (("gen", gen), ("ref", ref)) for c in cells], "k int, side string, cell string")
    sets = {r["k"]: r for r in X.compare_pairs(status, rows, ["k"]).collect()}
    bags = {r["k"]: r for r in X.compare_pairs(status, rows, ["k"], multiset=True).collect()}
    assert sets[1]["exact_match"] and not bags[1]["exact_match"] and bags[1]["similarity"] == 2 / 4
    assert bags[2]["exact_match"] and bags[2]["similarity"] == 1.0 and bags[5]["similarity"] == 1 / 3
    assert bags[3]["exact_match"] and bags[3]["empty_match"] and not bags[4]["empty_match"] and not bags[2]["empty_match"]


def test_comparison_reads_its_rows_once(spark):
    from conftest import SF001
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    rows = orders.selectExpr("o_custkey AS k", "CASE WHEN o_orderkey % 2 = 0 THEN 'gen' ELSE 'ref' END AS side", "o_orderkey AS cell")
    status = spark.read.parquet(f"{SF001}/customer.parquet").selectExpr("c_custkey AS k", "true AS gen_success", "true AS ref_success")
    plan = X.compare_pairs(status, rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
