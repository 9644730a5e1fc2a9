"""X1 executor: batching by template, isolation of failures, safety, whole results."""

import pytest
from pyspark.sql import functions as F

from sqlscore.sources.executor import run_query_batch, templatize
from sqlscore.sources.tables import from_records, register_tables


@pytest.fixture(scope="module")
def views(spark):
    from conftest import SF001
    register_tables(spark, SF001, ["orders", "customer"])  # for the expected results


def run(spark, items, tables=None):
    from conftest import SF001
    q = spark.createDataFrame(items, "query_id string, query string")
    if tables is not None:
        q = q.withColumn("tables", F.array(*[F.lit(t) for t in tables]))
    ex, rows = run_query_batch(spark, q, lambda s: register_tables(s, SF001, ["orders", "customer"]),
                               tables="tables" if tables is not None else None)
    return {r["query_id"]: r for r in ex.collect()}, rows


def test_templatize(spark):
    df = spark.createDataFrame([("a", "SELECT x FROM t WHERE y = 'it''s' AND z = 12 -- 7\n AND `c9` = 3.50"),
                                ("b", "SELECT x FROM t WHERE y = 'no' AND z = 99999999999 -- 7\n AND `c9` = 1.25")],
                               "id string, query string")
    t = {r["id"]: r for r in templatize(df).collect()}
    assert t["a"]["slot_val"] == ["it's", "12", "3.50"]
    assert t["a"]["slot_kind"] == ["s", "i", "d3_2"] and t["b"]["slot_kind"] == ["s", "l", "d3_2"]
    assert "-- 7" in t["a"]["template"] and "`c9`" in t["a"]["template"]


def test_batch_matches_single_runs(spark, views):
    keys = [r["c_custkey"] for r in spark.table("customer").select("c_custkey").limit(20).collect()]
    items = [(f"q{k}", f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = {k};") for k in keys]
    ex, rows = run(spark, items)
    assert all(r["success"] for r in ex.values())
    for k in keys[:3]:
        want = spark.sql(f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = {k}").count()
        assert ex[f"q{k}"]["row_count"] == want
        assert rows.where(F.col("query_id") == f"q{k}").count() == want


def test_errors_refusals_and_runtime_fallback(spark, views):
    ex, _ = run(spark, [
        ("ddl", "DROP TABLE orders"),
        ("multi", "SELECT 1; DROP TABLE orders"),
        ("refl", "SELECT reflect('java.lang.System', 'exit', '0')"),
        ("blank", ""),
        ("bad", "INVALID SQL QUERY HERE"),
        ("d1", "SELECT 100 DIV (1 - 2) AS x FROM customer WHERE c_custkey = 1"),
        ("d2", "SELECT 100 DIV (2 - 2) AS x FROM customer WHERE c_custkey = 1"),
        ("d3", "SELECT 100 DIV (3 - 2) AS x FROM customer WHERE c_custkey = 1"),
    ])
    for k in ("ddl", "multi", "refl", "blank", "bad", "d2"):
        assert ex[k]["success"] is False, k
    assert ex["ddl"]["error_class"] == "PARSE_SYNTAX_ERROR"
    assert ex["d2"]["error_class"] == "DIVIDE_BY_ZERO"
    assert ex["d1"]["success"] and ex["d3"]["success"] and ex["d1"]["row_count"] == 1
    assert spark.table("orders").count() > 0


def test_empty_result(spark, views):
    ex, _ = run(spark, [("e", "SELECT o_orderkey FROM orders WHERE o_custkey < 0")])
    assert ex["e"]["success"] and ex["e"]["row_count"] == 0


def test_whole_results_are_kept(spark, views):
    ex, rows = run(spark, [("all", "SELECT o_orderkey FROM orders"), ("one", "SELECT 1 AS x")])
    n = spark.table("orders").count()
    assert n > 1000 and ex["all"]["row_count"] == n and rows.where("query_id = 'all'").count() == n
    assert ex["all"]["seconds"] > 0


def test_bad_members_are_isolated(spark, views):
    ex, _ = run(spark, [(f"d{k}", f"SELECT 100 DIV ({k} - 40) AS x FROM customer WHERE c_custkey = 1") for k in range(80)])
    assert [k for k, r in ex.items() if not r["success"]] == ["d40"]
    assert ex["d40"]["error_class"] == "DIVIDE_BY_ZERO" and all(r["row_count"] == 1 for k, r in ex.items() if k != "d40")


def test_text_is_parsed_alone_and_checked_in_the_plan(spark, views):
    ex, rows = run(spark, [
        ("unbalanced", "SELECT 1 AS x) a, (SELECT 2 AS y"),
        ("quoted", "SELECT `reflect`('java.lang.Integer', 'parseInt', '1')"),
        ("spaced", "SELECT reflect/**/('java.lang.Integer', 'parseInt', '1')"),
        ("text", "SELECT 'please reflect (on it)' AS a"),
        ("variable", "SELECT '${system:java.version}' AS a"),
        ("file", "SELECT * FROM parquet.`/tmp/x`"),
        ("long", "SELECT '" + "x" * 100_000 + "' AS a"),
    ])
    assert {k for k, r in ex.items() if r["success"]} == {"text", "variable", "long"}
    assert rows.where("query_id = 'variable'").first()["cells"] == ["s:${system:java.version}"]
    assert ex["unbalanced"]["error_class"] == "PARSE_SYNTAX_ERROR"


def test_only_declared_tables_exist(spark, views):
    ex, _ = run(spark, [("own", "WITH w AS (SELECT * FROM orders) SELECT count(*) FROM w"), ("other", "SELECT c_custkey FROM customer"),
                        ("inside", "SELECT 1 FROM orders WHERE EXISTS (SELECT 1 FROM customer)")], tables=["orders"])
    assert ex["own"]["success"] and not ex["other"]["success"] and not ex["inside"]["success"]
    assert ex["other"]["error_class"] == "TABLE_OR_VIEW_NOT_FOUND"


def test_limit_shapes_run_with_their_own_texts(spark, views):
    keys = [r["o_custkey"] for r in spark.table("orders").groupBy("o_custkey").count()
            .where("count >= 5").orderBy("o_custkey").limit(6).collect()]
    ex, rows = run(spark, [(f"k{k}", f"SELECT o_orderkey FROM orders WHERE o_custkey = {k} LIMIT 3") for k in keys])
    assert all(ex[f"k{k}"]["success"] and ex[f"k{k}"]["row_count"] == 3 for k in keys)


def test_timeout_is_told_by_class(spark):
    from sqlscore.operators import score as C
    cols = "completion string, answer string, context string, gen_success boolean, gen_error string, gen_error_class string, ref_success boolean, " \
           "exact_match boolean, similarity double, gen_rows long, ref_rows long"
    df = spark.createDataFrame([("SELECT 1", "SELECT 1", "CREATE TABLE t (a INT)", False, "no column timeout", "UNRESOLVED_COLUMN", True, False, 0.0, 0, 0),
                                ("SELECT 1", "SELECT 1", "CREATE TABLE t (a INT)", False, "x", "TIMEOUT", True, False, 0.0, 0, 0)], cols)
    d = C.with_sql_columns(df)
    s, _ = C.execution_scorer()(d)
    assert [r["s"] for r in d.select(s.alias("s")).collect()] == [-0.6, -0.8]


def test_scratch_folder_needs_a_shared_setting_off_local():
    from types import SimpleNamespace

    from sqlscore.session import ensure_checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                           sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)


def test_tables_are_listed_anew(spark, tmp_path):
    from sqlscore.sources.tables import read_table
    spark.range(10).write.parquet(f"{tmp_path}/t.parquet")
    assert read_table(spark, str(tmp_path), "t").count() == 10
    spark.range(5).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    assert read_table(spark, str(tmp_path), "t").count() == 15


def test_from_records(spark):
    df = from_records(spark, {"question": ["a", "b"], "context": ["c", None], "answer": ["d", "e"]})
    assert df.columns == ["question", "context", "answer"] and [tuple(r) for r in df.collect()] == [("a", "c", "d"), ("b", None, "e")]
    with pytest.raises(ValueError):
        from_records(spark, {"a": ["x"], "b": []})


def test_structural_literals_stay_in_template(spark):
    df = spark.createDataFrame([("a", "SELECT x FROM t WHERE y = 7 ORDER BY x LIMIT 5"),
                                ("b", "SELECT x FROM t WHERE d > DATE '2020-01-01' + INTERVAL 3 DAYS")],
                               "id string, query string")
    t = {r["id"]: r for r in templatize(df).collect()}
    assert t["a"]["slot_raw"] == ["7"] and "LIMIT 5" in t["a"]["template"]
    assert t["b"]["slot_raw"] == [] and "DATE '2020-01-01'" in t["b"]["template"]


def test_names_made_at_run_time_and_shadowing_do_not_reach_other_tables(spark, views):
    ex, _ = run(spark, [
        ("made", "SELECT c_custkey FROM IDENTIFIER('customer')"),
        ("made_own", "SELECT o_orderkey FROM IDENTIFIER('orders')"),
        ("call", "SELECT IDENTIFIER('reflect')('java.lang.Integer', 'parseInt', '1')"),
        ("shadow", "WITH customer AS (SELECT * FROM customer) SELECT count(*) FROM customer"),
        ("later", "WITH a AS (SELECT * FROM customer), customer AS (SELECT 1 AS x) SELECT * FROM a"),
        ("inner", "SELECT * FROM (WITH customer AS (SELECT 1 AS x) SELECT * FROM customer) CROSS JOIN customer"),
        ("scoped", "WITH customer AS (SELECT 1 AS x) SELECT x FROM customer"),
        ("nested", "WITH a AS (SELECT o_orderkey FROM orders), b AS (SELECT * FROM a) SELECT count(*) FROM b"),
        ("qualified", "SELECT * FROM default.customer"),
    ], tables=["orders"])
    assert {k for k, r in ex.items() if r["success"]} == {"scoped", "nested"}
    assert ex["made"]["error_class"] == ex["call"]["error_class"] == "IDENTIFIER_NOT_ALLOWED"
    assert ex["shadow"]["error_class"] == ex["later"]["error_class"] == ex["inner"]["error_class"] == "TABLE_OR_VIEW_NOT_FOUND"


def test_only_declared_columns_exist(spark, views):
    ex, rows = run(spark, [("own", "SELECT o_orderkey FROM orders WHERE O_CustKey = 1"), ("other", "SELECT o_totalprice FROM orders"),
                           ("star", "SELECT * FROM orders WHERE o_orderkey = 1"), ("filter", "SELECT o_orderkey FROM orders WHERE o_totalprice > 0")],
                   tables=["orders(o_orderkey,o_custkey,missing)"])
    assert ex["own"]["success"] and ex["star"]["success"] and not ex["other"]["success"] and not ex["filter"]["success"]
    assert {len(r["cells"]) for r in rows.where("query_id = 'star'").collect()} == {2}
    ex, _ = run(spark, [("all", "SELECT o_totalprice FROM orders")], tables=["orders"])
    assert ex["all"]["success"]


def test_declared_tables_of_schema_texts(spark):
    from sqlscore.sources.executor import declared_tables
    texts = {
        "CREATE TABLE Orders (o_orderkey BIGINT, price DECIMAL(10, 2) CHECK (price IN (1, 2)), PRIMARY KEY (o_orderkey));\n"
        "create table if not exists `items` (\"id\" int, -- the key, (unique)\n [name] text /* , gone int */)": ["orders(o_orderkey,price)", "items(id,name)"],
        "CREATE TEMP TABLE t AS SELECT 1 AS x": ["t"],
        "no schema": [], "": [],
    }
    df = spark.createDataFrame([(t,) for t in texts], "s string").select("s", declared_tables(F.col("s")).alias("d"))
    assert {r["s"]: r["d"] for r in df.collect()} == texts


def test_store_runs_new_and_failed_queries_only(spark, views, tmp_path):
    from conftest import SF001
    from sqlscore.sources.store import ExecutionStore
    register = lambda s: register_tables(s, SF001, ["orders", "customer"])

    def batch(store, items):
        q = spark.createDataFrame(items, "query_id string, query string")
        ex, rows = run_query_batch(spark, q, register, store=store)
        return {r["query_id"]: r for r in ex.collect()}, rows
    path = f"{tmp_path}/store"
    store = ExecutionStore(spark, path, buckets=4)
    ok = [(f"q{k}", f"SELECT o_orderkey FROM orders WHERE o_custkey = {k}") for k in range(1, 30)]
    first, _ = batch(store, [*ok, ("bad", "SELECT nothing FROM orders"), ("empty", "SELECT 1 FROM orders WHERE o_orderkey < 0")])
    assert not any(r["kept"] for r in first.values())
    again = ExecutionStore(spark, path, buckets=99)  # an existing store keeps its number of buckets
    assert again.buckets == 4
    second, rows = batch(again, [*ok, *ok, ("bad", "SELECT o_orderkey FROM orders WHERE o_custkey = 1"), ("empty", "SELECT 1 FROM orders WHERE o_orderkey < 0"),
                                 ("new", "SELECT count(*) FROM orders")])
    assert {k for k, r in second.items() if not r["kept"]} == {"bad", "new"} and all(r["success"] for r in second.values())
    assert all(second[k]["row_count"] == first[k]["row_count"] for k, _ in ok)
    counted = {r["query_id"]: r["count"] for r in rows.groupBy("query_id").count().collect()}
    assert counted == {k: r["row_count"] for k, r in second.items() if r["row_count"]}
    third, rows = batch(again, ok[:2])
    assert all(r["kept"] for r in third.values()) and rows.where("query_id = 'q1'").count() == third["q1"]["row_count"]
    # a run that ended before its last step leaves rows that nobody reads
    spark.createDataFrame([("dead", f"{path}/nowhere")], "run string, path string").write.mode("append").parquet(f"{path}/paths")
    assert batch(again, ok[:1])[0]["q1"]["kept"]


def test_store_is_not_shuffled(spark, tmp_path):
    from sqlscore.sources.store import ExecutionStore
    store = ExecutionStore(spark, f"{tmp_path}/plan", buckets=4)
    done = spark.range(100).selectExpr("cast(id AS string) AS query_id", "true AS success", "1L AS row_count", "0.1D AS seconds")
    store.keep("r", done, [])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        batch = spark.range(90, 120).selectExpr("cast(id AS string) AS query_id", "'x' AS query")
        fresh = store.fresh(store.dealt(batch))
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 4 out of 4" in plan
        assert sorted(int(r["query_id"]) for r in fresh.collect()) == list(range(100, 120))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
