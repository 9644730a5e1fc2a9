"""Work made of few bytes is dealt over all cores; keys that move are small."""

from hashlib import md5 as _md5

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sqlscore.functions import cells
from sqlscore.operators import score as C
from sqlscore.sources import executor as X
from sqlscore.sources import fixtures as FX
from sqlscore.sources.tables import spread


def md5(text):
    return _md5(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def one_split(spark, tmp_path_factory):
    """3,000 customers (one id a thousand times, one null) in a file that a scan reads in one task."""
    path = str(tmp_path_factory.mktemp("one_split"))
    ids = spark.range(2000).select(F.col("id").alias("c_custkey")).unionByName(spark.range(999).select(F.lit(7).cast("long").alias("c_custkey")))
    ids = ids.unionByName(spark.range(1).select(F.lit(None).cast("long").alias("c_custkey")))
    ids.coalesce(1).write.parquet(f"{path}/customer.parquet")
    orders = spark.range(4000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 2000).alias("o_custkey"))
    orders.coalesce(1).write.parquet(f"{path}/orders.parquet")
    return path


def even(df):
    sizes = [n for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()]
    return max(sizes) <= 2 * sum(sizes) / len(sizes) and len(sizes) >= 3 * df.sparkSession.sparkContext.defaultParallelism


def test_candidates_are_dealt_over_all_cores(spark, one_split):
    df = FX.candidates(spark, one_split)
    assert df.count() == 4 * 3000
    assert even(df)


@pytest.mark.parametrize("make,rows", [(FX.candidates_wide, 3000), (FX.samples, 3000)])
def test_samples_are_dealt_over_all_cores(spark, one_split, make, rows):
    df = make(spark, one_split)
    assert df.count() == rows
    assert even(df)


def test_integers_print_as_all_numbers_do(spark):
    values = [0, 1, -1, 10, -10, 1200, 1002, -(2 ** 63), 2 ** 63 - 1, 10 ** 18, None]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = df.select(cells.cell(F.col("v"), T.LongType()).alias("a"),
                    F.concat(F.lit("n:"), cells._number(F.col("v").cast("string"))).alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]
    assert [r["a"] for r in got][:6] == ["n:0e0", "n:1e0", "n:-1e0", "n:1e1", "n:-1e1", "n:12e2"]


def test_batch_reads_tables_of_a_schema_text(spark, one_split):
    q = spark.createDataFrame([
        ("a", "SELECT count(*) FROM orders", "CREATE TABLE orders (o_orderkey BIGINT, o_custkey BIGINT);"),
        ("a", "SELECT count(*) FROM orders", "CREATE TABLE orders (o_orderkey BIGINT, o_custkey BIGINT);"),
        ("b", "SELECT count(*) FROM customer", "CREATE TABLE orders (o_orderkey BIGINT);"),
        ("c", "SELECT o_custkey FROM orders", "CREATE TABLE orders (o_orderkey BIGINT);"),
        ("d", " SELECT o_orderkey FROM orders WHERE o_orderkey < 3 ; ", "create table orders (o_orderkey BIGINT)")],
        "query_id string, query string, s string")

    def views(session):
        for name in ("customer", "orders"):
            session.read.parquet(f"{one_split}/{name}.parquet").createOrReplaceTempView(name)
    ex, rows = X.run_query_batch(spark, q, views, schema="s")
    got = {r["query_id"]: (r["success"], r["row_count"]) for r in ex.collect()}
    assert got == {"a": (True, 1), "b": (False, 0), "c": (False, 0), "d": (True, 3)}
    assert rows.count() == 4
    listed = X.run_query_batch(spark, q.withColumn("t", X.declared_tables(F.col("s"))), views, tables="t")[0]
    assert {r["query_id"]: (r["success"], r["row_count"]) for r in listed.collect()} == got


def test_kept_executions_make_their_texts_once(spark, one_split, monkeypatch):
    from sqlscore.plans.catalog import QUERIES

    seen = []

    class Enough(Exception):
        pass

    def batch(spark, queries, *args, **kwargs):
        seen.append((queries, kwargs))
        raise Enough
    monkeypatch.setattr(X, "run_query_batch", batch)
    with pytest.raises(Enough):
        QUERIES["kept_executions"](spark, one_split)
    queries, kwargs = seen[0]
    plan = queries._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "regexp" not in plan
    assert queries.rdd.getNumPartitions() > 2
    assert queries.count() == 2 * 2 * 3000  # two of four generations, each with its reference


def test_distinct_executions_move_no_keys(spark):
    df = spark.createDataFrame([("a", "s"), ("a", "s"), ("a", None), ("a", None), ("a", ""), (None, "s"), (None, "s"), (None, None)], "q string, s string")
    out = C.distinct_executions(df, "q", "s")
    got = sorted(((r["exec_key"], r["query"], r["schema"]) for r in out.collect()), key=str)
    want = [(md5("a:s"), "a", "s"), (md5("a:"), "a", None), (md5("a:"), "a", ""), (None, None, "s"), (None, None, None)]
    assert got == sorted(want, key=str)
    below = out._jdf.queryExecution().executedPlan().toString().split("Exchange")[1]
    assert "md5" not in below  # a key is made of what is left


def test_duplicate_stats_group_by_few_bytes(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("ab", ""), ("a", None), (None, "a"), (None, "a")], "x string, y string")
    out = C.duplicate_stats(df, ["x", "y"])
    assert tuple(out.first())[:3] == (6, 4, 2)
    wide = spark.range(100).select(F.lit("k").alias("x"), F.col("id").cast("string").alias("y"))
    keys = C.duplicate_stats(wide, ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert "unhex(md5(" in keys  # 16 bytes, however many fields


def test_write_evaluation_scores_once(spark, one_split, monkeypatch):
    from sqlscore.plans import catalog

    seen, write = [], catalog.write_evaluation

    def kept(records, summary, path):
        seen.extend((records, summary))
        write(records, summary, path)
    monkeypatch.setattr(catalog, "write_evaluation", kept)
    out = catalog.QUERIES["write_evaluation"](spark, one_split)
    assert out.count() == 2001 and {r[0] for r in out.select("num_samples").distinct().collect()} == {2001}
    assert all("FileScan" not in df._jdf.queryExecution().executedPlan().toString() for df in seen)


@pytest.mark.parametrize("name", ["sample_rewards", "score_by_type", "reward_monitor", "reward_statistics", "write_eval_summary"])
def test_scored_texts_are_made_by_all_cores(spark, one_split, monkeypatch, name):
    from sqlscore.plans import catalog

    seen, outcome = [], catalog.outcome
    monkeypatch.setattr(catalog, "outcome", lambda *args, **kwargs: seen.append(outcome(*args, **kwargs)) or seen[-1])
    catalog.QUERIES[name](spark, one_split)
    made = seen[0].select("_gen_tok", "_ref_tok", "gen_rows")._jdf.queryExecution().executedPlan().toString()
    texts = made[:made.index("orders.parquet")]  # the candidates' side of the join comes before their rows
    assert "RoundRobinPartitioning" in texts and texts.index("regexp_replace") < texts.index("RoundRobinPartitioning") < texts.index("customer.parquet")


def _expected_rows(path, spark):
    """Rows of both sides, made in Python."""
    ids = [r[0] for r in spark.read.parquet(f"{path}/customer.parquet").collect()]
    by = {}
    for k, c in spark.read.parquet(f"{path}/orders.parquet").select("o_orderkey", "o_custkey").collect():
        by.setdefault(c, []).append(k)
    out = []
    for c in ids:
        for g in range(4):
            for k in by.get(c, ()) if c is not None else ():
                v = (c + g) % 11
                if v != 10:
                    out.append((c, g, "ref", k))
                if v not in (7, 8, 9) and not (v == 5 and k % 3 == 0):
                    out.append((c, g, "gen", k + 1000000 if v == 6 and k % 2 == 0 else k))
    return sorted(out)


def test_result_rows_are_made_in_tasks_of_bounded_size(spark, one_split, monkeypatch):
    monkeypatch.setattr(FX, "ORDERS_PER_TASK", 100, raising=False)
    rows = FX.result_rows(spark, one_split)
    assert rows.rdd.getNumPartitions() == 40  # 4,000 orders; not one scan task, and not merged by the few bytes of the orders
    assert sorted(map(tuple, rows.select("sample_id", "gen_idx", "side", "cell").collect())) == _expected_rows(one_split, spark)
    assert "BroadcastHashJoin" not in rows._jdf.queryExecution().executedPlan().toString()  # an order becomes several rows


def test_texts_are_made_in_tasks_of_bounded_size(spark, one_split, monkeypatch):
    monkeypatch.setattr(FX, "CUSTOMERS_PER_TASK", 50, raising=False)
    df = FX.candidates(spark, one_split)
    sizes = df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == 60 and sum(sizes) == 4 * 3000 and max(sizes) <= 2 * 4 * 50  # 3,000 customers, whatever the cores


@pytest.fixture(scope="module")
def one_crowded(spark, tmp_path_factory):
    """3,000 of 4,000 orders are those of two customers (one of them stands twice, one order without a customer)."""
    path = str(tmp_path_factory.mktemp("one_crowded"))
    spark.createDataFrame([(i,) for i in [*range(300), 5, None]], "c_custkey long").coalesce(1).write.parquet(f"{path}/customer.parquet")
    key = F.when(F.col("id") < 2000, 5).when(F.col("id") < 3000, 11).when(F.col("id") < 3999, F.col("id") % 300).cast("long")
    spark.range(4000).select(F.col("id").alias("o_orderkey"), key.alias("o_custkey")).coalesce(1).write.parquet(f"{path}/orders.parquet")
    return path


def test_orders_of_a_crowded_customer_are_dealt_evenly(spark, one_crowded, monkeypatch):
    monkeypatch.setattr(FX, "ORDERS_PER_TASK", 100)
    rows = FX.result_rows(spark, one_crowded)
    assert sorted(map(tuple, rows.select("sample_id", "gen_idx", "side", "cell").collect())) == _expected_rows(one_crowded, spark)
    sizes = rows.rdd.mapPartitions(lambda r: [sum(1 for _ in r)]).collect()
    assert max(sizes) <= 2 * 16 * 100 < sum(sizes) / 8  # an order of customer 5 becomes up to sixteen rows


def test_scores_do_not_depend_on_crowding(spark, one_crowded, monkeypatch):
    from sqlscore.plans import catalog

    def scores():
        return sorted(map(tuple, catalog.QUERIES["score_by_type"](spark, one_crowded).collect()), key=str)
    before = scores()
    monkeypatch.setattr(FX, "ORDERS_PER_TASK", 100)
    assert scores() == before and len(before) == 4 * 4 * 302


def test_crowded_keys(spark):
    from sqlscore.sources.tables import crowded
    df = spark.range(1000).select(F.when(F.col("id") < 300, 1).when(F.col("id") < 600, 2).when(F.col("id") < 900, None).otherwise(F.col("id")).alias("k"))
    assert sorted(r[0] for r in crowded(df, "k", 100, 10).collect()) == [1, 2]
    assert crowded(df, "k", 300, 8) is None  # no task holds twice as many, and no key more
    assert crowded(df.where("k > 2"), "k", 100, 8) is None and crowded(df.where("false"), "k", 100, 8) is None


def test_spread_adds_tasks_as_rows_grow(spark):
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    tasks = [spread(spark.range(n), "id", rows_per_task=10).rdd.getNumPartitions() for n in (0, 1, 10 * least, 10 * least + 1, 100 * least)]
    assert tasks == [least, least, least, least + 1, 10 * least]


def test_scores_of_shared_columns_are_those_of_the_texts(spark):
    texts = ["SELECT a FROM t", "select  a from t -- x", "SELECT b FROM t", "", "   ", None, "```sql\nSELECT a FROM t\n```", "'"]
    df = spark.createDataFrame([(i, a, b, c) for i, (a, b, c) in enumerate((a, b, c) for a in texts for b in texts for c in ("CREATE TABLE t (a INT);", "none", None))],
                               "id long, completion string, answer string, context string")
    flags = {"gen_success": F.lit(True), "gen_error": F.lit(None).cast("string"), "ref_success": F.col("id") % 5 != 0, "exact_match": F.col("id") % 2 == 0,
             "similarity": F.lit(0.5), "gen_rows": F.lit(1), "ref_rows": F.lit(1)}
    few = C.with_sql_columns(df).withColumns(flags)
    plain = few.drop(C.VALID, C.SAME, C.SIM, C.HAS_SCHEMA, C.GIVEN)

    def scores(d):
        cols = [c for name in ("syntax", "execution", "semantic", "combined") for c in C.score_by_type(name)(d)]
        return d.select("id", *[c.alias(f"c{i}") for i, c in enumerate(cols)]).orderBy("id").collect()
    assert scores(few) == scores(plain)
    assert [r[0] for r in few.orderBy("id").select(C.GIVEN).collect()] == [a is not None and b is not None for a in texts for b in texts for _ in range(3)]


@pytest.mark.parametrize("name", ["sample_rewards", "score_by_type", "reward_monitor", "reward_statistics", "write_eval_summary"])
def test_no_text_meets_the_result_rows(spark, one_split, monkeypatch, name):
    from sqlscore.plans import catalog

    seen, write = [], catalog.write_eval_summary
    monkeypatch.setattr(catalog, "write_eval_summary", lambda summary, path: seen.append(summary) or write(summary, path))
    out = catalog.QUERIES[name](spark, one_split)
    plan = (seen + [out])[0]._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("regexp_replace")]
    above = above[:above.rindex("Exchange hashpartitioning(sample_id")]  # what is computed of the moved rows
    assert "SortMergeJoin" in above and not [c for c in ("completion#", "answer#", "_sql#", "_norm#", "_gen_tok#", "_ref_tok#") if c in above]


def test_sample_rewards_keep_generations_and_rewards(spark, one_split):
    from sqlscore.plans import catalog

    def lists(df):
        out = {}
        for sample, gen, value in df.collect():
            out.setdefault(sample, []).append((gen, value))
        return {k: [x for _, x in sorted(v, key=lambda p: p[0])] for k, v in out.items()}
    texts = lists(FX.candidates(spark, one_split).select("sample_id", "gen_idx", "completion"))
    scores = lists(catalog.QUERIES["sql_score"](spark, one_split).select("sample_id", "gen_idx", "score"))
    got = {r["sample_id"]: r for r in catalog.QUERIES["sample_rewards"](spark, one_split).collect()}
    assert len(got) == 2001 and sum(len(r["generated"]) for r in got.values()) == 4 * 3000
    assert {k: r["generated"] for k, r in got.items()} == texts and {k: r["rewards"] for k, r in got.items()} == scores
    assert all(r["best_reward"] == max(r["rewards"]) and r["num_generations"] == len(r["rewards"]) for r in got.values())
    assert all(abs(r["mean_reward"] - sum(r["rewards"]) / len(r["rewards"])) <= 1e-6 for r in got.values())
    assert got[7]["num_generations"] == 4 * 1000 and got[None]["generated"] == [None] * 4 and got[None]["rewards"] == [-1.0] * 4
    assert [t[-8:] for t in got[5]["generated"]] == ["% 3 <> 0", "tkey = 5", "ERY HERE", "   "]  # variants 5 to 8
