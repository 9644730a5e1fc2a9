"""Scores end to end on hand cases (FIXTURES.md §2), plus registered-query invariants."""

import pytest
from pyspark.sql import functions as F

from sqlscore.operators import compare as X
from sqlscore.operators import evaluate as E
from sqlscore.operators import score as C
from sqlscore.params import ScoreParams, check_weights

CTX = "CREATE TABLE users (id INT, name TEXT);"
KEYS = ["sample_id", "gen_idx"]


def score_cases(spark, cases, rows=()):
    """cases: (sample_id, completion, answer, gen_success, gen_error, ref_success, context)."""
    df = spark.createDataFrame(
        [(i, 0, comp, ans, gs, ge, rs, ctx) for i, comp, ans, gs, ge, rs, ctx in cases],
        "sample_id long, gen_idx int, completion string, answer string, gen_success boolean, "
        "gen_error string, ref_success boolean, context string")
    rr = spark.createDataFrame(list(rows), "sample_id long, gen_idx int, side string, cell string")
    out = X.compare_pairs(C.with_sql_columns(df), rr, KEYS)
    cols = {}
    for name, scorer in C.sql_components():
        cols[name] = scorer(out)[0]
    total, details = C.combined_scorer()(out)
    res = out.select("sample_id", *[v.alias(k) for k, v in cols.items()], total.alias("score"),
                     details.alias("details"))
    return {r["sample_id"]: r for r in res.collect()}


def test_hand_cases(spark):
    r = score_cases(spark, [
        (1, "SELECT COUNT(*) FROM users;", "SELECT COUNT(*) FROM users;", True, None, True, CTX),
        (2, "SELECT name FROM users", "SELECT name FROM users;", True, None, True, CTX),
        (3, "INVALID SQL QUERY HERE", "SELECT * FROM users;", False, "SQL error: near INVALID", True, CTX),
    ])
    assert (r[1]["syntax"], r[1]["execution"], r[1]["semantic"], r[1]["score"]) == (1.0, 1.0, 1.0, 1.0)
    assert r[2]["semantic"] == pytest.approx(0.28) and r[2]["score"] == pytest.approx(0.856)
    assert r[3]["syntax"] == 1.0 and r[3]["execution"] == -0.6 and r[3]["semantic"] == pytest.approx(-0.2)
    assert r[3]["score"] == pytest.approx(-0.2)
    d = r[2]["details"]["reward_1_execution"]
    assert d["weight"] == 0.6 and d["details"]["exact_match"] is True


def test_syntax_blank_and_short(spark):
    r = score_cases(spark, [(1, "   ", "SELECT 1", True, None, True, CTX),
                            (2, "SELECT 1", "SELECT 1", True, None, True, CTX)])
    assert r[1]["syntax"] == -0.5
    assert r[2]["syntax"] == pytest.approx(0.9)


def test_semantic_both_blank_and_reordered(spark):
    r = score_cases(spark, [(1, "", "  ", True, None, True, CTX),
                            (2, "b a", "a b", True, None, True, CTX)])
    assert r[1]["semantic"] == 1.0
    assert r[2]["semantic"] == pytest.approx(0.6)


def test_execution_rules(spark):
    rows = ([(1, 0, "gen", v) for v in "ab"] + [(1, 0, "ref", v) for v in "abcd"]        # 2 vs 4 rows
            + [(2, 0, "gen", v) for v in "aab"] + [(2, 0, "ref", v) for v in "abb"]      # bag differs, set equal
            + [(3, 0, "gen", v) for v in "ab"] + [(3, 0, "ref", v) for v in "ac"])       # 1/3 overlap
    r = score_cases(spark, [
        (1, "q", "q", True, None, True, CTX), (2, "q", "q", True, None, True, CTX),
        (3, "q", "q", True, None, True, CTX), (4, "q", "q", True, None, True, CTX),   # both empty
        (5, "q", "q", True, None, True, "no ddl here"),                               # no schema
        (6, "q", "q", False, "Query execution timed out", True, CTX),
        (7, "q", "q", False, "SQL error: no such column", True, CTX),
        (8, "q", "q", True, None, False, CTX),
    ], rows)
    assert r[1]["execution"] == pytest.approx(-0.195)
    assert r[2]["execution"] == 1.0
    assert r[3]["execution"] == pytest.approx(-0.0666666667)
    assert r[4]["execution"] == 1.0
    assert [r[i]["execution"] for i in (5, 6, 7, 8)] == [-1.0, -0.8, -0.6, 0.3]


def test_timeout_terms_as_coded(spark):
    df = spark.createDataFrame([("Query execution timed out",)], "gen_error string")
    assert df.select(C.is_timeout(F.col("gen_error"), ("timeout",))).first()[0] is False
    assert df.select(C.is_timeout(F.col("gen_error"))).first()[0] is True


def test_weights_checked():
    assert check_weights(None, 4) == (0.25,) * 4
    with pytest.raises(ValueError):
        check_weights((0.5, 0.6))
    with pytest.raises(ValueError):
        check_weights((0.5, 0.5), 3)
    with pytest.raises(ValueError):
        ScoreParams(weights=(0.3, 0.3, 0.3))


def test_score_by_type_unknown():
    with pytest.raises(ValueError):
        C.score_by_type("nope")


def test_safe_score_and_statistics(spark):
    df = spark.createDataFrame([(0.5,), (None,), (1.0,)], "s double")
    s, ok = C.safe_score(F.col("s"), [])
    scored = df.select(s.alias("score"), ok.alias("scored"))
    assert sorted(r["score"] for r in scored.collect()) == [-1.0, 0.5, 1.0]
    st = C.reward_statistics(scored).first()
    assert (st["call_count"], st["total_reward"], st["average_reward"]) == (2, 1.5, 0.75)
    empty = C.reward_statistics(scored.where("false")).first()
    assert (empty["call_count"], empty["average_reward"]) == (0, 0.0)


def test_evaluation_rates(spark):
    per = spark.createDataFrame([(1, 0.5, 0.5, 1), (2, 0.95, 0.9, 1), (3, 1.0, 1.0, 1)],
                                "sample_id long, best_reward double, mean_reward double, num_generations long")
    row = E.evaluation_summary(per).first()
    assert row["success_rate"] == pytest.approx(2 / 3, abs=1e-6)
    assert row["perfect_rate"] == pytest.approx(1 / 3, abs=1e-6)
    one = E.evaluation_summary(per.limit(1)).first()
    assert one["best_reward_std"] is None


def test_duplicate_stats(spark):
    calls = spark.createDataFrame([(i, k) for i, k in enumerate("aabcbca")], "t long, k string")
    row = C.duplicate_stats(calls, ["k"]).first()
    assert (row["calls"], row["distinct_keys"], row["repeats"]) == (7, 3, 4) and row["repeat_rate"] == pytest.approx(4 / 7)
    assert tuple(C.duplicate_stats(calls.where("false"), ["k"]).first()) == (0, 0, 0, 0.0)


def test_means_are_not_rounded(spark):
    scored = spark.createDataFrame([(1, 0, "a", 0.1234567), (1, 1, "b", 0.7654323)], "sample_id long, gen_idx int, completion string, score double")
    row = E.sample_rewards(scored, ["sample_id"], keep_lists=True).first()
    assert row["mean_reward"] == pytest.approx((0.1234567 + 0.7654323) / 2, abs=1e-12)
    assert row["generated"] == ["a", "b"] and row["rewards"] == [0.1234567, 0.7654323]


def test_score_distinct_matches_direct(spark):
    from conftest import SF001
    from sqlscore.functions import text as T
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")

    def fn(k):
        return k.withColumn("n", F.length(T.normalize_sql(F.col("text"))))
    via = C.score_distinct(docs, "doc_id", ["text"], fn, ["n"])
    direct = fn(docs)
    assert via.select("doc_id", "n").exceptAll(direct.select("doc_id", "n")).count() == 0
    assert via.count() == docs.count()


def test_pandas_scorer_registered_by_name(spark):
    def longer(prompt, completion, answer):
        return (completion.str.len() >= answer.str.len()).map({True: 1.0, False: -1.0})

    C.register_scorer("longer", C.pandas_scorer(longer, "longer"))
    df = spark.createDataFrame([("SELECT 1", "SELECT 1"), ("S", "SELECT 1")], "completion string, answer string")
    out = C.apply_scorer(df, C.score_by_type("longer"))
    assert [r["score"] for r in out.orderBy(F.length("completion").desc()).collect()] == [1.0, -1.0]


def test_sample_rewards_keep_lists(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (1, 0, 1.0), (2, 0, -0.2)], "sample_id long, gen_idx int, score double")
    r = {x["sample_id"]: x for x in E.sample_rewards(df, ["sample_id"], keep_lists=True).collect()}
    assert r[1]["rewards"] == [1.0, 0.5] and r[1]["best_reward"] == 1.0 and r[1]["mean_reward"] == 0.75
    assert r[2]["num_generations"] == 1


def test_sample_rewards_meet_texts_that_stayed_behind(spark):
    rows = [(1, 1, "b", 0.5), (1, 0, "a", 1.0), (1, 0, None, -1.0), (1, 0, "c", 0.25), (1, 0, "a", 0.75), (1, 10, "d", 0.0),
            (2, 0, "x", -0.2), (None, 1, "n", 0.1), (None, 0, "m", 0.2)]
    df = spark.createDataFrame(rows, "sample_id long, gen_idx int, completion string, score double").repartition(3)
    scored = df.select("sample_id", "gen_idx", "score", E.text_digest().alias(E.DIGEST))
    out = E.sample_rewards(scored, ["sample_id"], keep_lists=True, generations=df)
    got = {r["sample_id"]: r for r in out.collect()}
    assert len(got) == 3 and out.columns == ["sample_id", "best_reward", "mean_reward", "num_generations", "generated", "rewards"]
    first = list(zip(got[1]["generated"], got[1]["rewards"]))
    assert sorted(first[:4], key=str) == sorted([("a", 1.0), (None, -1.0), ("c", 0.25), ("a", 0.75)], key=str)  # a reward stands by its text
    assert first[4:] == [("b", 0.5), ("d", 0.0)]
    assert (got[1]["best_reward"], got[1]["mean_reward"], got[1]["num_generations"]) == (1.0, pytest.approx(0.25), 6)
    assert (got[2]["generated"], got[2]["rewards"]) == (["x"], [-0.2])
    assert (got[None]["generated"], got[None]["rewards"], got[None]["num_generations"]) == (["m", "n"], [0.2, 0.1], 2)


def test_score_range_strict_fails(spark):
    from pyspark.errors import PySparkException
    from pyspark.sql.utils import AnalysisException  # noqa: F401

    from sqlscore.operators import dataset as D
    ok = spark.createDataFrame([(0.5,), (-1.0,)], "score double")
    assert D.score_range_check(ok, strict=True).first()["out_of_range"] == 0
    bad = spark.createDataFrame([(0.5,), (1.5,)], "score double")
    assert D.score_range_check(bad).first()["out_of_range"] == 1
    with pytest.raises(Exception) as e:
        D.score_range_check(bad, strict=True).collect()
    assert "must be in [-1, 1]" in str(e.value) or isinstance(e.value, PySparkException)


def test_distinct_scoring_returns_every_row_once(spark):
    rows = [(1, "a"), (1, "a"), (2, "b"), (2, "a"), (None, "c"), (None, "c"), (None, "a"), (3, None), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    calls = spark.sparkContext.accumulator(0)

    def score(keys):
        def count(batches):
            for b in batches:
                calls.add(len(b))
                yield b.assign(n=b["text"].map(lambda t: -1 if t is None else len(t)))
        return keys.mapInPandas(count, "_kd string, text string, n long")
    got = C.score_distinct(df, "id", ["text"], score, ["n"]).collect()
    assert sorted(((r["id"], r["text"], r["n"]) for r in got), key=str) == sorted(((i, t, -1 if t is None else len(t)) for i, t in rows), key=str)


def test_scorer_that_raises_on_some_of_many_rows(spark):
    """C4: the rows at fault score -1.0 and are not counted; the others keep their scores."""
    def brittle(prompt, completion, answer):
        return completion.map(lambda t: 1 / int(t))
    df = spark.range(10_000).selectExpr("id", "CASE WHEN id % 997 = 3 THEN 'x' WHEN id % 2500 = 0 THEN '0' ELSE cast(id AS string) END AS completion", "'a' AS answer")
    out = C.apply_scorer(df, C.pandas_scorer(brittle)())
    bad = {r["id"]: r["details"]["error"].split(":")[0] for r in out.where("not scored").collect()}
    assert bad == {**{i: "ValueError" for i in range(3, 10_000, 997)}, **{i: "ZeroDivisionError" for i in range(0, 10_000, 2500)}}
    assert out.where("not scored and score <> -1.0").count() == 0
    assert out.where("scored and (score <> 1 / cast(completion as double) or details.error is not null)").count() == 0
    stats = C.reward_statistics(out).first()
    assert stats["call_count"] == 10_000 - len(bad)


def test_isolation_calls_few_times_and_refuses_wrong_sizes():
    import pandas as pd
    calls = []

    def fn(x):
        calls.append(len(x))
        if (x == 77).any():
            raise RuntimeError("no")
        return x * 2.0
    scores, errors = C.isolate(fn, [pd.Series(range(1024), index=range(5, 1029))])
    assert errors.notna().sum() == 1 and errors.iloc[77] == "RuntimeError: no" and scores.isna().sum() == 1 and scores.iloc[1023] == 2046
    assert len(calls) <= 2 * 10 + 1
    scores, errors = C.isolate(lambda x: x.iloc[:1], [pd.Series([1.0, 2.0])])
    assert scores.tolist() == [1.0, 2.0] and errors.isna().all()  # alone, each row gives one score
    assert C.isolate(fn, [pd.Series([], dtype=float)])[0].empty
