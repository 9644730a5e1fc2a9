"""Cuts, slices and single rows by counts, against sorting in Python."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from sqlscore.operators import dataset as D
from sqlscore.operators import selection as S
from sqlscore.operators.ranking import seeded_hash


@pytest.fixture(scope="module")
def ids(spark):
    """1,000 ids with repetitions, nulls and one hot id; every row has a number of its own."""
    rng = random.Random(1)
    rows = [(rng.choice([None, 7, 7, 7, *range(-400, 400)]), n) for n in range(1000)] + [(7, 1000 + n) for n in range(300)]
    return spark.createDataFrame(rows, "id long, n long").repartition(5).cache()


@pytest.fixture
def deep(monkeypatch):
    """Several levels of descent on small tables."""
    monkeypatch.setattr(S, "DIGITS", 1)
    monkeypatch.setattr(S, "BINS", 8)
    monkeypatch.setattr(S, "LEAF", 5)


def in_order(ids, salt):
    return [(r["h"], r["id"]) for r in ids.select(seeded_hash("id", 42, salt).alias("h"), "id").orderBy("h", F.col("id").asc_nulls_first()).collect()]


@pytest.mark.parametrize("k", [1, 2, 137, 640, 641, 700, 1299, 1300])
def test_cut_keeps_exactly_the_first(spark, ids, deep, k):
    order = in_order(ids, "")
    kept = D.take_subset(ids, "id", k).collect()
    assert len(kept) == k and len({r["n"] for r in kept}) == k
    key = lambda i: (i is not None, i or 0)
    assert sorted((r["id"] for r in kept), key=key) == sorted((i for _, i in order[:k]), key=key)


def test_cut_of_all_or_nothing(spark, ids):
    assert D.take_subset(ids, "id", 5000).count() == 1300
    assert D.take_subset(ids, "id", 0).count() == 0
    empty = ids.where("false")
    assert D.take_subset(empty, "id", 3).count() == 0 and D.train_test_split(empty, "id", 0.2).count() == 0


@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.333, 1.0])
def test_split_is_exact_with_repeated_ids(spark, ids, deep, fraction):
    counts = {r["split"]: r["num_rows"] for r in D.split_counts(D.train_test_split(ids, "id", fraction)).collect()}
    train, test = D.split_sizes(1300, fraction)
    assert (counts.get("train", 0), counts.get("test", 0)) == (train, test)


def test_rows_by_position(spark, ids, deep):
    order = in_order(ids, D.SPLIT_SALT)
    h = seeded_hash("id", 42, D.SPLIT_SALT)
    for p in (0, 1, 500, 1299):
        assert [r["id"] for r in S.hash_row(ids, "id", h, p).collect()] == [order[p][1]]
    assert S.hash_row(ids, "id", h, 1300).count() == 0
    split = D.train_test_split(ids.dropDuplicates(["id"]).where("id is not null"), "id", 0.25)
    for name, index in (("test", 0), ("test", 3), ("train", 0), ("train", 20), ("test", 10_000)):
        a = D.sample_preview(split, "id", name, index).collect()
        b = D.split_preview(split.drop("split"), "id", 0.25, name, index).collect()
        assert [r["id"] for r in a] == [r["id"] for r in b] and len(a) == (index < 10_000)


@pytest.mark.parametrize("span", [(0, 10), (0, 1300), (5, 5), (40, 700), (600, 601), (1250, 5000), (3000, 4000), (0, 60), (20, 1299)])
def test_slices_equal_sorting(spark, ids, deep, span):
    order = sorted((r["id"] for r in ids.collect()), key=lambda i: (i is not None, i or 0))
    got = S.slice_rows(ids, "id", *span, "pos").orderBy("pos").collect()
    assert [r["id"] for r in got] == order[span[0]:span[1]]
    assert [r["pos"] for r in got] == list(range(*span))[:len(got)]
    assert len({r["n"] for r in got}) == len(got)
    assert S.slice_rows(ids, "id", *span).count() == len(got)


def test_slices_part_ties_without_overlap(spark, ids):
    parts = [S.slice_rows(ids, "id", a, a + 325).collect() for a in range(0, 1300, 325)]
    assert sorted(r["n"] for p in parts for r in p) == list(range(1300))


def test_slices_of_dates_and_of_the_whole_range_of_longs(spark, deep):
    days = [datetime.date(1960, 1, 1) + datetime.timedelta(k * k) for k in range(60)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert sorted(r["d"] for r in S.slice_rows(df, "d", 10, 33).collect()) == days[10:33]
    ends = [-2 ** 63, -2 ** 63 + 1, -5, 0, 3, 2 ** 62, 2 ** 63 - 2, 2 ** 63 - 1]
    df = spark.createDataFrame([(x,) for x in ends], "x long")
    for a in range(8):
        assert sorted(r["x"] for r in S.slice_rows(df, "x", a, a + 3).collect()) == ends[a:a + 3]
    text = spark.createDataFrame([(c,) for c in "dbca"], "c string")
    assert sorted(r["c"] for r in S.slice_rows(text, "c", 1, 3).collect()) == ["b", "c"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_rank_sort_and_write_no_rows(spark):
    from conftest import SF01
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    p = D.DataParams()
    split = plan_of(D.prepare_splits(orders, "o_orderkey", p))
    assert "Window" not in split and "Exchange" not in split and "Sort" not in split and split.count("FileScan") == 1
    part = plan_of(D.holdout_slice(orders, "o_orderkey", 10_000, 12_500))
    assert "Window" not in part and "Exchange" not in part and "Sort" not in part
    assert "GreaterThanOrEqual(o_orderkey" in part.split("PushedFilters")[1]
    row = plan_of(D.split_preview(orders, "o_orderkey", 0.2, "train", 0))
    assert row.count("FileScan") == 1 and "EqualTo(o_orderkey" in row.split("PushedFilters")[1]
