from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.operators import joins
from tidemark.operators.joins import check_merge_key_overlap, join_on_index, safe_merge
from tidemark.operators.selection import head, nlargest, slice_rows, sort_values, tail, top_groups_detail
from tidemark.operators.stacking import concat_all, safe_concat
from tidemark.session import materialize
from tidemark.sources import store_bucketed


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_merge_matches_pandas(frame, how):
    left = pd.DataFrame({"k": ["a", None, "b", "b", "c"], "v": [1, 2, 3, 4, 5], "x": [1, 1, 1, 1, 1]})
    right = pd.DataFrame({"k": ["b", "b", None, "d"], "v": [10, 20, 30, 40], "y": [0, 0, 0, 0]})
    want = left.merge(right, on="k", how=how)
    got = safe_merge(frame(left), frame(right), "k", how)
    assert got.columns == want.columns.tolist() == ["k", "v_x", "x", "v_y", "y"]
    key = lambda rows: sorted(str(tuple(None if v != v else v for v in r)) for r in rows)
    assert key([tuple(None if v is None else v if isinstance(v, str) else float(v) for v in r) for r in got.collect()]) == key(
        [tuple(None if pd.isna(v) else v if isinstance(v, str) else float(v) for v in r) for r in want.itertuples(index=False)]
    )


def test_null_keys_can_be_kept_apart(frame):
    a, b = frame({"k": [None, "x"]}, "k string"), frame({"k": [None, "x"]}, "k string")
    assert safe_merge(a, b, "k").count() == 2
    assert safe_merge(a, b, "k", null_safe=False).count() == 1


def test_null_safe_merge_is_a_hash_or_sort_join(frame):
    plan = safe_merge(frame({"k": ["a"]}), frame({"k": ["a"]}), "k")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_missing_key_names_the_side(frame):
    with pytest.raises(KeyError, match="left"):
        safe_merge(frame({"a": [1]}), frame({"k": [1]}), "k")
    with pytest.raises(KeyError, match="right"):
        safe_merge(frame({"k": [1]}), frame({"a": [1]}), "k")
    with pytest.raises(ValueError):
        safe_merge(frame({"k": [1]}), frame({"k": [1]}), "k", how="cross")


def test_right_key_takes_left_type(frame):
    got = safe_merge(frame({"k": [1, 2], "a": [1, 2]}), frame({"k": ["2", "3"], "b": ["x", "y"]}), "k")
    assert values(got, "k", "b") == [(2, "x")] and got.schema["k"].dataType.simpleString() == "bigint"


def test_dates_parsed_bad_ones_match_nothing(frame):
    left = frame({"d": ["2024-01-01", "bad"], "a": [1, 2]})
    right = frame({"d": ["2024-01-01", "worse"], "b": [3, 4]})
    got = safe_merge(left, right, "d", parse_dates=True)
    assert values(got, "d", "a", "b") == [(dt.datetime(2024, 1, 1), 1, 3)]


def test_two_keys_suffixes_and_no_match(frame, capsys):
    left = frame({"r": ["e", "w"], "m": ["1", "1"], "sales": [1, 2]})
    right = frame({"r": ["e", "w"], "m": ["1", "2"], "sales": [3, 4]})
    got = safe_merge(left, right, ["r", "m"], suffixes=("_store", "_loan"), verbose=True)
    assert values(got, "r", "m", "sales_store", "sales_loan") == [("e", "1", 1, 3)]
    assert "sales_store" in capsys.readouterr().out
    empty = safe_merge(frame({"k": ["cust-1"], "a": [1]}), frame({"k": ["1"], "b": [2]}), "k")
    assert empty.count() == 0 and empty.columns == ["k", "a", "b"]


def test_overlap_and_index_join(frame):
    a, b = frame({"k": [1, 2], "x": [1, 2]}), frame({"k": [2], "y": [5]})
    assert check_merge_key_overlap(a, b) == ["k"]
    assert values(join_on_index(a, b, "k").orderBy("k"), "k", "y") == [(1, None), (2, 5)]
    with pytest.raises(ValueError):
        join_on_index(a, a, "k")


def test_concat_rows(frame):
    a, b = frame({"x": [1, 2], "y": [3, 4]}), frame({"y": [4], "x": [2]})
    assert sorted(values(safe_concat([a, b], verbose=True), "x", "y")) == [(1, 3), (2, 4), (2, 4)]
    with pytest.raises(ValueError):
        safe_concat([a, frame({"x": [1]})])
    assert sorted(values(concat_all([a, frame({"x": [9]})]), "x", "y"), key=str) == [(1, 3), (2, 4), (9, None)]
    with pytest.raises(ValueError):
        safe_concat([])


def test_concat_of_empty_keeps_columns(frame):
    a = frame({"x": [1]})
    assert safe_concat([a.filter("x > 5"), a.filter("x > 6")]).columns == ["x"]


def test_concat_side_by_side(frame):
    a, b = frame({"x": [3, 1, 2]}), frame({"y": [20, 10]})
    got = safe_concat([a, b], axis=1, check_columns=False, order_by=["x", "y"]).orderBy("position")
    assert values(got, "x", "y") == [(1, 10), (2, 20), (3, None)]
    for bad in ({"order_by": None}, {"order_by": ["x"]}):
        with pytest.raises(ValueError):
            safe_concat([a, b], axis=1, check_columns=False, **bad)
    with pytest.raises(ValueError):
        safe_concat([a, a], axis=1, order_by=["x", "x"])


def test_sort_and_limits(frame):
    df = frame({"k": [1, 2, 3, 4, 5], "v": [2.0, None, 9.0, 9.0, 1.0]})
    assert values(sort_values(df, "v"), "k")[-1] == 2
    assert values(sort_values(df, ["v", "k"], [False, True]), "k") == [3, 4, 1, 5, 2]
    assert values(head(df, 2, "k"), "k") == [1, 2]
    assert values(tail(df, 2, "k"), "k") == [4, 5]
    assert values(nlargest(df, 2, "v", "k"), "k") == [3, 4]
    assert values(slice_rows(df, 1, 3, "k", ["k"]).orderBy("k"), "k") == [2, 3]
    assert values(slice_rows(df, 1, 3, "k", ["k"], inclusive=True).orderBy("k"), "k") == [2, 3, 4]


def test_head_is_a_top_k_plan(frame):
    plan = head(frame({"k": [1, 2]}), 1, "k")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_detail_of_top_groups(frame):
    df = frame({"g": ["a", "b", "c", "a"], "v": [1, 5, 3, 1]})
    assert sorted(values(top_groups_detail(df, "g", "v", 2), "g")) == ["b", "c"]


@pytest.mark.parametrize("how, n", [("inner", 1), ("left", 201), ("right", 201), ("outer", 401)])
def test_unreadable_keys_match_nothing(spark, how, n):
    left = spark.createDataFrame([(f"bad {i}", i) for i in range(200)] + [(None, 7)], "k string, a int")
    right = spark.createDataFrame([(f"worse {i}", i) for i in range(200)] + [(None, 8)], "k string, b int")
    merged = safe_merge(left, right, "k", how, parse_dates=True)
    assert merged.columns == ["k", "a", "b"] and merged.count() == n
    assert safe_merge(left, right, "k", how, parse_dates=True, null_safe=False).count() == n - 1 + (how == "outer") * 2 + (how in ("left", "right"))


@pytest.fixture
def many_partitions(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield spark
    for k, v in kept.items():
        spark.conf.set(k, v)


def skewed_pair():
    draw = random.Random(4)
    left = [(draw.choice([1, 1, 1, None, None, 9, 9, draw.randint(2, 60)]), i) for i in range(700)]
    right = [(k, -k) for k in range(1, 50) if k != 9] + [(None, 0), (None, 1), (3, 5), (1, 6)] + [(77, i) for i in range(40)]
    schema = "k int, v int"
    return (left, schema), (right, "k int, w int")


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
@pytest.mark.parametrize("null_safe", [True, False])
def test_spread_merge_equals_the_plain_one(many_partitions, how, null_safe):
    spark = many_partitions
    left, right = (spark.createDataFrame(*x) for x in skewed_pair())
    for a, b in ((left, right), (right.withColumnRenamed("w", "v"), left.withColumnRenamed("v", "w"))):
        plain, spread = (safe_merge(a, b, "k", how, null_safe=null_safe, spread=s) for s in (False, True))
        assert spread.columns == plain.columns
        assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_spread_merge_reads_dates_and_empty_tables(many_partitions):
    spark = many_partitions
    a = spark.createDataFrame([("2024-01-01", i) for i in range(50)] + [("soon", -1), (None, -2)], "d string, v int")
    b = spark.createDataFrame([("2024-01-01 00:00:00", 1), ("never", 2), (None, 3)], "d string, w int")
    for how in ("inner", "outer"):
        plain, spread = (safe_merge(a, b, "d", how, parse_dates=True, spread=s) for s in (False, True))
        assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
        assert safe_merge(a.limit(0), b, "d", how, spread=True).count() == (0 if how == "inner" else 3)
        assert safe_merge(a.limit(0), b.limit(0), "d", how, spread=True).collect() == []


def test_frequent_keys_do_not_meet_in_one_task(many_partitions):
    spark = many_partitions
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    lines = spark.range(40_000).select(F.when(F.col("id") % 10 < 3, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    names = spark.range(40_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for spread, fair in ((False, False), (True, True)):
        rows = safe_merge(lines, names, "k", "left", spread=spread).groupBy(F.spark_partition_id()).count().collect()
        sizes = sorted(r["count"] for r in rows)
        assert sum(sizes) == 40_000
        assert (sizes[-1] <= 3 * sizes[len(sizes) // 2]) == fair


def test_rows_are_copied_no_more_often_than_they_match(many_partitions, monkeypatch):
    spark, stored = many_partitions, []
    monkeypatch.setattr(joins, "materialize", lambda df: stored.append(materialize(df)) or stored[-1])
    lines = spark.range(2_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    names = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c")], "k long, w string")
    assert safe_merge(lines, names, "k", spread=True).count() == 3_000
    assert {r["k"]: r["__right"] for t in stored if "__right" in t.columns and "__left" in t.columns
            for r in t.withColumnRenamed("__k0", "k").collect()} == {0: 1, 1: 2}


def test_tables_stored_in_buckets_join_where_they_lie(spark):
    a = store_bucketed(spark.range(1000).select("id", (F.col("id") * 3).alias("x")), "id", 4)
    b = store_bucketed(spark.range(500).select((F.col("id") * 2).alias("id"), F.lit(1).alias("y")), "id", 4)
    joined = join_on_index(a, b.hint("merge"), "id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert joined.count() == 1000 and joined.where("y = 1").count() == 500
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
