import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.operators.reports import gradient, histogram
from tidemark.operators.filters import detect_outliers_iqr
from tidemark.operators.aggregation import (
    binned_summary, compute_approval_rate, groupby_summary, grouped_totals, named_summary, rate_of, table_summary,
)
from tidemark.operators.calendar import by_day, by_month_start, by_month_text, resample_daily, resample_monthly
from tidemark.operators.profile import describe
from tidemark.operators.reshape import melt_summary, pivot_cells, pivot_table_summary, stacked_groupby_unstack


@pytest.fixture
def shop(frame):
    return frame({"Category": ["A", "A", "B", "B"], "Sales": [100, 150, 200, 250], "Profit": [20, 30, 40, 50]})


@pytest.mark.parametrize("reset", [True, False])
def test_group_by_dictionary(shop, reset):
    df = groupby_summary(shop, "Category", {"Sales": "sum", "Profit": "mean"}, reset).orderBy("Category")
    assert values(df, "Category", "Sales", "Profit") == [("A", 250, 25.0), ("B", 450, 45.0)]


def test_lists_give_flat_names(shop):
    df = groupby_summary(shop, "Category", {"Sales": ["count", "sum"], "Profit": "mean"})
    assert df.columns == ["Category", "Sales_count", "Sales_sum", "Profit_mean"]


def test_missing_column(shop):
    with pytest.raises(KeyError):
        groupby_summary(shop, "Category", {"Nope": "sum"})
    with pytest.raises(KeyError):
        groupby_summary(shop, "Nope", {"Sales": "sum"})
    with pytest.raises(ValueError):
        groupby_summary(shop, "Category", {"Sales": "mode"})


def test_null_rules_match_pandas(frame):
    data = pd.DataFrame({"k": ["a", "a", "b", None], "v": [1.0, np.nan, np.nan, 5.0]})
    want = data.groupby("k").v.agg(["sum", "mean", "count"]).reset_index()
    got = groupby_summary(frame(data), "k", {"v": ["sum", "mean", "count"]}).orderBy("k").toPandas()
    assert got.v_sum.tolist() == want["sum"].tolist() and got.v_count.tolist() == want["count"].tolist()
    assert np.allclose(got.v_mean.astype(float), want["mean"], equal_nan=True)


def test_user_aggregates(shop):
    df = groupby_summary(shop, "Category", {"Sales": lambda c: F.max(c) - F.min(c)}).orderBy("Category")
    assert values(df, "Sales") == [50, 50]

    @F.pandas_udf("double")
    def median(s: pd.Series) -> float:
        return float(s.median())

    df = groupby_summary(shop, "Category", {"Sales": median}).orderBy("Category")
    assert values(df, "Sales") == [125.0, 225.0]


def test_other_summaries(shop):
    assert values(named_summary(shop, "Category", n=("Sales", "size")).orderBy("Category"), "n") == [2, 2]
    assert table_summary(shop, {"Sales": "sum", "Profit": "mean"}).first().asDict() == {"Sales": 700, "Profit": 35.0}
    assert values(grouped_totals(shop, "Category", ["Profit"], "max").orderBy("Category"), "Profit") == [30, 50]


def test_approval_rate(frame):
    df = frame({"region": ["East", "East", "West", "West", "West"], "approved": ["yes", "no", "yes", "yes", None]}, "region string, approved string")
    got = dict(values(compute_approval_rate(df), "region", "approval_rate"))
    assert got == {"East": 0.5, "West": pytest.approx(2 / 3)}


def test_bins_without_rows_are_present(frame):
    df = frame({"age": [21, 25, 45, 99], "amount": [10.0, 20.0, 30.0, 40.0], "approved": ["yes", "no", "no", "yes"]})
    got = binned_summary(df, "age", [20, 30, 40, 50], "bracket", mean=("amount", "mean"), n=("amount", "count"), rate=("approved", rate_of("yes")))
    assert values(got.orderBy("bracket"), "bracket", "mean", "n", "rate") == [
        ("[20, 30)", 15.0, 2, 0.5), ("[30, 40)", None, 0, None), ("[40, 50)", 30.0, 1, 0.0)
    ]


@pytest.fixture
def gaps(frame):
    days = [dt.date(2024, 1, 5), dt.date(2024, 3, 2), dt.date(2024, 3, 4), None]
    return frame({"d": days, "v": [1.0, 1.5, 2.5, 9.0]}, "d date, v double")


def test_monthly_resample_fills_gaps(gaps):
    df = resample_monthly(gaps, "d", {"v": ["sum", "mean", "count", "max"]}).orderBy("d")
    assert values(df, "d", "v_sum", "v_mean", "v_count", "v_max") == [
        (dt.date(2024, 1, 31), 1.0, 1.0, 1, 1.0),
        (dt.date(2024, 2, 29), 0.0, None, 0, None),
        (dt.date(2024, 3, 31), 4.0, 2.0, 2, 2.5),
    ]


def test_daily_resample_fills_gaps(gaps):
    df = resample_daily(gaps, "d", {"v": "sum"}).orderBy("d")
    assert df.count() == 60
    assert values(df, "v")[-3:] == [1.5, 0.0, 2.5]


def test_resample_matches_pandas(frame):
    rng = np.random.default_rng(3)
    data = pd.DataFrame({"d": pd.Timestamp("2020-01-01") + pd.to_timedelta(rng.integers(0, 900, 60), "D"), "v": rng.integers(0, 9, 60)})
    want = data.set_index("d").resample("ME").agg({"v": "sum"})
    got = resample_monthly(frame(data), "d", {"v": "sum"}).orderBy("d").toPandas()
    assert [str(x) for x in got.d] == [str(x.date()) for x in want.index] and got.v.tolist() == want.v.tolist()


def test_resample_of_nothing(spark):
    assert resample_monthly(spark.createDataFrame([], "d date, v int"), "d", {"v": "sum"}).count() == 0


def test_month_labels(gaps):
    assert values(by_month_start(gaps, "d", {"v": "sum"}).orderBy("month"), "month", "v") == [(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 3, 1), 4.0)]
    assert values(by_month_text(gaps, "d", {"v": "sum"}).orderBy("month"), "month", "v") == [("2024-01", 1.0), ("2024-03", 4.0)]
    assert values(by_day(gaps, "d", {"v": "sum"}).orderBy("d"), "d", "v")[1] == (dt.date(2024, 3, 2), 1.5)


@pytest.fixture
def cells(frame):
    return frame({"Region": ["E", "E", "W", "W", "W"], "Product": ["P", "Q", "P", "Q", "Q"], "Sales": [100.0, 150.0, 200.0, 250.0, 50.0], "Seg": ["x", "x", "x", "y", "y"]})


def test_pivot(cells):
    df = pivot_table_summary(cells, "Region", "Product", "Sales", "sum").orderBy("Region")
    assert values(df, "Region", "P", "Q") == [("E", 100.0, 150.0), ("W", 200.0, 300.0)]
    assert values(pivot_table_summary(cells, "Region", "Product", "Sales").orderBy("Region"), "Q") == [150.0, 150.0]
    spread = pivot_table_summary(cells, "Region", "Product", "Sales", lambda c: F.max(c) - F.min(c), ["P", "Q"])
    assert values(spread.orderBy("Region"), "Q") == [0.0, 200.0]


def test_pivot_leaves_missing_cells_null_and_melts_them(frame):
    df = pivot_table_summary(frame({"r": ["a", "b"], "c": ["x", "y"], "v": [1, 2]}), "r", "c", "v", "sum")
    assert values(df.orderBy("r"), "x", "y") == [(1, None), (None, 2)]
    long = melt_summary(df, "r", "c", "v").orderBy("r", "c")
    assert values(long, "r", "c", "v") == [("a", "x", 1), ("a", "y", None), ("b", "x", None), ("b", "y", 2)]


def test_pivot_refuses_too_many_columns(spark):
    df = spark.range(10).selectExpr("id", "id as k", "1 as one")
    spark.conf.set("spark.sql.pivotMaxValues", 5)
    try:
        with pytest.raises(ValueError):
            pivot_table_summary(df, "one", "k", "id")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_unstack_fills(cells):
    df = stacked_groupby_unstack(cells, ["Region", "Seg", "Product"], "Sales", "Product").orderBy("Region", "Seg")
    assert values(df, "Region", "Seg", "P", "Q") == [("E", "x", 100.0, 150.0), ("W", "x", 200.0, 0.0), ("W", "y", 0.0, 300.0)]


def test_nan_is_read_as_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("b", float("nan")), ("b", None), ("a", 3.0)], "g string, v double")
    got = groupby_summary(df, "g", {"v": ["sum", "mean", "max", "count"]}).orderBy("g").collect()
    assert [tuple(r) for r in got] == [("a", 4.0, 2.0, 3.0, 2), ("b", 0.0, None, None, 0)]
    assert tuple(table_summary(df, {"v": "sum"}).first()) == (4.0,)
    assert {r.bin: r["count"] for r in histogram(df, "v", 4).collect()} == {0: 1, 1: 0, 2: 0, 3: 1}
    assert sorted((r.v_intensity for r in gradient(df, ["v"]).collect()), key=str) == [0.0, 1.0, None, None, None]
    many = spark.createDataFrame([(float(i),) for i in range(9)] + [(100.0,), (float("nan"),)], "v double")
    assert [r.v for r in detect_outliers_iqr(many, "v").collect()] == [100.0]


def test_more_aggregates_and_dotted_names(spark):
    df = spark.createDataFrame([("a", 2.0, "x.y"), ("a", 0.0, "z"), ("b", 3.0, "x.y")], "g string, `v.w` double, k string")
    got = groupby_summary(df, "g", {"v.w": ["prod", "any", "all"]}).orderBy("g").collect()
    assert [tuple(r) for r in got] == [("a", 0.0, True, False), ("b", 3.0, True, True)]
    wide = stacked_groupby_unstack(df, ["g", "k"], "v.w", "k").orderBy("g")
    assert wide.columns == ["g", "x.y", "z"] and [tuple(r) for r in wide.collect()] == [("a", 2.0, 0.0), ("b", 3.0, 0.0)]


ORDER_STATISTICS = {"v": ["median", "first", "last", "sum"], "w": "median"}


def test_order_statistics_beside_other_aggregates(frame):
    pdf = pd.DataFrame({
        "g": ["a", "a", "b", "b", "b", None, "c"], "o": [3, 1, 5, 4, None, 0, 9],
        "v": [1.0, None, 7.0, 5.0, 2.0, 1.0, None], "w": [1, 2, 3, 4, 5, 6, 7],
    })
    got = groupby_summary(frame(pdf), "g", ORDER_STATISTICS, order_by="o").orderBy("g")
    assert got.columns == ["g", "v_median", "v_first", "v_last", "v_sum", "w_median"]
    # NULL order keys come last, NULL values are skipped
    assert [tuple(r) for r in got.collect()] == [("a", 1.0, 1.0, 1.0, 1.0, 1.5), ("b", 5.0, 5.0, 2.0, 14.0, 4.0), ("c", None, None, None, 0.0, 7.0)]
    whole = table_summary(frame(pdf), {"v": ["median", "max"], "w": ["first", "median"]}, order_by="o").collect()
    assert [tuple(r) for r in whole] == [(2.0, 7.0, 6, 4.0)]
    only = named_summary(frame(pdf), ["g"], middle=("w", "median")).orderBy("g").collect()
    assert [tuple(r) for r in only] == [("a", 1.5), ("b", 4.0), ("c", 7.0)]
    assert groupby_summary(frame(pdf).limit(0), "g", ORDER_STATISTICS, order_by="o").collect() == []
    with pytest.raises(ValueError, match="order_by"):
        groupby_summary(frame(pdf), "g", {"v": "first"})


def test_pivot_across_two_columns(frame):
    pdf = pd.DataFrame({"i": [1, 1, 2, 2, 2, None], "a": ["x", "x", "y", "x", None, "x"], "b": [1, 2, 1, 1, 1, 1], "v": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]})
    got = pivot_table_summary(frame(pdf), "i", ["a", "b"], "v", "sum").orderBy("i")
    assert got.columns == ["i", "x_1", "x_2", "y_1"]
    assert [tuple(r) for r in got.collect()] == [(1, 1.0, 2.0, None), (2, 4.0, None, 3.0)]
    fixed = pivot_table_summary(frame(pdf), "i", ["a", "b"], "v", "sum", column_values=["y_1", "z_9"]).orderBy("i")
    assert [tuple(r) for r in fixed.collect()] == [(1, None, None), (2, 3.0, None)]
    clash = pd.DataFrame({"i": [1, 1], "a": ["x_1", "x"], "b": ["2", "1_2"], "v": [1, 2]})
    with pytest.raises(ValueError, match="x_1_2"):
        pivot_table_summary(frame(clash), "i", ["a", "b"], "v", "sum")
    cells = pivot_cells(frame(pdf), "i", ["a", "b"], "v", "max", "top")
    assert cells.columns == ["i", "a", "b", "top"] and cells.count() == 4


def test_pivot_reads_its_input_once(spark, frame, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    df = frame({"i": [1, 1, 2], "a": ["x", "y", "x"], "v": [1.0, 2.0, 3.0]})
    pivot_table_summary(df.mapInPandas(seen, df.schema), "i", "a", "v", "sum").collect()
    assert reads.value == 3


def test_quantiles_narrow_any_distribution(spark, monkeypatch):
    from tidemark.operators import quantiles as q

    rng = np.random.default_rng(1)
    n = 30_000
    pdf = pd.DataFrame({
        "g": rng.integers(0, 3, n), "wide": np.exp(rng.normal(0, 30, n)) * rng.choice([-1, 1], n),
        "few": np.round(rng.normal(0, 2, n)), "tied": np.where(rng.random(n) < 0.4, 7.0, rng.random(n)),
    })
    pdf.loc[:100, "wide"] = np.nan
    pdf.loc[5:9, "tied"] = [np.inf, -np.inf, -0.0, 0.0, 1e300]
    df = spark.createDataFrame(pdf).repartition(5)
    asked = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    monkeypatch.setattr(q, "ACCURACY", 500)  # so that bounds are needed
    for most in (65_536, 20):
        monkeypatch.setattr(q, "MOST_ROWS", most)
        found = {(r.g, r.column, r.probability): r.value for r in q.quantiles(df, ["wide", "few", "tied"], asked, "g").collect()}
        assert len(found) == 63
        for (g, column, p), value in found.items():
            have = pdf[pdf.g == g][column].dropna().sort_values().to_numpy()
            place = (len(have) - 1) * p
            low, high = have[int(np.floor(place))], have[int(np.ceil(place))]
            assert value == low if low == high else value == pytest.approx(low + (high - low) * (place - np.floor(place)), rel=1e-12)


def test_describe_has_columns_without_values(frame):
    got = {r.column: r for r in describe(frame({"x": [1.0, 2.0, 4.0], "y": [None, None, None]}, "x double, y double")).collect()}
    assert (got["x"]["count"], got["x"].q50, got["x"].max) == (3, 2.0, 4.0)
    assert (got["y"]["count"], got["y"].q50, got["y"].mean) == (0, None, None)
