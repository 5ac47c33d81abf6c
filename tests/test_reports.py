from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from tests.conftest import values
from tidemark.operators import reports
from tidemark.plans import jobs
from tidemark.sources import load_csv, load_parquet


def test_histogram(frame):
    df = frame({"q": [1, 1, 2, 5, 9, 11]})
    assert values(reports.histogram(df, "q", 5).orderBy("bin"), "bin", "bin_start", "count") == [
        (0, 1.0, 3), (1, 3.0, 0), (2, 5.0, 1), (3, 7.0, 0), (4, 9.0, 2)
    ]
    assert values(reports.histogram(frame({"q": [3, 3]}), "q", 4).orderBy("bin"), "bin", "count") == [(0, 2), (1, 0), (2, 0), (3, 0)]
    assert reports.histogram(frame({"q": [None]}, "q double"), "q").count() == 0


def test_box(frame):
    df = frame({"c": ["a"] * 6 + ["b"], "v": [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, 7.0]})
    got = {r["c"]: r for r in reports.box_stats(df, "v", "c").collect()}
    assert (got["a"]["q1"], got["a"]["median"], got["a"]["q3"]) == (2.25, 3.5, 4.75)
    assert (got["a"]["lower_whisker"], got["a"]["upper_whisker"], got["a"]["outliers"]) == (1.0, 5.0, 1)
    assert (got["b"]["lower_whisker"], got["b"]["upper_whisker"], got["b"]["outliers"]) == (7.0, 7.0, 0)


def test_share(frame):
    df = frame({"s": ["x", "x", "y", None]}, "s string")
    assert values(reports.value_share(df, "s"), "s", "count", "percent") == [("x", 2, pytest.approx(200 / 3)), ("y", 1, pytest.approx(100 / 3))]


def test_flags_gradient_money(frame):
    df = frame({"m": ["1", "2", "3"], "a": [1.0, 3.0, 3.0], "b": [5.0, None, 2.0]}, "m string, a double, b double")
    flagged = reports.highlight_max(df).orderBy("m")
    assert values(flagged, "is_max_a", "is_max_b", "is_max_m") == [(False, True, False), (True, False, False), (True, False, True)]
    assert values(reports.gradient(df, ["a"]).orderBy("m"), "a_intensity") == [0.0, 1.0, 1.0]
    assert values(reports.gradient(frame({"a": [2, 2]}), ["a"]), "a_intensity") == [None, None]
    assert values(reports.format_money(df, ["a"]).orderBy("m"), "a")[0] == "$1.00"


@pytest.fixture
def sales(frame):
    days = [dt.date(2020, m, 5) for m in (1, 1, 2, 3, 4)]
    return frame({
        "order_date": days, "customer_id": [1, 2, 1, 2, 3], "region": ["E ", "W", "E", "W", "E"], "segment": ["s", "t", "s", "t", "s"],
        "category": ["A", "B", "A", "B", "A"], "sub_category": ["a", "b", "a", "b", "c"], "sales": [100.0, 50.0, 300.0, 150.0, 600.0],
        "profit": [10.0, 20.0, 30.0, 60.0, 90.0], "quantity": [1, 2, 3, 4, 5], "discount": [0.1, 0.0, 0.2, 0.0, 0.1],
    }, "order_date date, customer_id long, region string, segment string, category string, sub_category string,"
       "sales double, profit double, quantity long, discount double")


@pytest.fixture
def outside(frame):
    days = [dt.date(2020, m, 9) for m in (1, 2, 3, 4, 5)]
    return frame({"date": days, "new_cases": [5, 6, 7, 8, 9], "new_deaths": [1, 1, 1, 1, 1], "hospitalized": [2.0, 4.0, 6.0, 8.0, 9.0], "site": list("xxyyz")},
                 "date date, new_cases long, new_deaths long, hospitalized double, site string")


def test_final_report_rules(sales, outside):
    report = jobs.final_report(sales, outside).orderBy("month")
    assert report.columns == ["month", "sales", "profit", "new_cases", "hospitalized", "rolling_profit", "sales_pct_change"]
    assert values(report, "month", "sales", "new_cases") == [("2020-01", 150.0, 5), ("2020-02", 300.0, 6), ("2020-03", 150.0, 7), ("2020-04", 600.0, 8)]
    assert values(report, "rolling_profit") == [None, None, 40.0, 60.0]
    assert values(report, "sales_pct_change") == [None, 1.0, -0.5, 3.0]


def test_sales_with_outside_series(sales, outside):
    df = jobs.sales_with_outside_series(sales, outside).orderBy("order_month")
    assert values(df, "cum_sales") == [150.0, 450.0, 600.0, 1200.0]
    assert values(df, "rolling_profit") == [None, None, 40.0, 60.0]


def test_region_month(sales, outside):
    df = jobs.region_month_summary(sales, outside, {"x": "E", "y": "W"})
    assert values(df, "region", "order_month", "sales", "hospitalized") == [("E", "2020-02", 300.0, 4.0), ("W", "2020-03", 150.0, 6.0)]


def test_customers_since(sales):
    df = jobs.customers_since(sales, "2020-02-01")
    assert values(df, "customer_id", "total_sales", "sales_rank") == [(3, 600.0, 1.0), (1, 300.0, 2.0), (2, 150.0, 3.0)]


def test_sales_aggregates_match_direct_grouping(sales):
    tables = jobs.sales_aggregates(sales)
    assert values(tables["category_stats"], "category", "sales_count", "sales_sum", "discount_mean") == [
        ("A", 3, 1000.0, pytest.approx(0.4 / 3)), ("B", 2, 200.0, 0.0)
    ]
    assert values(tables["region_segment"], "region", "segment", "sales", "profit")[0] == ("E", "s", 900.0, 60.0)
    assert [str(d) for d in values(tables["monthly"].orderBy("order_date"), "order_date")] == ["2020-01-31", "2020-02-29", "2020-03-31", "2020-04-30"]
    assert values(tables["region_by_category"].orderBy("region"), "A", "B") == [(900.0, 0.0), (100.0, 0.0), (0.0, 200.0)]
    assert values(tables["segment_by_sub_category"].orderBy("segment"), "a", "b", "c") == [(400.0, None, 600.0), (None, 200.0, None)]
    assert values(tables["stacked"].orderBy("region", "segment"), "A")[0] == 900.0
    assert values(tables["category_totals"].orderBy("category"), "quantity") == [9, 6]


def test_loan_summaries(frame):
    loans = frame({"loan_purpose": ["car", "car", "home"], "loan_amount": [10.0, 20.0, 5.0], "income": [1.0, 3.0, 5.0], "approved": ["yes", "no", "yes"], "age": [25, 35, 71]})
    assert values(jobs.loan_summary(loans).orderBy("loan_purpose"), "loan_purpose", "total_loan", "avg_income", "approval_rate") == [("car", 30.0, 2.0, 0.5), ("home", 5.0, 5.0, 1.0)]
    brackets = jobs.loan_by_bracket(loans, "age", [20, 30, 40, 50]).orderBy("age_bracket")
    assert values(brackets, "avg_loan_amount", "approval_rate") == [(10.0, 1.0), (20.0, 0.0), (None, None)]


def test_report_export_and_dashboard(sales, outside, spark, tmp_path):
    report = jobs.final_report(sales, outside)
    shown = jobs.formatted_report(report, str(tmp_path / "report"))
    assert values(shown.filter("is_max_sales"), "month", "sales") == [("2020-04", "$600.00")]
    assert load_csv(str(tmp_path / "report.csv"), spark=spark).count() == load_parquet(str(tmp_path / "report.parquet"), spark).count() == 4
    board = jobs.dashboard(report, "2020-03", "2020-0[12]")
    assert board.kpis.first().asDict() == {"sales": 1200.0, "profit": 210.0, "new_cases": 26, "avg_hospitalized": 5.0}
    assert values(board.trend, "label")[0] == "Jan 2020"
    assert values(board.month_rows, "month") == ["2020-03"] and values(board.matches, "month") == ["2020-01", "2020-02"]


def test_clean_and_optimize_jobs(sales, frame, spark, tmp_path):
    report = jobs.clean_job(frame({"s": [" A", "a", None], "v": [1.0, 1.0, None]}, "s string, v double"), ["s"], ["v"], str(tmp_path / "clean"))
    assert report.cleaned.count() == 1 and dict(values(report.missing, "column", "missing")) == {"s": 1, "v": 1}
    assert values(report.outliers, "outliers") == [0] and load_csv(str(tmp_path / "clean"), spark=spark).count() == 1
    loans = frame({"loan_amount": [10.0, 5.0], "income": [4.0, 0.0]})
    out = jobs.optimize_job(sales, loans, 200, str(tmp_path / "opt"), ["region"])
    assert out.high_sales.count() == 2 and values(out.loans, "loan_to_income_ratio") == [2.5, None]
    assert load_csv(str(tmp_path / "opt" / "loan_optimized"), spark=spark).count() == 2


def test_load_job(frame, spark, tmp_path):
    raw = frame({"Order Date": ["2024-01-02", "never"], "Loan-Amount": ["12.5", "x"], "Region": ["E", "W"]})
    typed = jobs.load_job(raw, str(tmp_path / "t"), ["order_date"], ["loan_amount"], by_region="region")
    assert values(typed.orderBy("region"), "order_date", "loan_amount") == [(dt.date(2024, 1, 2), 12.5), (None, None)]
    jobs.load_job(raw, str(tmp_path / "u"), ["order_date"])
    assert load_csv(str(tmp_path / "u"), spark=spark).count() == 2


def test_clean_group_and_save(frame, spark, tmp_path):
    """From raw file to grouped file."""
    from tidemark.operators.aggregation import groupby_summary
    from tidemark.operators.cleaning import clean_dataframe
    from tidemark.sources import save_csv

    save_csv(frame({"Name": [" Ann", "BO", "ann ", "Cy"], "Score": [90.0, 80.0, 90.0, None], "Grade": ["A", "B", "a", "B"]}, "Name string, Score double, Grade string"), str(tmp_path / "raw"))
    cleaned = clean_dataframe(load_csv(str(tmp_path / "raw"), spark=spark), drop_na_cols=["Score"])
    save_csv(groupby_summary(cleaned, "Grade", {"Score": "mean"}), str(tmp_path / "out"))
    assert values(load_csv(str(tmp_path / "out"), spark=spark).orderBy("Grade"), "Grade", "Score") == [("a", 90.0), ("b", 80.0)]


def test_box_of_many_values_takes_two_scans(spark, monkeypatch):
    from tidemark.operators import quantiles as q

    monkeypatch.setattr(q, "ACCURACY", 300)  # so that bounds are needed
    rng = np.random.default_rng(2)
    n = 12_000
    pdf = pd.DataFrame({
        "c": rng.choice(["a", "b", "d"], n), "v": np.concatenate([rng.normal(0, 1, n - 500), rng.normal(0, 9, 400), np.full(100, 40.0)]),
    })
    pdf.loc[pdf.c == "d", "v"] = np.round(pdf.v[pdf.c == "d"])
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    df = spark.createDataFrame(pdf)
    got = {r.c: r for r in reports.box_stats(df.mapInPandas(seen, df.schema), "v", "c").collect()}
    assert reads.value == 2 * n
    for c, v in pdf.groupby("c")["v"]:
        q1, median, q3 = v.quantile([0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = v[(v >= low) & (v <= high)]
        assert (got[c].q1, got[c].median, got[c].q3) == (pytest.approx(q1), pytest.approx(median), pytest.approx(q3))
        assert (got[c].lower_whisker, got[c].upper_whisker, got[c].outliers) == (inside.min(), inside.max(), len(v) - len(inside))


def test_totals_by_each_group_from_one_scan(frame):
    df = frame({"s": ["x", "x", None, "y"], "r": ["n", "m", "n", "n"], "a": [1.0, 2.0, 4.0, 8.0], "b": [10, 20, 40, 80]})
    got = reports.totals_by_each(df, {"a by s": ("s", "a"), "b by r": ("r", "b"), "a by r": ("r", "a")})
    assert got._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    assert sorted(map(tuple, got.collect())) == [
        ("a by r", "m", 2.0), ("a by r", "n", 13.0), ("a by s", "x", 3.0), ("a by s", "y", 8.0), ("b by r", "m", 20.0), ("b by r", "n", 130.0),
    ]
