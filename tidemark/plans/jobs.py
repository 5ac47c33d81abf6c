"""End-to-end jobs.

Each job takes DataFrames and returns DataFrames; callers choose sources and
sinks. Windows here run on calendar series, at most one row per period and
group, hence ``small_groups=True``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import evaluate, map_values, month_label, month_start, parse_date, parse_number, query
from tidemark.operators.aggregation import (
    binned_summary,
    compute_approval_rate,
    groupby_summary,
    grouped_totals,
    named_summary,
    rate_of,
    table_summary,
)
from tidemark.operators.calendar import by_month_start, by_month_text, resample_monthly
from tidemark.operators.cleaning import align_customer_ids, clean_dataframe, standardize_strings
from tidemark.operators.columns import normalize_names, rename_columns
from tidemark.operators.filters import count_outliers_iqr, equals, search_text
from tidemark.operators.joins import safe_merge
from tidemark.operators.narrowing import optimize_dataframe
from tidemark.operators.profile import missing_values
from tidemark.operators.ranking import rank_values
from tidemark.operators.reports import format_money, highlight_max
from tidemark.operators.reshape import pivot_table_summary, stacked_groupby_unstack
from tidemark.operators.selection import head, sort_values
from tidemark.operators.windows import cumulative_sum, pct_change, rolling_mean
from tidemark.session import materialize
from tidemark.sources.writers import export_formats, save_by_region, save_csv


def load_and_type(
    df: DataFrame, dates: Sequence[str] = (), numbers: Sequence[str] = ()
) -> DataFrame:
    """Normalise column names; parse date and number columns, bad values becoming NULL."""
    named = normalize_names(df)
    parsed = {c: parse_date(F.col(c).cast("string")) for c in dates}
    parsed |= {c: parse_number(c) for c in numbers}
    return named.withColumns(parsed) if parsed else named


def load_job(
    df: DataFrame,
    output_path: str,
    dates: Sequence[str] = (),
    numbers: Sequence[str] = (),
    by_region: str | None = None,
) -> DataFrame:
    """Type a raw table and write it, by region if asked; return what was typed."""
    typed = load_and_type(df, dates, numbers)
    if by_region:
        save_by_region(typed, output_path, by_region)
    else:
        save_csv(typed, output_path)
    return typed


@dataclass
class CleaningReport:
    cleaned: DataFrame
    missing: DataFrame
    outliers: DataFrame


def clean_job(
    df: DataFrame, drop_na_cols: Sequence[str], outlier_cols: Sequence[str], output_path: str | None = None
) -> CleaningReport:
    """Clean a table; report missing values before and outliers after."""
    cleaned = clean_dataframe(df, list(drop_na_cols))
    if output_path:
        save_csv(cleaned, output_path)
    return CleaningReport(cleaned, missing_values(df), count_outliers_iqr(cleaned, list(outlier_cols)))


CUBE_KEYS = ("region", "segment", "category", "sub_category", "month")
CUBE_SUMS = ("sales", "profit", "quantity", "discount")


def sales_cube(sales: DataFrame) -> DataFrame:
    """Sums and counts per region, segment, category, sub-category and month, kept.

    All sales summaries roll up from this one pass over the order lines. Its
    size is the number of key combinations, not of lines.
    """
    sums = [F.sum(c).alias(c) for c in CUBE_SUMS]
    counts = [F.count(c).alias(f"{c}_n") for c in CUBE_SUMS]
    return materialize(sales.withColumn("month", month_start("order_date")).groupBy(*CUBE_KEYS).agg(*sums, *counts))


def _mean(cube_column: str):
    """Mean of the lines behind a cube column."""
    return F.try_divide(F.sum(cube_column), F.sum(f"{cube_column}_n"))


def sales_aggregates(sales: DataFrame, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The sales summaries: by region and segment, by category, by month, pivots; all, or those in ``names``."""
    cube = sales_cube(sales)

    def region_segment() -> DataFrame:
        totals = cube.dropna(subset=["region", "segment"]).groupBy("region", "segment").agg(
            F.coalesce(F.sum("sales"), F.lit(0.0)).alias("sales"), _mean("profit").alias("profit")
        )
        return sort_values(totals, "sales", False)

    def category_stats() -> DataFrame:
        totals = cube.dropna(subset=["category"]).groupBy("category").agg(
            F.sum("sales_n").alias("sales_count"),
            F.coalesce(F.sum("sales"), F.lit(0.0)).alias("sales_sum"),
            _mean("discount").alias("discount_mean"),
        )
        return sort_values(totals, "sales_sum", False)

    def monthly() -> DataFrame:
        return resample_monthly(cube, "month", {"sales": "sum", "profit": "sum"}).withColumnRenamed("month", "order_date")

    builders = {
        "region_segment": region_segment,
        "category_stats": category_stats,
        "category_totals": lambda: grouped_totals(cube, "category", ["sales", "profit", "quantity"]),
        "monthly": monthly,
        "region_by_category": lambda: pivot_table_summary(cube, "region", "category", "sales", "sum").fillna(0),
        "segment_by_sub_category": lambda: pivot_table_summary(cube, "segment", "sub_category", "sales", "sum"),
        "stacked": lambda: stacked_groupby_unstack(cube, ["region", "segment", "category"], "sales", "category"),
    }
    return {name: builders[name]() for name in (builders if names is None else names)}


def loan_summary(loans: DataFrame) -> DataFrame:
    """Total loan, average income and approval rate per purpose."""
    totals = named_summary(loans, "loan_purpose", total_loan=("loan_amount", "sum"), avg_income=("income", "mean"))
    return safe_merge(totals, compute_approval_rate(loans, "loan_purpose"), "loan_purpose")


def loan_by_bracket(loans: DataFrame, column: str, bounds: Sequence[float]) -> DataFrame:
    """Average loan and approval rate per bracket of a number, empty brackets included."""
    return binned_summary(
        loans, column, bounds, "age_bracket",
        avg_loan_amount=("loan_amount", "mean"), approval_rate=("approved", rate_of("yes")),
    )


def sales_with_outside_series(sales: DataFrame, outside: DataFrame) -> DataFrame:
    """Monthly sales beside a monthly outside series, with cumulative sales and rolling profit."""
    monthly = by_month_start(sales, "order_date", {"sales": "sum", "profit": "sum"}, name="order_month")
    other = by_month_start(outside, "date", {"new_cases": "sum", "new_deaths": "sum"}, name="order_month")
    joined = safe_merge(monthly, other, "order_month", parse_dates=True)
    summed = cumulative_sum(joined, "sales", "order_month", new_col="cum_sales", small_groups=True)
    return rolling_mean(summed, "profit", 3, "order_month", new_col="rolling_profit", small_groups=True)


def region_month_summary(sales: DataFrame, outside: DataFrame, site_to_region: Mapping[str, str]) -> DataFrame:
    """Region × month sales beside the outside series mapped to the same regions."""
    by_region = by_month_text(sales, "order_date", {"sales": "sum", "profit": "sum"}, "region", "order_month")
    mapped = outside.withColumn("region", map_values("site", site_to_region))
    other = by_month_text(mapped, "date", {"hospitalized": "mean"}, "region", "order_month")
    return sort_values(safe_merge(by_region, other, ["region", "order_month"]), ["region", "order_month"])


def customers_since(sales: DataFrame, since: str) -> DataFrame:
    """Customers with orders since a date, ranked by their sales."""
    recent = query(sales, f"order_date >= '{since}'")
    totals = named_summary(recent, "customer_id", total_sales=("sales", "sum"), avg_profit=("profit", "mean"))
    return sort_values(rank_values(totals, "total_sales", ascending=False, new_col="sales_rank"), "sales_rank")


def final_report(sales: DataFrame, outside: DataFrame) -> DataFrame:
    """Monthly sales and profit beside the outside series, with rolling profit and sales growth."""
    clean_sales = align_customer_ids(standardize_strings(sales))
    monthly = by_month_text(clean_sales, "order_date", {"sales": "sum", "profit": "sum"})
    other = by_month_text(outside, "date", {"new_cases": "sum", "hospitalized": "mean"})
    joined = safe_merge(monthly, other, "month")
    rolled = rolling_mean(joined, "profit", 3, "month", new_col="rolling_profit", small_groups=True)
    return pct_change(rolled, "sales", "month", new_col="sales_pct_change", small_groups=True)


def formatted_report(report: DataFrame, base_path: str | None = None) -> DataFrame:
    """Report with maximum flags and money text; also exported as CSV and Parquet if a path is given."""
    kept = materialize(report)
    if base_path:
        export_formats(kept, base_path)
    return format_money(highlight_max(kept), ["sales", "profit"])


@dataclass
class Dashboard:
    kpis: DataFrame
    trend: DataFrame
    month_rows: DataFrame
    matches: DataFrame


def dashboard(report: DataFrame, month: str, keyword: str) -> Dashboard:
    """KPIs and trends over all months; all rows of one month; all rows matching a keyword.

    A preview is :func:`head` of a result.
    """
    report = materialize(report)  # one small table behind all four results
    kpis = table_summary(
        rename_columns(report, {"hospitalized": "avg_hospitalized"}),
        {"sales": "sum", "profit": "sum", "new_cases": "sum", "avg_hospitalized": "mean"},
    )
    trend = sort_values(
        report.select("month", month_label(parse_date("month", "yyyy-MM")).alias("label"), "sales", "profit"), "month"
    )
    return Dashboard(
        kpis, trend, sort_values(equals(report, "month", month), "month"),
        sort_values(search_text(report, keyword), "month"),
    )


@dataclass
class OptimizedTables:
    sales: DataFrame
    high_sales: DataFrame
    loans: DataFrame
    profit_by_region: DataFrame


def optimize_job(
    sales: DataFrame, loans: DataFrame, threshold: float = 500, output_path: str | None = None, categories: Sequence[str] = (),
) -> OptimizedTables:
    """Narrow both tables, filter high sales, add the loan ratio, average profit by region.

    ``categories`` names text columns of ``sales`` with few values. Narrowing
    reads a table once before its first use, so the tables are best stored ones.
    """
    narrow_sales = optimize_dataframe(sales, list(categories), verbose=False)
    narrow_loans = optimize_dataframe(loans, verbose=False)
    with_ratio = evaluate(narrow_loans, "loan_to_income_ratio = loan_amount / income")
    if output_path:
        save_csv(narrow_sales, f"{output_path}/sales_optimized")
        save_csv(with_ratio, f"{output_path}/loan_optimized")
    return OptimizedTables(
        narrow_sales,
        query(narrow_sales, f"sales > {threshold}"),
        with_ratio,
        grouped_totals(narrow_sales, "region", ["profit"], "mean"),
    )
