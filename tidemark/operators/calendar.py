"""Aggregation by calendar period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.dates import month_end, month_start, month_text
from tidemark.operators.aggregation import (
    EMPTY_RESULT,
    Aggregate,
    aggregate_column,
    aggregate_plan,
    groupby_summary,
    require_columns,
)
from tidemark.operators.ordering import as_list

# Truncation unit and step of each resampling frequency.
PERIODS = {
    "month": ("MM", "INTERVAL 1 MONTH"),
    "day": ("DD", "INTERVAL 1 DAY"),
}


def _period_start(column: str, period: str) -> Column:
    unit, _ = PERIODS[period]
    day = F.col(column).cast("date")
    return day if unit == "DD" else F.trunc(day, unit)


def resample(
    df: DataFrame,
    date_col: str,
    metrics_dict: Mapping[str, Aggregate | Sequence[Aggregate]],
    period: str = "month",
) -> DataFrame:
    """Aggregate per period, with a row for every period between first and last.

    Rows are grouped first; gaps are then filled on the small period table, so
    the data is scanned once. Empty periods hold 0 for sums and counts, NULL
    for the rest. ``date_col`` holds the first day of the period.
    """
    require_columns(df, [date_col, *metrics_dict])
    plan = aggregate_plan(metrics_dict)
    step = F.expr(PERIODS[period][1])
    found = (
        df.withColumn("__period", _period_start(date_col, period))
        .filter(F.col("__period").isNotNull())
        .groupBy("__period")
        .agg(*[aggregate_column(column, how).alias(name) for name, column, how in plan])
    )
    # At most one row per calendar period: this window is bounded.
    following = F.lead("__period").over(Window.orderBy("__period"))
    last_of_run = F.coalesce(F.add_months(following, -1) if period == "month" else F.date_sub(following, 1), "__period")
    spread = found.withColumn("__last", last_of_run).withColumn(
        date_col, F.explode(F.sequence("__period", "__last", step))
    )
    is_real = F.col(date_col) == F.col("__period")
    return spread.select(
        date_col,
        *[
            F.when(is_real, F.col(name)).otherwise(F.lit(EMPTY_RESULT.get(how) if isinstance(how, str) else None)).alias(name)
            for name, _, how in plan
        ],
    )


def resample_monthly(
    df: DataFrame, date_col: str, metrics_dict: Mapping[str, Aggregate | Sequence[Aggregate]]
) -> DataFrame:
    """Monthly resampling labelled by the last day of the month."""
    return resample(df, date_col, metrics_dict, "month").withColumn(date_col, month_end(date_col))


def resample_daily(
    df: DataFrame, date_col: str, metrics_dict: Mapping[str, Aggregate | Sequence[Aggregate]]
) -> DataFrame:
    """Daily resampling."""
    return resample(df, date_col, metrics_dict, "day")


def _by_period(df, date_col, key, agg_dict, also_by, name):
    keyed = df.withColumn(name, key)
    return groupby_summary(keyed, [*as_list(also_by), name], agg_dict)


def by_month_start(df, date_col, agg_dict, also_by=None, name="month") -> DataFrame:
    """Group by the first day of the month (present months only), and by ``also_by``."""
    return _by_period(df, date_col, month_start(date_col), agg_dict, also_by, name)


def by_month_text(df, date_col, agg_dict, also_by=None, name="month") -> DataFrame:
    """Group by ``YYYY-MM`` text (present months only), and by ``also_by``."""
    return _by_period(df, date_col, month_text(date_col), agg_dict, also_by, name)


def by_day(df, date_col, agg_dict, also_by=None, name=None) -> DataFrame:
    """Group by calendar day (present days only), and by ``also_by``."""
    return _by_period(df, date_col, F.col(date_col).cast("date"), agg_dict, also_by, name or date_col)
