"""Row filters and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import contains
from tidemark.operators.aggregation import require_columns
from tidemark.operators.cleaning import string_columns
from tidemark.operators.quantiles import quantiles

# Fixed value: reach of the outlier fences, in interquartile ranges.
FENCE = 1.5


def where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where the condition is true; NULL counts as false."""
    return df.filter(condition)


def equals(df: DataFrame, column: str, value) -> DataFrame:
    """Rows with one value in a chosen column."""
    require_columns(df, [column])
    return df.filter(F.col(column) == F.lit(value))


def is_member(column: str | Column, values: Sequence) -> Column:
    """True for listed values, false for all else and NULL."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.isin(list(values)), F.lit(False))


def search_text(df: DataFrame, pattern: str) -> DataFrame:
    """Rows where any text column matches the pattern (a regex), ignoring case."""
    hit = F.lit(False)
    for c in string_columns(df):
        hit = hit | contains(c, pattern, case=False)
    return df.filter(hit)


def iqr_bounds(df: DataFrame, columns: str | Sequence[str], approximate: bool = False) -> dict[str, tuple[float, float]]:
    """Outlier fences per column: two numbers each, the only thing the driver gets."""
    names = [columns] if isinstance(columns, str) else list(columns)
    require_columns(df, names)
    found: dict[str, dict[float, float]] = {}
    for row in quantiles(df, names, (0.25, 0.75), approximate=approximate).collect():
        found.setdefault(row["column"], {})[row["probability"]] = row["value"]
    bounds = {}
    for name, q in found.items():
        spread = q[0.75] - q[0.25]
        bounds[name] = (q[0.25] - FENCE * spread, q[0.75] + FENCE * spread)
    return bounds


def _outside(column: str, bounds: dict[str, tuple[float, float]]) -> Column:
    if column not in bounds:  # no values at all
        return F.lit(False)
    low, high = bounds[column]
    # Spark holds NaN above all numbers, infinity included; comparisons reach the file scan, isnan doesn't
    return (F.col(column) < low) | ((F.col(column) > high) & (F.col(column) <= float("inf")))


def detect_outliers_iqr(df: DataFrame, col: str, approximate: bool = False) -> DataFrame:
    """Rows beyond 1.5 interquartile ranges of the quartiles.

    The fences are literals in the plan, so the filter reaches the file scan.
    """
    return df.filter(_outside(col, iqr_bounds(df, col, approximate)))


def count_outliers_iqr(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Outliers per column, as rows (column, outliers); one pass for all quartiles, one to count."""
    bounds = iqr_bounds(df, columns, approximate)
    counts = df.agg(*[F.count_if(_outside(c, bounds)).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "outliers")
