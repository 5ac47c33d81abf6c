"""Cleaning whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.text import lower, normalize, trim
from tidemark.operators.aggregation import require_columns
from tidemark.operators.windows import forward_fill

__all__ = [
    "align_customer_ids", "clean_dataframe", "drop_duplicates", "drop_nulls", "fill_nulls",
    "forward_fill", "standardize_strings", "string_columns",
]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _on_strings(df: DataFrame, change) -> DataFrame:
    columns = {c: change(F.col(c)) for c in string_columns(df)}
    return df.withColumns(columns) if columns else df


def drop_nulls(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Drop rows that are NULL in any of the columns."""
    wanted = [columns] if isinstance(columns, str) else list(columns)
    require_columns(df, wanted)
    return df.dropna(subset=wanted)


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows; NULLs are equal.

    Copies collapse inside each input partition before the shuffle.
    """
    return df.dropDuplicates() if df.columns else df


def clean_dataframe(
    df: DataFrame,
    drop_na_cols: Sequence[str] | None = None,
    dedupe: bool = True,
    clean_strings: bool = True,
    null_token: str | None = None,
) -> DataFrame:
    """Drop NULL rows, normalise strings, then drop duplicates, in that order.

    NULL strings stay NULL unless ``null_token`` names a text to put instead.
    """
    kept = drop_nulls(df, drop_na_cols) if drop_na_cols else df
    if clean_strings:

        def change(c: Column) -> Column:
            return normalize(c) if null_token is None else F.coalesce(normalize(c), F.lit(null_token))

        kept = _on_strings(kept, change)
    return drop_duplicates(kept) if dedupe else kept


def standardize_strings(df: DataFrame) -> DataFrame:
    """Trim and lower-case every string column."""
    return _on_strings(df, lambda c: lower(trim(c)))


def align_customer_ids(df: DataFrame, column: str = "customer_id") -> DataFrame:
    """Make the id column trimmed text, if the table has it."""
    return df.withColumn(column, trim(F.col(column).cast("string"))) if column in df.columns else df


def fill_nulls(df: DataFrame, value=0, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL by a constant in the columns of the constant's type."""
    return df.fillna(value, subset=list(columns)) if columns else df.fillna(value)
