"""Column-level table operations."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.numbers import when_update
from tidemark.operators.aggregation import require_columns
from tidemark.operators.reshape import pivot_values


def normalize_names(df: DataFrame) -> DataFrame:
    """Strip and lower-case column names; blanks and hyphens become underscores."""
    names = [c.strip().lower().replace(" ", "_").replace("-", "_") for c in df.columns]
    clashes = [name for name, n in Counter(names).items() if n > 1]
    if clashes:
        raise ValueError(f"column names clash after normalising: {clashes}")
    return df.toDF(*names)


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    require_columns(df, columns)
    return df.select(*columns)


def rename_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Rename; names the table lacks are passed over."""
    return df.withColumnsRenamed(dict(columns))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    require_columns(df, columns)
    return df.drop(*columns)


def assign(df: DataFrame, **columns: Column | Callable[[DataFrame], Column]) -> DataFrame:
    """Add columns one after the other; a function gets the table built so far."""
    for name, made in columns.items():
        df = df.withColumn(name, made(df) if callable(made) and not isinstance(made, Column) else made)
    return df


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    require_columns(df, list(types))
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def apply_to_column(
    df: DataFrame, column: str, func: Callable[[Column], Column], new_col: str | None = None
) -> DataFrame:
    """Element-wise function: a Column builder, or a pandas UDF for what Spark lacks."""
    return df.withColumn(new_col or column, func(F.col(column)))


def update_where(df: DataFrame, condition: Column, column: str, value) -> DataFrame:
    """Set a column where the condition holds."""
    return df.withColumn(column, when_update(column, condition, value))


def one_hot(df: DataFrame, column: str, values: Sequence | None = None) -> DataFrame:
    """Replace a column by one boolean column per value, ``column_value``."""
    found = list(values) if values is not None else pivot_values(df, column)
    flags = [F.coalesce(F.col(column) == F.lit(v), F.lit(False)).alias(f"{column}_{v}") for v in found]
    return df.select(*[c for c in df.columns if c != column], *flags)
