"""Wide and long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.aggregation import Aggregate, aggregate_column, named, nan_as_null, require_columns
from tidemark.operators.ordering import as_list
from tidemark.session import materialize


def pivot_values(df: DataFrame, column: str) -> list:
    """Distinct non-NULL values to become columns; refuses more than Spark's pivot limit."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    found = [r[0] for r in df.select(column).dropna().distinct().orderBy(column).limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values, too many columns; use pivot_cells for the long form")
    return found


def pivot_cells(
    df: DataFrame, index: str | Sequence[str], columns: str | Sequence[str], values: str, aggfunc: Aggregate = "mean", name: str = "value"
) -> DataFrame:
    """The cells of a pivot in long form: one row per (index, columns) with its aggregate, for any number of values."""
    keys, across = as_list(index), as_list(columns)
    require_columns(df, [*keys, *across, values])
    return (
        nan_as_null(df, [*keys, *across, values]).dropna(subset=[*keys, *across])
        .groupBy(*keys, *across)
        .agg(aggregate_column(values, aggfunc).alias(name))
    )


def pivot_table_summary(
    df: DataFrame,
    index: str | Sequence[str],
    columns: str | Sequence[str],
    values: str,
    aggfunc: Aggregate = "mean",
    column_values: Sequence | None = None,
) -> DataFrame:
    """Pivot ``columns`` across, aggregating ``values``; missing cells are NULL.

    The input is read once: rows are aggregated to cells per (index, columns), and the stored cells give the columns
    and the rows. Several ``columns`` give one column per combination that occurs, named ``a_b``. ``column_values``
    fixes the columns (texts ``a_b`` for several) and saves storing the cells.
    """
    keys, across = as_list(index), as_list(columns)
    cells = pivot_cells(df, keys, across, values, aggfunc, "__cell")
    column = across[0]
    if len(across) > 1:
        column = "__across"
        label = F.concat_ws("_", *[named(c).cast("string") for c in across])
        cells = cells.select(*keys, *across, label.alias(column), "__cell")
    if column_values is None:
        cells = materialize(cells)
    if len(across) > 1:
        combinations = cells.select(*across, column).distinct().groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
        shared = combinations.where("__n > 1").first()
        if shared:
            raise ValueError(f"several combinations of {across} are named {shared[0]!r}")
    names = list(column_values) if column_values is not None else pivot_values(cells, column)
    return cells.groupBy(*keys).pivot(column, names).agg(F.first("__cell", ignorenulls=True))


def stacked_groupby_unstack(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    unstack_col: str,
    fill_value=0,
    column_values: Sequence | None = None,
) -> DataFrame:
    """Sum per group, one group key moved to columns, gaps filled."""
    index = [c for c in group_cols if c != unstack_col]
    wide = pivot_table_summary(df, index, unstack_col, value_col, "sum", column_values)
    gaps = F.lit(fill_value)
    return wide.select(*index, *[F.coalesce(named(c), gaps).alias(c) for c in wide.columns if c not in index])


def melt_summary(
    df: DataFrame, id_vars: str | Sequence[str], var_name: str, value_name: str
) -> DataFrame:
    """Wide to long: one row per remaining column; NULL cells are kept."""
    ids = as_list(id_vars)
    require_columns(df, ids)
    return df.unpivot(ids, [c for c in df.columns if c not in ids], var_name, value_name)
