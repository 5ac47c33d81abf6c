"""Concatenating tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ordering import POSITION, row_positions


def check_same_columns(dfs: Sequence[DataFrame]) -> None:
    """Raise ``ValueError`` unless all tables have the same set of columns."""
    for i, df in enumerate(dfs[1:], 1):
        if set(df.columns) != set(dfs[0].columns):
            odd = sorted(set(df.columns) ^ set(dfs[0].columns))
            raise ValueError(f"tables 0 and {i} differ in columns {odd}")


def safe_concat(
    dfs: Sequence[DataFrame],
    axis: int = 0,
    ignore_index: bool = True,
    check_columns: bool = True,
    verbose: bool = False,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Stack tables by rows (axis 0) or side by side (axis 1).

    Rows: columns match by name; with ``check_columns=False`` a table may lack
    some, giving NULL. Side by side: rows pair up by position, so
    ``order_by`` names one order key per table; names must not clash. There
    is no index, so ``ignore_index`` changes nothing.
    """
    tables = list(dfs)
    if not tables:
        raise ValueError("no tables to concatenate")
    if check_columns:
        check_same_columns(tables)
    if axis == 0:
        result = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=not check_columns), tables)
    elif axis == 1:
        result = _side_by_side(tables, order_by)
    else:
        raise ValueError("axis must be 0 or 1")
    if verbose:
        print(f"concatenated {len(tables)} tables, {len(result.columns)} columns")
    return result


def _side_by_side(tables: Sequence[DataFrame], order_by: Sequence[str] | None) -> DataFrame:
    if order_by is None or len(order_by) != len(tables):
        raise ValueError("axis=1 needs one order key per table")
    names = [c for df in tables for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError("column names clash")
    placed = [row_positions(df, [key]) for df, key in zip(tables, order_by)]
    joined = reduce(lambda a, b: a.join(b, POSITION, "full_outer"), placed)
    return joined.select(POSITION, *names).withColumnRenamed(POSITION, "position")


def concat_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack a list of tables, filling columns a table lacks with NULL."""
    return safe_concat(dfs, check_columns=False)
