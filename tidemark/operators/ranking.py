"""Ranks over unbounded tables and groups.

Rows are first counted per distinct (group, value), which shrinks any pile of
equal values to one row before the shuffle. A running total of those counts
over range blocks gives how many rows come before each value, and the result
joins back on (group, value), where adaptive execution may split a hot value
because the rank side has one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.operators.ordering import as_list, running_total
from tidemark.session import materialize


def present(df: DataFrame, column: str) -> Column:
    """True where the value is neither NULL nor NaN."""
    known = F.col(column).isNotNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        known = known & ~F.isnan(column)
    return known


def _rank_column(method: str, before: Column, ties: Column, distinct: Column) -> Column:
    if method == "average":
        return before + (ties + 1) / F.lit(2.0)
    if method == "min":
        return before + 1
    if method == "max":
        return before + ties
    if method == "dense":
        return distinct
    raise ValueError(f"unknown rank method {method!r}")


def rank_values(
    df: DataFrame,
    value: str,
    partition_by: str | Sequence[str] | None = None,
    ascending: bool = True,
    method: str = "average",
    new_col: str = "rank",
    small_groups: bool = False,
    stored: bool = False,
) -> DataFrame:
    """Rank of each value in the table or its group; NULL stays unranked.

    ``stored=True`` says that ``df`` is a stored table, or a filter or
    selection of one: it gives the same values whenever it is read, so it need
    not be written first.
    """
    groups = as_list(partition_by)
    if small_groups:
        return _rank_by_window(df, value, groups, ascending, method, new_col)

    # Both sides of the join back must see the same values: float sums may
    # differ in the last digit when computed twice.
    rows = df if stored else materialize(df)
    ranked_rows = present(rows, value)
    for g in groups:
        ranked_rows = ranked_rows & F.col(g).isNotNull()
    counts = rows.filter(ranked_rows).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("__ties"))
    order = [F.col(value).asc() if ascending else F.col(value).desc()]
    if method == "dense":
        through = running_total(counts.withColumn("__one", F.lit(1)), "__one", order, groups, "__through")
    else:
        through = running_total(counts, "__ties", order, groups, "__through")
    before = F.col("__through") - F.col("__ties")
    ranks = through.select(
        *[F.col(c).alias(f"__k_{c}") for c in [*groups, value]],
        _rank_column(method, before, F.col("__ties"), F.col("__through")).cast("double").alias(new_col),
    )
    keys = [*groups, value]
    same = F.col(value) == F.col(f"__k_{value}")
    for g in groups:
        same = same & (F.col(g) == F.col(f"__k_{g}"))
    return rows.join(ranks, same, "left").drop(*[f"__k_{c}" for c in keys])


def _rank_by_window(df, value, groups, ascending, method, new_col):
    order = F.col(value).asc_nulls_last() if ascending else F.col(value).desc_nulls_last()
    ordered = Window.partitionBy(*groups).orderBy(order)
    ties = F.count(F.lit(1)).over(Window.partitionBy(*groups, value))
    rank = _rank_column(method, F.rank().over(ordered) - 1, ties, F.dense_rank().over(ordered))
    known = present(df, value)
    for g in groups:
        known = known & F.col(g).isNotNull()
    return df.withColumn(new_col, F.when(known, rank.cast("double")))
