"""Rolling, cumulative, growth and fill windows.

``small_groups=True`` is the caller's promise that every group fits one task:
true for calendar series, which hold at most one row per period. Then a plain
Spark window is the best plan. Without the promise the same columns are
computed over range blocks or tiles (see ``ordering``), so neither a missing
partition key nor a hot one gathers a large group in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemark.operators.ordering import (
    TILE_ROWS, as_list, carry_forward, filled_and_previous, nulls_last, over_tiles, own_rows, running_total,
)
from tidemark.session import materialize


def _add(df, order_by, partition_by, reach, build, small_groups, tile_rows=TILE_ROWS):
    if small_groups:
        window = Window.partitionBy(*partition_by).orderBy(*nulls_last(order_by))
        return df.withColumns(build(window))
    return over_tiles(df, nulls_last(order_by), partition_by, reach, build, tile_rows)


def rolling_mean(
    df: DataFrame,
    value: str,
    window: int,
    order_by: str | Sequence,
    partition_by: str | Sequence[str] | None = None,
    min_periods: int | None = None,
    new_col: str | None = None,
    small_groups: bool = False,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Mean of the last ``window`` rows; NULL until ``min_periods`` values are present.

    ``min_periods`` defaults to the full window and counts non-NULL values. ``tile_rows``: rows per tile.
    """
    needed = window if min_periods is None else min_periods

    def build(w: WindowSpec) -> dict[str, Column]:
        frame = w.rowsBetween(-(window - 1), Window.currentRow)
        mean = F.avg(value).over(frame)
        return {new_col or f"rolling_{value}": F.when(F.count(value).over(frame) >= needed, mean)}

    return _add(df, as_list(order_by), as_list(partition_by), window - 1, build, small_groups, tile_rows)


def cumulative_sum(
    df: DataFrame,
    value: str,
    order_by: str | Sequence,
    partition_by: str | Sequence[str] | None = None,
    new_col: str | None = None,
    small_groups: bool = False,
) -> DataFrame:
    """Running sum; a NULL value adds nothing and stays NULL itself."""
    order, groups, name = as_list(order_by), as_list(partition_by), new_col or f"cum_{value}"
    if small_groups:
        frame = (
            Window.partitionBy(*groups)
            .orderBy(*nulls_last(order))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        summed = df.withColumn(name, F.sum(value).over(frame))
    else:
        summed = running_total(df, value, nulls_last(order), groups, name)
    return summed.withColumn(name, F.when(F.col(value).isNotNull(), F.col(name)))


def forward_fill(
    df: DataFrame,
    value: str,
    order_by: str | Sequence[str],
    partition_by: str | Sequence[str] | None = None,
    new_col: str | None = None,
    small_groups: bool = False,
) -> DataFrame:
    """Replace NULL by the last earlier value of the group."""
    order, groups = as_list(order_by), as_list(partition_by)
    if not small_groups:
        return carry_forward(df, value, order, groups, new_col)
    frame = (
        Window.partitionBy(*groups)
        .orderBy(*nulls_last(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(new_col or value, F.last(value, ignorenulls=True).over(frame))


def pct_change(
    df: DataFrame,
    value: str,
    order_by: str | Sequence[str],
    partition_by: str | Sequence[str] | None = None,
    new_col: str | None = None,
    small_groups: bool = False,
) -> DataFrame:
    """Growth against the row before, after filling gaps forward; 0.2 means 20 percent."""
    order, groups, name = as_list(order_by), as_list(partition_by), new_col or f"{value}_pct_change"
    if not small_groups:
        rows, filled, previous = filled_and_previous(df, value, order, groups)
        return own_rows(rows.withColumn(name, F.try_divide(filled.cast("double"), previous.cast("double")) - 1))
    filled = forward_fill(df, value, order, groups, "__pct_base", small_groups)
    window, base = Window.partitionBy(*groups).orderBy(*nulls_last(order)), F.col("__pct_base").cast("double")
    return filled.withColumn(name, F.try_divide(base, F.lag(base).over(window)) - 1).drop("__pct_base")


def rolling_apply(
    df: DataFrame,
    value: str,
    window: int,
    func: Callable[[Column], Column],
    order_by: str | Sequence,
    partition_by: str | Sequence[str] | None = None,
    min_periods: int | None = None,
    new_col: str | None = None,
    small_groups: bool = False,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Any function of the last ``window`` values.

    ``func`` gets the values of the trailing frame as an array column, oldest first and without NULL, and returns a
    column made with Spark's array functions, so it runs in the JVM: a trimmed mean, a weighted sum, a range.
    NULL until ``min_periods`` values (by default the full window) are present. Groups of any size are cut into
    tiles of ``tile_rows`` rows; the last rows of a tile lead in the next one. A total order gives one result.
    """
    needed = window if min_periods is None else min_periods

    def build(w: WindowSpec) -> dict[str, Column]:
        recent = F.collect_list(value).over(w.rowsBetween(-(window - 1), Window.currentRow))
        return {"__recent": recent}

    rows = _add(df, as_list(order_by), as_list(partition_by), window - 1, build, small_groups, tile_rows)
    recent = F.col("__recent")
    return rows.withColumn(new_col or f"rolling_{value}", F.when(F.size(recent) >= needed, func(recent))).drop("__recent")


def grouped_transform(
    df: DataFrame,
    group_cols: str | Sequence[str],
    new_col: str,
    state: Mapping[str, Column],
    row: Callable[[Mapping[str, Column]], Column],
) -> DataFrame:
    """Add a column that depends on a row and on aggregates of its group, for groups of any size.

    A user transform split in two: ``state`` names aggregates of the group (``{"mean": F.avg("x")}``), which combine
    before their shuffle, and ``row`` gets them as columns and returns the new column of a row. NULL groups are groups.
    States are stored, as every row of a group must see the same. Rows of groups beyond a task's fair share stay
    where they are and meet the states of these groups, fewer than shuffle partitions, as a broadcast; only the rows
    of other groups may be shuffled.
    """
    groups = as_list(group_cols)
    names = {name: f"__state_{name}" for name in state}
    keys = [f"__r_{i}" for i in range(len(groups))]
    counted = df.groupBy(*groups).agg(*[c.alias(names[n]) for n, c in state.items()], F.count(F.lit(1)).alias("__rows"))
    states = materialize(counted.withColumnsRenamed(dict(zip(groups, keys))))
    fair = F.lit((states.agg(F.sum("__rows")).first()[0] or 0) / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    large, small = (states.where(c).drop("__rows") for c in (F.col("__rows") > fair, F.col("__rows") <= fair))
    same = F.lit(True)
    for group, key in zip(groups, keys):
        same = same & F.col(group).eqNullSafe(F.col(key))
    if large.isEmpty():
        joined = df.join(small, same, "left")
    elif small.isEmpty():
        joined = df.join(F.broadcast(large), same, "left")
    else:
        rest = df.join(F.broadcast(large.select(*keys)), same, "left_anti").join(small, same, "left")
        joined = df.join(F.broadcast(large), same).unionByName(rest)
    return joined.withColumn(new_col, row({n: F.col(c) for n, c in names.items()})).drop(*keys, *names.values())


def rolling_rank(
    df: DataFrame,
    group_col: str | Sequence[str],
    value_col: str,
    window: int,
    ascending: bool = False,
    rank_method: str = "average",
    order_col: str | Sequence[str] = "order_date",
    small_groups: bool = False,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Rank of each value among the last ``window`` rows of its group.

    The frame holds at most ``window`` values per row. ``order_col`` should be
    a total order within the group.
    """
    name = f"rolling_rank_{value_col}"
    value = F.col(value_col)

    def build(w: WindowSpec) -> dict[str, Column]:
        # collect_list leaves NULLs out, as ranking does.
        recent = F.collect_list(value_col).over(w.rowsBetween(-(window - 1), Window.currentRow))
        better = F.filter(recent, lambda x: (x < value) if ascending else (x > value))
        equal = F.size(F.filter(recent, lambda x: x == value))
        ahead = F.size(better)
        ranks = {
            "average": 1 + ahead + (equal - 1) / F.lit(2.0),
            "min": 1 + ahead,
            "max": ahead + equal,
            "first": ahead + equal,  # the current row is the latest of its ties
            "dense": 1 + F.size(F.array_distinct(better)),
        }
        if rank_method not in ranks:
            raise ValueError(f"unknown rank method {rank_method!r}")
        return {name: F.when(value.isNotNull(), ranks[rank_method].cast("double"))}

    return _add(df, as_list(order_col), as_list(group_col), window - 1, build, small_groups, tile_rows)


def grouped_eval(
    df: DataFrame,
    group_cols: str | Sequence[str],
    target_col: str,
    new_col: str,
    func: Callable[[Column, WindowSpec], Column],
    order_by: str | Sequence | None = None,
) -> DataFrame:
    """Add a user-defined window column, one value per input row.

    ``func`` gets the target column and the group's ordered window and returns
    a column, so the work stays in Spark. Nested windows take two calls. It is
    meant for groups of bounded size (calendar series); for large groups use
    :func:`grouped_transform`, the other operators of this module and those of ``ranking``.
    """
    window = Window.partitionBy(*as_list(group_cols))
    if order_by is not None:
        window = window.orderBy(*nulls_last(as_list(order_by)))
    return df.withColumn(new_col, func(F.col(target_col), window))


def growth(column: Column, window: WindowSpec) -> Column:
    """Growth against the previous row, for ``grouped_eval`` on gap-free values."""
    base = column.cast("double")
    return F.try_divide(base, F.lag(base).over(window)) - 1
