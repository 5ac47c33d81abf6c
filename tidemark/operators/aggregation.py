"""Grouped and whole-table aggregation.

All built-in aggregates combine partially before the shuffle, so a hot group
reaches the final task as one row per input partition.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.numbers import cut, cut_labels
from tidemark.operators.ordering import as_list
from tidemark.operators.quantiles import quantiles

Aggregate = "str | Callable[[Column], Column]"

# NULL and NaN are skipped by all of these; the sum of no values is 0.
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "mean": F.avg,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "nunique": F.count_distinct,
    "size": lambda c: F.count(F.lit(1)),
    "prod": lambda c: F.coalesce(F.product(c), F.lit(1.0)),
    "any": lambda c: F.coalesce(F.bool_or(c.cast("boolean")), F.lit(False)),
    "all": lambda c: F.coalesce(F.bool_and(c.cast("boolean")), F.lit(True)),
}

# Result of an aggregate over no rows, where that is not NULL.
EMPTY_RESULT = {"sum": 0, "count": 0, "nunique": 0, "size": 0, "prod": 1.0, "any": False, "all": True}


def named(column: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")


def nan_as_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with NaN read as NULL in those of ``columns`` that are floating-point; others are untouched."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.withColumns({c: F.when(~F.isnan(named(c)), named(c)) for c in columns if c in floats})


def aggregate_column(column: str, how: Aggregate) -> Column:
    if callable(how):
        return how(named(column))
    if how not in AGGREGATES:
        raise ValueError(f"unknown aggregate {how!r}; known: {sorted([*AGGREGATES, 'first', 'last', 'median'])}")
    return AGGREGATES[how](named(column))


def aggregate_name(how: Aggregate) -> str:
    return how if isinstance(how, str) else getattr(how, "__name__", "value").strip("<>")


def aggregate_plan(agg_dict: Mapping[str, Aggregate | Sequence[Aggregate]]) -> list[tuple[str, str, Aggregate]]:
    """(output name, column, aggregate): ``col`` alone, or ``col_how`` once any column has a list."""
    flat = any(isinstance(v, (list, tuple)) for v in agg_dict.values())
    plan = []
    for column, wanted in agg_dict.items():
        for how in wanted if isinstance(wanted, (list, tuple)) else [wanted]:
            plan.append((f"{column}_{aggregate_name(how)}" if flat else column, column, how))
    return plan


def _summary(
    df: DataFrame, keys: Sequence[str], plan: Sequence[tuple[str, str, Aggregate]], order_by: str | Sequence[str] | None
) -> DataFrame:
    """One row per group: aggregates that combine in one pass, and medians joined to them by group."""
    used, order = [*keys, *[column for _, column, _ in plan]], as_list(order_by)
    require_columns(df, [*used, *order])
    rows = nan_as_null(df, used).dropna(subset=list(keys)) if keys else nan_as_null(df, used)
    columns, medians = [], {}
    for name, column, how in plan:
        if how == "median":
            medians[name] = column
        elif how in ("first", "last"):
            if not order:
                raise ValueError(f"{how!r} of a table needs order_by: the columns that say which row comes first")
            # NULL values are skipped, NULL order keys come last
            place = F.struct(*[x for k in order for x in (F.col(k).isNull(), F.col(k))])
            pick = F.min_by if how == "first" else F.max_by
            columns.append(pick(named(column), F.when(named(column).isNotNull(), place)).alias(name))
        else:
            columns.append(aggregate_column(column, how).alias(name))
    names = [name for name, _, _ in plan]
    if not medians:
        return rows.groupBy(*keys).agg(*columns)
    group = [f"__g{i}" for i in range(len(keys))]
    values = {c: f"__v{i}" for i, c in enumerate(dict.fromkeys(medians.values()))}
    narrow = rows.select(*[named(k).alias(g) for k, g in zip(keys, group)], *[named(c).alias(v) for c, v in values.items()])
    found = quantiles(narrow, list(values.values()), (0.5,), group)
    wide = found.groupBy(*group).agg(*[
        F.max(F.when(F.col("column") == values[c], F.col("value"))).alias(f"__m{i}") for i, c in enumerate(medians.values())
    ])
    # one row per group on both sides; a group without values has no median
    every = rows.groupBy(*keys).agg(*(columns or [F.count(F.lit(1)).alias("__n")]))
    if keys:
        joined = every.join(wide, [named(k) == F.col(g) for k, g in zip(keys, group)], "left")
    else:
        joined = every.join(wide, F.lit(True), "left")
    renamed = {name: F.col(f"__m{i}") for i, name in enumerate(medians)}
    return joined.select(*[named(k) for k in keys], *[renamed[n].alias(n) if n in renamed else named(n) for n in names])


def groupby_summary(
    df: DataFrame,
    group_col: str | Sequence[str],
    agg_dict: Mapping[str, Aggregate | Sequence[Aggregate]],
    reset: bool = True,
    order_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Group and aggregate by a dictionary of column → aggregate or list of them.

    An aggregate is a name or a function from Column to Column (a grouped
    pandas UDF also fits). ``first`` and ``last`` take the first and last value by
    ``order_by``; ``median`` is exact in groups of any size (see ``quantiles``). Rows with
    a NULL key are left out. Keys stay ordinary columns, so ``reset`` changes nothing.
    """
    return _summary(df, as_list(group_col), aggregate_plan(agg_dict), order_by)


def named_summary(
    df: DataFrame, group_col: str | Sequence[str], order_by: str | Sequence[str] | None = None, **named: tuple[str, Aggregate]
) -> DataFrame:
    """Group with named results: ``total=("sales", "sum")``; ``order_by`` as in :func:`groupby_summary`."""
    return _summary(df, as_list(group_col), [(name, column, how) for name, (column, how) in named.items()], order_by)


def table_summary(
    df: DataFrame, agg_dict: Mapping[str, Aggregate | Sequence[Aggregate]], order_by: str | Sequence[str] | None = None
) -> DataFrame:
    """The same aggregates over the whole table, as one row."""
    return _summary(df, [], aggregate_plan(agg_dict), order_by)


def grouped_totals(
    df: DataFrame, group_col: str | Sequence[str], columns: Sequence[str], how: Aggregate = "sum"
) -> DataFrame:
    """One aggregate over several columns."""
    return groupby_summary(df, group_col, {c: how for c in columns})


def rate_of(value) -> Callable[[Column], Column]:
    """Aggregate: share of rows equal to ``value``; NULL counts as not equal."""
    return lambda column: F.avg(F.when(column == F.lit(value), 1.0).otherwise(0.0))


def compute_approval_rate(
    df: DataFrame, region_col: str | Sequence[str] = "region", approval_col: str = "approved", approval_value="yes"
) -> DataFrame:
    """Share of rows with the approval value, per group."""
    return named_summary(df, region_col, approval_rate=(approval_col, rate_of(approval_value)))


def binned_summary(
    df: DataFrame,
    column: str,
    bounds: Sequence[float],
    bin_col: str,
    **named: tuple[str, Aggregate],
) -> DataFrame:
    """Aggregate per half-open bin; bins without rows are present too."""
    labels = cut_labels(bounds)
    found = named_summary(df.withColumn(bin_col, cut(column, bounds)), bin_col, **named)
    # One row per bin: the literal list bounds this table.
    bins = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in labels])).alias(bin_col))
    empty = {name: EMPTY_RESULT[how] for name, (_, how) in named.items() if isinstance(how, str) and how in EMPTY_RESULT}
    joined = bins.join(found, bin_col, "left")
    return joined.fillna(empty) if empty else joined
