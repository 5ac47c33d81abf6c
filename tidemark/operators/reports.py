"""Result tables behind charts and styled reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.numbers import currency
from tidemark.operators.aggregation import nan_as_null, require_columns
from tidemark.operators.filters import FENCE
from tidemark.operators.ordering import as_list
from tidemark.operators.profile import numeric_columns, value_counts
from tidemark.operators.quantiles import box
from tidemark.session import materialize


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts per equal-width bin between minimum and maximum; NULL and NaN are left out, empty bins are not.

    The driver sees the two ends only.
    """
    require_columns(df, [column])
    df = nan_as_null(df, [column])
    value = F.col(column).cast("double")
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None:
        return df.select(F.lit(0).cast("long").alias("bin"), F.lit(0.0).alias("bin_start"), F.lit(0).cast("long").alias("count")).limit(0)
    width = (high - low) / bins or 1.0
    number = F.least(F.floor((value - low) / width), F.lit(bins - 1))
    counts = df.filter(value.isNotNull()).groupBy(number.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"), F.coalesce("count", F.lit(0)).alias("count")
    )


def box_stats(df: DataFrame, value: str, by: str | Sequence[str]) -> DataFrame:
    """Per group: quartiles, whiskers (last values inside the fences) and outlier count; NULL and NaN are left out."""
    found = box(df, value, as_list(by), FENCE)
    return found.withColumnsRenamed({"lower": "lower_whisker", "upper": "upper_whisker", "beyond": "outliers"})


def totals_by_each(df: DataFrame, totals: dict[str, tuple[str, str]]) -> DataFrame:
    """Sums of several panels from one scan, as rows (panel, name, amount).

    ``totals``: panel → (group column, summed column). Rows are grouped by each of the group columns at a time;
    NULL groups are left out.
    """
    groups = list(dict.fromkeys(group for group, _ in totals.values()))
    sums = {c: F.coalesce(F.sum(c), F.lit(0)).alias(f"__{c}") for _, c in totals.values()}
    by_each = df.groupingSets([[g] for g in groups], *groups).agg(F.grouping_id().alias("__id"), *sums.values())
    alone = {g: (1 << len(groups)) - 1 - (1 << (len(groups) - 1 - i)) for i, g in enumerate(groups)}
    panels = F.array(*[
        F.when(F.col("__id") == alone[g], F.struct(F.lit(panel).alias("panel"), F.col(g).cast("string").alias("name"), F.col(f"__{c}").alias("amount")))
        for panel, (g, c) in totals.items()
    ])
    return by_each.select(F.explode(F.array_compact(panels)).alias("__row")).select("__row.*").where(F.col("name").isNotNull())


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of each non-NULL value.

    The total is a scalar subquery over the same counts, whose shuffle Spark reuses.
    """
    counts = value_counts(df, column)
    total = counts.agg(F.sum("count"))
    return counts.withColumn("percent", F.col("count") / total.scalar() * 100)


def highlight_max(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add ``is_max_<column>`` flags to a report.

    The report is computed once and kept: a float sum computed a second time
    may differ in its last digit and miss its own maximum. The maxima are one
    row, read as a scalar subquery.
    """
    names = list(columns) if columns else df.columns
    rows = materialize(df)
    best = rows.agg(*[F.max(c).alias(c) for c in names]).select(F.struct(*names)).scalar()
    return rows.withColumns({
        f"is_max_{c}": F.coalesce(F.col(c) == best.getField(c), F.lit(False)) for c in names
    })


def gradient(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add ``<column>_intensity``: place between minimum (0) and maximum (1).

    Both ends of all columns come from one scalar subquery. Materialise ``df``
    first where it is expensive: it is read twice.
    """
    names = list(columns) if columns else numeric_columns(df)
    clean = nan_as_null(df, names)
    ends = [f(c).cast("double").alias(f"{c}_{n}") for c in names for n, f in (("low", F.min), ("high", F.max))]
    found = clean.agg(F.struct(*ends)).scalar()

    def intensity(c: str):
        low, high = found.getField(f"{c}_low"), found.getField(f"{c}_high")
        return F.try_divide(F.col(c).cast("double") - low, high - low)

    return df.withColumns({f"{c}_intensity": F.nanvl(intensity(c), F.lit(None)) for c in names})


def format_money(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Replace number columns by ``$1,234.50`` text."""
    require_columns(df, columns)
    return df.withColumns({c: currency(c, digits) for c in columns})
