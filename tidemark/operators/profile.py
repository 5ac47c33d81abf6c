"""Describing a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.operators.aggregation import named
from tidemark.operators.quantiles import quantiles_and_measures


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _unpivot_counts(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Turn one row of counts into rows (column, name)."""
    return df.unpivot([], list(columns), "column", name)


def load_dataset_summary(df: DataFrame, name: str = "Dataset", rows: int = 5) -> DataFrame:
    """Print row and column counts and names; return the first rows."""
    print(f"{name}: {df.count()} rows, {len(df.columns)} columns")
    print("columns:", ", ".join(df.columns))
    return df.limit(rows)


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def column_info(df: DataFrame) -> DataFrame:
    """Per column: position, type, non-NULL and NULL counts, in one scan."""
    total = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(named(c)).alias(c) for c in df.columns]
    )
    facts = F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            named(f.name).alias("non_null"),
            (F.col("__rows") - named(f.name)).alias("nulls"),
        )
        for i, f in enumerate(df.schema.fields)
    ])
    return total.select(F.inline(facts))


def missing_values(df: DataFrame) -> DataFrame:
    """Columns that have NULLs, with count and percentage."""
    nulls = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(named(c).isNull()).alias(c) for c in df.columns]
    )
    return (
        nulls.unpivot(["__rows"], df.columns, "column", "missing")
        .filter(F.col("missing") > 0)
        .select("column", "missing", (F.col("missing") / F.col("__rows") * 100).alias("missing_pct"))
    )


def count_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: how many rows repeat an earlier one."""
    keys = list(columns) if columns else df.columns
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return copies.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: count, mean, std, min, exact quartiles, max, in two scans; NULL and NaN are left out."""
    names = list(columns) if columns else numeric_columns(df)
    value = F.col("value")
    measures = {"count": F.count(value), "mean": F.avg(value), "std": F.stddev_samp(value), "min": F.min(value), "max": F.max(value)}
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    measured, found = quantiles_and_measures(df, names, list(quartiles.values()), measures)
    side_by_side = found.groupBy("column").agg(*[
        F.max(F.when(F.col("probability") == F.lit(p), F.col("value"))).alias(n) for n, p in quartiles.items()
    ])
    # columns without values are there too; one row per column on all sides
    every = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in names])).alias("column"))
    rows = every.join(measured, "column", "left").join(side_by_side, "column", "left")
    return rows.withColumn("count", F.coalesce("count", F.lit(0))).select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-NULL value, most frequent first."""
    return (
        df.select(column).dropna().groupBy(column).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
    )


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values per column.

    One scan: cells become rows (column number, 128-bit hash of the value), which combine before the shuffle, so
    what is shuffled is as long as the distinct values are many, whatever their size. ``approximate=True`` shuffles
    one sketch per column and input partition instead. Equal numbers count once (0.0 and -0.0, all NaN).
    """
    names = list(columns) if columns else df.columns
    if approximate:
        return _unpivot_counts(df.agg(*[F.approx_count_distinct(named(c)).alias(c) for c in names]), names, "distinct")
    # two hashes of 64 bits with different starts
    hashes = [F.when(named(c).isNotNull(), F.struct(F.xxhash64(named(c)).alias("h"), F.xxhash64(F.lit(1), named(c), F.lit(2)).alias("g"))) for c in names]
    cells = df.select(F.stack(F.lit(len(names)), *[x for i, h in enumerate(hashes) for x in (F.lit(i), h)]).alias("__column", "__hash"))
    values = cells.where(F.col("__hash").isNotNull()).select("__column", "__hash.h", "__hash.g").distinct()
    counts = values.groupBy("__column").agg(F.count(F.lit(1)).alias("distinct"))
    # columns without values are there too
    every = df.sparkSession.range(len(names)).select(F.col("id").cast("int").alias("__column"))
    label = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("__column") + 1)
    return every.join(counts, "__column", "left").select(label.alias("column"), F.coalesce("distinct", F.lit(0)).alias("distinct"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-NULL values."""
    return df.select(column).dropna().distinct().orderBy(column)
