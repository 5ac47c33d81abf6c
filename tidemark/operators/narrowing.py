"""Narrower column types."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

# Bounds of the integer types, and how far a float may move
# when stored in single precision.
INTEGER_TYPES = [
    (T.ByteType(), -(2**7), 2**7 - 1),
    (T.ShortType(), -(2**15), 2**15 - 1),
    (T.IntegerType(), -(2**31), 2**31 - 1),
]
FLOAT_TOLERANCE = 5e-4


def narrow_types(df: DataFrame) -> dict[str, T.DataType]:
    """Smallest type holding every value of each numeric column, from one aggregate row."""
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ShortType, T.IntegerType, T.LongType))]
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    checks = []
    for i, c in enumerate(whole):
        checks += [F.min(c).alias(f"min_{i}"), F.max(c).alias(f"max_{i}")]
    for i, c in enumerate(floats):
        # A non-finite difference means overflow, unless the value itself is not finite.
        single = F.col(c).cast("float").cast("double")
        moved = F.when(F.isnan(c) | (single == F.col(c)), 0.0).otherwise(F.abs(single - F.col(c)))
        checks.append(F.max(moved).alias(f"moved_{i}"))
    if not checks:
        return {}
    row = df.agg(*checks).first()
    found: dict[str, T.DataType] = {}
    for i, c in enumerate(whole):
        low, high = row[f"min_{i}"], row[f"max_{i}"]
        if low is None:
            continue
        width = df.schema[c].dataType
        for kind, lower_bound, upper_bound in INTEGER_TYPES:
            if kind == width:
                break
            if lower_bound <= low and high <= upper_bound:
                found[c] = kind
                break
    for i, c in enumerate(floats):
        moved = row[f"moved_{i}"]
        if moved is not None and moved <= FLOAT_TOLERANCE:
            found[c] = T.FloatType()
    return found


def optimize_dataframe(
    df: DataFrame, category_cols: Sequence[str] | None = None, verbose: bool = True
) -> DataFrame:
    """Cast numeric columns to the smallest type that keeps their values.

    Category columns stay strings, since Parquet dictionary-encodes them;
    names the table lacks are reported.
    """
    missing = [c for c in category_cols or [] if c not in df.columns]
    if missing:
        warnings.warn(f"category columns not found: {missing}", stacklevel=2)
    found = narrow_types(df)
    if verbose:
        for c, kind in found.items():
            print(f"{c}: {df.schema[c].dataType.simpleString()} -> {kind.simpleString()}")
    return df.withColumns({c: F.col(c).cast(kind) for c, kind in found.items()}) if found else df


def schema_table(df: DataFrame) -> DataFrame:
    """Columns and types as rows, at most one per column."""
    pairs = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"))
        for f in df.schema.fields
    ])
    return df.sparkSession.range(1).select(F.inline(pairs))
