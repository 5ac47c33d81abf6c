"""Exact quantiles with linear interpolation, without sorting or gathering a group.

The built-in exact percentile keeps every distinct value of a group in one
task's map, and a sort moves every value. Here values are narrowed down instead.
One scan sketches each group and gives, around every wanted position, two values
that are sure to enclose it. A second scan counts: values between two such bounds
by themselves, all others only as how many lie in the gap between bounds. Both
scans combine before their shuffle, so a gap arrives as one row per input
partition, and about one value in ``ACCURACY`` per position arrives at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.ordering import BLOCK, CARRY, as_list, block_window, range_blocks
from tidemark.session import materialize

QUARTILES = (0.25, 0.5, 0.75)

COLUMN, ALL = "__column", "__all"
ORDER = ["value", "__gap"]
#: Rank error of the sketch: one in so many. Groups with fewer values are counted value by value.
ACCURACY = 10_000
#: Counted rows of a group that one task may hold; more are spread over range blocks.
MOST_ROWS = 65_536


def with_keys(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(groups)) if groups else df


def _long(df: DataFrame, columns: Sequence[str], groups: Sequence[str]) -> DataFrame:
    """One row per (group, column number, value); NULL groups, NULL and NaN are left out.

    The number is what gets shuffled; names are put back on the few results.
    """
    cells = [x for i, c in enumerate(columns) for x in (F.lit(i), F.col(c).cast("double"))]
    return (
        with_keys(df, groups)
        .select(*groups, F.stack(F.lit(len(columns)), *cells).alias(COLUMN, "value"))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def _named(found: DataFrame, columns: Sequence[str], groups: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in columns])
    return found.select(*groups, F.element_at(names, F.col(COLUMN) + 1).alias("column"), "probability", "value")


def quantiles(
    df: DataFrame,
    columns: str | Sequence[str],
    probabilities: Sequence[float] = QUARTILES,
    partition_by: str | Sequence[str] | None = None,
    approximate: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """Quantiles as rows (group…, column, probability, value).

    Exact by default. ``approximate=True`` takes one sketch pass instead, with
    a rank error of at most 1/accuracy.
    """
    groups, wanted = as_list(partition_by), [float(p) for p in probabilities]
    names = as_list(columns)
    cells = _long(df, names, groups)
    keys = [*groups, COLUMN]
    if approximate:
        found = cells.groupBy(*keys).agg(F.percentile_approx("value", wanted, accuracy).alias("__q"))
        return _named(found.select(*keys, F.inline(_pairs(wanted))), names, groups)

    return _named(_narrowed(cells, sketch(cells, keys, wanted), keys, wanted), names, groups)


def quantiles_and_measures(
    df: DataFrame, columns: Sequence[str], wanted: Sequence[float], measures: dict[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """Rows (column, measures…) and rows (column, probability, value); the measures, of ``value``, cost no scan."""
    names = as_list(columns)
    cells = _long(df, names, [])
    bounds = sketch(cells, [COLUMN], wanted, measures)
    label = F.element_at(F.array(*[F.lit(c) for c in names]), F.col(COLUMN) + 1).alias("column")
    return bounds.select(label, *measures), _named(_narrowed(cells, bounds, [COLUMN], wanted), names, [])


def box(df: DataFrame, column: str, groups: Sequence[str], reach: float) -> DataFrame:
    """Per group: quartiles, the last values within ``reach`` interquartile ranges of them, and the number beyond.

    Two scans: the bounds of the quartiles bound the fences too, so values near a fence are counted by themselves in
    the same scan, and every gap lies on one side of it.
    """
    keys = [*groups, COLUMN]
    cells = _long(df, [column], groups)
    bounds = sketch(cells, keys, QUARTILES, fences=reach)
    counts = _counted(cells, bounds, keys, len(QUARTILES) + 2)
    found = _positioned(counts, bounds, keys, QUARTILES)
    picks = [F.max(F.when(F.col("probability") == p, F.col("value"))).alias(n) for n, p in zip(("q1", "median", "q3"), QUARTILES)]
    boxes = found.groupBy(*keys).agg(*picks)
    far = (F.col("q3") - F.col("q1")) * reach
    low, high = F.col("q1") - far, F.col("q3") + far
    return (
        counts.join(boxes, keys).groupBy(*groups, "q1", "median", "q3")
        .agg(
            F.min(F.when((F.col("__from") >= low) & (F.col("__from") <= high), F.col("__from"))).alias("lower"),
            F.max(F.when((F.col("__to") <= high) & (F.col("__to") >= low), F.col("__to"))).alias("upper"),
            F.coalesce(F.sum(F.when((F.col("__to") < low) | (F.col("__from") > high), F.col("__n"))), F.lit(0)).alias("beyond"),
        )
    )


def sketch(
    cells: DataFrame, keys: Sequence[str], wanted: Sequence[float], measures: dict[str, Column] | None = None, fences: float | None = None
) -> DataFrame:
    """One row per group, stored: ``measures``, number of values, and bounds around each wanted position.

    The bounds are values whose ranks are four times the sketch's rank error away from the position, or the
    ends of the group. ``fences``: with ``wanted`` quartiles, bounds also around the two values that lie so many
    interquartile ranges outside them.
    """
    reach = 4 / ACCURACY
    asked = sorted({min(1.0, max(0.0, p + side)) for p in wanted for side in (-reach, reach)})
    value = F.col("value")
    found = cells.groupBy(*keys).agg(
        F.count(value).alias(ALL), F.min(value).alias("__min"), F.max(value).alias("__max"),
        F.percentile_approx(value, asked, ACCURACY).alias("__asked"), *[c.alias(n) for n, c in (measures or {}).items()],
    )
    few = F.col(ALL) <= ACCURACY

    def bound(p: float, side: float) -> Column:
        at = p + side
        end = F.col("__min") if side < 0 else F.col("__max")
        if not 0 < at < 1:
            return end
        return F.when(few, end).otherwise(F.col("__asked")[asked.index(at)])

    lows, highs = ([bound(p, side) for p in sorted(wanted)] for side in (-reach, reach))
    if fences is not None:
        least, most = F.greatest(F.lit(0.0), lows[2] - highs[0]) * fences, (highs[2] - lows[0]) * fences
        # a little wider than the arithmetic says, which rounds
        slack = (F.abs(lows[0]) + F.abs(highs[2]) + most) * 1e-9
        lows += [lows[0] - most - slack, lows[2] + least - slack]
        highs += [highs[0] - least + slack, highs[2] + most + slack]
    return materialize(found.select(*keys, ALL, F.array(*lows).alias("__lows"), F.array(*highs).alias("__highs"), *(measures or {})))


def _counted(cells: DataFrame, bounds: DataFrame, keys: Sequence[str], intervals: int) -> DataFrame:
    """Stored rows (keys, value, __gap, __n, __from, __to): values inside an interval, and gaps behind a bound."""
    value = F.col("value")
    low, high = F.col("__lows"), F.col("__highs")
    between = F.lit(False)
    passed = []
    for i in range(intervals):
        between = between | value.between(low[i], high[i])
        passed.append(F.when(value > high[i], high[i]))
    below = F.greatest(*passed, F.lit(None).cast("double"))  # the highest upper bound below the value, or NULL
    # a gap comes behind the values equal to the bound below it
    narrowed = cells.join(bounds.select(*keys, "__lows", "__highs"), list(keys)).select(
        *keys, F.when(between, value).otherwise(below).alias("value"), (~between).alias("__gap"), value.alias("__value")
    )
    return materialize(narrowed.groupBy(*keys, "value", "__gap").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__value").alias("__from"), F.max("__value").alias("__to"),
    ))


def _narrowed(cells: DataFrame, bounds: DataFrame, keys: Sequence[str], wanted: Sequence[float]) -> DataFrame:
    """Rows (keys, probability, value)."""
    return _positioned(_counted(cells, bounds, keys, len(wanted)), bounds, keys, wanted)


def _positioned(counts: DataFrame, bounds: DataFrame, keys: Sequence[str], wanted: Sequence[float]) -> DataFrame:
    """Rows (keys, probability, value) from the values between the bounds and the sizes of the gaps."""
    largest = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).agg(F.max("__rows")).first()[0]
    if (largest or 0) > MOST_ROWS:  # one task would hold too many: spread them
        return _from_blocks(range_blocks(counts, keys, ORDER), keys, wanted)
    within = Window.partitionBy(*keys).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("__through", F.sum("__n").over(within))
    targets = placed.join(bounds.select(*keys, F.col(ALL)), list(keys)).withColumn("__sought", _positions(wanted))
    return _interpolated(targets, keys, wanted)


def _pairs(wanted: Sequence[float]) -> Column:
    return F.arrays_zip(F.array(*[F.lit(p) for p in wanted]).alias("probability"), F.col("__q").alias("value"))


def _positions(wanted: Sequence[float]) -> Column:
    places = [f(_place(p)).cast("long") for p in wanted for f in (F.floor, F.ceil)]
    return F.array_distinct(F.array(*places))


def _interpolated(placed: DataFrame, keys: Sequence[str], wanted: Sequence[float]) -> DataFrame:
    """From rows with ``__n`` values up to position ``__through`` and the positions ``__sought`` to the quantiles."""
    covered = F.filter(
        "__sought",
        lambda at: (at < F.col("__through")) & (at >= F.col("__through") - F.col("__n")),
    )
    found = placed.select(*keys, "value", "__gap", ALL, F.explode(covered).alias("__at"))
    # no position lies in a gap, or the bounds were wrong
    value = F.when(~F.col("__gap"), F.col("value")).otherwise(F.raise_error(F.lit("a quantile lies outside its bounds")).cast("double"))
    # At most two positions per probability and group.
    per_group = found.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("__at", value.alias("value")))).alias("__values"),
        F.max(ALL).alias(ALL),
    )
    rows = F.explode(F.array(*[F.struct(F.lit(p).alias("probability"), _interpolate(p).alias("value")) for p in wanted]))
    return per_group.select(*keys, rows.alias("__row")).select(*keys, "__row.probability", "__row.value")


def _from_blocks(blocks: DataFrame, keys: Sequence[str], wanted: Sequence[float]) -> DataFrame:
    """Find the values at the wanted positions, opening only the blocks that hold one."""
    totals = blocks.groupBy(*keys, BLOCK).agg(F.sum("__n").alias("__block_n"))
    # Block tables: one row per block, and one more per group boundary.
    whole = Window.partitionBy(*keys)
    located = totals.select(
        *keys,
        BLOCK,
        "__block_n",
        F.coalesce(F.sum("__block_n").over(block_window(keys)), F.lit(0)).alias(CARRY),
        F.sum("__block_n").over(whole).alias(ALL),
    )
    here = F.filter(_positions(wanted), lambda at: (at >= F.col(CARRY)) & (at < F.col(CARRY) + F.col("__block_n")))
    # At most two rows per probability and group, stored, so the join is chosen by their size in bytes.
    sought = materialize(located.withColumn("__sought", here).filter(F.size("__sought") > 0).drop("__block_n"))
    within = (
        Window.partitionBy(*keys, BLOCK).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    through = F.col(CARRY) + F.sum("__n").over(within)
    return _interpolated(blocks.join(sought, [*keys, BLOCK]).withColumn("__through", through), keys, wanted)


def _place(probability: float) -> Column:
    return (F.col(ALL) - 1).cast("double") * F.lit(probability)


def _interpolate(probability: float) -> Column:
    place = _place(probability)
    low = F.element_at("__values", F.floor(place).cast("long"))
    high = F.element_at("__values", F.ceil(place).cast("long"))
    # infinity minus itself is no number
    return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place)))


def quantile_columns(
    df: DataFrame,
    columns: str | Sequence[str],
    probabilities: dict[str, float],
    partition_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Quantiles side by side: (group…, column, one column per name)."""
    groups = as_list(partition_by)
    long = quantiles(df, columns, list(probabilities.values()), groups)
    picks = [
        F.max(F.when(F.col("probability") == F.lit(float(p)), F.col("value"))).alias(name)
        for name, p in probabilities.items()
    ]
    return long.groupBy(*groups, "column").agg(*picks)
