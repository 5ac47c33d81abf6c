"""Sorting, first and last rows, top-k, positional slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

from tidemark.operators.ordering import POSITION, as_list, row_positions


def _directions(ascending: bool | Sequence[bool], n: int) -> list[bool]:
    return [ascending] * n if isinstance(ascending, bool) else list(ascending)


def sort_keys(by: str | Sequence[str], ascending: bool | Sequence[bool] = True) -> list[Column]:
    """Sort columns with NULLs last in both directions."""
    names = as_list(by)
    return [
        F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last()
        for c, up in zip(names, _directions(ascending, len(names)), strict=True)
    ]


def sort_values(df: DataFrame, by: str | Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    """Global sort, NULLs last."""
    return df.orderBy(*sort_keys(by, ascending))


def head(df: DataFrame, n: int, by: str | Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    """First ``n`` rows in the given order; each task keeps only its own best ``n``."""
    return df.orderBy(*sort_keys(by, ascending)).limit(n)


def tail(df: DataFrame, n: int, by: str | Sequence[str], ascending: bool | Sequence[bool] = True) -> DataFrame:
    """Last ``n`` rows in the given order, in that order."""
    names = as_list(by)
    ups = _directions(ascending, len(names))
    reverse = [
        F.col(c).desc_nulls_first() if up else F.col(c).asc_nulls_first() for c, up in zip(names, ups, strict=True)
    ]
    return df.orderBy(*reverse).limit(n).orderBy(*sort_keys(names, ups))


def nlargest(df: DataFrame, n: int, column: str, tie_keys: str | Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the largest values; tie keys decide among equals."""
    return df.filter(F.col(column).isNotNull()).orderBy(F.col(column).desc(), *sort_keys(tie_keys)).limit(n)


def top_groups_detail(
    df: DataFrame, group_col: str, value_col: str, n: int
) -> DataFrame:
    """All rows of the ``n`` groups with the largest sums; the semi join side has ``n`` rows."""
    totals = df.dropna(subset=[group_col]).groupBy(group_col).agg(F.sum(value_col).alias("__total"))
    best = nlargest(totals, n, "__total", group_col).select(group_col)
    return df.join(best, group_col, "left_semi")


def slice_rows(
    df: DataFrame, start: int, stop: int, order_by: str | Sequence[str], columns: Sequence[str] | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Rows ``start:stop`` by position in the given order, and a column subset.

    ``inclusive=True`` keeps the end row, as label slices do. Only rows near the slice are sorted: splitters from
    a sample of the keys cut the order into blocks, one scan counts their rows, and the blocks that hold the slice
    are cut again until little else is left. Rows before them count only by their number.
    """
    end = stop + 1 if inclusive else stop
    kept = list(columns or df.columns)
    keys = as_list(order_by)
    narrow = df.select(*dict.fromkeys([*kept, *keys]))
    ahead, rows, left = 0, narrow, narrow.count()
    start, end = max(0, start), min(max(0, end), left)
    if start >= end:
        return narrow.limit(0).select(*kept)
    while left > max(LITTLE, 2 * (end - start)):
        block = _block_number(_splitters(rows, keys, left), keys)
        sizes = sorted(rows.groupBy(block.alias("__block")).agg(F.count(F.lit(1)).alias("__n")).collect())
        through, first, last, passed = ahead, None, None, ahead
        for number, n in sizes:
            if through + n > start and first is None:
                first, passed = number, through
            if through < end:
                last = number
            through += n
        inside = sum(n for number, n in sizes if first <= number <= last)
        if inside > 0.7 * left:  # many equal keys, or a slice across most blocks
            break
        rows, left, ahead = rows.filter(block.between(first, last)), inside, passed
    placed = row_positions(rows, sort_keys(keys)).withColumn(POSITION, F.col(POSITION) + ahead)
    return placed.filter((F.col(POSITION) >= start) & (F.col(POSITION) < end)).select(*kept)


#: Rows that are sorted without being cut down first, blocks of a cut, and sampled keys per splitter.
LITTLE, BLOCKS, SAMPLED = 100_000, 64, 50


def _splitters(rows: DataFrame, keys: Sequence[str], n: int) -> list[Row]:
    """At most ``BLOCKS`` - 1 distinct keys that cut the rows into blocks of about one size, in order."""
    share = min(1.0, BLOCKS * SAMPLED / n)
    sample = rows.select(*keys).sample(share, seed=23).orderBy(*sort_keys(keys)).collect()  # a fixed number, about
    picks = [sample[i * len(sample) // BLOCKS] for i in range(1, BLOCKS)] if sample else []
    return list(dict.fromkeys(picks))


def _block_number(splitters: Sequence[Row], keys: Sequence[str]) -> Column:
    """How many splitters come before or with a row, found by halving; NULL comes last, NaN before it."""
    def reached(splitter: Row) -> Column:
        found = F.lit(True)  # equal keys
        for key, value in reversed(list(zip(keys, splitter))):
            c = F.col(key)
            if value is None:
                found = c.isNull() & found
            else:
                found = c.isNull() | (c > F.lit(value)) | ((c == F.lit(value)) & found)
        return F.coalesce(found, F.lit(False))

    def number(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(reached(splitters[middle]), number(middle + 1, high)).otherwise(number(low, middle))

    return number(0, len(splitters))
