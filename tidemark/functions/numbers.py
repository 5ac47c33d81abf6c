"""Numeric column builders: parsing, binning, mapping, ratios, display text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_number(column: Column | str) -> Column:
    """Double, or NULL where the value is no number."""
    return _col(column).try_cast("double")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating-point column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df


def absolute(column: Column | str) -> Column:
    return F.abs(_col(column))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives NULL on a zero denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent(part: Column | str, whole: Column | str) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def loan_to_income(loan: Column | str, income: Column | str) -> Column:
    return ratio(loan, income)


def case_rate(cases: Column | str, population: Column | str) -> Column:
    """Cases per 100,000 people."""
    return ratio(cases, population) * F.lit(100_000.0)


def death_rate(deaths: Column | str, cases: Column | str) -> Column:
    """Deaths in percent of cases."""
    return percent(deaths, cases)


def map_values(column: Column | str, mapping: Mapping) -> Column:
    """Look a value up in a dictionary; unmatched and NULL keys give NULL."""
    pairs = [F.lit(x) for x in chain.from_iterable(mapping.items())]
    return F.try_element_at(F.create_map(*pairs), _col(column))


def cut_labels(bounds: Sequence[float]) -> list[str]:
    """Interval names ``[lo, hi)`` for consecutive bounds."""
    return [f"[{lo}, {hi})" for lo, hi in zip(bounds, bounds[1:])]


def cut(column: Column | str, bounds: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Name of the half-open bin ``[lo, hi)`` holding the value, else NULL."""
    if any(lo >= hi for lo, hi in zip(bounds, bounds[1:])):
        raise ValueError("bin bounds must increase")
    names = list(labels) if labels is not None else cut_labels(bounds)
    if len(names) != len(bounds) - 1:
        raise ValueError("need one label per bin")
    value = _col(column)
    # Bounds rise, so the first bound above the value decides the bin.
    binned = F.when(value < bounds[0], F.lit(None).cast("string"))
    for upper_bound, name in zip(bounds[1:], names):
        binned = binned.when(value < upper_bound, F.lit(name))
    return binned


def when_update(column: str, condition: Column, value) -> Column:
    """The column with ``value`` where the condition holds."""
    new = value if isinstance(value, Column) else F.lit(value)
    return F.when(condition, new).otherwise(F.col(column))


def thousands(column: Column | str, digits: int = 0) -> Column:
    """``1,234,567`` with a fixed number of decimals."""
    return F.format_number(_col(column), digits)


def currency(column: Column | str, digits: int = 2, symbol: str = "$") -> Column:
    """``$1,234.50``; the sign follows the symbol."""
    return F.concat(F.lit(symbol), F.format_number(_col(column), digits))
