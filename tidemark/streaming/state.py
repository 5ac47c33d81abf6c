"""Grouped totals that grow with new files, without reading old rows again.

A run takes in the files that arrived since the last one, reduces their rows to one
state row per group (counts, sums, extremes, means and squared deviations) and merges
it with the stored state, which is then a new version. Rows and state are tied
together by the number of the run: the file sink writes the rows of run n once, by
its own log, as a partition, and they belong to version n of the state only. A run that
is cut off anywhere is done again under its number, so each row counts exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.aggregation import aggregate_plan, named, nan_as_null, require_columns
from tidemark.operators.ordering import as_list
from tidemark.session import completed_versions, delete_path
from tidemark.streaming.ingest import ingest_files

RUN = "__run"

# What the state of an aggregate is made of.
PARTS = {
    "sum": ("sum",), "count": ("count",), "size": ("size",), "mean": ("count", "mean"), "min": ("min",), "max": ("max",),
    "var": ("count", "mean", "m2"), "std": ("count", "mean", "m2"), "prod": ("prod",), "any": ("any",), "all": ("all",),
}

REDUCE: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum, "count": F.count, "size": lambda c: F.count(F.lit(1)), "min": F.min, "max": F.max, "mean": F.avg,
    "m2": lambda c: F.var_pop(c) * F.count(c), "prod": F.product,
    "any": lambda c: F.bool_or(c.cast("boolean")), "all": lambda c: F.bool_and(c.cast("boolean")),
}


def _merge(part: str, old: Callable[[str], Column], new: Callable[[str], Column]) -> Column:
    """One part of two states of the same column; a side without values is NULL."""
    a, b = old(part), new(part)
    both: Column
    if part in ("sum", "count", "size"):
        both = a + b
    elif part == "prod":
        both = a * b
    elif part == "min":
        return F.least(a, b)  # skips NULL
    elif part == "max":
        return F.greatest(a, b)
    elif part == "any":
        both = a | b
    elif part == "all":
        both = a & b
    else:
        n_a, n_b = old("count"), new("count")
        step = new("mean") - old("mean")
        n = n_a + n_b
        if part == "mean":
            both = old("mean") + step * n_b / n
        else:
            both = a + b + step * step * n_a * n_b / n
    return F.coalesce(both, a, b)


def _final(how: str, part: Callable[[str], Column]) -> Column:
    if how == "mean":
        return part("mean")
    if how in ("var", "std"):
        found = F.when(part("count") > 1, part("m2") / (part("count") - 1))
        return F.sqrt(found) if how == "std" else found
    empty = {"sum": 0, "count": 0, "size": 0, "prod": 1.0, "any": False, "all": True}
    return F.coalesce(part(how), F.lit(empty[how])) if how in empty else part(how)


class GroupState:
    """Reduces, merges and finishes the state of ``agg_dict`` per group."""

    def __init__(self, group_col: str | Sequence[str], agg_dict: Mapping):
        self.keys, self.plan = as_list(group_col), aggregate_plan(agg_dict)
        unknown = sorted({str(how) for _, _, how in self.plan if how not in PARTS})
        if unknown:
            raise ValueError(f"{unknown} can't be merged from partial states; known: {sorted(PARTS)}")
        self.columns = list(dict.fromkeys(column for _, column, _ in self.plan))
        wanted = {(self.columns.index(column), part) for _, column, how in self.plan for part in PARTS[how]}
        self.parts = sorted(wanted)

    def reduce(self, df: DataFrame) -> DataFrame:
        """State of the rows of ``df``, as columns ``k<i>`` and ``s<column>_<part>``; NULL keys are left out."""
        used = [*self.keys, *self.columns]
        require_columns(df, used)
        rows = nan_as_null(df, used).dropna(subset=self.keys)
        rows = rows.select(*[named(k).alias(f"k{i}") for i, k in enumerate(self.keys)], *[named(c).alias(f"v{i}") for i, c in enumerate(self.columns)])
        return rows.groupBy(*self._state_keys()).agg(*[REDUCE[part](F.col(f"v{i}")).alias(f"s{i}_{part}") for i, part in self.parts])

    def merge(self, old: DataFrame, new: DataFrame) -> DataFrame:
        keys = self._state_keys()
        kinds = dict(new.dtypes)
        a, b = old.alias("a"), new.alias("b")
        same = F.lit(True)
        for k in keys:
            same = same & (F.col(f"a.{k}") == F.col(f"b.{k}"))

        def side(name: str, i: int) -> Callable[[str], Column]:
            return lambda part: F.col(f"{name}.s{i}_{part}")

        return a.join(b, same, "full").select(
            *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys],
            *[_merge(part, side("a", i), side("b", i)).cast(kinds[f"s{i}_{part}"]).alias(f"s{i}_{part}") for i, part in self.parts],
        )

    def finish(self, state: DataFrame) -> DataFrame:
        def part_of(column: str) -> Callable[[str], Column]:
            return lambda part: F.col(f"s{self.columns.index(column)}_{part}")

        return state.select(
            *[F.col(f"k{i}").alias(k) for i, k in enumerate(self.keys)],
            *[_final(how, part_of(column)).alias(name) for name, column, how in self.plan],
        )

    def _state_keys(self) -> list[str]:
        return [f"k{i}" for i in range(len(self.keys))]


def summarize_new_files(
    stream: DataFrame,
    folder: str,
    group_col: str | Sequence[str],
    agg_dict: Mapping,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Take in the files that are new to ``folder`` and return the totals of all files taken in so far.

    ``folder`` holds the progress of the stream, the rows, a partition for each run, and the states after
    it (``state/<run>``); one run at a time may work on it. The work is that of the new rows and of one row per
    group. Aggregates that need all values at once (``nunique``, functions) are refused. Until files have
    arrived the table is empty.
    """
    spark, state = stream.sparkSession, GroupState(group_col, agg_dict)
    versions = completed_versions(spark, f"{folder}/state")
    last = versions[-1] if versions else 0
    run = last + 1
    rows = ingest_files(stream, f"{folder}/rows", f"{folder}/progress", lambda df: transform(df).withColumn(RUN, F.lit(run)), RUN)
    new = state.reduce(rows.where(F.col(RUN) == run))
    kept = f"{folder}/state/{{}}"
    if last:
        new = state.merge(spark.read.schema(new.schema).parquet(kept.format(last)), new)
    new.write.mode("overwrite").parquet(kept.format(run))
    # a reader may still be at the last version
    for version in versions[:-1]:
        delete_path(spark, kept.format(version))
    return state.finish(spark.read.schema(new.schema).parquet(kept.format(run)))
