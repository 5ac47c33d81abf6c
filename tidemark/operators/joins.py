"""Joins with key checks.

No join is forced to broadcast: adaptive execution picks broadcast from the
measured size, splits skewed partitions of a sort-merge join, and both stay
right when a side grows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordering import as_list
from tidemark.session import materialize

JOIN_TYPES = {"inner", "left", "right", "outer"}


def check_merge_key_overlap(df1: DataFrame, df2: DataFrame) -> list[str]:
    """Columns both tables have, sorted."""
    return sorted(set(df1.columns) & set(df2.columns))


def check_keys(df1: DataFrame, df2: DataFrame, keys: Sequence[str]) -> None:
    """Raise ``KeyError`` naming the table that lacks a key."""
    for side, df in (("left", df1), ("right", df2)):
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise KeyError(f"{missing} not found in the {side} table")


def align_keys(df1: DataFrame, df2: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The right table with its keys cast to the left table's types."""
    casts = {
        k: F.col(k).cast(df1.schema[k].dataType)
        for k in keys
        if df1.schema[k].dataType != df2.schema[k].dataType
    }
    return df2.withColumns(casts) if casts else df2


def safe_merge(
    df1: DataFrame,
    df2: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
    parse_dates: bool = False,
    verbose: bool = False,
    null_safe: bool = True,
    spread: bool = False,
) -> DataFrame:
    """Equi-join on shared keys.

    Keys must exist on both sides; right keys take the left keys' types;
    ``parse_dates`` reads keys as timestamps first; unreadable ones become
    NULL and match nothing. Other columns both sides have get the suffixes.
    NULL keys match each other unless ``null_safe=False``: n of them on the
    left and m on the right give n * m rows, so turn that off where both can
    be many. ``spread=True`` counts the keys first and deals the rows of frequent
    ones (NULL too) over many tasks, see :func:`spread_join`.
    """
    keys = as_list(on)
    check_keys(df1, df2, keys)
    if how not in JOIN_TYPES:
        raise ValueError(f"how must be one of {sorted(JOIN_TYPES)}")
    left, right = df1, align_keys(df1, df2, keys)
    if parse_dates:
        parsed = {k: F.col(k).try_cast("timestamp") for k in keys}
        unreadable = [F.col(k).isNotNull() & F.col(k).try_cast("timestamp").isNull() for k in keys]
        # a different mark on each side, compared as one more key
        left = left.withColumn("__l_bad", F.when(F.greatest(F.lit(False), *unreadable), "left")).withColumns(parsed)
        right = right.withColumn("__r_bad", F.when(F.greatest(F.lit(False), *unreadable), "right")).withColumns(parsed)

    shared = (set(left.columns) & set(right.columns)) - set(keys)
    left_names = {c: c + suffixes[0] if c in shared else c for c in left.columns}
    right_names = {c: f"__r_{c}" if c in keys else c + suffixes[1] if c in shared else c for c in right.columns}
    left, right = left.withColumnsRenamed(left_names), right.withColumnsRenamed(right_names)

    pairs = [(k, f"__r_{k}") for k in keys]
    if parse_dates:
        pairs.append(("__l_bad", "__r_bad"))
    if spread:
        joined = spread_join(left, right, pairs, how, null_safe)
    else:
        joined = left.join(right, _same(pairs, null_safe), how)
    if how in ("right", "outer"):
        joined = joined.withColumns({k: F.coalesce(F.col(k), F.col(f"__r_{k}")) for k in keys})
    if verbose:
        print(f"{how} join on {keys}: columns {[c for c in joined.columns if not c.startswith(('__r_', '__l_'))]}")
    return joined.drop("__l_bad", "__r_bad", *[f"__r_{k}" for k in keys])


def _same(pairs: Sequence[tuple[str, str]], null_safe: bool) -> Column:
    same = F.lit(True)
    for l, r in pairs:
        # marks of unreadable dates are NULL on all other rows
        same = same & (F.col(l).eqNullSafe(F.col(r)) if null_safe or l.startswith("__l_") else F.col(l) == F.col(r))
    return same


#: Pieces of a task's fair share that a frequent key's rows are dealt in, so that pieces even out over tasks.
PIECES = 8


def spread_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str, null_safe: bool = True) -> DataFrame:
    """Equi-join on ``pairs`` of columns in which no key's rows meet in one task.

    A key is frequent if it holds more rows of either side than a shuffle partition's fair share; there can be no
    more than twice as many of these as shuffle partitions, so their table is small. All other rows are joined as
    usual. Frequent keys that one side lacks need no join. Rows of the others are dealt at random into pieces, each
    piece of the left side meets each of the right side in one cell, and the cells are what is shuffled. The
    pieces are written once, so that a task that runs again deals the same ones.
    """
    spark = left.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"__k{i}" for i in range(len(pairs))]
    own = {"left": [l for l, _ in pairs], "right": [r for _, r in pairs]}
    sides = {"left": left, "right": right}
    apart: list[DataFrame] = []
    if not null_safe:  # NULL keys match nothing, so they needn't meet in one task either
        for side in sides:
            lacking = F.lit(False)
            for c in own[side]:
                lacking = lacking | (F.lit(False) if c.startswith(("__l_", "__r_bad")) else F.col(c).isNull())
            if how in (side, "outer"):
                apart.append(sides[side].where(lacking))
            sides[side] = sides[side].where(~lacking)

    def keys_of(side: str) -> DataFrame:
        return sides[side].select(*[F.col(c).alias(n) for c, n in zip(own[side], names)])

    def equal(a: Sequence[str], b: Sequence[str]) -> Column:
        same = F.lit(True)
        for x, y in zip(a, b):
            same = same & F.col(x).eqNullSafe(F.col(y))
        return same

    fair = {side: F.lit(max(1, sides[side].count()) / partitions) for side in sides}
    often = [keys_of(s).groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > fair[s]).select(*names) for s in sides]
    frequent = materialize(often[0].union(often[1]).distinct())
    counts = frequent
    for side in sides:
        seen = [f"__{side}{i}" for i in range(len(names))]
        # at most two rows per shuffle partition
        found = keys_of(side).toDF(*seen).join(F.broadcast(frequent), equal(seen, names), "inner").groupBy(*names).agg(F.count(F.lit(1)).alias(f"__n_{side}"))
        again = [f"__{n}" for n in names]
        counts = counts.join(found.toDF(*again, f"__n_{side}"), equal(names, again), "left").drop(*again)
    rows = {s: F.coalesce(f"__n_{s}", F.lit(0)) for s in sides}
    # no more pieces than rows: the other side is copied once for each, and its rows meet as many anyway
    pieces = {s: F.least(rows[s], F.ceil(PIECES * rows[s] / fair[s])).cast("int") for s in sides}
    keyed = materialize(counts.select(*names, F.xxhash64(*names).alias("__id"), pieces["left"].alias("__left"), pieces["right"].alias("__right")))

    marked = {s: sides[s].join(F.broadcast(keyed), equal(own[s], names), "left").drop(*names) for s in sides}
    usual = {s: marked[s].where(F.col("__id").isNull()).drop("__id", "__left", "__right") for s in sides}
    out = usual["left"].join(usual["right"], _same(pairs, null_safe), how)
    for rows in apart:
        out = out.unionByName(rows, allowMissingColumns=True)
    dealt = {}
    for side, other in (("left", "right"), ("right", "left")):
        rows = marked[side].where(F.col("__id").isNotNull())
        if how in (side, "outer"):
            out = out.unionByName(rows.where(F.col(f"__{other}") == 0).drop("__id", "__left", "__right"), allowMissingColumns=True)
        piece = F.floor(F.rand(17) * F.col(f"__{side}")).cast("int").alias(f"__at_{side}")
        rows = rows.where((F.col("__left") > 0) & (F.col("__right") > 0))
        rows = materialize(rows.select(*sides[side].columns, "__id", f"__{other}", piece))
        each = F.explode(F.sequence(F.lit(0), F.col(f"__{other}") - 1)).alias(f"__at_{other}")
        dealt[side] = rows.select(*sides[side].columns, F.col("__id").alias(f"__id_{side}"), F.col(f"__at_{side}").alias(f"__{side}_{side}"), each)
        dealt[side] = dealt[side].withColumnRenamed(f"__at_{other}", f"__{side}_{other}")
    cell = F.col("__id_left") == F.col("__id_right")
    for side in sides:
        cell = cell & (F.col(f"__left_{side}") == F.col(f"__right_{side}"))
    # equal hashes of different keys are told apart by the keys themselves
    met = dealt["left"].join(dealt["right"], cell & _same(pairs, null_safe)).select(*left.columns, *right.columns)
    return out.unionByName(met)


def join_on_index(df1: DataFrame, df2: DataFrame, key: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join by key as an index; overlapping other columns are refused.

    Tables stored with ``store_bucketed`` on the key, in as many buckets, join where they lie: no shuffle.
    """
    keys = as_list(key)
    shared = set(check_merge_key_overlap(df1, df2)) - set(keys)
    if shared:
        raise ValueError(f"columns overlap: {sorted(shared)}")
    check_keys(df1, df2, keys)
    return df1.join(df2, keys, how)
