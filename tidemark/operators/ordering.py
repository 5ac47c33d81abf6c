"""Ordered work without one-task windows.

A window with no partition key, or with one hot key, sends all its rows to one
task. The operators here split the order itself: rows are range-partitioned by
(group, order key) into blocks, each block is summarised, and the few block
summaries carry the running state from one block to the next.

Adaptive execution merges small neighbouring blocks, and there are never more
than the session's shuffle partitions, so block tables stay small however large
the data is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemark.session import materialize

BLOCK = "__block"
ROW = "__row"
POSITION = "__position"
TILE = "__tile"
CARRY = "__carry"
LEAD = "__lead"

# Rows per tile: large enough that the copied lead-in rows are a small share,
# small enough to sort in one task's memory.
TILE_ROWS = 200_000

OrderKeys = Sequence["str | Column"]


def as_columns(keys: OrderKeys) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def as_list(keys) -> list:
    if keys is None:
        return []
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def nulls_last(keys: OrderKeys) -> list[Column]:
    return [F.col(k).asc_nulls_last() if isinstance(k, str) else k for k in keys]


def range_blocks(df: DataFrame, partition_by: OrderKeys, order_by: OrderKeys) -> DataFrame:
    """Rows with the number of the range block they fall in, written once.

    Range bounds come from a sample and differ between runs, hence the
    checkpoint: every later read must see the same blocks.
    """
    keys = [*as_columns(partition_by), *as_columns(order_by)]
    return materialize(df.repartitionByRange(*keys).withColumn(BLOCK, F.spark_partition_id()))


def block_window(partition_by: OrderKeys) -> WindowSpec:
    """Earlier blocks of the same group: at most one row per block and group."""
    return (
        Window.partitionBy(*as_columns(partition_by))
        .orderBy(BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def continue_blocks(
    blocks: DataFrame, carried: DataFrame, partition_by: Sequence[str], order_by: OrderKeys
) -> tuple[DataFrame, WindowSpec]:
    """Put the carried state of each (group, block) in front of its rows.

    The state travels as one extra row, marked by ``LEAD``, so a single window
    over (group, block) sees it: no join, and NULL groups need no care.
    """
    rows = blocks.withColumn(LEAD, F.lit(0)).unionByName(
        carried.withColumn(LEAD, F.lit(-1)), allowMissingColumns=True
    )
    window = (
        Window.partitionBy(*partition_by, BLOCK)
        .orderBy(LEAD, *as_columns(order_by))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows, window


def running_total(
    df: DataFrame, amount: str, order_by: OrderKeys, partition_by: Sequence[str] = (), new_col: str = "running"
) -> DataFrame:
    """Inclusive running sum along ``order_by`` within each group, in any group size.

    ``order_by`` should be a total order within the group.
    """
    blocks = range_blocks(df, partition_by, order_by).withColumn(CARRY, F.col(amount))
    totals = blocks.groupBy(*partition_by, BLOCK).agg(F.sum(CARRY).alias("__total"))
    carried = totals.select(*partition_by, BLOCK, F.sum("__total").over(block_window(partition_by)).alias(CARRY))
    rows, window = continue_blocks(blocks, carried, partition_by, order_by)
    return rows.withColumn(new_col, F.sum(CARRY).over(window)).filter(F.col(LEAD) == 0).drop(CARRY, BLOCK, LEAD)


def filled_and_previous(
    df: DataFrame, value: str, order_by: OrderKeys, partition_by: Sequence[str] = ()
) -> tuple[DataFrame, Column, Column]:
    """Rows, and for each the last value up to it and the last one before it, NULL skipped, in any group size.

    One range sort: each block is written once, and what the blocks before it end with goes in front of its rows.
    The rows must go through :func:`own_rows` once the two columns have been used.
    """
    order = as_list(order_by)
    blocks = range_blocks(df, partition_by, nulls_last(order)).withColumn(CARRY, F.col(value))
    place = F.struct(*[x for k in as_columns(order) for x in (k.isNull(), k)])
    latest = F.max_by(F.col(CARRY), F.when(F.col(CARRY).isNotNull(), place))
    summary = blocks.groupBy(*partition_by, BLOCK).agg(latest.alias("__last"))
    # A block of NULLs only hands on what it received.
    carried = summary.select(
        *partition_by, BLOCK, F.last("__last", ignorenulls=True).over(block_window(partition_by)).alias(CARRY)
    )
    rows, window = continue_blocks(blocks, carried, partition_by, nulls_last(order))
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return rows, F.last(CARRY, ignorenulls=True).over(window), F.last(CARRY, ignorenulls=True).over(before)


def own_rows(rows: DataFrame) -> DataFrame:
    """Without the carried rows and the helper columns."""
    return rows.filter(F.col(LEAD) == 0).drop(CARRY, BLOCK, LEAD)


def carry_forward(
    df: DataFrame, value: str, order_by: Sequence[str], partition_by: Sequence[str] = (), new_col: str | None = None
) -> DataFrame:
    """Fill NULL with the last earlier value of the group, in any group size; NULL keys come last."""
    rows, filled, _ = filled_and_previous(df, value, order_by, partition_by)
    return own_rows(rows.withColumn(new_col or value, filled))


def row_positions(
    df: DataFrame, order_by: OrderKeys, partition_by: OrderKeys = (), new_col: str = POSITION
) -> DataFrame:
    """Dense 0-based position of each row along (group, order), over the whole table.

    After a range partition and a sort inside each partition, Spark's
    monotonic id is (partition, row in partition); adding the sizes of earlier
    partitions makes it dense. The size table has one row per partition.
    """
    keys = [*as_columns(partition_by), *as_columns(order_by)]
    ranged = materialize(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("__id", F.monotonically_increasing_id())
        .withColumn(BLOCK, F.shiftright(F.col("__id"), 33))
        .withColumn(ROW, F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__id")
    )
    sizes = ranged.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("__size"))
    starts = sizes.select(
        F.col(BLOCK), F.coalesce(F.sum("__size").over(block_window([])), F.lit(0)).alias(CARRY)
    )
    # One row per shuffle partition: the bound makes the broadcast safe.
    return (
        ranged.join(F.broadcast(starts), BLOCK)
        .withColumn(new_col, F.col(CARRY) + F.col(ROW))
        .drop(BLOCK, ROW, CARRY)
    )


def over_tiles(
    df: DataFrame,
    order_by: OrderKeys,
    partition_by: Sequence[str],
    reach: int,
    build: Callable[[WindowSpec], dict[str, Column]],
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Window columns that look back at most ``reach`` rows, in any group size.

    Rows are cut into tiles of consecutive positions; the last ``reach`` rows
    of a tile are copied to the next one as lead-in and dropped afterwards, so
    a tile alone is enough to compute its rows and no task holds a whole group.
    """
    size = max(tile_rows, reach, 1)
    tile = F.floor(F.col(POSITION) / size)
    in_lead = F.col(POSITION) % size >= size - reach
    placed = (
        row_positions(df, order_by, partition_by)
        .withColumn(TILE, F.explode(F.when(in_lead, F.array(tile, tile + 1)).otherwise(F.array(tile))))
    )
    window = Window.partitionBy(*partition_by, TILE).orderBy(POSITION)
    return placed.withColumns(build(window)).filter(F.col(TILE) == tile).drop(TILE, POSITION)
