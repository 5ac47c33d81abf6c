"""Best-fit packing of token pieces into sequences of a fixed capacity, by linear grouping.

Lengths are whole numbers up to the capacity, so the counts per length (at most
``capacity`` rows) say all that a packing depends on; which document fills a place
of its length is free. The plan is made from these counts on the driver and its work
and size do not grow with the corpus; placing the pieces is a distributed rank and
one join with the plan:

1. Lengths of ``small`` tokens or more are cut, longest first, into groups of equal
   cardinality, and each is rounded up to the longest of its group.
2. Configurations (multisets of rounded lengths that fit a sequence) are optimised by
   column generation: a linear programme whose new columns come from a knapsack.
3. Whole multiples of each configuration are used; actual pieces, longest first, take the places.
4. All other pieces, longest first, go where the least room stays; new sequences open last.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import materialize

#: Groups of rounded lengths, and pieces per rank block.
GROUPS, BLOCK = 128, 50_000


def cut_documents(encoded: DataFrame, capacity: int) -> DataFrame:
    """One row per piece: documents over ``capacity`` ids are cut, the first piece takes the remainder.

    In: ``doc_id``, ``ids`` (binary, 4 bytes an id). Documents without ids give no piece.
    """
    n = (F.length("ids") / 4).cast("long")
    pieces = F.ceil(F.col("n") / capacity).cast("int")
    first = F.col("n") - (F.col("pieces") - 1) * capacity
    start = F.when(F.col("piece") == 0, F.lit(0).cast("long")).otherwise(F.col("first") + (F.col("piece") - 1).cast("long") * capacity)
    length = F.when(F.col("piece") == 0, F.col("first")).otherwise(F.lit(capacity).cast("long"))
    return (
        encoded.select("doc_id", "ids", n.alias("n")).where("n > 0").withColumn("pieces", pieces).withColumn("first", first)
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select("doc_id", "piece", start.alias("start"), length.alias("length"), "ids")
        .withColumn("ids", F.expr("substring(ids, cast(start * 4 + 1 as int), cast(length * 4 as int))"))
    )


# ---- the plan ----

@dataclass
class Run:
    """Sequences ``low`` up to ``high`` (not included), each filled with ``used`` tokens."""

    low: int
    high: int
    used: int


@dataclass
class Supply:
    """Pieces of one length by rank, handed out from the front."""

    length: int
    left: int
    next: int = 0


def group_lengths(counts: dict[int, int], small: int, groups: int) -> list[list[int]]:
    """Large lengths, longest first, in groups of about equal numbers of pieces."""
    large = sorted((length for length in counts if length >= small), reverse=True)
    share = sum(counts[x] for x in large) / groups
    out: list[list[int]] = []
    room = 0.0
    for length in large:
        if room <= 0:
            out.append([])
            room = share
        out[-1].append(length)
        room -= counts[length]
    return out


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The multiset of sizes within ``capacity`` that is worth most."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fits = np.flatnonzero(sizes <= room)
        if len(fits):
            worth = best[room - sizes[fits]] + prices[fits]
            top = int(worth.argmax())
            if worth[top] > best[room] + 1e-12:
                best[room], taken[room] = worth[top], fits[top]
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            pattern[taken[room]] += 1
            room -= int(sizes[taken[room]])
    return pattern


def optimise(sizes: list[int], demand: list[int], capacity: int, rounds: int = 3000) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often each is used in whole, from the linear optimum."""
    s, d = np.array(sizes), np.array(demand, float)
    basis = np.diag((capacity // s).astype(float))
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        prices = inverse.sum(axis=0)  # each configuration costs one sequence
        column = best_pattern(prices, s, capacity)
        if prices @ column <= 1 + 1e-7:
            break
        amounts, change = inverse @ d, inverse @ column
        ratio = np.where(change > 1e-9, np.maximum(amounts, 0) / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    amounts = np.linalg.solve(basis, d)
    return [(basis[:, j].astype(int), int(x + 1e-6)) for j, x in enumerate(amounts) if x + 1e-6 >= 1]


def make_plan(counts: dict[int, int], capacity: int, small: int, groups: int = GROUPS) -> tuple[list[tuple], int]:
    """Rows ``(length, low, high, sequence, each, offset)`` and the number of sequences.

    Pieces of ``length`` with ranks from ``low`` up to ``high`` go to the sequences from
    ``sequence`` on, ``each`` to a sequence, the first of them at ``offset``.
    """
    stock = {length: Supply(length, n) for length, n in counts.items()}
    rows: list[tuple] = []
    total = 0

    def hand_out(supply: Supply, run: Run, each: int) -> None:
        n = (run.high - run.low) * each
        rows.append((supply.length, supply.next, supply.next + n, run.low, each, run.used))
        supply.next, supply.left = supply.next + n, supply.left - n
        run.used += each * supply.length

    open_runs: list[Run] = []
    grouped = group_lengths(counts, small, groups)
    if grouped:
        configurations = optimise([g[0] for g in grouped], [sum(counts[x] for x in g) for g in grouped], capacity)
        for pattern, times in configurations:
            pieces = [Run(total, total + times, 0)]
            total += times
            for group, multiplicity in zip(grouped, pattern):
                for _ in range(multiplicity):
                    done: list[Run] = []
                    while pieces:  # the places of one slot, filled from the longest lengths left
                        run = pieces.pop()
                        supply = next((stock[x] for x in group if stock[x].left), None)
                        if supply is None:
                            done.append(run)
                            continue
                        n = min(run.high - run.low, supply.left)
                        if n < run.high - run.low:
                            pieces.append(Run(run.low + n, run.high, run.used))
                            run = Run(run.low, run.low + n, run.used)
                        hand_out(supply, run, 1)
                        done.append(run)
                    pieces = done
            open_runs += pieces

    by_gap: dict[int, list[Run]] = {}
    for run in open_runs:
        by_gap.setdefault(capacity - run.used, []).append(run)
    for length in sorted(stock, reverse=True):
        supply = stock[length]
        for gap in range(length, capacity + 1):
            while supply.left and by_gap.get(gap):
                run = by_gap[gap].pop()
                each = min(gap // length, supply.left)
                n = min(run.high - run.low, supply.left // each)
                if n < run.high - run.low:
                    by_gap[gap].append(Run(run.low + n, run.high, run.used))
                    run = Run(run.low, run.low + n, run.used)
                hand_out(supply, run, each)
                by_gap.setdefault(capacity - run.used, []).append(run)
            if not supply.left:
                break
        if supply.left:
            each = capacity // length
            for n, k in ((supply.left // each, each), (1, supply.left % each)):
                if n and k:
                    run = Run(total, total + n, 0)
                    total += n
                    hand_out(supply, run, k)
                    by_gap.setdefault(capacity - run.used, []).append(run)
    return rows, total


def best_plan(counts: dict[int, int], capacity: int, groups: int = GROUPS) -> tuple[list[tuple], int]:
    """The plan with the fewest sequences over a few bounds of what is small, from a half of the capacity down.

    With many kinds of pieces, leaving more of them to best fit wastes less on rounding; with few
    kinds, configurations win. Stops at the lower bound.
    """
    least = max(-(-sum(n * x for x, n in counts.items()) // capacity), sum(n for x, n in counts.items() if 2 * x > capacity))
    best: tuple[list[tuple], int] | None = None
    for small in (capacity // 2 + 1, 2 * capacity // 5, capacity // 4, capacity // 8):
        plan = make_plan(counts, capacity, max(2, small), groups)
        best = plan if best is None or plan[1] < best[1] else best
        if best[1] <= least:
            break
    return best


# ---- placing the pieces ----

def ranked(pieces: DataFrame, total: int) -> DataFrame:
    """``rank`` from 0 among the pieces of the same length, without one task per length.

    Ties are broken by all columns but binary ones, which are only carried along."""
    others = [c for c, kind in pieces.dtypes if kind != "binary"]
    blocks = max(1, total // BLOCK)
    dealt = pieces.withColumn("_block", F.pmod(F.xxhash64(*others), F.lit(blocks)))
    sizes = dealt.groupBy("length", "_block").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("length", "_block").orderBy(*others)) - 1
    return (
        dealt.withColumn("_inside", inside)
        .join(sizes.select("length", "_block", before.alias("_before")), ["length", "_block"])
        .withColumn("rank", F.col("_before") + F.col("_inside")).drop("_block", "_inside", "_before")
    )


def pack(pieces: DataFrame, capacity: int, small: int | None = None, groups: int = GROUPS) -> DataFrame:
    """Every row of ``pieces`` with ``sequence_id`` and ``offset``, sequences gapless from 0.

    ``pieces`` needs ``length`` (1 to ``capacity``); its other columns are carried along and only
    break ties, so repeated rows each get a place. Pieces below ``small`` tokens stay out of the
    configurations; by default several bounds are tried. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    kept = materialize(pieces)
    counts = {r["length"]: r["n"] for r in kept.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not x or x < 1 or x > capacity for x in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    rows, _ = make_plan(counts, capacity, small, groups) if small else best_plan(counts, capacity, groups)
    # an Arrow table needs no Python workers, which would stand idle beside those that hold the vocabulary
    names = ["length", "_low", "_high", "_sequence", "_each", "_offset"]
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))]
    plan = spark.createDataFrame(pa.Table.from_arrays(columns, names))
    step = F.col("rank") - F.col("_low")
    # the plan is made from at most `capacity` counts, so it may be sent to every task
    placed = ranked(kept, sum(counts.values())).join(F.broadcast(plan), "length").where("rank >= _low and rank < _high")
    return placed.select(
        *(F.col(c) for c in kept.columns),
        (F.col("_sequence") + F.expr("(rank - _low) div _each")).alias("sequence_id"),
        (F.col("_offset") + F.pmod(step, F.col("_each")) * F.col("length")).alias("offset"),
    )
