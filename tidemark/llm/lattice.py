"""Near-duplicate vectors by lattice hashing.

Unit vectors are projected to 8 random dimensions in each of several tables and decoded to
the nearest point of the E8 lattice, which names their cell. A vector lives in its own cell
and visits the neighbouring cells nearest to it, so two close vectors meet in some table
even if a cell border parts them. All vectors that meet are compared by cosine in double
precision, in blocks, inside the cell.

Equal vectors are one class first, so copies cost nothing. A cell with many members is cut
into chunks and its pairs of chunks are separate groups: no task holds a whole hot cell. Linked
pairs are counted where they are found, each in the first cell that both share; what is given out is
a row for each vector of a group, with its number of links and the least vector it is connected to.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.graph import components
from tidemark.session import materialize

#: Two unit vectors with cosine 0.93 meet in one table with probability 0.76, in six with 0.9998;
#: two orthogonal ones in one table with less than 0.03.
TABLES, VISITS, SCALE, SEED = 6, 4, 0.5, 20_251
CHUNK, PAIRS = 1000, 20_000


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest whole-number points with an even sum."""
    point = np.rint(x)
    rest = x - point
    worst = np.abs(rest).argmax(axis=1)
    rows = np.flatnonzero(point.sum(axis=1) % 2 != 0)
    point[rows, worst[rows]] += np.where(rest[rows, worst[rows]] >= 0, 1.0, -1.0)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8: D8, or D8 shifted by one half in every coordinate."""
    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def shortest_e8() -> np.ndarray:
    """The 240 lattice vectors of least length: steps to the neighbouring points."""
    steps = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            step = [0.0] * 8
            step[i], step[j] = a, b
            steps.append(step)
    steps += [list(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(steps)


def cells(unit: np.ndarray, table: int, scale: float, visits: int) -> np.ndarray:
    """Names of each vector's own cell (first column) and of the neighbouring cells nearest to it."""
    rng = np.random.default_rng([SEED, table, unit.shape[1]])
    x = unit @ (rng.standard_normal((unit.shape[1], 8)) * scale) + rng.random(8)
    own = nearest_e8(x)
    steps = shortest_e8()
    away = (steps**2).sum(axis=1) - 2 * (x - own) @ steps.T  # squared distance to the neighbour, less a constant
    near = np.argpartition(away, visits, axis=1)[:, :visits] if visits else np.zeros((len(x), 0), int)
    points = np.concatenate([own[:, None, :], own[:, None, :] + steps[near]], axis=1)
    mix = rng.integers(1, 2**62, 8, dtype=np.int64) | 1
    return ((2 * points).astype(np.int64) * mix).sum(axis=2)  # wraps; unlike cells may share a name, pairs are verified


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column, all of one length, as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares of very large or small parts stay finite
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def by_length(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    lengths = pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        yield batch.filter(pa.array(lengths == n))


def no_negative_zero(column: str) -> Column:
    """The vector with 0 for -0, so that equal vectors group."""
    return F.transform(column, lambda x: F.when(x == 0, F.abs(x)).otherwise(x))


def vector_classes(vectors: DataFrame, key: str, column: str, label: str) -> DataFrame:
    """``key``, ``label`` and ``v`` of every comparable row.

    Left out: NULL labels, vectors that are NULL, empty or zero, and those with NULL or non-finite parts.
    """
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col(label).isNotNull() & F.col(column).isNotNull() & ~bad & F.exists(column, lambda x: x != 0)
    return vectors.where(good).select(F.col(key).alias("key"), F.col(label).alias("label"), no_negative_zero(column).alias("v"))


def all_names(unit: np.ndarray, group: np.ndarray, tables: int, visits: int, scale: float) -> np.ndarray:
    """Names of all cells of each vector, its own cell of every table first: rows of tables * (visits + 1)."""
    parts = [cells(unit, t, scale, visits) * 31 + group[:, None] * 1_000_003 + t for t in range(tables)]
    return np.concatenate(parts, axis=1)


def first_meeting(x: np.ndarray, y: np.ndarray, tables: int) -> np.ndarray:
    """For each pair of rows of names, which meet somewhere: the cell that counts, in the first table where they meet."""
    x, y = (names.reshape(len(names), tables, -1) for names in (x, y))
    none = np.iinfo(np.int64).max
    in_y = np.where((x[:, :, :1] == y).any(axis=2), x[:, :, 0], none)  # the one lives where the other is
    in_x = np.where((y[:, :, :1] == x).any(axis=2), y[:, :, 0], none)
    table = ((in_x < none) | (in_y < none)).argmax(axis=1)
    rows = np.arange(len(x))
    return np.minimum(in_x[rows, table], in_y[rows, table])


def smallest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest number reachable from each of 0 to ``n`` - 1 over links ``a``, ``b``."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def found_links(nodes: DataFrame, least: float, tables: int = TABLES, visits: int = VISITS, scale: float = SCALE) -> DataFrame:
    """Rows ``node``, ``linked``, ``root``; together they hold all pairs with equal labels and cosine ``least`` or more.

    ``nodes``: ``node`` (long), ``label``, ``copies`` and ``v`` (array<double>, finite, not zero), all different.
    Only vectors of the same number of dimensions are compared. A pair counts in one cell only, so the ``linked`` of a
    node sum up to the copies of its partners, and links to the ``root`` of each row connect what pairs connect. Pairs
    themselves don't leave the task that finds them.
    """
    spark = nodes.sparkSession

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for same in by_length(whole, "v"):
                for at in range(0, same.num_rows, 1000):
                    batch = same.slice(at, 1000)
                    names = all_names(unit_rows(matrix(batch.column("v"))), batch.column("group").to_numpy(), tables, visits, scale)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(names) + 1) * names.shape[1], pa.int32()), pa.array(names.ravel()))
                    yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "copies", "v")), lists], ["node", "copies", "v", "names"])

    grouped = nodes.select("node", F.col("copies").cast("long"), "v", F.xxhash64("label", F.size("v")).alias("group"))
    named = materialize(grouped.mapInArrow(deal, f"node long, copies long, v {dict(grouped.dtypes)['v']}, names array<long>"))
    members = named.select("node", F.posexplode("names").alias("place", "cell"))
    members = materialize(members.select("node", "cell", (F.col("place") % (visits + 1) == 0).alias("lives")))
    sizes = members.groupBy("cell").agg(F.count("*").alias("n"), F.max("lives").alias("any")).where("n > 1 and any")
    sizes = sizes.select("cell", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    # lone members meet nobody; a chunk of a large cell meets every chunk of it
    spread = (
        members.join(sizes, "cell").withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("node", "lives", "cell", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .join(named, "node")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell and chunk pair; a group is compared when it is complete."""
        out = ["node", "linked", "root"]
        parts: list[pa.RecordBatch] = []
        name = None

        def links() -> Iterator[pa.RecordBatch]:
            held = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            for same in by_length(held, "v"):
                node, lives, own, copies = (same.column(c).to_numpy(zero_copy_only=False) for c in ("node", "lives", "own", "copies"))
                unit = unit_rows(matrix(same.column("v")))
                names = same.column("names").flatten().to_numpy(zero_copy_only=False).reshape(same.num_rows, -1)
                first, second = np.flatnonzero(own == name[1]), np.flatnonzero(own == name[2])
                meet = lives[first][:, None] | lives[second][None, :]
                x, y = np.nonzero((unit[first] @ unit[second].T >= least) & meet)
                a, b = first[x], second[y]
                once = node[a] < node[b] if name[1] == name[2] else node[a] != node[b]
                a, b = a[once], b[once]
                counts = [first_meeting(names[a[at:at + PAIRS]], names[b[at:at + PAIRS]], tables) == name[0] for at in range(0, len(a), PAIRS)]
                if not counts:
                    continue
                counts = np.concatenate(counts)
                a, b = a[counts], b[counts]
                linked = np.zeros(len(node), np.int64)
                np.add.at(linked, a, copies[b])
                np.add.at(linked, b, copies[a])
                place = np.argsort(node, kind="stable")  # roots by the order of nodes
                rank = np.empty(len(node), np.int64)
                rank[place] = np.arange(len(node))
                root = node[place][smallest_reachable(len(node), rank[a], rank[b])][rank]
                there = linked > 0
                if there.any():
                    yield pa.RecordBatch.from_arrays([pa.array(node[there]), pa.array(linked[there]), pa.array(root[there])], out)

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "i", "j")], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for low, high in zip(edges[:-1], edges[1:]):
                if high == low:
                    continue
                if (key := tuple(keys[low].tolist())) != name:
                    if sum(p.num_rows for p in parts) > 1:
                        yield from links()
                    parts, name = [], key
                parts.append(batch.slice(low, high - low))
        if sum(p.num_rows for p in parts) > 1:
            yield from links()

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = spread.repartition(buckets, "cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return laid.mapInArrow(compare, "node long, linked long, root long")


def near_duplicates(vectors: DataFrame, least: float, key: str = "vec_id", column: str = "embedding", label: str = "label", tables: int = TABLES, visits: int = VISITS, scale: float = SCALE) -> DataFrame:
    """Per row of ``vectors``: ``key``, ``n_links``, ``component_id``, ``kept``.

    Rows with equal labels and cosine ``least`` or more are linked; what cannot be compared (NULL label or
    key, unusable vector) links with nothing and is its own component. ``n_links`` counts rows, copies
    included; ``component_id`` is the smallest key reachable. Keys are whole numbers; a repeated key gives
    a repeated row.
    """
    usable = vector_classes(vectors.where(F.col(key).isNotNull()), key, column, label)
    classes = materialize(usable.groupBy("label", "v").agg(F.min("key").cast("long").alias("node"), F.count("*").alias("copies")))
    links = materialize(found_links(classes, least, tables, visits, scale))
    linked = links.groupBy("node").agg(F.sum("linked").alias("linked"))
    roots = components(links.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_class = (
        classes.join(linked, "node", "left").join(roots, "node", "left")
        .select("label", "v", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    )
    # a class id for each row: by its vector, unless that cannot be compared
    rows = vectors.select(F.col(key), F.col(label).alias("label"), no_negative_zero(column).alias("v"))
    rows = rows.withColumn("label", F.when(F.col(key).isNotNull(), F.col("label")))
    found = rows.join(per_class, ["label", "v"], "left")
    component = F.coalesce("component_id", F.col(key).cast("long"))
    return found.select(
        key, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col(key) == component).alias("kept"),
    )
