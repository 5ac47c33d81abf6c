"""Near-duplicate documents by a multi-index Hamming join of b-bit minhash signatures.

A document is its set of word shingles. A signature has ``POSITIONS`` values of 8 bits, each
from the minimum of the set under another hash function; two sets with likeness J differ in
about (1 - J) of them. Signatures that differ in at most ``most`` positions are found without
loss: cut into ``chunks`` pieces, two of them differ in at most ``most // chunks`` positions of
some piece, so every signature is indexed under each piece with every choice of that many
positions left out. ``most`` leaves a pair at the threshold out with probability 0.0001.
Found pairs are confirmed on the full sets.

Groups of copies cost no rows for their pairs: equal sets are one node, and the members of a bucket
are first compared with its smallest member only. What that leaves in different components is then
compared all with all, inside the bucket's task and in chunks; a pair that meets in several buckets
counts in the first of them. Candidates travel as lists, one for each document and block of partners,
to the task that holds the sets of that block, and only confirmed links become rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.graph import components
from tidemark.llm.katz import expand_sorted, squeeze_sorted
from tidemark.llm.members import bits_for, likely_members
from tidemark.llm.memory import let_go, tidy
from tidemark.llm.words import mixed, shingles, word_hashes
from tidemark.session import arrow_batches, materialize, release

POSITIONS, MISSED, SEED = 128, 0.0001, 7
#: Texts that a worker gets at a time.
ROWS = 500
#: Members of a bucket that are compared at a time, sets of partners that a task holds, and lists that ask them, about.
BLOCK, PARTNERS, ASKERS = 1000, 250, 500


def most_differences(likeness: float, positions: int = POSITIONS, missed: float = MISSED) -> int:
    """Least bound that a pair at ``likeness`` exceeds with a probability of at most ``missed``."""
    q, total = (1 - likeness) * (1 - 2**-8), 0.0
    for k in range(positions + 1):
        total += math.comb(positions, k) * q**k * (1 - q) ** (positions - k)
        if 1 - total <= missed:
            return k
    return positions


def pieces(positions: int, most: int) -> list[tuple[list[int], int]]:
    """Pieces of neighbouring positions, as few as leave at most one difference in some piece."""
    chunks = most // 2 + 1
    parts = np.array_split(np.arange(positions), chunks)
    return [(p.tolist(), most // chunks) for p in parts]


def all_choices(positions: int, most: int) -> list[tuple[int, list[int], int]]:
    """Piece, positions kept and position left out (-1: none) of every index key of a signature."""
    return [
        (number, [p for p in piece if p != left_out], left_out)
        for number, (piece, errors) in enumerate(pieces(positions, most))
        for left_out in (piece if errors else [-1])
    ]


def signature(hashes: np.ndarray, positions: int = POSITIONS) -> bytes:
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 2**63, positions, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(positions, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):  # bounded memory for long documents
        least = np.minimum(least, (hashes[at:at + 4096] * factors[:, None]).min(axis=1))
    return mixed(least).astype(np.uint8).tobytes()


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what is made from texts is handed on soon."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def described(docs: DataFrame, words: int, positions: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_id`` (128-bit hash of the set), ``signature`` of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("signature", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        let_go("words")
        for batch in slices(batches):
            sets = [shingles(word_hashes(t), words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([signature(s, positions) if len(s) else None for s in sets], pa.binary()),
            ], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run), "doc_id long, n_shingles long, set_id binary, signature binary")


def keys_of(signatures: np.ndarray, choices: list[tuple[int, list[int], int]]) -> Iterator[np.ndarray]:
    """For each choice the key of every signature."""
    values = signatures.astype(np.uint64)
    for number, (_, kept, _) in enumerate(choices):
        h = np.full(len(values), number + 1, np.uint64)
        for p in kept:
            h = mixed(h * np.uint64(257) + values[:, p])
        yield h


def index_keys(nodes: DataFrame, positions: int, most: int, likely: np.ndarray) -> DataFrame:
    """``key``, ``choice`` (its number), ``node``: each piece of the signature with every allowed choice of positions
    left out, but for most of the keys that no other signature has (``likely``: see :func:`shared_keys`)."""
    choices = all_choices(positions, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy()
            for number, h in enumerate(keys_of(matrix(batch.column("signature"), positions), choices)):
                at = (h >> DROPPED) & np.uint64(8 * len(likely) - 1)
                hit = (likely[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[hit].view(np.int64)), pa.array(np.full(hit.sum(), number, np.int32)), pa.array(node[hit])], ["key", "choice", "node"])

    return nodes.select("node", "signature").mapInArrow(tidy(run), "key long, choice int, node long")


#: The last bits of a key are not needed to see which keys occur again; keys that agree in the others are told
#: apart afterwards. Keys gathered in a block, and keys of a bucket, about.
DROPPED, BLOCK_KEYS, BUCKET_KEYS = np.uint64(16), 3_000_000, 3_000_000


def shared_keys(nodes: DataFrame, positions: int, most: int) -> np.ndarray:
    """A bitmap, by the first bits of their keys, of all keys that two signatures or more have.

    Most keys occur once. A block of signatures sends its sorted keys to buckets as compressed differences,
    some 4 bytes a key; a bucket merges them and gives out those that occur again.
    """
    choices = all_choices(positions, most)
    count = nodes.count()
    buckets = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(count * len(choices) / BUCKET_KEYS))
    step = np.uint64(2 ** 48 // buckets + 1)
    per_block = max(1, BLOCK_KEYS // len(choices))

    def packets(signatures: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.sort(np.concatenate(list(keys_of(np.concatenate(signatures), choices))) >> DROPPED)
        starts = np.arange(buckets, dtype=np.uint64) * step
        edges = [*np.searchsorted(keys, starts).tolist(), len(keys)]
        rows = [{"bucket": i, "keys": squeeze_sorted(keys[a:b])} for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]
        return pa.RecordBatch.from_pylist(rows, pa.schema([("bucket", pa.int64()), ("keys", pa.binary())]))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for at in range(0, batch.num_rows, per_block):
                held.append(matrix(batch.column("signature").slice(at, per_block), positions))
                if sum(map(len, held)) >= per_block:
                    yield packets(held)
                    held = []
        if held:
            yield packets(held)

    def again(keys: list[np.ndarray]) -> pa.RecordBatch:
        every = np.sort(np.concatenate(keys))
        return pa.RecordBatch.from_arrays([pa.array(np.unique(every[1:][every[1:] == every[:-1]]).view(np.int64))], ["key"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket and held:
                    yield again(held)
                    held = []
                bucket = row["bucket"]
                held.append(expand_sorted(row["keys"]))
        if held:
            yield again(held)

    sent = nodes.select("signature").mapInArrow(tidy(send), "bucket long, keys binary")
    found = materialize(sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(merge), "key long"))
    bits = bits_for(found.count())
    at = found.select((F.pmod("key", F.lit(bits)) + 1).alias("p"))  # bitmaps count from 1
    parts = at.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    table = np.zeros((bits // 32_768, 4096), np.uint8)
    for r in parts.toLocalIterator():
        table[r["bucket"] - 1] = np.frombuffer(r["bits"], np.uint8)
    release(found)
    return table.ravel()


class Buckets:
    """Compares signatures inside buckets; a pair counts in the first bucket that it shares."""

    def __init__(self, positions: int, most: int):
        self.positions, self.most = positions, most
        parts = [piece for piece, _ in pieces(positions, most)]
        self.piece_starts = np.array([p[0] for p in parts])
        self.choices = all_choices(positions, most)
        self.first_choice = np.array([next(i for i, c in enumerate(self.choices) if c[0] == n) for n in range(len(parts))])
        self.choice_of_position = np.full(positions, -1)
        for i, (_, _, left_out) in enumerate(self.choices):
            if left_out >= 0:
                self.choice_of_position[left_out] = i

    def near(self, left: np.ndarray, right: np.ndarray, choice: int) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs of rows within the bound whose first common key is of this choice."""
        found = []
        step = max(1, 4_000_000 // max(1, right.size))
        for at in range(0, len(left), step):
            differ = left[at:at + step, None, :] != right[None, :, :]
            x, y = np.nonzero(differ.sum(axis=2, dtype=np.uint16) <= self.most)
            if len(x):
                rows = differ[x, y]
                in_piece = np.add.reduceat(rows, self.piece_starts, axis=1, dtype=np.uint16)
                piece = (in_piece <= 1).argmax(axis=1)  # of pairs within the bound, some piece has at most one difference
                clean = in_piece[np.arange(len(x)), piece] == 0
                # the one difference in the piece: the first at or behind its start
                behind = rows & (np.arange(self.positions) >= self.piece_starts[piece][:, None])
                first = np.where(clean, self.first_choice[piece], self.choice_of_position[behind.argmax(axis=1)])
                keep = first == choice
                found.append((x[keep] + at, y[keep]))
        if not found:
            return np.zeros(0, int), np.zeros(0, int)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def matrix(column: pa.Array, positions: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, positions)


def by_bucket(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Groups of two rows or more of batches sorted by ``names`` (whole numbers)."""
    parts: list[pa.RecordBatch] = []
    name: tuple | None = None

    def whole() -> Iterator[tuple[tuple, pa.RecordBatch]]:
        if sum(p.num_rows for p in parts) > 1:
            yield name, pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in names], axis=1)
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for low, high in zip(edges[:-1], edges[1:]):
            if high > low:
                if (key := tuple(keys[low].tolist())) != name:
                    yield from whole()
                    parts, name = [], key
                parts.append(batch.slice(low, high - low))
    yield from whole()


def with_heads(pairs: DataFrame, positions: int, most: int) -> DataFrame:
    """``a`` (head), ``b``: pairs of a node and the smallest of a bucket, with signatures, within the bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, head = batch.column("node").to_numpy(), batch.column("head").to_numpy()
            x, y = matrix(batch.column("signature"), positions), matrix(batch.column("head_signature"), positions)
            near = [np.zeros(0, int)]
            for at in range(0, len(own), 4096):
                part = slice(at, at + 4096)
                near.append(at + np.flatnonzero((x[part] != y[part]).sum(axis=1) <= most))
            keep = np.concatenate(near)
            yield pa.RecordBatch.from_arrays([pa.array(head[keep]), pa.array(own[keep])], ["a", "b"])

    return pairs.mapInArrow(tidy(run), "a long, b long")


def across_components(members: DataFrame, positions: int, most: int) -> DataFrame:
    """``o``, ``family``, ``sub``, ``partners`` (packed): nodes outside a bucket's main component, and
    all members of the bucket in other components that are within the bound.

    ``members``: ``key``, ``choice``, ``node``, ``label``, ``main``, ``family``, ``sub``, ``signature``, and ``own``, ``i``, ``j``
    (the member's chunk and the pair of chunks compared).
    """
    schema = pa.schema([("o", pa.int64()), ("family", pa.int64()), ("sub", pa.int32()), ("partners", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(positions, most)
        for (_, i, j), group in by_bucket(batches, ["key", "i", "j"]):
            node, label, main, own, family, sub = (group.column(c).to_numpy() for c in ("node", "label", "main", "own", "family", "sub"))
            signatures, choice = matrix(group.column("signature"), positions), int(group.column("choice")[0].as_py())
            rows = []
            for this, that in {(i, j), (j, i)}:
                o, y = np.flatnonzero((own == this) & (label != main)), np.flatnonzero(own == that)
                if len(o) and len(y):
                    a, b = buckets.near(signatures[o], signatures[y], choice)
                    a, b = o[a], y[b]
                    # two outsiders meet once
                    keep = (label[a] != label[b]) & ((label[b] == main[b]) | (node[a] < node[b]))
                    a, b = a[keep], b[keep]
                    place = np.lexsort([node[b], sub[b], family[b], a])
                    a, b = a[place], b[place]
                    edges = np.flatnonzero(np.diff(a, prepend=-1) | np.diff(family[b], prepend=-1) | np.diff(sub[b], prepend=-1))
                    for low, high in zip(edges, [*edges[1:], len(a)]):
                        at = b[low]
                        rows.append({"o": node[a[low]], "family": family[at], "sub": sub[at], "partners": node[b[low:high]].astype("<i8").tobytes()})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(tidy(run), "o long, family long, sub int, partners binary")


def listed_nodes(lists: DataFrame) -> DataFrame:
    """``node``: everything named in lists (see :func:`across_components`)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(0, np.int64)
        for batch in batches:
            parts = [np.frombuffer(x, "<i8") for x in batch.column("partners").to_pylist()]
            found = np.unique(np.concatenate([found, batch.column("o").to_numpy(), *parts]))
            if len(found) > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(found)], ["node"])
                found = found[:0]
        yield pa.RecordBatch.from_arrays([pa.array(found)], ["node"])

    return lists.select("o", "partners").mapInArrow(tidy(run), "node long").distinct()


def sets_of(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``node`` and its ``hashes`` (binary) for the documents in ``ids`` (``node``), stored.

    Their texts are stored first, so no task holds a worker for the filter and another for the sets.
    """
    likely = likely_members(ids, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(word_hashes(t), words).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "hashes"])

    some = docs.select(F.col("doc_id").cast("long").alias("node"), "text").where(likely(F.col("node")))
    texts = materialize(some.join(ids, "node", "left_semi"))
    with arrow_batches(docs.sparkSession, ROWS):
        sets = materialize(texts.mapInArrow(tidy(run), "node long, hashes binary").dropDuplicates(["node"]))
    release(texts)
    return sets


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def part_similar(x: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """:func:`similar` of one set to each of several, none empty."""
    sizes = np.array([len(y) for y in others])
    every = np.concatenate(others)
    at = np.minimum(np.searchsorted(x, every), len(x) - 1)
    both = np.add.reduceat((x[at] == every).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * both >= percent * (len(x) + sizes - both)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union of their full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("x"), batch.column("y"))  # read in place
            near = pa.array([similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in both], pa.bool_())
            yield pa.RecordBatch.from_arrays([pc.filter(batch.column(c), near) for c in ("a", "b")], ["a", "b"])

    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long")


def confirmed_lists(lists: DataFrame, places: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed pairs of ``lists`` (see :func:`across_components`); a block of partners holds about ``PARTNERS`` sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        name, held = None, {}
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if name != (row["family"], row["sub"], row["salt"]):
                    name, held = (row["family"], row["sub"], row["salt"]), {}
                hashes = np.frombuffer(row["hashes"], np.uint64)
                if row["partners"] is None:  # sets of the block come first
                    held[row["node"]] = hashes
                    continue
                others = np.frombuffer(row["partners"], "<i8").tolist()
                for low in range(0, len(others), 100):  # bounded memory for large sets
                    part = others[low:low + 100]
                    near = part_similar(hashes, [held[o] for o in part], percent)
                    found += [{"a": min(row["node"], o), "b": max(row["node"], o)} for o, yes in zip(part, near) if yes]
            yield pa.RecordBatch.from_pylist(found, schema)

    # askers of one block of partners go to several tasks, each with a copy of the block
    blocks = lists.groupBy("family", "sub").agg(F.ceil(F.count("*") / ASKERS).cast("int").alias("salts"))
    asked = lists.join(blocks, ["family", "sub"]).join(sets.withColumnRenamed("node", "o"), "o")
    salt = F.pmod(F.xxhash64("o"), F.col("salts")).cast("int").alias("salt")
    asked = asked.select(F.col("o").alias("node"), "family", "sub", salt, "partners", "hashes")
    copies = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    there = places.join(blocks, ["family", "sub"]).select("node", "family", "sub", copies).join(sets, "node")
    there = there.select("node", "family", "sub", "salt", F.lit(None).cast("binary").alias("partners"), "hashes")
    laid = there.unionByName(asked).repartition("family", "sub", "salt")
    laid = laid.sortWithinPartitions("family", "sub", "salt", F.col("partners").isNotNull())
    return laid.mapInArrow(tidy(run), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, positions: int = POSITIONS) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Rows are linked if their sets of ``words``-word shingles have 100 * intersection >= percent * union;
    ``component_id`` is the smallest ``doc_id`` reachable and ``kept`` says that it is the row's own. Fewer
    words than ``words`` count as one shingle. NULL, empty and white texts have an empty set, link with
    nothing and are kept, as are rows without an id (``component_id`` NULL). ``doc_id`` is a whole number and
    unique but for repeated rows, which give repeated rows.

    Pairs whose signatures differ in more positions than the bound are not tried. By the binomial
    distribution, with 128 positions and 80 percent, that loses about 93 links of a million pairs at exactly
    0.80, 26 at 0.81, 6 at 0.82 and 0.04 at 0.85; a lost link matters only if no other path joins the two.
    """
    most = most_differences(percent / 100, positions)
    with arrow_batches(docs.sparkSession, ROWS):
        rows = materialize(described(docs, words, positions))
    usable = rows.where("n_shingles > 0 and doc_id is not null")
    nodes = materialize(usable.groupBy("set_id").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")))

    # buckets with two members or more, each with its smallest member
    keys = materialize(index_keys(nodes, positions, most, shared_keys(nodes, positions, most)))
    shared = keys.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last"), F.count("*").alias("n")).where("head < last").select("key", "head", "n")
    members = materialize(keys.join(shared, "key"))
    release(keys)
    side = nodes.select("node", "signature")
    # one row for each pair of a node and a smallest member, however many buckets they share
    to_heads = members.where("node <> head").select("node", "head").distinct()
    to_heads = to_heads.join(side, "node").join(side.toDF("head", "head_signature"), "head").select("node", "head", "signature", "head_signature")
    tried = materialize(with_heads(to_heads, positions, most))
    ends = tried.select(F.col("a").alias("node")).union(tried.select("b")).distinct()
    sets = sets_of(docs, ends, words)
    links = materialize(confirmed(tried, sets, percent))

    # what is left: pairs of a bucket across components
    labels = components(links)
    labelled = members.join(labels, "node", "left").select("key", "choice", "node", "head", "n", F.coalesce("component", "node").alias("label"))
    sizes = labelled.groupBy("key", "label").agg(F.count("*").alias("m"))
    main = sizes.groupBy("key").agg(F.max_by("label", F.struct("m", "label")).alias("main"), F.count("*").alias("labels")).where("labels > 1").select("key", "main")
    # partners are kept in blocks of nodes that share buckets: those with the same smallest head
    family = members.groupBy("node").agg(F.min("head").alias("family"))
    many = family.groupBy("family").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("subs"))
    places = materialize(family.join(many, "family").select("node", "family", F.pmod(F.xxhash64("node"), F.col("subs")).cast("int").alias("sub")))
    open_members = labelled.join(main, "key").join(places, "node").join(side, "node")
    chunks = F.ceil(F.col("n") / BLOCK).cast("int")
    spread = (
        open_members.withColumn("own", F.pmod(F.xxhash64("node"), chunks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", "head", "n")
    )
    lists = materialize(across_components(spread, positions, most))
    # stored, or Spark would put the filter of sets_of behind listed_nodes, two workers for a task
    missing = materialize(listed_nodes(lists).join(sets.select("node"), "node", "left_anti"))
    sets = sets.union(sets_of(docs, missing, words))
    whole = components(links.union(confirmed_lists(lists, places, sets, percent)))

    classes = nodes.select("set_id", "node").join(whole, "node", "left").select("set_id", F.coalesce("component", "node").alias("component"))
    usable_id = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("set_id"))
    out = rows.select("doc_id", "n_shingles", usable_id.alias("set_id")).join(classes, "set_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs``, all columns, but for those whose near duplicate with a smaller id stays.

    Of repeated rows one stays; rows without an id stay.
    """
    judged = near_duplicates(docs, words, percent)
    gone = judged.where("not kept").select("doc_id")
    out = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return out
    return out.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(out.where("doc_id is null"))
