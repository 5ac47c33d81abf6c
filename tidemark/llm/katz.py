"""Scoring texts by a Katz backoff model of word pairs.

Good-Turing discounts take mass from n-grams seen up to ``RARE`` times; what a history loses
goes to its unseen words in proportion to the shorter model, by a weight that makes all
probabilities of a history sum to exactly 1. The shortest model has one place for all
unknown words. A text's score is the sum over its tokens (words and one end) of
log10 p(token | token before, or start), looked up pair first and then backing off.

How the counts travel. Most word pairs of a corpus are rare, so one row for each would move
far more than the text. Texts are gathered into blocks; a block counts its own words and pairs,
and sends them as sorted, delta-coded, compressed arrays ("packets") to the buckets of the model
that hold them. A bucket merges the packets, keeps its part of the n-gram table, and answers each
packet in the packet's order with the totals. No task sees more than one block or one
bucket; a history with more than its share of all tokens is split over several buckets by the
next word, and only its sums (at most ``4 * buckets`` histories can be that frequent) pass
the driver. Blocks are stored in a table bucketed by block, so answers are joined without moving texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.memory import tidy
from tidemark.llm.words import mixed, word_hashes
from tidemark.session import arrow_batches, delete_at_exit, scratch_path
from tidemark.sources import store_bucketed

RARE = 5
BLOCK_CHARS = 8_000_000
#: Texts that a worker gets at a time.
ROWS = 500
END = np.uint64(xxhash.xxh64_intdigest(b" end"))  # no word holds a blank
START, UNKNOWN = np.uint64(2**32 - 1), np.uint64(2**32 - 2)
LOW = np.uint64(2**32 - 1)
SHIFT = np.uint64(32)


# ---- arrays as bytes ----

def squeeze(values: np.ndarray) -> bytes:
    """Byte planes of an array, compressed; rising arrays are best given as differences."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expand(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def squeeze_sorted(values: np.ndarray) -> bytes:
    return squeeze(np.diff(values, prepend=values.dtype.type(0)))


def expand_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data, "<u8"), dtype=np.uint64)


def distinct(values: np.ndarray) -> np.ndarray:
    """``np.unique`` by sorting: of many different values, or sorted ones, faster than by its hash table."""
    ordered = np.sort(values)
    return ordered[np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)]]


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows by ``key`` of batches sorted by it."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0][key] != row[key]:
                yield held[0][key], held
                held = []
            held.append(row)
    if held:
        yield held[0][key], held


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows that hold a whole block each; a batch of them is not copied at once."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def records(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


# ---- the model's arithmetic ----

def discounts(seen: list[int]) -> np.ndarray:
    """Good-Turing discounts of counts 1 to ``RARE`` (index 0 and above: 1) from the numbers of
    n-grams seen 1 to ``RARE`` + 1 times; absolute discounting by one half where these are too few to estimate from."""
    out = np.ones(RARE + 2)
    first = seen[0]
    common = (RARE + 1) * seen[RARE] / first if first else 1.0
    for r in range(1, RARE + 1):
        estimate = ((r + 1) * seen[r] / (r * seen[r - 1]) - common) / (1 - common) if seen[r - 1] and common < 1 else 0.0
        out[r] = estimate if 0 < estimate < 1 else (r - 0.5) / r
    return out


class Words:
    """The shortest model: p(word) from its training count, and of an unknown word."""

    def __init__(self, n: int, distinct: int, seen: list[int]):
        self.n, self.distinct, self.d = n, distinct, discounts(seen)
        lost = sum(r * seen[r - 1] * (1 - self.d[r]) for r in range(1, RARE + 1))
        self.total = n if lost > 0 else n + 1  # nothing rare to take from: one more token, unknown
        self.unknown = (lost if lost > 0 else 1.0) / max(self.total, 1) if n else 1.0

    def p(self, counts: np.ndarray) -> np.ndarray:
        known = self.d[np.minimum(counts, RARE + 1)] * counts / max(self.total, 1)
        return np.where(counts > 0, known, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.n + 0.5 * (self.distinct + 1)))


def history_sums(histories: np.ndarray, counts: np.ndarray, p_next: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``histories`` (sorted in) and for each: pairs seen 1 to ``RARE`` times, tokens of
    more frequent pairs, and the probability of all seen next words in the shortest model."""
    names, first = np.unique(histories, return_index=True)
    columns = [(counts == r).astype(float) for r in range(1, RARE + 1)]
    columns += [np.where(counts > RARE, counts, 0).astype(float), np.where(counts > 0, p_next, 0.0)]
    return names, np.stack([np.add.reduceat(c, first) for c in columns], axis=1) if len(names) else np.zeros((0, RARE + 2))


def weights(sums: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each history: the divisor of its pair counts, and the weight of its unseen words."""
    r = np.arange(1, RARE + 1)
    tokens = sums[:, :RARE] @ r + sums[:, RARE]
    kept = sums[:, :RARE] @ (r * d[1:RARE + 1]) + sums[:, RARE]
    divisor = np.where(tokens - kept > 1e-9, tokens, tokens + 1)
    unseen = np.maximum(1 - sums[:, RARE + 1], 1e-300)
    return divisor, np.where(tokens > 0, (1 - kept / np.maximum(divisor, 1)) / unseen, 1.0)


# ---- a block ----

def text_blocks(docs: DataFrame, block_chars: int) -> DataFrame:
    """Blocks of whole texts: local word numbers, the words' hashes and training counts, document bounds."""
    schema = pa.schema([("block", pa.int64()), ("docs", pa.binary()), ("tokens", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()), ("starts", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, chars = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        held: list[bool] = []
        parts: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            lengths = np.array([len(p) for p in parts], np.uint64)
            words, local = np.unique(np.concatenate(parts), return_inverse=True)
            training = np.repeat(~np.array(held), lengths.astype(int))
            counts = np.bincount(local[training], minlength=len(words)).astype(np.uint32)
            docs = pa.record_batch([pa.array(ids, pa.int64()), pa.array(held), pa.array(lengths)], ["doc_id", "held_out", "n"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, docs.schema) as writer:
                writer.write_batch(docs)
            return records([{
                "block": part << 24 | number, "docs": sink.getvalue().to_pybytes(), "tokens": squeeze(local.astype(np.uint32)),
                "words": squeeze_sorted(words), "counts": squeeze(counts), "starts": len(held) - sum(held),
            }], schema)

        for batch in batches:
            for doc_id, text, out in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "held_out"))):
                ids.append(doc_id)
                held.append(out)
                parts.append(np.append(word_hashes(text), END))
                chars += len(text or "") + 1
                if chars >= block_chars:
                    yield block()
                    ids, held, parts, chars, number = [], [], [], 0, number + 1
        if ids:
            yield block()

    return docs.select(F.col("doc_id").cast("long"), "text", "held_out").mapInArrow(tidy(run), "block long, docs binary, tokens binary, words binary, counts binary, starts long")


def bucket_edges(buckets: int) -> np.ndarray:
    """First hash of every bucket of the word table but the first."""
    return np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)


class Block:
    """A block with the word table's answers: everything needed to send its pairs and to score."""

    def __init__(self, row: dict):
        answers = sorted(row["words_known"], key=lambda a: a["bucket"])
        self.ids = np.concatenate([expand(a["ids"], "<u8") for a in answers])
        self.counts = np.concatenate([expand(a["totals"], "<i8") for a in answers])
        with pa.ipc.open_stream(row["docs"]) as reader:
            docs = reader.read_all()
        self.doc_ids, self.held_out, lengths = (docs.column(c).to_pylist() for c in ("doc_id", "held_out", "n"))
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - np.array(lengths)
        self.next = expand(row["tokens"], "<u4").astype(np.int64)
        before = np.empty(len(self.next), np.uint64)
        before[1:] = self.ids[self.next[:-1]]
        before[self.starts] = START
        self.before, self.after = before, self.ids[self.next]
        self.training = np.repeat(~np.array(self.held_out), lengths)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs (sorted keys), the token positions' pair numbers, and training counts by pair.

        Every known history also has a pair with the unknown word, so that it is asked for."""
        key = self.before << SHIFT | self.after
        key[self.before == UNKNOWN] = UNKNOWN << SHIFT | UNKNOWN
        every = np.concatenate([key, distinct(self.before) << SHIFT | UNKNOWN])
        # positions come from the one sort; looking a million keys up afterwards costs several times as much
        order = np.argsort(every)
        every = every[order]
        first = np.append(True, every[1:] != every[:-1])
        places = np.empty(len(every), np.int32)
        places[order] = np.cumsum(first, dtype=np.int32) - np.int32(1)
        keys, at = every[first], places[:len(key)]
        del every, order, first, key
        counts = np.bincount(at[self.training & (self.after != UNKNOWN)], minlength=len(keys))
        return keys, at, counts.astype(np.uint32)


def pair_buckets(keys: np.ndarray, history_tokens: np.ndarray, share: float, buckets: int) -> np.ndarray:
    """Bucket of each pair: by its history, and by the next word too if the history is frequent."""
    parts = np.clip(np.ceil(history_tokens / share), 1, buckets).astype(np.uint64)
    history, word = keys >> SHIFT, keys & LOW
    return (((mixed(history) % np.uint64(buckets)) + mixed(word) % parts) % np.uint64(buckets)).astype(np.int64)


# ---- the stages ----

def word_table(blocks: DataFrame, path: str, buckets: int) -> None:
    """Count words over all blocks. Rows with ``block`` -1 are the table, the others answers."""
    edges = bucket_edges(buckets)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])
        for row in one_by_one(batches):
            words, counts = expand_sorted(row["words"]), expand(row["counts"], "<u4")
            cuts = [0, *np.searchsorted(words, edges).tolist(), len(words)]
            yield records([
                {"bucket": i, "block": row["block"], "words": squeeze_sorted(words[a:b]), "counts": squeeze(counts[a:b])}
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a
            ], schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("ids", pa.binary()), ("totals", pa.binary()), ("seen", pa.list_(pa.int64()))])
        for bucket, packets in groups(batches, "bucket"):
            lists = [expand_sorted(p["words"]) for p in packets]
            words, local = np.unique(np.concatenate(lists), return_inverse=True)
            counts = np.concatenate([expand(p["counts"], "<u4") for p in packets])
            totals = np.bincount(local, counts, len(words)).astype(np.int64)
            known = totals > 0
            ids = np.where(known, (np.cumsum(known) - 1) * buckets + bucket, int(UNKNOWN)).astype(np.uint64)
            if len(ids) and known.any() and ids[known].max() >= UNKNOWN:
                raise ValueError("more than 2^32 distinct words")
            seen = np.bincount(np.minimum(totals[known], RARE + 2), minlength=RARE + 3)[1:RARE + 2].tolist()
            yield records([{"block": -1, "bucket": bucket, "ids": squeeze_sorted(words[known]), "totals": squeeze(totals[known]), "seen": [int(totals.sum()), int(known.sum()), *seen]}], schema)
            at = 0
            for p, words_of in zip(packets, lists):
                mine = local[at:at + len(words_of)]
                at += len(words_of)
                yield records([{"block": p["block"], "bucket": bucket, "ids": squeeze(ids[mine]), "totals": squeeze(totals[mine]), "seen": None}], schema)

    packets = blocks.select("block", "words", "counts").mapInArrow(tidy(send), "bucket int, block long, words binary, counts binary")
    merged = packets.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block").mapInArrow(tidy(merge), "block long, bucket int, ids binary, totals binary, seen array<long>")
    merged.write.parquet(path)


def pair_table(known: DataFrame, path: str, buckets: int, words: Words, starts: int) -> None:
    """Count pairs over all blocks, as :func:`word_table` does words; history sums go with the answers."""
    share = max((words.n + starts) / (4 * buckets), 1.0)

    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("next", pa.binary()), ("split", pa.binary())])

    def sent(row: dict) -> Iterator[pa.RecordBatch]:
        block = Block(row)
        keys, _, counts = block.pairs()
        tokens, following = key_counts(block, keys, starts)
        bucket = pair_buckets(keys, tokens, share, buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for i in range(buckets):
            mine = order[cuts[i]:cuts[i + 1]]
            if len(mine):
                yield records([{
                    "bucket": i, "block": row["block"], "keys": squeeze_sorted(keys[mine]), "counts": squeeze(counts[mine]),
                    "next": squeeze(following[mine].astype(np.uint32)), "split": np.packbits(tokens[mine] > share).tobytes(),
                }], schema)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in one_by_one(batches):
            yield from sent(row)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("totals", pa.binary()), ("sums", pa.binary()), ("lower", pa.binary()), ("seen", pa.list_(pa.int64()))])
        for bucket, packets in groups(batches, "bucket"):
            lists = [expand_sorted(p["keys"]) for p in packets]
            keys, first, local = np.unique(np.concatenate(lists), return_index=True, return_inverse=True)
            totals = np.bincount(local, np.concatenate([expand(p["counts"], "<u4") for p in packets]), len(keys)).astype(np.int64)
            following = np.concatenate([expand(p["next"], "<u4") for p in packets])[first].astype(np.int64)
            split = np.concatenate([np.unpackbits(np.frombuffer(p["split"], np.uint8), count=len(k)) for p, k in zip(packets, lists)])[first].astype(bool)
            names, sums = history_sums(keys >> SHIFT, totals, words.p(following))
            seen = np.bincount(np.minimum(totals, RARE + 2), minlength=RARE + 3)[1:RARE + 2].tolist()
            parted = np.isin(names, distinct(keys[split] >> SHIFT))
            some = totals > 0
            yield records([{
                "block": -1, "bucket": bucket, "keys": squeeze_sorted(keys[some]), "totals": squeeze(totals[some].astype(np.uint32)),
                "sums": squeeze(names[parted]), "lower": sums[parted].tobytes(), "seen": seen,
            }], schema)
            at = 0
            for p, mine in zip(packets, lists):
                asked = np.searchsorted(names, distinct(mine >> SHIFT))
                yield records([{
                    "block": p["block"], "bucket": bucket, "keys": None, "totals": squeeze(totals[local[at:at + len(mine)]].astype(np.uint32)),
                    "sums": squeeze(sums[asked, :RARE + 1].astype(np.uint32).ravel()), "lower": squeeze(sums[asked, RARE + 1]), "seen": None,
                }], schema)
                at += len(mine)

    packets = known.mapInArrow(tidy(send), "bucket int, block long, keys binary, counts binary, next binary, split binary")
    merged = packets.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block").mapInArrow(tidy(merge), "block long, bucket int, keys binary, totals binary, sums binary, lower binary, seen array<long>")
    merged.write.parquet(path)


def key_counts(block: Block, keys: np.ndarray, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens of each key's history and next word, from the block's own words."""
    names, first = np.unique(block.ids, return_index=True)
    counts = block.counts[first].astype(np.int64)

    def of(ids: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(names, ids), len(names) - 1)
        return np.where(names[at] == ids, counts[at], 0)

    history = keys >> SHIFT
    return np.where(history == START, starts, np.where(history == UNKNOWN, 0, of(history))), np.where(keys & LOW == UNKNOWN, 0, of(keys & LOW))


def scores(known: DataFrame, buckets: int, words: Words, starts: int, d: np.ndarray, frequent: dict[int, np.ndarray]) -> DataFrame:
    share = max((words.n + starts) / (4 * buckets), 1.0)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def scored(row: dict) -> pa.RecordBatch:
        block = Block(row)
        keys, at, _ = block.pairs()
        tokens, _ = key_counts(block, keys, starts)
        bucket = pair_buckets(keys, tokens, share, buckets)
        order = np.argsort(bucket, kind="stable")
        answers = sorted(row["pairs_known"], key=lambda a: a["bucket"])
        totals = np.empty(len(keys), np.int64)
        totals[order] = np.concatenate([expand(a["totals"], "<u4") for a in answers])
        divisor, weight = np.ones(len(keys)), np.ones(len(keys))
        low = 0
        for a in answers:
            lower = expand(a["lower"], "<f8")
            sums = np.concatenate([expand(a["sums"], "<u4").reshape(len(lower), RARE + 1), lower[:, None]], axis=1)
            n = len(expand(a["totals"], "<u4"))
            mine = order[low:low + n]
            low += n
            names, which = np.unique(keys[mine] >> SHIFT, return_inverse=True)
            for i, name in enumerate(names.tolist()):
                if name in frequent:
                    sums[i] = frequent[name]
            parts = weights(sums, d)
            divisor[mine], weight[mine] = parts[0][which], parts[1][which]
        count = block.counts[block.next]
        shorter = np.log10(words.p(count)) + np.log10(weight[at])
        pair = totals[at]
        direct = np.log10(np.maximum(d[np.minimum(pair, RARE + 1)] * pair, 1e-300) / divisor[at])
        found = np.where(pair > 0, direct, shorter)
        lengths = block.ends - block.starts
        return pa.RecordBatch.from_arrays([
            pa.array(block.doc_ids, pa.int64()), pa.array(block.held_out), pa.array(lengths.astype(np.int64)),
            pa.array(np.add.reduceat((count > 0).astype(np.int64), block.starts)), pa.array(np.full(len(lengths), words.n, np.int64)),
            pa.array(np.add.reduceat(words.base(count), block.starts)), pa.array(np.add.reduceat(found, block.starts)),
        ], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(scored, one_by_one(batches))

    return known.mapInArrow(tidy(run), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def totals_of(spark: SparkSession, path: str) -> list[int]:
    """Sums of the buckets' ``seen``."""
    rows = spark.read.parquet(path).where("block = -1").select(F.posexplode("seen").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).collect()
    found = {r["i"]: r["n"] for r in rows}
    return [found.get(i, 0) for i in range(RARE + 3)]


def score(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``, ``held_out``): token numbers, ``base_score`` and ``score``.

    The model learns from rows that are not ``held_out``. NULL and empty texts are one end token;
    repeated rows are learned from and scored as often as they occur; with nothing to learn from, all
    scores are 0. Word and pair tables stay in the shared folder until the session ends.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = scratch_path(spark, "katz")
    delete_at_exit(spark, folder)
    with arrow_batches(spark, ROWS):
        blocks = store_bucketed(text_blocks(docs, block_chars), "block", buckets, f"{folder}/blocks")
    word_table(blocks, f"{folder}/words", buckets)
    n, distinct, *seen = totals_of(spark, f"{folder}/words")
    words = Words(n, distinct, seen)
    starts = blocks.agg(F.coalesce(F.sum("starts"), F.lit(0))).first()[0]

    def answers(path: str, *columns: str) -> DataFrame:
        rows = spark.read.parquet(path).where("block >= 0")
        return rows.groupBy("block").agg(F.collect_list(F.struct("bucket", *columns)).alias(path.rpartition("/")[2] + "_known"))

    known = blocks.select("block", "docs", "tokens").join(answers(f"{folder}/words", "ids", "totals"), "block")
    pair_table(known, f"{folder}/pairs", buckets, words, starts)
    d = discounts(totals_of(spark, f"{folder}/pairs")[:RARE + 1])
    frequent: dict[int, np.ndarray] = {}
    for r in spark.read.parquet(f"{folder}/pairs").where("block = -1").select("sums", "lower").collect():
        names = expand(r["sums"], "<u8").tolist()
        for history, sums in zip(names, np.frombuffer(r["lower"], "<f8").reshape(len(names), RARE + 2)):
            frequent[history] = frequent.get(history, 0) + sums
    both = known.join(answers(f"{folder}/pairs", "totals", "sums", "lower"), "block")
    return scores(both, buckets, words, starts, d, frequent)
