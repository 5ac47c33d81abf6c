"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed once from its start: each phrase is the longest one seen before and one
more character, and joins the dictionary. Texts that compress well together share phrases.
The phrases are hashed along the parse, and a fingerprint holds the ``SIZE`` smallest hashes
of the phrase set (all of them for short texts), so two fingerprints estimate the share of
common phrases.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.katz import distinct

#: Hashes in a fingerprint; the likeness has a standard error of at most 0.5 / sqrt(SIZE).
SIZE = 128
#: The hash of no phrase. Each further character: times FACTOR, and its code point and 1 more, modulo 2^64.
ROOT, FACTOR = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
INVERSE = pow(FACTOR, -1, 1 << 64)
#: Steps to a phrase's end one by one; beyond, the interval is halved.
NEAR = 12
#: Powers kept.
KEPT = 1 << 17


_powers: dict[int, np.ndarray] = {}


def powers(of: int, n: int) -> np.ndarray:
    """Of 0 to n - 1, modulo 2^64; as many as most texts need are kept."""
    if n <= KEPT and of in _powers:
        return _powers[of][:n]
    factors = np.full(max(n, KEPT), of, np.uint64)
    factors[0] = 1
    made = np.cumprod(factors, dtype=np.uint64)
    _powers.setdefault(of, made[:KEPT].copy())
    return made[:n]


def phrase_hashes(text: str, ends: list[int]) -> np.ndarray:
    """Hashes of phrases that lie one behind the other; ``ends`` begins with 0."""
    n = ends[-1]
    if not n:
        return np.zeros(0, np.uint64)
    at = np.array(ends)
    points = np.frombuffer(text[:n].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    # the odd factor has an inverse, so sums from the start of the text serve every phrase
    sums = np.append(np.uint64(0), np.cumsum(points * powers(INVERSE, n), dtype=np.uint64))
    raised = powers(FACTOR, n + 1)
    return np.uint64(ROOT) * raised[np.diff(at)] + raised[at[1:] - 1] * np.diff(sums[at])


class Parser:
    """The phrases of one parse with their ends, in order. With a phrase all its beginnings are phrases too, so the longest
    one is found from a likely length on."""

    def __init__(self) -> None:
        self.children: dict[str, int] = {}
        self.open = ""  # a phrase seen before, at the end of what was parsed
        self.parts = [np.zeros(0, np.uint64)]

    def copy(self) -> Parser:
        other = Parser.__new__(Parser)
        other.children, other.open, other.parts = self.children.copy(), self.open, self.parts.copy()
        return other

    @property
    def hashes(self) -> list[int]:
        """The hash of no phrase, and those of the phrases in order."""
        return [ROOT, *np.concatenate(self.parts).tolist()]

    def feed(self, text: str) -> Parser:
        text, children = self.open + text, self.children
        before, last, at, end, size = len(children), len(text), 0, 0, 3
        while at < last >= end:
            first = at
            for _ in range(64):
                end = at + size
                phrase = text[at:end]
                if phrase in children:
                    end += 1
                    phrase = text[at:end]
                    while phrase in children and end <= last:
                        end = end + 1 if end < at + size + NEAR else self.cut(text, at, end)
                        phrase = text[at:end]
                    if end > last:
                        break
                else:
                    end -= 1
                    known = text[at:end]
                    while known and known not in children:
                        end -= 1
                        phrase, known = known, text[at:end]
                    end += 1
                children[phrase] = at = end
                if at >= last:
                    break
            size = max(1, min((at - first) // 64, NEAR))
        self.open = text[at:]
        self.parts.append(phrase_hashes(text, [0, *itertools.islice(children.values(), before, None)]))
        return self

    def cut(self, text: str, at: int, low: int) -> int:
        """End of the shortest new phrase from ``at`` on, which is beyond ``low``; behind the text if there is none."""
        last = len(text)
        high = low + 1
        while high <= last and text[at:high] in self.children:
            low, high = high, at + 2 * (high - at)
        high = min(high, last + 1)
        while high - low > 1:
            middle = (low + high) // 2
            if text[at:middle] in self.children:
                low = middle
            else:
                high = middle
        return high

    def signature(self, size: int = SIZE) -> np.ndarray:
        """Sorted smallest 32-bit hashes of the phrase set."""
        h = np.concatenate(self.parts)
        for shift, factor in ((32, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        return distinct((h >> np.uint64(32)).astype(np.uint32))[:size]


def to_text(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated share of common phrases: among the smallest of both together, those in both."""
    if not len(a) and not len(b):
        return 1.0
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:] == both[:-1]
    smallest = both[np.append(True, ~twice)][:size]
    return float(np.count_nonzero(both[1:][twice] <= smallest[-1]) / len(smallest))


def fingerprints(docs: DataFrame, size: int = SIZE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fingerprint`` (hex) of every whole ``text``; '' for NULL and empty texts."""
    source = docs.select(*keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([to_text(Parser().feed(t or "").signature(size)) for t in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), made], [*keep, "fingerprint"])

    kinds = dict(source.dtypes)
    return source.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "fingerprint string"]))


def with_followers(docs: DataFrame) -> DataFrame:
    """Rows laid out so that each document is followed by the next one in descending ``doc_id``.

    Columns ``doc_id``, ``text``, ``block``, ``lead``. Keys are cut into as many blocks as there are
    shuffle partitions; texts are shuffled once. The first document of every block is sent to the
    block before as well (``lead``), and the very first to the last block, to close the circle.
    Equal ids follow each other by a hash of their texts; NULL ids come last.
    """
    spark = docs.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    cuts = docs.where("doc_id is not null").approxQuantile("doc_id", [i / blocks for i in range(1, blocks)], 0.1 / blocks) if blocks > 1 else []
    bounds = np.unique(np.array(cuts, float))

    @F.pandas_udf("int")
    def block_of(ids: pd.Series) -> pd.Series:  # the highest ids come first, NULL last
        at = np.searchsorted(bounds, ids.astype("float64").to_numpy(na_value=-np.inf), side="right")
        return pd.Series(len(bounds) - at, dtype="int32")

    dealt = keyed.withColumn("block", block_of("doc_id"))
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "tie")
    # one row for each block
    heads = sorted(dealt.groupBy("block").agg(F.max(order).alias("head")).select("block", "head.doc_id", "head.tie").collect())
    before = [(heads[i - 1]["block"], h["doc_id"], h["tie"]) for i, h in enumerate(heads)]
    leads = spark.createDataFrame(before, "lead_to int, doc_id long, tie long")
    extra = keyed.join(F.broadcast(leads), keyed["doc_id"].eqNullSafe(leads["doc_id"]) & (keyed["tie"] == leads["tie"]))
    extra = extra.select(keyed["doc_id"], keyed["text"], keyed["tie"], F.col("lead_to").alias("block"), F.lit(True).alias("lead"))
    rows = dealt.select("doc_id", "text", "tie", "block", F.lit(False).alias("lead")).unionByName(extra)
    return rows.repartition(blocks, "block").sortWithinPartitions("block", "lead", F.desc_nulls_last("doc_id"), F.desc("tie")).drop("tie")


def compare_with_edits(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Fingerprints of every text, of an edited copy and of the next document, and their likeness.

    The edited copy has the last third of the text replaced by the start of the next document in
    descending ``doc_id`` (see :func:`with_followers`). Per row: ``doc_id``, ``n_chars``, ``edited``
    (text), ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``. The parse of the
    unchanged part is shared; each text is parsed in full.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def parsed(text: str, after: str) -> tuple[np.ndarray, np.ndarray, str]:
        cut = len(text) - len(text) // 3
        start = Parser().feed(text[:cut])
        edited = text[:cut] + after[:len(text) - cut]
        other = start.copy().feed(edited[cut:]).signature(size) if edited != text else None
        own = start.feed(text[cut:]).signature(size)
        return own, own if other is None else other, edited

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # block, doc_id and text of a document whose follower is the next row
        waiting: list[tuple] = []  # the finished row whose successor's fingerprint is still to come
        done: list[tuple] = []

        def settle(next_signature: np.ndarray) -> None:
            for doc_id, n, edited, own, other in waiting:
                done.append((doc_id, n, edited, to_text(own), to_text(other), likeness(own, other, size), likeness(own, next_signature, size)))
            waiting.clear()

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "block", "lead")))

        for doc_id, text, block, lead in rows():
            if held and held[0] == block:
                own, other, edited = parsed(held[2], text)
                settle(own)
                waiting.append((held[1], len(held[2]), edited, own, other))
                if lead:
                    settle(Parser().feed(text).signature(size))
            held = None if lead else (block, doc_id, text)
            if len(done) >= 200:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)
                done.clear()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)

    laid = with_followers(docs.withColumn("doc_id", F.col("doc_id").cast("long")))
    return laid.mapInArrow(run, "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
