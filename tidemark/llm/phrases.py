"""Collocations by marginalising the counts of longest windows.

Every word of a piece opens one window: itself and the words behind it, up to the longest phrase, as
columns that lead the word by 0, 1, 2 ... places and are padded with NULL at the end of the piece. Only
these windows are counted. A phrase of k words occurs as often as windows start with it, so one Spark
ROLLUP over the window's columns sums the counts of all shorter phrases, down to the number of words.

Most longest windows of a corpus are unique and would outweigh the text. A window that goes on over a
pair of words too rare for any candidate is therefore padded from there on: pairs are first counted
as 64-bit hashes, and a filter of the frequent ones, sized by their number, says where a window ends.
It never cuts at a frequent pair, so the counts of all candidates and their parts stay exact. Likewise
windows that turn out rare once counted are padded before the ROLLUP, see :func:`common_windows`.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.align import blocks_of
from tidemark.llm.words import mixed
from tidemark.session import materialize

LONGEST, LEAST, SCALE, CONTAINED = 4, 30, 2_000_000, 80
#: Characters handled at a time, about, and parts that the windows of one pair of first words are dealt in.
BLOCK_CHARS, PARTS = 4_000_000, 16
#: Bits of the filter of frequent pairs for each of them, and the most in all (64 MB); beyond that it lets
#: more windows through, which costs shuffle, not correctness.
BITS_EACH, MOST_BITS = 16, 1 << 29
UNKNOWN = "und"

ENDS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"\xff"  # no byte of UTF-8
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + ENDS, b"abcdefghijklmnopqrstuvwxyz" + BREAK * len(ENDS))


class Words:
    """Words of several texts, one behind the other, as numbers; 0 where a piece ends."""

    def __init__(self, texts: list[str | None]):
        known: dict[bytes, int] = {BREAK: 0}
        every, lengths = [], []
        for text in texts:
            # what is left of white space after the translation is spaces and tabs
            found = (text or "").encode().translate(LOWER).replace(BREAK, b" " + BREAK + b" ").split()
            found.append(BREAK)
            every += [known.setdefault(w, len(known)) for w in found]
            lengths.append(len(found))
        self.number = np.array(every, np.int64)
        self.text = np.repeat(np.arange(len(texts)), lengths)
        self.words = list(known)

    def leads(self, k: int) -> np.ndarray:
        """The number ``k`` places behind each word, 0 beyond the end."""
        return np.concatenate([self.number[k:], np.zeros(min(k, len(self.number)), np.int64)])

    def pair_hashes(self, tongue: np.ndarray) -> np.ndarray:
        """Of each place: hash of its text's language (``tongue``), its word and the next word."""
        own = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        return mixed(mixed(own[self.number] * np.uint64(0x9E3779B97F4A7C15) + tongue[self.text]) + own[self.leads(1)])


def in_blocks(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("_lang"), F.col("text").alias("_text"))


def tongues(batch: pa.RecordBatch) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(x) for x in batch.column(0).to_pylist()), np.uint64, batch.num_rows)


def pair_counts(docs: DataFrame) -> DataFrame:
    """``pair`` (hash), ``n``, not yet summed over blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks_of(batches, BLOCK_CHARS):
            words = Words(batch.column(1).to_pylist())
            there = (words.number > 0) & (words.leads(1) > 0)
            pairs, n = np.unique(words.pair_hashes(tongues(batch))[there].view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n, pa.int64())], ["pair", "n"])

    return in_blocks(docs).mapInArrow(run, "pair long, n long")


def frequent_pairs(docs: DataFrame, least: int) -> tuple[Broadcast, int]:
    """A filter that holds the hashes of all pairs found ``least`` times or more, and its size in bits."""
    often = materialize(pair_counts(docs).groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("pair"))
    bits = 1 << 16
    while bits < min(MOST_BITS, BITS_EACH * often.count()):
        bits *= 2
    at = often.select((F.pmod("pair", F.lit(bits)) + 1).alias("p"))  # bitmaps count from 1
    table = np.zeros((bits // 32_768, 4096), np.uint8)
    parts = at.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    for row in parts.toLocalIterator():
        table[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return docs.sparkSession.sparkContext.broadcast(table.ravel()), bits


def distinct_rows(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first of each distinct row of number columns, and how many there are of it."""
    key = columns[0]
    for column in columns[1:]:
        key = np.unique(key, return_inverse=True)[1] * (int(column.max(initial=0)) + 1) + column
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return first, n


def window_counts(docs: DataFrame, longest: int, frequent: Broadcast, bits: int) -> DataFrame:
    """``lang``, ``w1`` ... (padded with NULL), ``part`` (by the third word), ``n``, not yet summed over blocks."""
    names = [f"w{k}" for k in range(1, longest + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = frequent.value
        for batch in blocks_of(batches, BLOCK_CHARS):
            words = Words(batch.column(1).to_pylist())
            at = (words.pair_hashes(tongues(batch)) & np.uint64(bits - 1)).astype(np.int64)
            on = (flags[at >> 3] >> (at & 7) & 1).astype(bool) & (words.leads(1) > 0)
            columns, going = [words.number], words.number > 0
            for k in range(1, longest):
                going = going & np.concatenate([on[k - 1:], np.zeros(min(k - 1, len(on)), bool)])
                columns.append(np.where(going, words.leads(k), 0))
            lang = batch.column(0).dictionary_encode()
            code = lang.indices.to_numpy().astype(np.int64)[words.text]
            here = np.flatnonzero(words.number > 0)
            if not len(here):
                continue
            first, n = distinct_rows([code[here], *(c[here] for c in columns)])
            first = here[first]
            text = pa.array([None, *words.words[1:]], pa.binary()).cast(pa.string())
            part = np.fromiter((zlib.crc32(w) % PARTS for w in words.words), np.int32, len(words.words))
            yield pa.RecordBatch.from_arrays([
                lang.dictionary.take(pa.array(code[first])), *(text.take(pa.array(c[first])) for c in columns),
                pa.array(part[columns[min(2, longest - 1)][first]]), pa.array(n, pa.int64()),
            ], ["lang", *names, "part", "n"])

    return in_blocks(docs).mapInArrow(run, ", ".join(["lang string", *(f"{c} string" for c in names), "part int", "n long"]))


def common_windows(windows: DataFrame, longest: int, least: int) -> DataFrame:
    """The windows summed up, and padded where their count is below ``least``.

    Windows that begin with the same two words and are of the same part meet in one task, so those that begin with
    the same three or more words do, and counts of such beginnings need no further shuffle. A last word goes where
    the beginning up to it is rare; the windows that this makes equal are one. Sums of all shorter beginnings, and of
    the common ones, stay as they are.
    """
    names = [f"w{k}" for k in range(1, longest + 1)]
    keys = ["lang", "w1", "w2", "part", *names[2:]]
    rows = windows.repartition("lang", "w1", "w2", "part").groupBy(*keys).agg(F.sum("n").alias("n"))
    for k in range(longest, 2, -1):
        here = F.col("n") if k == longest else F.sum("n").over(Window.partitionBy(*keys[:k + 2]))
        rows = rows.withColumn("_common", here >= least)
        rows = rows.withColumns({c: F.when(F.col("_common"), F.col(c)) for c in names[k - 1:]})
        rows = rows.groupBy(*keys).agg(F.sum("n").alias("n"))
    return rows


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``lang``, ``size``, ``phrase``, ``f``: all phrases of 1 to ``longest`` words found ``least`` times or more, and
    the number of words of each language (``size`` 0, ``phrase`` '')."""
    frequent, bits = frequent_pairs(docs, least)
    names = [f"w{k}" for k in range(1, longest + 1)]
    counted = common_windows(window_counts(docs, longest, frequent, bits), longest, least)
    summed = counted.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("_left"))
    # a prefix of k words leaves out the last columns, whose bits of the grouping id are set
    size = F.lit(longest) - F.bit_count("_left")
    rows = summed.where(F.col("_left") < 2**longest).withColumn("size", size.cast("int"))
    # prefixes that end in padding aren't phrases
    words = F.array_compact(F.array(*names))
    rows = rows.where((F.size(words) == F.col("size")) & ((F.col("f") >= least) | (F.col("size") == 0)))
    return materialize(rows.select("lang", "size", F.array_join(words, " ").alias("phrase"), "f"))


def first_words(phrase: Column, k: int) -> Column:
    return F.substring_index(phrase, " ", k)


def collocations(docs: DataFrame, top: int, longest: int = LONGEST, least: int = LEAST, contained: int = CONTAINED) -> DataFrame:
    """The best ``top`` phrases of each ``lang``: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A-Z are lower-cased; ``.,;:!?`` and line ends cut pieces, spaces and tabs words. Candidates are phrases of 2 to
    ``longest`` words found ``least`` times or more (``a``). Cut behind its first k words, a candidate scores
    2000000 * a / (l + r), rounded down, with ``l`` and ``r`` the counts of its two parts; its worst cut counts, of equal
    ones the shortest first part. Candidates inside a longer one that is found at least ``contained`` percent as often
    are left out. Equal scores are ranked by ``a``, then by the bytes of the phrase. ``n``: words of the language.

    NULL languages count as ``und``; NULL, empty and wordless texts have no words; repeated rows count each; texts of
    any length count whole; an empty table gives an empty one. Columns other than ``text`` and ``lang`` aren't looked at.
    """
    counts = phrase_counts(docs, longest, least)
    candidates = counts.where("size >= 2").withColumnRenamed("f", "a")
    parts = counts.where(F.col("size").between(1, longest - 1))
    words = F.split("phrase", " ")

    def joined(start, length) -> Column:
        return F.array_join(F.slice(words, start, length), " ")

    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("head"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    cut = cut.join(parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cut = cut.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    # decimals of 38 digits hold the product of any two counts
    a, both = F.col("a").cast("decimal(19,0)"), F.col("l").cast("decimal(19,0)") + F.col("r")
    product = a * F.lit(SCALE).cast("decimal(7,0)")
    score = ((product - product % both) / both).cast("long")
    scored = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # the counts of the longer candidates that hold a phrase
    longer = candidates.where("size >= 3").withColumn("short", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("short") + 1)))
    inside = longer.select("lang", joined(F.col("at"), F.col("short")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("holder"))
    within = inside.where(F.col("holder").isNotNull())
    ten = F.col("holder").cast("decimal(25,0)") * 100 >= F.col("a").cast("decimal(25,0)") * contained
    free = scored.join(within, ["lang", "phrase"], "left").where(F.col("holder").isNull() | ~ten)

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = free.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    total = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
