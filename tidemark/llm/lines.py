"""Removal of lines that repeat, exactly or up to one edit, an earlier line of the corpus.

Lines are ordered by ``doc_id`` (NULL last), a hash of the text, and their number. Equal lines
(blanks around them aside) are one distinct line first. Distinct lines within edit distance 1 are
found by their deletion neighbourhood: a line emits the hash of itself and of every variant with
one character deleted, together with the place of the deletion. Two lines that share a variant at the
same place differ by one substitution; a line equal to a variant of another differs by one
deletion. So each group of equal keys needs only its earliest line, and no pairs are listed;
what is found is verified by edit distance. A group holds at most one line for each character
(and place), as equal lines are one already.

Not every line needs its neighbourhood: cut in the middle, two lines within one edit agree in one
half. Only lines that share a half with another distinct line of a fitting length emit variants;
this leaves nothing out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.members import likely_members
from tidemark.llm.memory import let_go, tidy
from tidemark.session import materialize

#: White space of any kind is no text, so a lone tab or carriage return makes no line either.
VISIBLE = r"(?U)\S"
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def all_lines(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``tie``, ``number``, ``line`` (without blanks around it) of every line with visible text."""
    # what is made from the text first, or every line would carry the whole text along
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    split = named.select("doc_id", "tie", F.posexplode(F.split("text", "\n")).alias("number", "raw"))
    return split.where(visible("raw")).select("doc_id", "tie", "number", F.trim("raw").alias("line"))


def visible(column: str) -> Column:
    """Whether a string has visible text. Nearly all begin with a visible ASCII character, which compares bytes only."""
    return ((F.col(column) >= "!") & (F.col(column) < "\x7f")) | F.col(column).rlike(VISIBLE)


def line_id() -> list[Column]:
    """128 bits that name a line."""
    return [F.xxhash64("line").alias("h"), F.xxhash64("line", F.lit(1)).alias("g")]


def place() -> Column:
    """Where a line stands in the corpus; comparable, the earliest is the least."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "number").alias("at")


def half_keys(line: Column, n: Column) -> Column:
    """The halves that a line shares with any line within one edit: as long as it, or as the longer of both."""
    def halves(longer: Column) -> list[Column]:
        front, back = F.floor(longer / 2).cast("int"), (longer - F.floor(longer / 2)).cast("int")
        return [
            F.xxhash64(F.lit("front"), longer, F.substring(line, F.lit(1), front)),
            F.xxhash64(F.lit("back"), longer, F.substring(line, n - back + 1, back)),
        ]

    return F.array(*halves(n), *halves(n + 1))


def variants(lines: DataFrame) -> DataFrame:
    """``key``, ``cut`` (place of the deletion, -1: the line itself), ``h`` of distinct lines."""
    schema = pa.schema([("key", pa.int64()), ("cut", pa.int32()), ("h", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go("lines")
        powers = np.ones(1, np.uint64)
        for batch in batches:
            for line, h in zip(*(batch.column(c).to_pylist() for c in ("line", "h"))):
                points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
                n = len(points)
                if len(powers) < n:
                    powers = np.cumprod(np.append(np.ones(1, np.uint64), np.full(2 * n, BASE, np.uint64)), dtype=np.uint64)
                terms = (points * np.uint64(0xD6E8FEB86659FD93) ^ (points << np.uint64(29))) * powers[:n]
                upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
                # what stands behind the deletion moves one place forward
                without = upto[:-1] + (upto[-1] - upto[1:]) * np.uint64(INVERSE)
                keys = np.concatenate([upto[-1:], without]).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys), pa.array(np.arange(-1, n, dtype=np.int32)), pa.array(np.full(n + 1, h, np.int64)),
                ], schema=schema)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches of about 100,000 rows."""
        held: list[pa.RecordBatch] = []
        rows = 0
        for part in run(batches):
            held.append(part)
            rows += part.num_rows
            if rows >= 100_000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return lines.select("line", "h").mapInArrow(tidy(joined), "key long, cut int, h long")


def near_repeats(docs: DataFrame) -> DataFrame:
    """``h``, ``g`` of the distinct lines that are within one edit of an earlier, different line."""
    spread = all_lines(docs).select(line_id()[0], half_keys(F.col("line"), F.length("line")).alias("halves")).select("h", F.explode("halves").alias("half"))
    shared = materialize(spread.groupBy("half").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low < high").select("half"))
    likely = likely_members(shared, "half")
    candidates = materialize(spread.where(likely(F.col("half"))).join(shared, "half", "left_semi").select("h").distinct())
    likely = likely_members(candidates, "h")
    texts = all_lines(docs).select(*line_id(), place(), "line").where(likely(F.col("h")))
    # one row a distinct line before the join: short lines are candidates as a rule, and some stand in most documents
    distinct = texts.groupBy("h", "g").agg(F.min("at").alias("at"), F.first("line").alias("line"))
    lines = materialize(distinct.join(candidates, "h", "left_semi"))

    same_place, same_key = Window.partitionBy("key", "cut"), Window.partitionBy("key")
    several = variants(lines).withColumn("low", F.min("h").over(same_key)).withColumn("high", F.max("h").over(same_key))
    rows = several.where("low < high").select("key", "cut", "h").join(lines.select("h", "g", "at"), "h")
    who = F.struct("at", "h", "g")
    met = (
        rows.withColumn("swapped", F.min(who).over(same_place))
        .withColumn("whole", F.min(F.when(F.col("cut") < 0, who)).over(same_key))
        .withColumn("longer", F.min(F.when(F.col("cut") >= 0, who)).over(same_key))
        .withColumn("other", F.explode(F.array(F.when(F.col("cut") >= 0, F.col("swapped")), F.when(F.col("cut") >= 0, F.col("whole")), F.when(F.col("cut") < 0, F.col("longer")))))
        .where("other.at < at")
        .select("h", "g", F.col("other.h").alias("oh"), F.col("other.g").alias("og")).distinct()
    )
    text = lines.select("h", "g", "line")
    pairs = met.join(text, ["h", "g"]).join(text.toDF("oh", "og", "earlier"), ["oh", "og"])
    return pairs.where(F.levenshtein("line", "earlier", 1).between(0, 1)).select("h", "g").distinct()


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``tie`` and ``removed`` (numbers of its lines from 0) of documents with repeated lines."""
    lines = all_lines(docs).select(*line_id(), place())
    again = lines.groupBy("h", "g").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").select("h", "g", "first")
    near = materialize(near_repeats(docs)).select("h", "g", F.lit(True).alias("near"))
    judged = lines.join(again.join(near, ["h", "g"], "full_outer"), ["h", "g"]).where("near or at > first")
    return judged.groupBy("at.doc_id", "at.tie").agg(F.collect_set("at.number").alias("removed"))


def _judged(docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` as ``_0``, ``_1`` ..., whatever their names, ``text`` without repeated lines, ``n_lines``, ``n_removed``."""
    numbered = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*(F.col(c).alias(n) for c, n in numbered.items()))
    id_, text_ = F.col(numbered["doc_id"]), F.col(numbered["text"])
    keyed = own.withColumn("tie", F.xxhash64(text_))
    plain = own.select(id_.alias("doc_id"), text_.alias("text"))
    gone = materialize(repeats(plain)).select(F.col("doc_id").alias("at_doc"), F.col("tie").alias("at_tie"), "removed")
    likely = likely_members(gone.select(F.xxhash64(F.coalesce(F.col("at_doc"), F.lit(-1)), "at_tie").alias("name")), "name")
    flagged = keyed.withColumn("likely", likely(F.xxhash64(F.coalesce(id_, F.lit(-1)), "tie")))
    ends = F.octet_length(text_) - F.octet_length(F.replace(text_, F.lit("\n"), F.lit("")))
    counted = flagged.withColumn("n_lines", F.coalesce(ends + 1, F.lit(0)))
    untouched = counted.where("not likely").withColumn("n_removed", F.lit(0)).withColumn("text", text_)
    rest = counted.where("likely").join(gone, id_.eqNullSafe(F.col("at_doc")) & (F.col("tie") == F.col("at_tie")), "left").drop("at_doc", "at_tie")
    numbers = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), F.col("removed"))
    kept = F.array_join(F.transform(numbers, lambda i: F.element_at("lines", i + 1)), "\n")
    changed = (
        rest.withColumn("lines", F.split(text_, "\n"))
        .withColumn("text", F.when(F.col("removed").isNull(), text_).otherwise(kept))
        .withColumn("n_removed", F.coalesce(F.when(F.col("removed").isNotNull(), F.size("removed")), F.lit(0))).drop("lines", "removed")
    )
    both = untouched.unionByName(changed).drop("likely")
    twice = keyed.groupBy(id_, "tie").agg(F.count("*").alias("n")).where("n > 1")
    if not twice.isEmpty():
        both = both.dropDuplicates([numbered["doc_id"], "tie"])
    return both.drop("tie")


def remove_repeated_lines(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without repeated lines, ``n_lines`` and ``n_removed`` added.

    A line with visible text, however short, goes if an equal line, or one within edit distance 1, stands
    earlier in the corpus; the others and blank lines keep their order. NULL texts stay NULL (0 lines), '' has one line.
    Repeated rows (equal id and text) become one. Columns may have any names; those of the input named ``n_lines`` or
    ``n_removed`` give way to the numbers counted here. An empty table gives an empty one.
    """
    done = _judged(docs)
    added = ("n_lines", "n_removed")
    columns = [("text" if c == "text" else f"_{i}", c) for i, c in enumerate(docs.columns) if c not in added]
    return done.select(*(F.col(n).alias(c) for n, c in columns), *added)


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """Columns of ``docs``; documents that lose lines go if no visible text is left, ``n_chars`` is counted anew if present.

    Other columns, whatever their names, keep their values; else as :func:`remove_repeated_lines`.
    """
    done = _judged(docs).where(F.col("text").isNull() | (F.col("n_removed") == 0) | visible("text"))
    columns = {c: F.col(f"_{i}") for i, c in enumerate(docs.columns)} | {"text": F.col("text")}
    if "n_chars" in columns:
        counted = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        columns["n_chars"] = F.when(F.col("n_removed") > 0, counted).otherwise(columns["n_chars"])
    return done.select(*(columns[c].alias(c) for c in docs.columns))
