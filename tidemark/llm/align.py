"""Alignment of the tokens that two tokenizers give for the same texts.

Both token sequences of a text cover the same bytes. They are merged in lockstep: one state vector
holds, for every text of a block, how far its A and its B tokens are merged; a step links the two
tokens at the front of each text, moves on behind the one that ends first (behind both, with a cut,
if they end together), and texts that are through leave the vector. Long texts enter as several
stretches that start behind an A token, so a block takes few steps whatever its texts.

How often two ids are linked in the whole corpus is counted from the blocks: each has its distinct id
pairs once, as rows that Spark sums and joins back to the block; links themselves are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.katz import expand, expand_sorted, squeeze, squeeze_sorted
from tidemark.llm.memory import Remembered, only
from tidemark.llm.tokens import byte_letters, new_encoder
from tidemark.session import materialize

#: Characters gathered in a block, about, and A tokens of a stretch.
BLOCK_CHARS, STRETCH = 3_000_000, 512


class Vocabulary:
    """Ids of texts, and the bytes of each id. ``lossless``: ids always spell the text."""

    def __init__(self, encode: Callable[[str], np.ndarray], pieces: list[bytes], lossless: bool):
        self.encode, self.pieces, self.lossless = encode, pieces, lossless
        self.lengths = np.array([len(p) for p in pieces], np.int64)

    def spells(self, ids: np.ndarray, text: bytes) -> bool:
        """Whether the tokens, joined, are this text, and none is empty."""
        lengths = self.lengths[ids]
        if int(lengths.sum()) != len(text) or not lengths.all():
            return False
        return self.lossless or b"".join(map(self.pieces.__getitem__, ids.tolist())) == text


def byte_level(path: str, pattern: str) -> Vocabulary:
    """A byte-level vocabulary file, over a space and the text; special tokens in a text are ordinary text."""
    from tokenizers import Tokenizer

    memory, tokenizer = new_encoder(path, pattern), Tokenizer.from_file(path)
    letters = {c: b for b, c in byte_letters().items()}
    entries = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
    pieces = [bytes(letters[c] for c in e) if all(c in letters for c in e) else e.encode() for e in entries]
    every_byte = all(c in set(entries) for c in letters)
    return Vocabulary(lambda text: np.frombuffer(memory.encode_behind_space(text), "<u4").astype(np.int64), pieces, every_byte)


def sentence_pieces(path: str) -> Vocabulary:
    """A SentencePiece model, over the text; it puts a space before it.

    Words that come again are remembered. That needs pieces with spaces at their start only, so that no merge goes
    over a single space; texts with other spaces, and models with other pieces, go through the library whole.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces, apart = [], True
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            pieces.append(bytes([int(piece[1:-1], 16)]))
        else:
            pieces.append(piece.replace("▁", " ").encode())
            apart &= "▁" not in piece.lstrip("▁") or model.is_control(i) or model.is_unknown(i)

    def packed(text: str) -> bytes:
        return np.array(model.encode(text, num_threads=1), "<u4").tobytes()

    words = Remembered(packed)

    def encode(text: str) -> np.ndarray:
        if apart and "  " not in text and text[0] != " " and text[-1] != " ":
            ids = b"".join(map(words.__getitem__, text.split(" ")))
        else:
            ids = packed(text)
        return np.frombuffer(ids, "<u4").astype(np.int64)

    return Vocabulary(encode, pieces, False)


def vocabularies(byte_path: str, pattern: str, piece_path: str) -> tuple[Vocabulary, Vocabulary]:
    """The two that a worker keeps from task to task of a stage."""
    return only(("align", byte_path, pattern, piece_path), lambda: (byte_level(byte_path, pattern), sentence_pieces(piece_path)))


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray, stretch: int = STRETCH):
    """Links (A index, B index) in order, and which A and which B tokens end at a cut.

    ``a_ends``, ``b_ends``: rising byte ends of all tokens of the block, one text behind the other;
    ``a_first``: index of the first A token of each text that has tokens.
    """
    n_a, n_b = len(a_ends), len(b_ends)
    a_cut, b_cut = np.zeros(n_a, bool), np.zeros(n_b, bool)
    if not n_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), a_cut, b_cut
    bounds = [*a_first.tolist(), n_a]
    i = np.concatenate([np.arange(low, high, stretch) for low, high in zip(bounds[:-1], bounds[1:])])
    stop = np.append(i[1:], n_a)
    # the B token that covers the first byte of the stretch
    j = np.searchsorted(b_ends, np.where(i > 0, a_ends[np.maximum(i, 1) - 1], 0), side="right")
    # a stretch has a link for each of its tokens at most, the B token that it shares with the next one included
    most = (stop - i) + np.append(j[1:], n_b) - j + 1
    place = np.cumsum(most) - most
    left, right = np.full(int(most.sum()), -1, np.int64), np.zeros(int(most.sum()), np.int64)
    while len(i):
        left[place], right[place] = i, j
        a_end, b_end = a_ends[i], b_ends[j]
        both = a_end == b_end
        a_cut[i[both]], b_cut[j[both]] = True, True
        i, j, place = i + (a_end <= b_end), j + (b_end <= a_end), place + 1
        going = i < stop
        if not going.all():
            i, j, place, stop = i[going], j[going], place[going], stop[going]
    there = left >= 0
    return left[there], right[there], a_cut, b_cut


@dataclass
class Block:
    """Aligned texts of a block: ids of all of them, one behind the other, with links and cuts."""

    a: np.ndarray
    b: np.ndarray
    a_start: np.ndarray  # index of the first A token of each text, and the number of all
    b_start: np.ndarray
    left: np.ndarray
    right: np.ndarray
    a_cut: np.ndarray
    b_cut: np.ndarray

    def group_texts(self) -> Iterator[str]:
        """Of each text: its groups as ``a1,a2|b1;a3|b2,b3``."""
        a_group, b_group = np.cumsum(self.a_cut) - self.a_cut, np.cumsum(self.b_cut) - self.b_cut
        a_from = np.concatenate([[0], np.flatnonzero(self.a_cut) + 1])
        b_from = np.concatenate([[0], np.flatnonzero(self.b_cut) + 1])
        # tokens of a group: all of A, then all of B
        words = np.empty(len(self.a) + len(self.b), object)
        for ids, cut, place, last in (
            (self.a, self.a_cut, np.arange(len(self.a)) + b_from[a_group], "|"),
            (self.b, self.b_cut, np.arange(len(self.b)) + a_from[b_group + 1] if len(self.b) else np.zeros(0, int), ";"),
        ):
            names, number = np.unique(ids, return_inverse=True)
            texts = np.array([f"{x}{sign}" for x in names.tolist() for sign in (",", last)], object)
            words[place] = texts[2 * number + cut] if len(ids) else texts
        start = (self.a_start + self.b_start).tolist()
        for low, high in zip(start[:-1], start[1:]):
            yield "".join(words[low:high].tolist())[:-1]

    def links_of(self) -> np.ndarray:
        """Index of the first link of each text, and the number of all."""
        return np.searchsorted(self.left, self.a_start, side="left")


def align_texts(texts: list[str | None], first: Vocabulary, second: Vocabulary) -> Block:
    """Alignment of ``texts``; NULL and empty ones, and those that a vocabulary doesn't spell, have no tokens."""
    a_ids, b_ids = [], []
    nothing = np.zeros(0, np.int64)
    for text in texts:
        a = b = nothing
        if text:
            spelled = b" " + text.encode()  # what both stand for
            a, b = first.encode(text), second.encode(text)
            if not (first.spells(a, spelled) and second.spells(b, spelled)):
                a = b = nothing
        a_ids.append(a)
        b_ids.append(b)
    a, b = np.concatenate([nothing, *a_ids]), np.concatenate([nothing, *b_ids])
    a_start, b_start = (np.cumsum([0, *map(len, ids)]) for ids in (a_ids, b_ids))
    a_first = np.unique(a_start[:-1][np.diff(a_start) > 0])
    return Block(a, b, a_start, b_start, *lockstep(np.cumsum(first.lengths[a]), np.cumsum(second.lengths[b]), a_first))


def blocks_of(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[pa.RecordBatch]:
    """Batches cut and joined so that each holds about ``chars`` characters of its last column."""
    parts, held = [], 0
    for whole in batches:
        lengths = np.array([len(t or "") + 8 for t in whole.column(whole.num_columns - 1).to_pylist()], np.int64)
        low = 0
        for at, n in enumerate(lengths.tolist()):
            held += n
            if held >= chars:
                parts.append(whole.slice(low, at + 1 - low))
                yield pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                parts, held, low = [], 0, at + 1
        if low < whole.num_rows:
            # a copy, so that the batch it came from can go
            parts.append(pa.Table.from_batches([whole.slice(low)]).combine_chunks().to_batches()[0])
    if parts:
        yield pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def align(docs: DataFrame, byte_path: str, pattern: str, piece_path: str, *keep: str) -> DataFrame:
    """``keep`` columns, ``a_ids``, ``b_ids``, ``links`` (places of linked tokens: a, b) and ``cuts`` (how many A and
    B tokens lie before and in each group) of every whole ``text``.

    A: a byte-level vocabulary file, over a space and the text; B: a SentencePiece model, over the text. NULL and
    empty texts, and those that a vocabulary doesn't spell, have empty lists. Rows are neither merged nor
    dropped.
    """
    source = docs.select(*keep, F.col("text").alias("_text"))
    names = source.columns[:-1]
    pair = pa.struct([("a", pa.int32()), ("b", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = vocabularies(byte_path, pattern, piece_path)
        for batch in blocks_of(batches, BLOCK_CHARS // 4):
            block = align_texts(batch.column(len(names)).to_pylist(), first, second)
            row_a, row_b = block.a_start, block.b_start
            at = block.links_of()
            a_of, b_of = np.repeat(row_a[:-1], np.diff(at)), np.repeat(row_b[:-1], np.diff(at))
            a_cut, b_cut = np.flatnonzero(block.a_cut), np.flatnonzero(block.b_cut)
            cut_at = np.searchsorted(a_cut, row_a)
            text_of = np.repeat(np.arange(len(row_a) - 1), np.diff(cut_at))

            def lists(offsets, *values):
                fields = pa.StructArray.from_arrays([pa.array(v, pa.int32()) for v in values], fields=list(pair))
                return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields)

            yield pa.RecordBatch.from_arrays([
                *batch.columns[:-1],
                pa.ListArray.from_arrays(pa.array(row_a, pa.int32()), pa.array(block.a, pa.int32())),
                pa.ListArray.from_arrays(pa.array(row_b, pa.int32()), pa.array(block.b, pa.int32())),
                lists(at, block.left - a_of, block.right - b_of),
                lists(cut_at, a_cut + 1 - row_a[text_of], b_cut + 1 - row_b[text_of]),
            ], [*names, "a_ids", "b_ids", "links", "cuts"])

    kinds = [*(f"`{c}` {k}" for c, k in source.dtypes[:-1]), "a_ids array<int>", "b_ids array<int>"]
    return source.mapInArrow(run, ", ".join([*kinds, "links array<struct<a: int, b: int>>", "cuts array<struct<a: int, b: int>>"]))


#: Columns of a text before the pairs are counted.
COUNTED = ("doc_id", "n_a", "n_b", "n_groups", "n_links")


def summarised(docs: DataFrame, byte_path: str, pattern: str, piece_path: str, chars: int) -> DataFrame:
    """One row per block: ``texts`` (its texts' ids, counts and group digests, and how often each of the block's id pairs
    is linked in each text, as an Arrow stream), and the block's distinct ``pairs`` with their ``totals``, as packed arrays."""
    schema = pa.schema([("block", pa.int64()), ("texts", pa.binary()), ("pairs", pa.binary()), ("totals", pa.binary())])
    numbers = [(c, pa.list_(pa.int64())) for c in (*COUNTED, "n_pairs")]
    layout = pa.schema([*numbers, ("groups_sha256", pa.list_(pa.string())), ("used", pa.binary()), ("uses", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = vocabularies(byte_path, pattern, piece_path)
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(blocks_of(batches, chars)):
            block = align_texts(batch.column(1).to_pylist(), first, second)
            at = block.links_of()
            text = np.repeat(np.arange(batch.num_rows), np.diff(at))
            pairs, pair, totals = np.unique(block.b[block.right] << 32 | block.a[block.left], return_inverse=True, return_counts=True)
            bags, uses = np.unique(text << 32 | pair, return_counts=True)
            shas = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in block.group_texts()]
            cuts = np.concatenate([[0], np.cumsum(block.a_cut)])[block.a_start]
            row = pa.RecordBatch.from_pylist([{
                "doc_id": batch.column(0).to_pylist(), "n_a": np.diff(block.a_start), "n_b": np.diff(block.b_start),
                "n_groups": np.diff(cuts), "n_links": np.diff(at), "n_pairs": np.bincount(bags >> 32, minlength=batch.num_rows),
                "groups_sha256": shas, "used": squeeze((bags & 0xFFFFFFFF).astype("<u4")), "uses": squeeze(uses.astype("<u4")),
            }], layout)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, layout) as stream:
                stream.write_batch(row)
            yield pa.RecordBatch.from_pylist([{
                "block": task << 32 | number, "texts": sink.getvalue().to_pybytes(),
                "pairs": squeeze_sorted(pairs.astype("<u8")), "totals": squeeze(totals.astype("<u8")),
            }], schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "block long, texts binary, pairs binary, totals binary")


def block_pairs(blocks: DataFrame) -> DataFrame:
    """``block``, ``place`` (in the block's sorted pairs), ``pair``, ``n`` (links in the block)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs, totals = expand_sorted(row["pairs"]).view(np.int64), expand(row["totals"], "<u8").view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), row["block"])), pa.array(np.arange(len(pairs), dtype=np.int32)), pa.array(pairs), pa.array(totals)],
                    ["block", "place", "pair", "n"],
                )

    return blocks.select("block", "pairs", "totals").mapInArrow(run, "block long, place int, pair long, n long")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair``, ``total`` (links that hold it in the corpus), ``best`` (whether no pair of its B id has more)."""
    counted = materialize(block_pairs(blocks).groupBy("pair").agg(F.sum("n").alias("total")))
    b = F.shiftright("pair", 32)
    most = counted.groupBy(b.alias("b")).agg(F.max("total").alias("most"))
    # one row of two numbers per id of B, so the vocabulary bounds it
    return counted.join(F.broadcast(most), b == F.col("b")).select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def alignment_summary(docs: DataFrame, byte_path: str, pattern: str, piece_path: str, chars: int = BLOCK_CHARS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    Vocabularies as in :func:`align`. A pair of an A and a B id counts as often as links hold it in all texts;
    ``count_sum`` is the sum of these counts over the links of the text, ``n_best`` the number of links whose pair has
    the highest count of its B id (all, where several have it). NULL, empty and misspelled texts have zeros and ''
    as digest. Repeated rows count each; ids may be NULL; an empty table gives an empty one.
    """
    blocks = materialize(summarised(docs, byte_path, pattern, piece_path, chars))
    # few narrow columns: there are many more of these rows than texts
    total = F.when(F.col("best"), F.col("total")).otherwise(-F.col("total"))
    found = block_pairs(blocks).select("block", "place", "pair").join(pair_counts(blocks), "pair").select("block", "place", total.alias("total"))
    # a block's totals, in the order of its pairs, and behind them the block
    whole = blocks.select("block", F.lit(LAST).alias("place"), "texts")
    laid = found.unionByName(whole, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            low = 0
            for at in np.flatnonzero(batch.column("place").to_numpy() == LAST).tolist():
                held.append(batch.column("total").slice(low, at - low).to_numpy(zero_copy_only=False))
                yield with_totals(batch.column("texts")[at].as_py(), np.concatenate(held).astype(np.int64))
                held, low = [], at + 1
            held.append(batch.column("total").slice(low).to_numpy(zero_copy_only=False))

    return laid.drop("block").mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


LAST = 2**31 - 1


def with_totals(texts: bytes, totals: np.ndarray) -> pa.RecordBatch:
    """The texts of a block with ``n_best`` and ``count_sum``; ``totals`` of its pairs are negative where not the best."""
    row = pa.ipc.open_stream(texts).read_next_batch()
    used, uses = expand(row.column("used")[0].as_py(), "<u4"), expand(row.column("uses")[0].as_py(), "<u4").astype(np.int64)
    edges = np.concatenate([[0], np.cumsum(row.column("n_pairs").flatten().to_numpy())])
    sums = np.concatenate([[0], np.cumsum(np.abs(totals)[used] * uses)])[edges]
    bests = np.concatenate([[0], np.cumsum((totals > 0)[used] * uses)])[edges]
    return pa.RecordBatch.from_arrays(
        [*(row.column(c).flatten() for c in COUNTED), pa.array(np.diff(bests)), pa.array(np.diff(sums)), row.column("groups_sha256").flatten()],
        [*COUNTED, "n_best", "count_sum", "groups_sha256"],
    )
