"""Byte-level BPE by ranks: encoding with a segment tree over byte positions, and decoding.

A leaf of the tree belongs to a byte position where a token starts and holds the rank
of the pair of that token and its right neighbour; inner nodes hold the minimum, ties
going to the left, so the root is the next merge. A merge touches three leaves: the
merged token, the neighbour it swallowed and the token before it. A match of n bytes
takes O(n log n) steps, however long it is. Short matches, nearly all of them, do without
the tree: the ranks of their pairs are a list, and its minimum is found by looking through it.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.memory import BYTES, only
from tidemark.llm.tokens import Batches, Memory, encode_batches

NOTHING = 1 << 96
SHIFT, MASK = 32, (1 << 32) - 1
#: Bytes of the longest match that is merged without a tree.
SHORT = 48


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Merger:
    """Applies the merges of a vocabulary; a token's rank is its id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = [ranks.get(bytes([b])) for b in range(256)]
        self.pairs = {
            ranks[token[:i]] << SHIFT | ranks[token[i:]]: rank
            for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks
        }

    def ids(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        if len(piece) <= SHORT:
            return self.few(piece)
        return self.many([self.single[b] for b in piece])

    def few(self, piece: bytes) -> list[int]:
        """Merges a short match: the least rank first, the leftmost of equal ones; bytes at ``starts`` begin tokens."""
        known = self.ranks
        rank = known.get
        starts = list(range(len(piece) + 1))
        ranks = [rank(piece[i:i + 2], NOTHING) for i in range(len(piece) - 1)]
        while ranks and (least := min(ranks)) < NOTHING:
            at = ranks.index(least)
            del starts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank(piece[starts[at - 1]:starts[at + 1]], NOTHING)
            if at < len(ranks):
                ranks[at] = rank(piece[starts[at]:starts[at + 2]], NOTHING)
        return [known[piece[a:b]] for a, b in itertools.pairwise(starts)]

    def many(self, ids: list[int]) -> list[int]:
        n, pairs = len(ids), self.pairs
        if n < 2:
            return ids
        size = 1 << (n - 2).bit_length()
        tree = [NOTHING] * (2 * size)
        for i in range(n - 1):
            rank = pairs.get(ids[i] << SHIFT | ids[i + 1])
            if rank is not None:
                tree[size + i] = rank << SHIFT | i
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(position: int, value: int) -> None:
            node = size + position
            tree[node] = value
            node >>= 1
            while node:
                left, right = tree[2 * node], tree[2 * node + 1]
                least = left if left < right else right
                if tree[node] == least:
                    return
                tree[node] = least
                node >>= 1

        def leaf(left: int, right: int) -> int:
            rank = pairs.get(ids[left] << SHIFT | ids[right])
            return NOTHING if rank is None else rank << SHIFT | left

        while (top := tree[1]) < NOTHING:
            at = top & MASK
            gone = following[at]
            after, ahead = following[gone], before[at]
            ids[at] = top >> SHIFT
            following[at] = after
            if gone < n - 1:
                put(gone, NOTHING)
            if after < n:
                before[after] = at
                put(at, leaf(at, after))
            else:
                put(at, NOTHING)
            if ahead >= 0:
                put(ahead, leaf(ahead, at))
        out, at = [], 0
        while at < n:
            out.append(ids[at])
            at = following[at]
        return out


def rank_encoder(path: str, pattern: str, size: int = BYTES) -> Memory:
    """A worker's encoder for a rank file, with ``size`` bytes of remembered words."""
    def build() -> Memory:
        ids = Merger(read_ranks(path)).ids
        return Memory(lambda match: np.array(ids(match.encode()), "<u4").tobytes(), pattern, size=size)

    return only(("ranks", path, pattern, size), build)


def encode(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``ids`` (binary, little-endian unsigned 32-bit) of every whole ``text``.

    Each match of ``pattern`` is merged by itself and there are no special tokens. NULL and
    empty texts have no ids. Columns other than ``keep`` are left out; rows are never merged.
    """
    return encode_batches(docs, lambda: rank_encoder(path, pattern), None, keep)


def decoder(path: str) -> Callable[[Batches], Batches]:
    """Adds ``decoded`` to batches with ``ids``."""
    def run(batches: Batches) -> Batches:
        token = {rank: word for word, rank in read_ranks(path).items()}.__getitem__

        def plain(ids: bytes | None) -> bytes | None:
            return None if ids is None else b"".join(map(token, np.frombuffer(ids, "<u4").tolist()))

        for batch in batches:
            done = pa.array([plain(x) for x in batch.column("ids").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, done], [*batch.schema.names, "decoded"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns and ``decoded`` (binary): the bytes that ``ids`` stand for; NULL ids stay NULL."""
    source = encoded.drop("decoded")
    return source.mapInArrow(decoder(path), ", ".join([*(f"`{c}` {kind}" for c, kind in source.dtypes), "decoded binary"]))


def encode_and_decode(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), size: int = BYTES) -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass: ``keep`` columns, ``ids`` and ``decoded``."""
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "ids binary", "decoded binary"])
    return encode_batches(docs, lambda: rank_encoder(path, pattern, size), None, keep, decoder(path), schema)
