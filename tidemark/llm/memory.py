"""What a Python worker remembers from batch to batch, in bounded memory."""

from __future__ import annotations

import ctypes
import gc
import itertools
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import pyarrow as pa

#: Bytes and entries of one memory, about. Most of a corpus repeats few words, so these fit soon.
BYTES, ENTRIES = 40 << 20, 1_000_000
#: Bytes of an entry besides its key and value: objects' heads, and its share of the table, which grows by doubling.
ENTRY = 250
DOORS = 1 << 21


class Remembered(dict):
    """Results of ``compute`` by key. A key is kept when it is asked for a second time, as most are asked for once.

    A full memory forgets its newer half: what was seen twice first is what is common.
    """

    def __init__(self, compute: Callable[[Any], Any], limit: int = ENTRIES, size: int = BYTES):
        super().__init__()
        self.compute, self.limit, self.size = compute, limit, size
        self.held, self.seen, self.doors = 0, 0, bytearray(DOORS)

    def __missing__(self, key):
        found = self.compute(key)
        door = hash(key) % DOORS
        if self.doors[door]:
            self.keep(key, found)
        else:
            self.doors[door] = 1
            self.seen += 1
            if self.seen > DOORS // 2:
                self.seen, self.doors = 0, bytearray(DOORS)
        return found

    def meet(self, keys: Iterable, results: Iterable) -> None:
        """As for a missing key, for many whose results were computed elsewhere."""
        doors = self.doors
        for key, found in zip(keys, results):
            door = hash(key) % DOORS
            if doors[door]:
                self.keep(key, found)
            else:
                doors[door] = 1
                self.seen += 1
                if self.seen > DOORS // 2:
                    self.seen, self.doors = 0, bytearray(DOORS)
                    doors = self.doors

    def keep(self, key, found) -> None:
        if len(self) >= self.limit or self.held >= self.size:
            for newest in list(itertools.islice(reversed(self), len(self) // 2 + 1)):
                del self[newest]
            self.held = sum(map(self.cost, self.keys(), self.values()))
        self[key] = found
        self.held += self.cost(key, found)

    @staticmethod
    def cost(key, found) -> int:
        return ENTRY + len(key) + (len(found) if isinstance(found, bytes) else 0)


_only: dict[Hashable, Any] = {}


def only(name: Hashable, build: Callable[[], Any]) -> Any:
    """What this worker remembers under ``name``, built when first asked for.

    One thing at a time: a task of another stage lets go of what the stages before remembered, so workers that
    are used again don't pile it up. What building took beyond the result, as a parsed file does, is given back as well.
    """
    if name not in _only:
        _only.clear()
        give_back()
        _only[name] = build()
        give_back()
    return _only[name]


def give_back() -> None:
    """Freed memory goes back to the system, where it can: a worker may idle beside those of the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, giving freed memory back at the end of each task."""
    def tidied(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return tidied


def let_go(name: Hashable) -> None:
    """For tasks of a stage that remembers nothing itself."""
    only(name, dict)
