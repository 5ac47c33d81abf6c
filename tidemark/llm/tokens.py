"""Token ids of whole texts by a byte-level tokenizer, one Arrow batch at a time.

Most of a corpus repeats the same words, so ids are remembered per chunk of text
between two spaces. A space between two visible characters always starts a new
match of the split pattern, so chunks can be encoded apart from each other; texts
with runs of white space are split by the pattern itself. The memory is bounded.

A batch can be encoded together: Arrow cuts its texts and numbers their distinct chunks, so each
is looked up once in a batch, and the library gets all that are new in one call.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tidemark.llm.memory import BYTES, ENTRIES, Remembered, only, tidy

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: Texts handed on at a time, and texts encoded together.
ROWS, TOGETHER = 500, 2_000
#: Characters encoded together, about.
CHARS = 32_000_000
#: White space that no single space between two visible characters explains.
ODD_SPACE = re.compile(r"\s\s|\A\s|\s\Z")
OTHER_SPACE = re.compile(r"[^\S \n]")
#: ASCII signs: behind a word, any number of them form one match.
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def odd_space(text: str) -> bool:
    """Whether the (not empty) text has white space other than single characters of it between visible ones."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n":
        return True
    # the slow search only where there is other white space
    return bool(OTHER_SPACE.search(text) and ODD_SPACE.search(text))


def cut_chunks(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct chunks between single spaces, the number of each chunk in order, and how many each text has (NULL: 0)."""
    cut = pc.split_pattern(pa.array(texts, pa.string()), " ")
    coded = cut.flatten().dictionary_encode()
    lengths = cut.value_lengths().fill_null(0).to_numpy()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), lengths


class Memory(Remembered):
    """Ids of the space and the chunk behind it; chunks that come again are remembered.

    ``encode_many`` gives the ids of a list of matches, if that costs less than one by one.
    """

    def __init__(
        self, encode_match: Callable[[str], bytes], pattern: str, limit: int = ENTRIES, size: int = BYTES,
        encode_many: Callable[[list[str]], list[bytes]] | None = None,
    ):
        super().__init__(self.ids_of, limit, size)
        self.encode_match = encode_match
        self.encode_many = encode_many or (lambda matches: [encode_match(m) for m in matches])
        self.kept = Remembered(encode_match, limit, min(size, BYTES) // 2)  # by match
        self.matches = regex.compile(pattern).findall

    def ids_of(self, chunk: str) -> bytes:
        """Ids of " " + chunk; of "\n" and what follows if the chunk starts with a line end."""
        start, word = ("", chunk[1:]) if chunk[0] == "\n" else (" ", chunk)
        core = word.rstrip(SIGNS)
        if core.isalpha():
            if not start:
                ids = self.kept["\n"] + self.encode_match(core)
            else:
                ids = self.encode_match(" " + core) if core == word else self[core]
            return ids if core == word else ids + self.kept[word[len(core):]]
        if start and "\n" in word:
            line, _, rest = word.partition("\n")
            return self[line] + self["\n" + rest]
        return self.split(start + word if start else chunk)

    def split(self, text: str) -> bytes:
        return b"".join(map(self.kept.__getitem__, self.matches(text)))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers; none for NULL or ''."""
        if not text:
            return b""
        if odd_space(text):
            return self.split(text)
        first, *chunks = text.split(" ")
        return self.split(first) + b"".join(map(self.__getitem__, chunks))

    def encode_behind_space(self, text: str) -> bytes:
        """Ids of a space and a text that isn't empty."""
        if odd_space(text):
            return self.split(" " + text)
        return b"".join(map(self.__getitem__, text.split(" ")))

    def find_matches(self, chunk: str, found: list[str]) -> int:
        """Puts the matches of " " + chunk behind those found, and says how many there are then."""
        for number, word in enumerate(chunk.split("\n") if "\n" in chunk else (chunk,)):
            if number:
                found.append("\n")
            start, core = "" if number else " ", word.rstrip(SIGNS)
            if not core.isalpha():
                found += self.matches(start + word)
            else:
                found.append(start + core)
                if core != word:
                    found.append(word[len(core):])
        return len(found)

    def ids_of_all(self, chunks: list[str]) -> list[bytes]:
        """:meth:`ids_of` of distinct chunks, not empty; those not remembered are computed together."""
        ids = list(map(self.get, chunks))
        new = [at for at, known in enumerate(ids) if known is None]
        # most are one match; flat lists, as the garbage collector would go through one list for each chunk again and again
        words, others = [at for at in new if chunks[at].isalpha()], [at for at in new if not chunks[at].isalpha()]
        matches: list[str] = []
        ends = [self.find_matches(chunks[at], matches) for at in others]
        # a match behind a space is a chunk itself
        of_match = {m: self.get(m[1:]) if m[0] == " " else self.kept.get(m) for m in matches}
        unknown = [m for m, known in of_match.items() if known is None]
        computed = self.encode_many([*(" " + chunks[at] for at in words), *unknown])
        of_match.update(zip(unknown, computed[len(words):]))
        parts = [of_match[m] for m in matches]
        computed[len(words):] = [parts[a] if b == a + 1 else b"".join(parts[a:b]) for a, b in zip([0, *ends], ends)]
        new = words + others
        for at, found in zip(new, computed):
            ids[at] = found
        self.meet((chunks[at] for at in new), computed)
        whole = {" " + chunks[at] for at in others}
        cores = [m for m in unknown if m[0] == " " and m not in whole]
        signs = [m for m in unknown if m[0] != " "]
        self.meet((m[1:] for m in cores), map(of_match.__getitem__, cores))
        self.kept.meet(signs, map(of_match.__getitem__, signs))
        return ids

    def encode_all(self, texts: list[str | None], tail: bytes = b"", apart: Callable[[str], bytes | None] = lambda text: None) -> pa.Array:
        """:meth:`encode` of whole texts, with ``tail`` behind each. ``apart`` may give the ids of a text instead."""
        if len(texts) > 1 and sum(len(t or "") for t in texts) > CHARS:
            half = len(texts) // 2
            return pa.concat_arrays([self.encode_all(part, tail, apart) for part in (texts[:half], texts[half:])])
        heads, rests = [], []
        for text in texts:
            head, rest = b"", None
            if text and (head := apart(text)) is None:
                if odd_space(text):
                    head = self.split(text)
                else:
                    first, gap, rest = text.partition(" ")
                    head, rest = self.split(first), rest if gap else None
            heads.append(head)
            rests.append(rest)
        chunks, number, counts = cut_chunks(rests)
        entries = pa.array([*self.ids_of_all(chunks), *heads, tail], pa.binary())
        # the head before a text's chunks and the tail behind them
        ends = np.cumsum(counts)
        around = np.stack([len(chunks) + np.arange(len(texts)), np.full(len(texts), len(entries) - 1)], axis=1)
        order = np.insert(number.astype(np.int64), np.stack([ends - counts, ends], axis=1).ravel(), around.ravel())
        joined = entries.take(pa.array(order))
        bounds = np.concatenate([[0], np.cumsum(counts + 2)])
        offsets = np.frombuffer(joined.buffers()[1], np.int32, len(joined) + 1)[bounds]
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), joined.buffers()[2]])


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes
    stand for themselves, the others take the letters from 256 up in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class AddedTokens:
    """``memory`` for ordinary texts; texts that hold an added token of the file go through the whole library.

    Only the library knows all rules of added tokens (single words, stripped sides, overlaps).
    """

    def __init__(self, memory: Memory, tokenizer: Tokenizer):
        self.memory, self.whole = memory, tokenizer.encode
        contents = sorted(t.content for t in tokenizer.get_added_tokens_decoder().values())
        self.search = re.compile("|".join(map(re.escape, contents))).search if contents else None

    def encode(self, text: str | None) -> bytes:
        ids = self.by_library(text) if text else None
        return self.memory.encode(text) if ids is None else ids

    def by_library(self, text: str) -> bytes | None:
        """Ids of a text that holds an added token."""
        if not self.search or not self.search(text):
            return None
        ids = self.whole(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_all(self, texts: list[str | None], tail: bytes = b"") -> pa.Array:
        return self.memory.encode_all(texts, tail, self.by_library)


def vocabulary_encoder(path: str, pattern: str, added: bool = False, size: int = BYTES) -> Memory | AddedTokens:
    """Encoder by a ``tokenizers`` file, with ``size`` bytes of remembered words.

    ``added``: the file's added tokens get their ids where they stand in a text, as the library does it;
    if not, they are ordinary text.
    """
    return only(("tokenizers", path, pattern, added, size), lambda: new_encoder(path, pattern, added, size))


def new_encoder(path: str, pattern: str, added: bool = False, size: int = BYTES) -> Memory | AddedTokens:
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    tokenizer, letters = Tokenizer.from_file(path), byte_letters()
    tokenize = tokenizer.model.tokenize
    # the model alone; without a letter for each byte, or with marks in its tokens, their lengths say nothing
    bare = Tokenizer(tokenizer.model)
    lengths = np.array([len(bare.id_to_token(i) or "") for i in range(bare.get_vocab_size())], np.int64)
    complete = all(bare.token_to_id(letter) is not None for letter in letters.values())
    letter_of = np.array([ord(letters[b]) for b in range(256)], "<u2")
    pack_into = [struct.Struct(f"<{n}I").pack for n in range(16)]

    def encode_match(match: str) -> bytes:
        word = match.encode().decode("latin-1").translate(letters)
        ids = [t.id for t in tokenize(word)]
        return pack_into[len(ids)](*ids) if len(ids) < 16 else struct.pack(f"<{len(ids)}I", *ids)

    def encode_many(matches: list[str]) -> list[bytes]:
        if not matches or not complete:
            return [encode_match(m) for m in matches]
        # no text holds the byte 255
        joined = np.frombuffer(b"\xff".join([m.encode() for m in matches]), np.uint8)
        word_ends = np.append(np.flatnonzero(joined == 255) - np.arange(len(matches) - 1), len(joined) - len(matches) + 1)
        words = letter_of[joined].tobytes().decode("utf-16-le").split(letters[255])
        ids = np.array(bare.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        token_ends = np.cumsum(lengths[ids])
        if token_ends[-1] != word_ends[-1]:
            return [encode_match(m) for m in matches]
        ends, data = (4 * np.searchsorted(token_ends, word_ends) + 4).tolist(), ids.tobytes()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    memory = Memory(encode_match, pattern, size=size, encode_many=encode_many)
    return AddedTokens(memory, tokenizer) if added else memory


Batches = Iterator[pa.RecordBatch]


def encode_batches(
    docs: DataFrame, encoder: Callable[[], Memory | AddedTokens], end: int | None, keep: tuple[str, ...],
    then: Callable[[Batches], Batches] | None = None, schema: str | None = None, together: bool = False,
) -> DataFrame:
    """``keep`` columns and ``ids`` (binary) of ``text``; ``end`` is added behind each text.

    ``then`` goes on with these batches in the same worker, so ids that only it needs are not sent
    from process to process; ``schema`` says what it returns. ``together``: all texts of a batch at once, in less
    time and more memory.
    """
    tail, rows = b"" if end is None else end.to_bytes(4, "little"), TOGETHER if together else ROWS

    def encoded(batches: Batches) -> Batches:
        made = encoder()
        encode = made.encode
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                texts = batch.column("text").to_pylist()
                ids = made.encode_all(texts, tail) if together else pa.array([encode(t) + tail for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids], [*keep, "ids"])

    def run(batches: Batches) -> Batches:
        return then(encoded(batches)) if then else encoded(batches)

    source = docs.select(*keep, "text")
    kinds = dict(source.dtypes)
    return source.mapInArrow(tidy(run), schema or ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "ids binary"]))


def encode_documents(
    docs: DataFrame, path: str, pattern: str, end: int | None = None, keep: tuple[str, ...] = ("doc_id",), added: bool = False,
    size: int = BYTES,
) -> DataFrame:
    """Ids of every whole ``text`` by the tokenizer file at ``path`` (readable on every executor).

    NULL and empty texts have no ids but ``end``; rows are neither merged nor dropped. ``added`` and ``size`` as in
    :func:`vocabulary_encoder`.
    """
    return encode_batches(docs, lambda: vocabulary_encoder(path, pattern, added, size), end, keep)
