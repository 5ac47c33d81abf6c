"""Alignment of two tokenizers against the libraries and plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel

from tidemark.llm import align
from tidemark.llm.queries import PATTERN, PIECES, VOCABULARY

ODD = [
    None, "", " ", "a", "two  spaces", " lead", "trail ", "tab\there\n\nnew\r\nline", "<|endoftext|> <s> </s> <unk> <0x41>", "under▁score",
    "日本語 текст é é", "\x00\x01", "😀😀 mixed 😀", "ｆｕｌｌ width", "﻿mark", "word " * 3000, "x" * 5000, "the the the", "don't 123456 !!!",
]


def tokens_by_hand(text):
    """Token ids and byte ranges of A and B; None for texts without tokens."""
    first = Tokenizer.from_file(VOCABULARY)
    first.encode_special_tokens = True
    letters = {c: b for b, c in align.byte_letters().items()}
    second = SentencePieceProcessor(model_file=PIECES)
    if not text:
        return None
    spelled = b" " + text.encode()
    a = first.encode(" " + text, add_special_tokens=False).ids
    b = second.encode(text)
    a_bytes = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(a_bytes) != spelled or b"".join(b_bytes) != spelled:
        return None
    return a, b, np.cumsum([0, *map(len, a_bytes)]).tolist(), np.cumsum([0, *map(len, b_bytes)]).tolist()


def aligned_by_hand(text):
    found = tokens_by_hand(text)
    if found is None:
        return [], [], [], [], ""
    a, b, a_at, b_at = found
    links = [(i, j) for i in range(len(a)) for j in range(len(b)) if a_at[i] < b_at[j + 1] and b_at[j] < a_at[i + 1]] if len(a) < 800 else None
    cuts = [0] + sorted(set(a_at[1:]) & set(b_at[1:]))
    groups = []
    for low, high in zip(cuts[:-1], cuts[1:]):
        groups.append((
            [x for x, end in zip(a, a_at[1:]) if low < end <= high], [x for x, end in zip(b, b_at[1:]) if low < end <= high],
        ))
    return a, b, links, groups, ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def rows_by_hand(texts):
    every = [aligned_by_hand(t) for t in texts]
    counts = Counter()
    linked = []
    for a, b, links, groups, _ in every:
        if links is None:  # a long text: link inside groups, whose bytes are few
            links = []
            i = j = 0
            _, _, a_at, b_at = tokens_by_hand(texts[len(linked)])
            while i < len(a) and j < len(b):
                links.append((i, j))
                x, y = a_at[i + 1], b_at[j + 1]
                i, j = i + (x <= y), j + (y <= x)
        pairs = [(a[i], b[j]) for i, j in links]
        counts.update(pairs)
        linked.append(pairs)
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (len(a), len(b), len(groups), len(pairs), sum(counts[p] == best[p[1]] for p in pairs), sum(counts[p] for p in pairs),
         hashlib.sha256(text.encode()).hexdigest() if text else "")
        for (a, b, _, groups, text), pairs in zip(every, linked)
    ]


def test_links_and_cuts_of_each_text(spark):
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(ODD)], "doc_id long, text string, links string, n_a int").repartition(3)
    rows = {r.doc_id: r for r in align.align(docs, VOCABULARY, PATTERN, PIECES, "doc_id").collect()}
    assert len(rows) == len(ODD)
    for i, text in enumerate(ODD):
        a, b, links, groups, _ = aligned_by_hand(text)
        r = rows[i]
        assert (r.a_ids, r.b_ids) == (a, b)
        if links is not None:
            assert [(x.a, x.b) for x in r.links] == links
        at, cut = (0, 0), []
        for c in r.cuts:
            cut.append((r.a_ids[at[0]:c.a], r.b_ids[at[1]:c.b]))
            at = (c.a, c.b)
        assert cut == groups


@pytest.mark.parametrize("chars", [40, 3_000_000])
def test_summary_equals_plain_python(spark, chars):
    draw = random.Random(9)
    words = ["the", "token", "izer", "zzz", "Ünder", "12", "!?", "\n", "日本", "don't", "  "]
    texts = [*ODD, *("".join(draw.choices(words, k=draw.randint(0, 30))) for _ in range(60)), "the the the"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, total int").repartition(4)
    got = align.alignment_summary(docs, VOCABULARY, PATTERN, PIECES, chars)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == dict(enumerate(rows_by_hand(texts)))


def test_repeated_rows_missing_ids_and_empty_tables(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "a c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = align.alignment_summary(docs, VOCABULARY, PATTERN, PIECES).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == sorted((str(i), *r) for (i, _), r in zip(rows, rows_by_hand([t for _, t in rows])))
    assert align.alignment_summary(docs.limit(0), VOCABULARY, PATTERN, PIECES).collect() == []
    assert align.align(docs.limit(0), VOCABULARY, PATTERN, PIECES, "doc_id").collect() == []


def test_lockstep_does_not_depend_on_stretches():
    rng = np.random.default_rng(1)
    a_ends, b_ends, first = [], [], []
    at = 0
    for _ in range(20):
        n = int(rng.integers(1, 90))
        first.append(len(a_ends))
        for ends in (a_ends, b_ends):
            cuts = np.unique(np.append(rng.integers(1, n + 1, rng.integers(0, n)), n))
            ends += (at + cuts).tolist()
        at += n
    a_ends, b_ends = np.array(a_ends), np.array(b_ends)
    whole = align.lockstep(a_ends, b_ends, np.array(first), 10_000)
    starts = {x: np.concatenate([[0], ends[:-1]]) for x, ends in (("a", a_ends), ("b", b_ends))}
    want = [(i, j) for i in range(len(a_ends)) for j in range(len(b_ends)) if starts["a"][i] < b_ends[j] and starts["b"][j] < a_ends[i]]
    assert list(zip(*(x.tolist() for x in whole[:2]))) == want
    assert (a_ends[whole[2]] == np.intersect1d(a_ends, b_ends)).all() and (b_ends[whole[3]] == np.intersect1d(a_ends, b_ends)).all()
    for stretch in (1, 2, 7):
        for x, y in zip(whole, align.lockstep(a_ends, b_ends, np.array(first), stretch)):
            assert (x == y).all()


def test_byte_level_decoding_is_that_of_the_library():
    first, tokenizer, decode = align.byte_level(VOCABULARY, PATTERN), Tokenizer.from_file(VOCABULARY), ByteLevel().decode
    for i in range(0, 50_000, 997):
        assert first.pieces[i].decode(errors="replace") == decode([tokenizer.id_to_token(i)])
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECES
