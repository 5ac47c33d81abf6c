from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import katz, lz


def discounts_by_hand(counts):
    """Good-Turing discounts of counts 1 to 5; one half off where n-grams are too few to estimate from."""
    seen = Counter(counts)
    first = seen[1]
    common = 6 * seen[6] / first if first else 1
    out = {0: 1.0, 6: 1.0}
    for r in range(1, 6):
        out[r] = (r - 0.5) / r
        if seen[r] and common < 1:
            turing = ((r + 1) * seen[r + 1] / (r * seen[r]) - common) / (1 - common)
            if 0 < turing < 1:
                out[r] = turing
    return out


def shortest_by_hand(words):
    """Probability of a word by its count; one place for all unknown words takes what the discounts leave."""
    n, off = sum(words.values()), discounts_by_hand(words.values())
    lost = sum(c * (1 - off[c]) for c in words.values() if c < 6)
    total = n if lost > 0 else n + 1
    return lambda c: off[min(c, 6)] * c / total if c else (lost if lost > 0 else 1) / total


def by_hand(rows):
    """Scores by plain dictionaries; rows: (id, text, held out)."""
    tokens = [[*re.findall("[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")), 0] for _, t, _ in rows]
    words, pairs = Counter(), Counter()
    for row, (_, _, held) in zip(tokens, rows):
        if not held:
            words.update(row)
            pairs.update(zip([1, *row[:-1]], row))
    n, v = sum(words.values()), len(words)
    shortest, d = shortest_by_hand(words), discounts_by_hand(pairs.values())
    after = defaultdict(dict)
    for (h, w), c in pairs.items():
        after[h][w] = c

    def p1(w):
        return shortest(words[w])

    def p(h, w):
        if h not in after:
            return p1(w)
        total = sum(after[h].values())
        kept = sum(d[min(c, 6)] * c for c in after[h].values())
        total += kept == total
        if w in after[h]:
            return d[min(after[h][w], 6)] * after[h][w] / total
        return (1 - kept / total) / (1 - sum(map(p1, after[h]))) * p1(w)

    for h in list(after)[:30]:  # exactly normalised, the unknown word included
        assert abs(sum(p(h, w) for w in [*words, "never seen"]) - 1) < 1e-9
    return Counter(
        (i, held, len(row), sum(words[w] > 0 for w in row), n, round(sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in row), 6), round(sum(math.log10(p(h, w)) for h, w in zip([1, *row[:-1]], row)), 6))
        for row, (i, _, held) in zip(tokens, rows))


def scored(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, held_out boolean, score int")
    return Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in katz.score(docs, **options).collect())


@pytest.mark.parametrize("block", [10**7, 300])
def test_katz_scores(spark, block):
    draw = random.Random(2)
    rows = [(i, draw.choice([" ", "\n"]).join(draw.choices(["the", "The", "of", "a", "É", *map(str, range(40))], [30, 5, 20, 10, 3, *[1] * 40], k=draw.randint(0, 60))), i % 4 == 1) for i in range(60)]
    rows += [(60, None, False), (61, None, True), (62, "", False), (63, "word never met", True), (3, "twice", False), (3, "twice", False), (None, "no id", True), (64, "the " * 3000, False)]
    assert scored(spark, rows, block_chars=block) == by_hand(rows)


def test_katz_without_training_or_rows(spark):
    assert scored(spark, [(1, "some words", True)]) == Counter([(1, True, 3, 0, 0, 0.0, 0.0)])
    assert scored(spark, [(1, "x", False)][:0]) == Counter()
    assert scored(spark, [(1, "x", False), (2, "y x", True)]) == by_hand([(1, "x", False), (2, "y x", True)])


def test_discounts_stay_in_range():
    for seen in ([10, 5, 3, 2, 1, 1], [0, 0, 0, 0, 0, 0], [5, 0, 9, 0, 1, 0], [1, 100, 1, 1, 1, 50]):
        d = katz.discounts(seen)
        assert (d > 0).all() and (d <= 1).all()


def test_packets_round_trip():
    values = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (katz.expand_sorted(katz.squeeze_sorted(values)) == values).all()
    assert len(katz.expand_sorted(katz.squeeze_sorted(values[:0]))) == 0


def plain_phrases(text):
    known, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in known:
            known.add(text[start:end])
            start = end
    return known


@pytest.mark.parametrize("text", ["", "a", "abababab", "the cat sat on the mat " * 20, "жжж éé 你好" * 9, "a" * 20_000])
def test_parse_is_that_of_the_phrase_dictionary(text):
    parser = lz.Parser().feed(text)
    assert len(parser.hashes) - 1 == len(plain_phrases(text)) == len(parser.children)
    half = len(text) // 2
    assert lz.Parser().feed(text[:half]).copy().feed(text[half:]).hashes == parser.hashes
    assert (lz.from_text(lz.to_text(parser.signature())) == parser.signature()).all()


@pytest.mark.parametrize("text", ["", "a" * 3000, "ab" * 900 + "x" * 700 + "ab" * 900, "h\U0001F600é" * 300, "the cat sat on the mat " * 40])
def test_phrases_are_hashed_as_by_the_tree_and_found_in_few_looks(text):
    root, factor, plain, known, start = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, [], set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in known:
            known.add(text[start:end])
            h = root
            for c in text[start:end]:
                h = (h * factor + ord(c) + 1) % 2**64
            plain.append(h)
            start = end
    assert lz.Parser().feed(text).hashes == [root, *plain]
    for at in (1, len(text) // 3, len(text) - 1):
        assert lz.Parser().feed(text[:at]).feed(text[at:]).hashes == [root, *plain]

    class Counted(dict):
        looks = 0

        def __contains__(self, phrase):
            Counted.looks += 1
            return super().__contains__(phrase)

        def get(self, phrase):
            Counted.looks += 1
            return super().get(phrase)

    parser = lz.Parser()
    parser.children = Counted()
    parser.feed(text)
    assert Counted.looks <= 0.9 * len(text)  # one by one: as many as characters


def test_likeness_estimates_shared_phrases():
    draw = random.Random(1)
    words = ["".join(draw.choices("abcdefghij", k=5)) for _ in range(3000)]
    a, b = " ".join(words[:2000]), " ".join(words[:1500] + words[2000:2500])
    pa, pb = plain_phrases(a), plain_phrases(b)
    estimate = lz.likeness(lz.Parser().feed(a).signature(), lz.Parser().feed(b).signature())
    assert abs(estimate - len(pa & pb) / len(pa | pb)) < 0.15
    empty = lz.Parser().signature()
    assert lz.likeness(empty, empty) == 1 and lz.likeness(empty, lz.Parser().feed("x").signature()) == 0


@pytest.mark.parametrize("n", [1, 2, 40])
def test_edits_take_the_next_document(spark, n):
    draw = random.Random(n)
    texts = {i * 3: "".join(draw.choices("ab cdé", k=draw.randint(0, 90))) for i in range(n)}
    docs = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, block int")
    order = sorted(texts, reverse=True)
    rows = lz.compare_with_edits(docs).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        text, after = texts[r.doc_id], texts[order[(order.index(r.doc_id) + 1) % n]]
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        own, other, following = (lz.Parser().feed(t).signature() for t in (text, edited, after))
        assert (r.n_chars, r.edited, r.fingerprint, r.edited_fingerprint) == (len(text), edited, lz.to_text(own), lz.to_text(other))
        assert (r.near_edited, r.near_next) == (lz.likeness(own, other), lz.likeness(own, following))


def test_fingerprint_cases(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, "abc"), (None, "abd"), (7, "")], "doc_id long, text string")
    assert Counter(r.doc_id for r in lz.compare_with_edits(docs).collect()) == Counter([1, 1, None, None, 7])
    assert lz.compare_with_edits(docs.limit(0)).collect() == []
    found = lz.fingerprints(docs).collect()
    assert len(found) == 5 and {r.fingerprint for r in found if r.doc_id} == {""}
    assert len({r.fingerprint for r in lz.fingerprints(spark.createDataFrame([(1, "same text"), (2, "same text")], "doc_id long, text string")).collect()}) == 1


def test_scoring_leaves_no_table_behind(spark):
    docs = spark.createDataFrame([(1, "a b a b", False), (2, "a c", True)], "doc_id long, text string, held_out boolean")
    before = {t.name for t in spark.catalog.listTables()}
    assert katz.score(docs).count() == 2
    assert {t.name for t in spark.catalog.listTables()} == before


def test_pairs_are_placed_by_their_one_sort(monkeypatch):
    draw = np.random.default_rng(4)
    block = katz.Block.__new__(katz.Block)
    block.before = draw.choice(np.array([katz.START, katz.UNKNOWN, 3, 5, 2**31], np.uint64), 500)
    block.after = draw.choice(np.array([katz.UNKNOWN, 3, 7, 2**32 - 9], np.uint64), 500)
    # words of training texts are known
    block.training = (draw.random(500) < 0.7) & (block.before != katz.UNKNOWN) & (block.after != katz.UNKNOWN)
    want = [int(a) << 32 | int(b) for a, b in zip(block.before, block.after)]
    unseen = int(katz.UNKNOWN) << 32 | int(katz.UNKNOWN)
    want = [unseen if k >> 32 == int(katz.UNKNOWN) else k for k in want]
    learned = Counter(k for k, t in zip(want, block.training) if t)

    def refuse(*_, **__):
        raise AssertionError("keys are looked up again")

    monkeypatch.setattr(np, "searchsorted", refuse)
    keys, at, counts = block.pairs()
    assert keys.tolist() == sorted({*want, *(int(a) << 32 | int(katz.UNKNOWN) for a in block.before)})
    assert keys[at].tolist() == want and dict(zip(keys.tolist(), counts.tolist())) == {k: learned[k] for k in keys.tolist()}


def test_distinct_is_unique():
    for values in ([], [4], [4, 4], [9, 1, 9, 2**63, 1]):
        values = np.array(values, np.uint64)
        assert katz.distinct(values).tolist() == np.unique(values).tolist()


def test_blocks_are_copied_one_by_one():
    class Batch:
        num_rows = 3

        def slice(self, at, length):
            assert length == 1
            return pa.table({"x": [at]})

    assert list(katz.one_by_one([Batch()])) == [{"x": 0}, {"x": 1}, {"x": 2}]


def test_texts_reach_blocks_in_small_batches(spark, monkeypatch):
    seen = []
    store = katz.store_bucketed
    monkeypatch.setattr(katz, "store_bucketed", lambda *a: seen.append(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) or store(*a))
    docs = spark.createDataFrame([(1, "a b", False), (2, "a c", True)], "doc_id long, text string, held_out boolean")
    assert katz.score(docs).count() == 2 and seen == [str(katz.ROWS)]
