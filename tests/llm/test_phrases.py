"""Collocations against plain Python and SQL."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from check_queries import compare, connect
from tidemark.llm import phrases, queries


def by_hand(rows, top, least, longest=4, contained=80):
    found = {}
    for lang, text in rows:
        f, n = found.setdefault(lang or "und", (Counter(), [0]))
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[0] += len(words)
            for k in range(1, longest + 1):
                f.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, (f, n) in found.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(
                len(q) > len(p) and 100 * b >= contained * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            )
            if not inside:
                scored.append((-score, -a, " ".join(p).encode(), p, k))
        for rank, (score, a, _, p, k) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, " ".join(p), -a, f[p[:k]], f[p[k:]], n[0], -score))
    return sorted(out)


def corpus(seed, n):
    draw = random.Random(seed)
    words = ["the", "New", "york", "City", "of", "a", "é", "x y", "big", "\U0001F600", "zz"]
    parts = ["new york city", "of the", "the big big big", "a, b; c", "New  York\tCity"]
    rows = []
    for _ in range(n):
        text = "".join(draw.choice([*words, *parts]) + draw.choice([" ", " ", " ", ". ", "\n", "\t", ", ", "\x0b"]) for _ in range(draw.randint(0, 25)))
        rows.append((draw.choice(["en", "en", "fr", None, "und"]), text))
    return [*rows, ("en", None), ("de", ""), (None, " .,\n"), ("xx", "lone")]


@pytest.mark.parametrize("top, least, longest", [(2000, 3, 4), (5, 2, 4), (50, 4, 3), (50, 3, 5)])
def test_equals_plain_python(spark, top, least, longest):
    rows = corpus(top + least, 120)
    docs = spark.createDataFrame([(i, t, lang, 1, "q") for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string").repartition(5)
    got = phrases.collocations(docs, top, longest, least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == by_hand(rows, top, least, longest)


def test_long_texts_and_blocks(spark, monkeypatch):
    rows = [("en", "alpha beta gamma delta " * 2000), ("en", "alpha beta " * 10), ("fr", ("mot clef. " * 3 + "autre mot clef\n") * 60)]
    want = by_hand(rows, 100, 30)
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    assert sorted(map(tuple, phrases.collocations(docs, 100).collect())) == want


def test_counts_past_64_bits(spark):
    """Products of counts need more than 64 bits; the score is exact all the same."""
    a, l, r = 9_000_000_000_000, 9_000_000_000_001, 10_000_000_000_007
    counts = spark.createDataFrame(
        [("en", 0, "", 10**14), ("en", 1, "x", l), ("en", 1, "y", r), ("en", 2, "x y", a)], "lang string, size int, phrase string, f long"
    )
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(phrases, "phrase_counts", lambda *_: counts)
        row = phrases.collocations(counts, 10).first()
    assert tuple(row) == ("en", 1, "x y", a, l, r, 10**14, 2_000_000 * a // (l + r))


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = corpus(1, 100)
    docs = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    want = sorted(map(tuple, phrases.collocations(docs, 100, least=3).collect()))
    full = spark.sparkContext.broadcast(__import__("numpy").full(8192, 255, "u1"))
    monkeypatch.setattr(phrases, "frequent_pairs", lambda *_: (full, 65_536))
    assert sorted(map(tuple, phrases.collocations(docs, 100, least=3).collect())) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert phrases.collocations(docs, 10).collect() == []
    assert phrases.collocations(spark.createDataFrame([(None, None)], "text string, lang string"), 10).collect() == []


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    df = queries.op13_collocations(spark, folder)
    relation = connect(folder).sql(queries.SQL["op13_collocations"])
    assert compare(df.columns, df.collect(), relation.columns, relation.fetchall()) is None
