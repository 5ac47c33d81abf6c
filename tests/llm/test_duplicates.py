"""MinHash, lattice and line deduplication and components against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import lattice, lines, memory, minhash, words
from tidemark.llm.graph import components
from tidemark.llm.members import likely_members
from tidemark.session import materialize

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("links", [
    [], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], [(99, i) for i in range(50)], [(3, 3), (4, 5), (5, 4), (5, 6)],
    [(random.Random(5).randint(0, 300), random.Random(i).randint(0, 300)) for i in range(200)],
])
def test_components(spark, links):
    found = {r.node: r.component for r in components(spark.createDataFrame([*links, (None, 7)], "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a != b]
    assert found == roots({n for pair in real for n in pair}, real)


def test_member_filter_misses_nobody(spark):
    test = likely_members(spark.range(0, 1000, 7), "id")
    rows = spark.range(0, 3000)
    hit = {r.id for r in rows.where(test(rows["id"])).collect()}
    assert set(range(0, 1000, 7)) <= hit and len(hit) < 200
    assert not rows.where(likely_members(spark.range(0), "id")(rows["id"])).count()


def shingle_set(text, size):
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    size = min(size, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[draw.choice(vocabulary) for _ in range(draw.randint(3, 120))] for _ in range(25)]
    rows = []
    for words in base:
        rows.append(" ".join(words))
        for _ in range(draw.choice([0, 1, 3, 12])):
            copy = list(words)
            for _ in range(draw.randint(0, max(1, len(copy) // 15))):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary).upper()
            rows.append("\t".join(copy) if draw.random() < 0.3 else " ".join(copy))
    rows += [None, "", "  \n", "one", "ONE", "one two", "two one", "É x y", "é x y", "w1 " * 5000]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("words, seed", [(2, 1), (5, 2)])
def test_minhash_links_all_similar_documents(spark, words, seed):
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, "a", 0) for i, t in enumerate(texts)], "doc_id long, text string, node string, component long")
    sets = [shingle_set(t, words) for t in texts]
    links = [
        (a, b) for b in range(len(sets)) for a in range(b)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    want = roots(range(len(texts)), links)
    rows = minhash.near_duplicates(docs, words=words).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {i: (len(sets[i]), want[i], want[i] == i) for i in range(len(texts))}
    kept = minhash.keep_one_of_each(docs, words=words)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_minhash_repeated_rows_no_ids_and_empty(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "a b c d"), (None, None), (3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs, words=2).collect())
    assert found == Counter({(1, 1, True): 2, (2, 1, False): 1, (None, None, True): 2, (3, 3, True): 1})
    assert Counter(r.doc_id for r in minhash.keep_one_of_each(docs, words=2).collect()) == Counter([1, None, None, 3])
    assert minhash.near_duplicates(docs.limit(0)).collect() == [] == minhash.keep_one_of_each(docs.limit(0)).collect()


def test_bound_of_differences_and_pieces():
    most = minhash.most_differences(0.8)
    parts = minhash.pieces(minhash.POSITIONS, most)
    assert sorted(p for piece, _ in parts for p in piece) == list(range(minhash.POSITIONS))
    assert sum(errors + 1 for _, errors in parts) > most  # pigeonhole
    a, b = (np.frombuffer(minhash.signature(np.arange(n, dtype=np.uint64) * np.uint64(7919)), np.uint8) for n in (1000, 1000))
    assert (a == b).all()


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node string, n_links int")


def brute(rows, least=0.93):
    good = {}
    for key, v, label, *_ in rows:
        if key is not None and v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[key] = (np.array(v, np.float32).astype(float), label)
    links = [(a, b) for a in good for b in good if a < b and good[a][1] == good[b][1] and len(good[a][0]) == len(good[b][0])
             and good[a][0] @ good[b][0] / np.linalg.norm(good[a][0]) / np.linalg.norm(good[b][0]) >= least]
    keys = [r[0] for r in rows if r[0] is not None]
    degree = Counter(x for pair in links for x in pair)
    want = roots(keys, links)
    return {k: (degree[k], want[k], want[k] == k) for k in keys}


@pytest.mark.parametrize("chunk", [1000, 7])
def test_lattice_finds_all_near_vectors(spark, monkeypatch, chunk):
    monkeypatch.setattr(lattice, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(30):
        base = rng.standard_normal(32)
        label = int(rng.integers(0, 3))
        for _ in range(int(rng.integers(1, 8))):
            noisy = base + rng.standard_normal(32) * rng.choice([0, 0.05, 0.15, 0.25])
            rows.append((len(rows), [float(x) for x in noisy.astype(np.float32) * np.float32(rng.choice([1, 5]))], label, "n", 1))
    odd = [None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [1.0, 2.0], [2.0, 4.0], [-0.0, 1.0], [0.0, 1.0]]
    for v in odd:
        rows.append((len(rows), v, 1, "n", 1))
    rows.append((len(rows), rows[0][1], None, "n", 1))
    rows.append((len(rows), rows[0][1], rows[0][2], "n", 1))
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(vectors(spark, rows), 0.93).collect()}
    assert found == brute(rows)


def test_lattice_empty_and_no_key(spark):
    table = vectors(spark, [(None, [1.0, 0.0], 1, "n", 1), (4, [1.0, 0.0], 1, "n", 1)])
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(table, 0.93).collect()}
    assert found[4] == (0, 4, True) and found[None][0] == 0
    assert lattice.near_duplicates(table.limit(0), 0.93).collect() == []


def test_e8_decoding_gives_the_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 8)) * 2
    point = lattice.nearest_e8(x)
    steps = lattice.shortest_e8()
    assert len(steps) == 240 and np.allclose((steps**2).sum(axis=1), 2)
    own = ((x - point) ** 2).sum(axis=1)
    others = ((x[:, None] - point[:, None] - steps) ** 2).sum(axis=2).min(axis=1)
    assert (own <= others + 1e-9).all() and np.allclose(2 * point % 1, 0) and np.allclose(point.sum(axis=1) % 2, 0)


def lines_by_hand(rows):
    """Texts by (id, text), rows in corpus order given."""
    seen, shorter, out = set(), set(), {}
    for doc_id, text in rows:
        kept = []
        for raw in [] if text is None else text.split("\n"):
            line = raw.strip(" ")
            if re.search(r"\S", line):
                cuts = [(line[:i] + line[i + 1:], i) for i in range(len(line))]
                again = line in seen or any(c in shorter for c in cuts) or any(c in seen for c, _ in cuts) or (line, None) in shorter
                seen.add(line)
                shorter.update(cuts)
                shorter.update((c, None) for c, _ in cuts)
                if again:
                    continue
            kept.append(raw)
        out[doc_id] = (None if text is None else "\n".join(kept), 0 if text is None else len(text.split("\n")) - len(kept))
    return out


def test_lines_within_one_edit_go(spark):
    draw = random.Random(4)
    base = ["".join(draw.choices("abcd éж", k=draw.randint(15, 60))).strip() + "x" for _ in range(30)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(draw.randint(0, 6)):
            line = draw.choice(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2])):
                at, kind = draw.randrange(len(line)), draw.random()
                line = line[:at] + (draw.choice("abq") if kind < 0.7 else "") + line[at + (kind < 0.35 or kind >= 0.7):]
            text.append(draw.choice(["", "  "]) + line)
        rows.append((i, "\n".join(text)))
    rows += [(100, None), (101, ""), (102, "short\nshort"), (103, "z" * 5000), (104, "z" * 5001)]
    docs = spark.createDataFrame([(i, t, 1, "a") for i, t in rows], "doc_id long, text string, h int, n_chars string")
    found = lines.remove_repeated_lines(docs)
    assert {r.doc_id: (r.text, r.n_removed) for r in found.collect()} == lines_by_hand(rows)


def test_line_dedup_stage_cases(spark):
    long = "a line that is long enough to count"
    rows = [(2, f"{long}\nkeep", 9), (1, long, 9), (1, long, 9), (None, f"{long}!", 9), (3, "short", 5), (4, None, None), (5, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    kept = lines.without_repeated_lines(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, long, 9), (2, "keep", 4), (3, "short", 5), (4, None, None), (5, "", 0)], key=str)
    assert lines.without_repeated_lines(docs.limit(0)).collect() == []


def test_short_lines_are_lines(spark):
    rows = [
        (1, "Read more\nShare this\nx\n\n- 1 -"), (2, "own words of the second\nRead more\n\nShare  this\n\t\n\r"),
        (3, "Read more.\nhi\n- 2 -\ny\n\t\n\r"), (4, "hi\nho\nxy\nabc"),
    ]
    found = lines.remove_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.text, r.n_removed) for r in found.collect()} == {
        1: (rows[0][1], 0), 2: ("own words of the second\n\n\t\n\r", 2), 3: ("hi\n\t\n\r", 3), 4: ("abc", 3),
    }


@pytest.mark.parametrize("likeness, lost", [(0.80, "93"), (0.81, "26"), (0.82, "6"), (0.85, "0.04")])
def test_docstring_gives_the_lost_links(likeness, lost):
    q, n, most = (1 - likeness) * 255 / 256, minhash.POSITIONS, minhash.most_differences(0.8)
    expected = 1e6 * sum(math.comb(n, k) * q**k * (1 - q) ** (n - k) for k in range(most + 1, n + 1))
    assert f"{expected:.{2 * ('.' in lost)}f}" == lost
    assert re.search(rf"\b{re.escape(lost)}\b[^,]* at\s+(exactly\s+)?{likeness:.2f}", minhash.near_duplicates.__doc__)


CLASHING = ["removed", "_lines", "_likely", "_tie", "_doc", "_t", "n_lines", "n_removed", "tie", "likely", "lines", "at_doc", "_0", "_1", "h", "g"]


def test_columns_of_any_name(spark):
    line = "a line that stands in two documents"
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` int" for c in CLASHING) + ", n_chars int"
    rows = [(1, f"{line}\nown", *range(len(CLASHING)), 7), (2, f"{line}\nother one", *range(100, 100 + len(CLASHING)), 8), (3, line, *([None] * len(CLASHING)), 9)]
    docs = spark.createDataFrame(rows, schema)
    kept = lines.without_repeated_lines(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [rows[0], (2, "other one", *rows[1][2:-1], 9)]
    found = lines.remove_repeated_lines(docs)
    assert found.columns == [*(c for c in docs.columns if c not in ("n_lines", "n_removed")), "n_lines", "n_removed"]
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed, r.removed, r["_tie"], r["_0"]) for r in found.collect()} == {
        1: (f"{line}\nown", 2, 0, 0, 3, 12), 2: ("other one", 2, 1, 100, 103, 112), 3: ("", 1, 1, None, None, None),
    }
    assert lines.remove_repeated_lines(docs.limit(0)).collect() == []


def test_lattice_counts_thousands_of_linked_vectors(spark):
    """Dense clouds, in which every vector has hundreds of links that meet in many cells."""
    rng = np.random.default_rng(8)
    rows = []
    for cloud in range(4):
        base = rng.standard_normal(64)
        for _ in range(350):
            noisy = base + rng.standard_normal(64) * rng.choice([0.15, 0.25, 0.3])
            rows.append((len(rows), [float(x) for x in noisy.astype(np.float32)], cloud % 2, "n", 1))
    for i in range(0, 300, 3):
        rows.append((len(rows), rows[i][1], rows[i][2], "n", 1))
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(vectors(spark, rows), 0.93).collect()}
    want = brute(rows)
    assert sum(n for n, *_ in want.values()) > 50_000
    # the method may lose a few links right at the threshold
    assert all(found[k][0] <= want[k][0] for k in want)
    assert sum(n for n, *_ in found.values()) >= 0.999 * sum(n for n, *_ in want.values())
    assert sum(found[k][1:] == want[k][1:] for k in want) >= 0.99 * len(want)


def test_smallest_reachable():
    draw = random.Random(3)
    for n in (1, 2, 50):
        links = [(draw.randrange(n), draw.randrange(n)) for _ in range(n // 2)]
        want = roots(range(n), links)
        a, b = (np.array([p[i] for p in links], np.int64) for i in (0, 1))
        assert lattice.smallest_reachable(n, a, b).tolist() == [want[i] for i in range(n)]
    chain = np.arange(999)
    assert (lattice.smallest_reachable(1000, chain, chain + 1) == 0).all()


def test_visible_text_is_what_the_pattern_says(spark):
    odd = ["", " ", "\t", "\r", "\u00a0", "\u2003", "a", "!", "~", "\x7f", " a", "\ta", "\x1f", "\x85", "\u00e4", "\u3000b", "\U0001f600", " \u2028 "]
    rows = spark.createDataFrame([(x,) for x in odd], "line string").select(lines.visible("line").alias("quick"), F.col("line").rlike(lines.VISIBLE).alias("slow"))
    assert [r["quick"] for r in rows.collect()] == [r["slow"] for r in rows.collect()]


def test_lines_are_counted_without_splitting_the_text_again(spark):
    texts = [None, "", "\n", "a", "a\n", "\n\nb\r\nc\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = lines.remove_repeated_lines(docs)
    assert {r["doc_id"]: r["n_lines"] for r in got.collect()} == {i: 0 if t is None else t.count("\n") + 1 for i, t in enumerate(texts)}
    assert "size(split" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_workers_remember_no_words():
    memory._only.clear()
    text = " ".join(f"Word{i % 50}" for i in range(500)) + " \u00c4b"
    assert words.word_hashes(text).tolist() == [xxhash.xxh64_intdigest(w) for w in text.encode().lower().split()]
    assert not len(words.word_hashes(None)) and not memory._only


def test_no_task_needs_two_workers_for_sets(spark, monkeypatch):
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df)

    monkeypatch.setattr(minhash, "materialize", noted)
    docs = spark.createDataFrame([(i, f"a b c d e {i}") for i in range(30)], "doc_id long, text string")
    got = minhash.sets_of(docs, spark.range(0, 30, 3).toDF("node"), 5)
    assert {r["node"]: r["hashes"] for r in got.collect()} == {i: words.shingles(words.word_hashes(f"a b c d e {i}"), 5).tobytes() for i in range(0, 30, 3)}
    assert ["ArrowEvalPython" in p for p in plans] == [True, False] and ["MapInArrow" in p for p in plans] == [False, True]


def test_no_stored_table_filters_and_computes_in_workers_at_once(spark, monkeypatch):
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df)

    monkeypatch.setattr(minhash, "materialize", noted)
    docs = spark.createDataFrame([(i, f"a b c d e f g {i // 2}") for i in range(20)], "doc_id long, text string")
    got = minhash.near_duplicates(docs, 2, 80)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {i: i // 2 * 2 for i in range(20)}
    assert len(plans) > 10 and not any("ArrowEvalPython" in p and "MapInArrow" in p for p in plans)
