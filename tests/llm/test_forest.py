"""Rule statistics and the isolation forest against plain Python."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from tidemark.llm import forest, queries

ODD = [
    None, "", " \t\n", "one", "a b c a b c", "a a a a", "x y   z ", "# * $ % & | < >\n\n# * $ % & | < >\n ", "same line\nsame line\r\nsame line",
    "é ü " * 400, "word " * 3000, "a\x0bb\x0cc", "l1 q\n\n \nl1 q\nl1 q", "1 2 3 " * 40 + "end",
]


def counts_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, copies = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(covered)


@pytest.mark.parametrize("text", [t for t in ODD if not t or len(t) < 4000])
def test_counts_equal_plain_python(text):
    assert forest.statistics(text)[0] == counts_by_hand(text)


def test_counts_of_random_texts():
    draw = random.Random(1)
    for _ in range(200):
        text = "".join(draw.choices(["a", "b", "#", " ", " ", "\n", "é", "\t"], k=draw.randint(0, 60)))
        assert forest.statistics(text)[0] == counts_by_hand(text)


def path_by_hand(model, tree, row):
    node = 0
    while model.feature[tree, node] >= 0:
        node = 2 * node + 1 + int(row[model.feature[tree, node]] >= model.split[tree, node])
    return model.path[tree, node]


def mean_path_by_hand(n):
    return 0 if n < 2 else 1 if n == 2 else 2 * (math.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def test_scores_are_mean_path_lengths():
    rng = np.random.default_rng(2)
    rows = np.concatenate([rng.normal(0, 1, (400, 5)), rng.normal(9, 1, (5, 5))])
    model = forest.plant(rows[:400], trees=30, tree_rows=64)
    want = [2 ** (-np.mean([path_by_hand(model, t, r) for t in range(30)]) / mean_path_by_hand(64)) for r in rows]
    assert model.scores(rows) == pytest.approx(want)
    assert model.scores(rows)[400:].min() > np.quantile(model.scores(rows)[:400], 0.95)


def test_trees_follow_their_rows():
    """Leaves hold the rows that reach them: depth reached plus the mean path of that many rows."""
    rng = np.random.default_rng(3)
    rows = np.round(rng.normal(0, 1, (50, 3)), 1)  # with ties
    feature, split, path = forest.grow(rows, np.random.default_rng(4), 6)
    reached = {}
    for row in rows:
        node, level = 0, 0
        while feature[node] >= 0:
            node, level = 2 * node + 1 + int(row[feature[node]] >= split[node]), level + 1
        reached.setdefault((node, level), []).append(row)
    assert sum(map(len, reached.values())) == 50
    for (node, level), here in reached.items():
        assert path[node] == pytest.approx(level + mean_path_by_hand(len(here)))
        assert level == 6 or len(here) == 1 or (np.ptp(here, axis=0) == 0).all()


def test_growing_never_leaves_an_empty_side():
    tiny = np.array([[0.0], [5e-324], [5e-324]])
    for seed in range(50):
        forest.grow(tiny, np.random.default_rng(seed), 3)
        forest.grow(np.zeros((9, 2)), np.random.default_rng(seed), 3)


def test_threshold_keeps_clean_rows():
    clean, junk = np.linspace(0.3, 0.5, 1000), np.linspace(0.48, 0.9, 300)
    at = forest.best_threshold(clean, junk, loss=0.01)
    assert (clean > at).mean() <= 0.01 and (junk > at).mean() > 0.9
    assert forest.best_threshold(clean, junk[:0], 0.01) > clean.max()
    assert forest.best_threshold(clean[:0], junk, 0.01) == math.inf


def clean_text(draw):
    vocabulary = [f"{a}{b}{c}" for a in ("ba", "lo", "mi", "ten") for b in ("r", "st", "v", "nd") for c in ("a", "en", "o", "is")]
    return "\n".join(" ".join(draw.choices(vocabulary, k=draw.randint(8, 20))).capitalize() + "." for _ in range(draw.randint(8, 20)))


def labelled(draw, n):
    rows = []
    for i in range(n):
        text, quality = clean_text(draw), 1
        if i % 6 == 0:
            text, quality = " ".join(w + draw.choice(["$$$", "###", "!!|"]) for w in text.upper().split()), 0
        rows.append((i, text, quality))
    return rows


def test_learns_and_judges(spark, tmp_path):
    draw = random.Random(5)
    rows = labelled(draw, 900)
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t, _ in rows], "doc_id long, text string, n_words int, kept string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows if i < 600] + [(None, 1, 0), (601, None, 0), (1, 0, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    model = forest.learn(docs, labels)
    extra = spark.createDataFrame([(i + 5000, t, None, None) for i, t in enumerate(ODD)] + [(None, clean_text(draw), None, None), (899, rows[899][1], 1, "")], docs.schema)
    judged = forest.judge(docs.union(extra), model, "doc_id").collect()
    assert len(judged) == 900 + len(ODD) + 2
    by_id = {r.doc_id: r for r in judged}
    held_out = [(by_id[i], q) for i, _, q in rows if i >= 600]
    assert np.mean([r.kept for r, q in held_out if q == 1]) >= 0.97
    assert np.mean([r.kept for r, q in held_out if q == 0]) <= 0.05
    for i, text in enumerate(ODD):
        if len(text or "") < 4000:
            row = by_id[5000 + i]
            assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == counts_by_hand(text)
            assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
            assert not (row.base_failed and row.kept)
    # equal texts get equal verdicts, whatever the partition
    again = {r.doc_id: r for r in forest.judge(docs.repartition(7), model, "doc_id").collect()}
    assert all(again[i] == by_id[i] for i, _, _ in rows)
    assert forest.judge(docs.limit(0), model, "doc_id").collect() == []


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, clean_text(random.Random(6))), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert forest.learn(docs, labels) is None
    assert [(r.doc_id, r.base_failed, r.kept) for r in forest.judge(docs, None, "doc_id").orderBy("doc_id").collect()] == [(1, False, True), (2, True, False)]


def test_query_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.op11_isolation_forest(spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows[::23]:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == counts_by_hand(texts[r.doc_id])[:4]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    passed = [r for r in rows if r.doc_id in quality and not r.base_failed]
    assert np.mean([r.kept for r in passed if quality[r.doc_id] == 1]) >= 0.97
