"""Quality rules by an isolation forest over rule statistics.

Every text gets the counts that quality rules look at (words, symbols, repeated lines and
word windows, letters, capitals, signs, line ends). A forest of trees, each split at random
features and random values, is grown on clean labelled texts; a text that random splits set apart
after few steps is unlike them. How short a path may be is calibrated from labelled rows, for each
length class on its own, as the statistics of short texts scatter more.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Labelled texts of each quality that are learned from, at most. Bounds what reaches the driver.
SAMPLE = 4000
TREES, TREE_ROWS, SEED = 200, 1024, 11
#: Shares of short texts scatter; they are drawn to 0 as if a text had so many more words, without any finding.
CALM = 50
#: Words from which a length class begins.
CLASSES = (50, 150, 400)
#: Share of clean labelled texts that a threshold may reject, at most; a class with fewer than ``FEW`` texts
#: of either quality takes the threshold of all.
LOSS, FEW = 0.005, 40
#: The plain rules: fewest words, and largest share of words in repeated windows.
FEWEST_WORDS, REPEATED_PERCENT, WINDOW = 50, 50, 3
TEXTS = 500  # texts handled at a time

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
SIGNS = re.compile(r"""[!-/:-@\[-`{-~]""")
ENDS = ('.', '!', '?', '"', "'", '”', '»', '…')

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The features of the forest: shares and means, so that texts of all lengths compare.
FEATURES = (
    "log_words", "word_length", "symbols_a_word", "dup_lines", "repeat_words", "letters", "digits", "capitals",
    "ended_lines", "log_words_a_line", "top_word", "signs_a_word", "bare_words",
)


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of ``size`` words found twice or more, first one included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    window = ids[:n]
    for i in range(1, size):
        window = np.unique(window * len(known) + ids[i:i + n], return_inverse=True)[1]
    often = np.bincount(window)[window] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(often), 1)
    np.add.at(covered, np.flatnonzero(often) + size, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def statistics(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """``COUNTS`` and ``FEATURES`` of one whole text; NULL counts as empty, which has zeros only."""
    text = text or ""
    words = text.encode().split()  # bytes.split() knows ASCII white space only
    if not words:
        return (0, 0, sum(map(text.count, SYMBOLS)), 0, 0), (0.0,) * len(FEATURES)
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    copies = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    letters = re.sub(r"[\W\d_]+", "", text)
    counted: dict[bytes, int] = {}
    for w in words:
        counted[w] = counted.get(w, 0) + 1
    # a line of one or two words is a heading or a rest; its end says nothing
    full = [line.rstrip(BLANKS) for line in lines if len(line.split()) > 2] or lines
    bare = sum(c for w, c in counted.items() if w.isascii() and w.upper() == w.lower())  # no letters
    calm = n / (n + CALM)
    features = (
        math.log(n), min(chars / n, 50.0), calm * symbols / n, calm * copies / len(lines), calm * repeats / n, len(letters) / chars,
        calm * sum(map(text.count, "0123456789")) / chars, calm * sum(map(str.isupper, letters)) / max(1, len(letters)),
        sum(line.endswith(ENDS) for line in full) / len(full), math.log(n / len(lines)), calm * max(counted.values()) / n,
        calm * min(len(SIGNS.findall(text)) / n, 10.0), calm * bare / n,
    )
    return (n, chars, symbols, copies, repeats), features


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < FEWEST_WORDS or 100 * n_repeat_words > REPEATED_PERCENT * n_words


def mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` values: what a leaf of ``n`` rows stands for."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow(rows: np.ndarray, rng: np.random.Generator, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree as arrays over a complete binary tree: feature (-1: leaf), split value, path length at leaves."""
    size = 2 ** (depth + 1) - 1
    feature, split, path = np.full(size, -1, np.int32), np.zeros(size), np.zeros(size)
    todo = [(0, np.arange(len(rows)), 0)]
    while todo:
        node, here, level = todo.pop()
        low, high = rows[here].min(axis=0), rows[here].max(axis=0)
        free = np.flatnonzero(high > low)
        if level == depth or len(here) < 2 or not len(free):
            path[node] = level + mean_path(len(here))
            continue
        feature[node] = f = int(rng.choice(free))
        at = high[f] - rng.uniform(0, high[f] - low[f])
        split[node] = at = at if at > low[f] else high[f]  # above the lowest value, so both sides have rows
        right = rows[here, f] >= at
        todo += [(2 * node + 1, here[~right], level + 1), (2 * node + 2, here[right], level + 1)]
    return feature, split, path


@dataclass
class Forest:
    feature: np.ndarray  # (trees, nodes)
    split: np.ndarray
    path: np.ndarray
    depth: int
    rows: int  # rows a tree was grown on
    threshold: np.ndarray | None = None  # highest score that is kept, of each length class

    def scores(self, features: np.ndarray) -> np.ndarray:
        """0 to 1; above one half: set apart sooner than a random row is. Mean path lengths over all trees."""
        tree, row = np.arange(len(self.feature)), np.arange(len(features))[:, None]
        node = np.zeros((len(features), len(self.feature)), np.int64)
        for _ in range(self.depth):
            f = self.feature[tree, node]
            right = features[row, np.maximum(f, 0)] >= self.split[tree, node]
            node = np.where(f < 0, node, 2 * node + 1 + right)
        return 2.0 ** (-self.path[tree, node].mean(axis=1) / max(mean_path(self.rows), 1e-9))

    def keeps(self, scores: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        return scores <= self.threshold[length_class(n_words)]


def length_class(n_words: np.ndarray) -> np.ndarray:
    return np.searchsorted(CLASSES, n_words, side="right")


def plant(features: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
    """A forest over rows of ``features``, each tree on at most ``tree_rows`` of them."""
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(features))
    depth = max(1, math.ceil(math.log2(max(size, 2))))
    grown = [grow(features[rng.choice(len(features), size, replace=False)], rng, depth) for _ in range(trees)]
    return Forest(*(np.stack(part) for part in zip(*grown)), depth, size)


def best_threshold(clean: np.ndarray, junk: np.ndarray, loss: float) -> float:
    """The score bound that rejects most junk beyond its share of clean rows, at most ``loss`` of these rejected.

    Halfway to the next score that is rejected, so that a score between the two isn't decided by one row.
    """
    if not len(clean):
        return math.inf
    floor = np.quantile(clean, 1 - loss, method="higher")
    every = np.unique(np.concatenate([clean[clean >= floor], junk[junk >= floor], [floor]]))
    gain = [(junk > s).mean() - (clean > s).mean() if len(junk) else 0.0 for s in every]
    at = len(gain) - 1 - int(np.argmax(gain[::-1])) if len(junk) else len(gain) - 1
    following = every[at + 1] if at + 1 < len(every) else 1.0
    return float((every[at] + following) / 2)


def calibrate(forest: Forest, features: np.ndarray, n_words: np.ndarray, good: np.ndarray, loss: float = LOSS) -> None:
    scores, classes = forest.scores(features), length_class(n_words)
    whole = best_threshold(scores[good], scores[~good], loss)
    forest.threshold = np.full(len(CLASSES) + 1, whole)
    for k in range(len(CLASSES) + 1):
        own = classes == k
        if min((own & good).sum(), (own & ~good).sum()) >= FEW:
            forest.threshold[k] = best_threshold(scores[own & good], scores[own & ~good], loss)


def measured(docs: DataFrame, *keep: str | Column) -> DataFrame:
    """``keep`` columns, ``COUNTS`` (long) and ``features`` (array) of ``text``."""
    source = docs.select(*keep, F.col("text").alias("_text"))
    names = source.columns[:-1]
    layout = pa.struct([(c, pa.int64()) for c in COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                found = [statistics(t) for t in batch.column(len(names)).to_pylist()]
                counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *map(pa.array, counts.T), pa.array([f for _, f in found], pa.list_(pa.float64()))],
                    [*names, *layout.names, "features"],
                )

    kinds = ", ".join([*(f"`{c}` {k}" for c, k in source.dtypes[:-1]), *(f"{c} long" for c in COUNTS), "features array<double>"])
    return source.mapInArrow(run, kinds)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest | None:
    """Forest and thresholds from the labelled rows of ``docs``; None without clean ones.

    ``labels``: ``doc_id`` and ``quality`` (1 clean, 0 junk). At most ``sample`` texts of each quality are used,
    those with the smallest hashes of their ids, and only those that pass the plain rules. The trees are grown on
    three quarters of the clean ones; the thresholds come from the other clean ones and all junk. NULL and other
    qualities are left out; a text with both labels counts as junk.
    """
    graded = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").alias("_quality"))
    order = F.xxhash64("_id")
    some = graded.where("_quality = 1").orderBy(order, "_id").limit(sample).union(graded.where("_quality = 0").orderBy(order, "_id").limit(sample))
    # at most two times ``sample`` rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(some), "_id")
    rows = measured(texts, "_id", "_quality").orderBy(order, "_id").collect()
    rows = [r for r in rows if not base_failed(r.n_words, r.n_repeat_words)]
    good = np.array([r["_quality"] == 1 for r in rows], bool)
    if not good.any():
        return None
    features, n_words = np.array([r.features for r in rows]), np.array([r.n_words for r in rows])
    clean = np.flatnonzero(good)
    grown = clean[np.arange(len(clean)) % 4 != 0] if len(clean) > 3 else clean
    forest = plant(features[grown])
    others = np.setdiff1d(np.arange(len(rows)), grown) if len(clean) > 3 else np.arange(len(rows))
    calibrate(forest, features[others], n_words[others], good[others])
    return forest


def judge(docs: DataFrame, forest: Forest | None, *keep: str | Column) -> DataFrame:
    """``keep`` columns, ``COUNTS``, ``base_failed``, ``kept``, ``score`` of every row, by its whole ``text``.

    A text is kept if it passes the plain rules (at least 50 words, at most half of them in repeated
    three-word windows) and its score is within the threshold of its length class; without a forest the plain
    rules decide. NULL and empty texts have no words, score 0 and fail. Rows are neither merged nor dropped, equal
    texts get equal results, ties with the threshold are kept, and an empty table gives an empty one.
    """
    source = docs.select(*keep, F.col("text").alias("_text"))
    names, kept_kinds = source.columns[:-1], source.dtypes[:-1]
    numbered = source.toDF(*[f"_{i}" for i in range(len(names))], "text")
    rows = measured(numbered, *[f"_{i}" for i in range(len(names))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_words").to_numpy()
            failed = (n < FEWEST_WORDS) | (100 * batch.column("n_repeat_words").to_numpy() > REPEATED_PERCENT * n)
            features = np.array(batch.column("features").to_pylist()).reshape(batch.num_rows, len(FEATURES))
            scores = np.zeros(batch.num_rows)
            fine = np.ones(batch.num_rows, bool)
            if forest is not None:
                for at in range(0, batch.num_rows, TEXTS):
                    part = slice(at, at + TEXTS)
                    scores[part] = forest.scores(features[part])
                scores[n == 0] = 0.0
                fine = forest.keeps(scores, n)
            columns = [*batch.columns[:-1], pa.array(failed), pa.array(fine & ~failed), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "base_failed", "kept", "score"])

    kinds = [*(f"_{i} {k}" for i, (_, k) in enumerate(kept_kinds)), *(f"{c} long" for c in COUNTS), "base_failed boolean", "kept boolean", "score double"]
    return rows.mapInArrow(run, ", ".join(kinds)).toDF(*names, *COUNTS, "base_failed", "kept", "score")
