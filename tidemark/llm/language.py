"""Language identification by nearest centroid.

A text is lower-cased, everything but letters becomes a word boundary, and its letter
n-grams (1 to 3, boundaries included) are counted into hashed buckets. Counts are damped
(log), weighted by inverse document frequency and scaled to length 1. Each language has
several centroids, found by spherical k-means over a bounded sample of labelled texts, and
the nearest centroid by cosine gives the language. A text is rejected if it is like nothing
learned: farther from its nearest centroid than halfway from a high quantile of the sample's
distances there (each as if the text itself hadn't been learned from) to 1 (nothing in common). Short texts have few n-grams and lie far out, so the
quantiles are those of a length class; each sample text is also cut to one of the short classes.
A single odd or mislabelled text doesn't move a quantile.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.memory import let_go, tidy
from tidemark.session import arrow_batches, materialize

BITS = 12
#: Whole texts handed to a worker at a time by the stage.
ROWS = 500
#: Labelled texts a language is learned from, about; all, if it has fewer. Bounds what reaches the driver.
SAMPLE = 1000
CENTROIDS, ROUNDS = 4, 12
#: Letters (boundaries included) from which a length class begins; sample texts are cut to all but the last.
CLASSES = (3, 6, 12, 25, 50, 100, 200, 400)
#: Share of the sample texts of a centroid and class that bounds their distances; with fewer than
#: ``FEW`` texts those of the whole language count, or else of all. A class with fewer in all counts
#: with the shorter ones.
HIGH, FEW = 0.99, 50
UNKNOWN = "und"

_letter: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, one space for every run of anything else, and around."""
    if not _letter:
        _letter.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    points = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    points = np.where(_letter[0][points], points, 32)
    space = points == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    keep[0] = True
    return points[keep]


def length_class(n: int) -> int:
    return max(0, bisect.bisect_right(CLASSES, n) - 1)


def gram_counts(text: str, first: int | None = None) -> np.ndarray | None:
    """Damped counts by bucket, of the ``first`` letters if given; None if the text has no letter."""
    points = letters(text)[:first].astype(np.uint32)
    if len(points) < 3:  # a letter has a boundary on both sides
        return None
    mix, shift = np.uint32(2654435761), np.uint32(32 - BITS)
    pairs = points[:-1] * np.uint32(40503) + points[1:]
    triples = pairs[:-1] * np.uint32(40503) + points[2:]
    counts = np.zeros(1 << BITS, np.int64)
    for order, codes in enumerate((points, pairs, triples)):
        counts += np.bincount((codes * mix + np.uint32(order * 97)) * mix >> shift, minlength=1 << BITS)
    return np.log1p(counts).astype(np.float32)


def scaled(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=-1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def cluster(rows: np.ndarray, k: int) -> np.ndarray:
    """Centroids by spherical k-means from farthest-first starts."""
    centers = [scaled(rows.mean(axis=0))]
    near = rows @ centers[0]
    while len(centers) < min(k, len(rows)):
        centers.append(rows[int(near.argmin())])
        near = np.maximum(near, rows @ centers[-1])
    found = np.array(centers)
    for _ in range(ROUNDS):
        own = (rows @ found.T).argmax(axis=1)
        found = np.array([scaled(rows[own == j].mean(axis=0)) if (own == j).any() else found[j] for j in range(len(found))])
    return found


def as_if_unseen(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Cosines of the rows that ``centers`` were learned from, to the nearest as it were without the row itself."""
    cosines = rows @ centers.T
    own = cosines.argmax(axis=1)
    for j in range(len(centers)):
        at = np.flatnonzero(own == j)
        total = rows[at].sum(axis=0)
        along = rows[at] @ total
        rest = np.sqrt(np.maximum(total @ total - 2 * along + 1, 1e-9))
        cosines[at, j] = (along - 1) / rest if len(at) > 1 else -1.0
    return cosines


def reaches(distances: np.ndarray, own: np.ndarray, kinds: np.ndarray, languages: list[str]) -> np.ndarray:
    """Distance by centroid and length class from which a text is like nothing learned.

    Of every sample text or cut: ``distances`` to the nearest centroid of its language, which is ``own``,
    and its length class. A shorter class reaches at least as far as a longer one.
    """
    spoken = np.array(languages)
    out = np.zeros((len(languages), len(CLASSES)))
    for kind in range(len(CLASSES) - 1, -1, -1):
        low = next((k for k in range(kind, -1, -1) if ((kinds >= k) & (kinds <= kind)).sum() >= FEW), 0)
        there = (kinds >= low) & (kinds <= kind)
        there = there if there.any() else kinds >= 0
        for j in range(len(languages)):
            groups = (there & (own == j), there & (spoken[own] == spoken[j]), there)
            group = next((g for g in groups if g.sum() >= FEW), groups[-1])
            out[j, kind] = (1 + np.quantile(distances[group], HIGH)) / 2
        if kind + 1 < len(CLASSES):
            out[:, kind] = np.maximum(out[:, kind], out[:, kind + 1])
    return out


@dataclass
class Model:
    languages: list[str]  # of each centroid
    weights: np.ndarray
    centroids: np.ndarray
    reach: np.ndarray  # of each centroid and length class


def learn(docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model | None:
    """Fit on rows with a text and a language; None if there are none.

    About ``sample`` texts of each language are taken by a hash of key and text, so the driver
    holds at most that many vectors a language, whatever the size of the table.
    """
    known = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample / n))])
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                n = len(letters(text))
                cut = CLASSES[zlib.crc32(text.encode("utf-8", "surrogatepass")) % (len(CLASSES) - 1)]
                for whole, first in ((True, n), *([(False, cut)] if cut < n else [])):
                    row = gram_counts(text, first)
                    if row is not None:
                        at = np.flatnonzero(row).astype("<u2")
                        out.append({"lang": lang, "at": at.tobytes(), "value": row[at].astype("<f4").tobytes(), "whole": whole, "kind": length_class(first)})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("lang", pa.string()), ("at", pa.binary()), ("value", pa.binary()), ("whole", pa.bool_()), ("kind", pa.int32()),
            ]))

    drawn_rows = known.where(drawn).select("text", "lang").mapInArrow(tidy(run), "lang string, at binary, value binary, whole boolean, kind int").collect()
    rows, cuts = (sorted(r for r in drawn_rows if r["whole"] == whole) for whole in (True, False))
    if not rows:
        return None

    def dense(some: list) -> np.ndarray:
        table = np.zeros((len(some), 1 << BITS), np.float32)
        for i, r in enumerate(some):
            table[i, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["value"], "<f4")
        return table

    table = dense(rows)
    weights = (np.log((1 + len(rows)) / (1 + (table > 0).sum(axis=0))) + 1).astype(np.float32)
    table = scaled(table * weights)
    languages, centers, unseen = [], [], []
    for lang in sorted({r["lang"] for r in rows}):
        spoken = np.array([r["lang"] == lang for r in rows])
        found = cluster(table[spoken], centroids)
        unseen.append((spoken, as_if_unseen(table[spoken], found), len(languages)))
        languages += [lang] * len(found)
        centers.append(found)
    centers = np.concatenate(centers).astype(np.float32)
    of_whole = np.full((len(rows), len(languages)), -1.0, np.float32)
    for spoken, cosines, first in unseen:
        of_whole[spoken, first:first + cosines.shape[1]] = cosines
    of_cuts = [scaled(dense(cuts[i:i + 512]) * weights) @ centers.T for i in range(0, len(cuts), 512)]
    for i, cosines in enumerate(of_cuts):
        cosines[np.array([r["lang"] for r in cuts[512 * i:512 * (i + 1)]])[:, None] != np.array(languages)] = -1.0
    to_own = np.concatenate([of_whole, *of_cuts])
    reach = reaches(1 - to_own.max(axis=1), to_own.argmax(axis=1), np.array([r["kind"] for r in [*rows, *cuts]]), languages)
    return Model(languages, weights, centers, reach)


def predict(docs: DataFrame, model: Model | None, *keep: str | Column) -> DataFrame:
    """``keep`` columns of every row, and ``lang_pred``, ``score`` (0 to 1), ``rejected``.

    NULL texts and texts without a letter are ``und``, score 0, rejected. Without a model all texts
    are ``und``, and those with a letter are not rejected. Only the whole text is looked at. Of centroids equally near
    the first counts; rows are neither merged nor dropped, so repeated rows give repeated rows.
    """
    source = docs.select(*keep, F.col("text").alias("_text"))
    kept = source.columns[:-1]

    def judge(texts: list[str | None]) -> list[tuple[str, float, bool]]:
        rows = [None if t is None else gram_counts(t) for t in texts]
        out = [(UNKNOWN, 0.0, row is None) for row in rows]
        there = [i for i, row in enumerate(rows) if row is not None]
        if model and there:
            cosines = scaled(np.array([rows[i] for i in there]) * model.weights) @ model.centroids.T
            for i, best, row in zip(there, cosines.argmax(axis=1).tolist(), cosines):
                cosine = float(row[best])
                out[i] = (model.languages[best], min(1.0, max(0.0, cosine)), 1 - cosine > model.reach[best, length_class(len(letters(texts[i])))])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go("language")
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = judge(batch.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c) for c in kept), pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()), pa.array([bool(x[2]) for x in found], pa.bool_()),
                ], [*kept, "lang_pred", "score", "rejected"])

    schema = ", ".join(f"`{c}` {kind}" for c, kind in source.dtypes[:len(kept)])
    return source.mapInArrow(tidy(run), f"{schema}, lang_pred string, score double, rejected boolean")


def keep_known_languages(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Rows of ``docs``, all columns, without those that are rejected; learns from their labels.

    Workers get texts in small batches and give back ids and hashes of the rejected ones only, which are stored.
    """
    named = [F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"), F.xxhash64(F.lit(1), "text").alias("_g")]
    with arrow_batches(docs.sparkSession, ROWS):
        judged = predict(docs.where("text is not null"), learn(docs, sample), *named)
        gone = materialize(judged.where("rejected").select("_id", "_h", "_g"))
    numbered = {c: "_text" if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)}  # whatever their names
    own = docs.select(*(F.col(c).alias(n) for c, n in numbered.items())).where("_text is not null")
    # the id is part of the key, so copies of a text are no hot spot
    same = F.col(numbered["doc_id"]).eqNullSafe(F.col("_id")) & (F.xxhash64("_text") == F.col("_h")) & (F.xxhash64(F.lit(1), "_text") == F.col("_g"))
    return own.join(gone, same, "left_anti").select(*(F.col(n).alias(c) for c, n in numbered.items()))
