"""Quality rules: base statistics, and gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Labelled rows that the trees are fitted on, at most: those of smallest hashed doc_id.
MAX_LABELS = 20_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?.,;:")] = True

FEATURES = ("log_words", "chars_per_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "digit_share", "marks_per_word", "distinct_share", "log_lines")
#: The direction in which a feature may move the score of being good: more junk never helps.
MONOTONE = (0, 0, -1, -1, -1, -1, 0, 0, 0, 0)


def statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(n x 5 base counts, n x len(FEATURES) features) of whole texts.

    Base counts: words, code points in words, symbols, lines with a word equal to an earlier line,
    words in 3-word windows that occur twice or more in the text.
    """
    words = common.Words(column)
    n_docs = len(column)
    n_words = words.counts()
    data = words.data
    chars = words.per_doc(words.inside & ((data & 0xC0) != 0x80))
    symbols = words.per_doc(_SYMBOL[data])
    h = words.hashes()
    doc = words.doc_of_word()
    repeats = np.zeros(n_docs, np.int64)
    if len(h) >= 3:
        window = common.runs(h, 3)
        inside = doc[2:] == doc[:-2]
        at = np.flatnonzero(inside)
        key = common.mix(window[at] ^ (doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        _, codes, counts = np.unique(key, return_inverse=True, return_counts=True)
        twice = at[counts[codes] > 1]
        covered = np.zeros(len(h), bool)
        for k in range(3):
            covered[twice + k] = True
        repeats = np.bincount(doc[covered], minlength=n_docs)
    distinct = np.zeros(n_docs, np.int64)
    if len(h):
        own = np.unique(common.mix(h ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))), return_index=True)[1]
        distinct = np.bincount(doc[own], minlength=n_docs)
    dup_lines, lines = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
    for i, text in enumerate(column.to_pylist()):
        if text:
            own_lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
            lines[i], dup_lines[i] = len(own_lines), len(own_lines) - len(set(own_lines))
    base = np.stack([n_words, chars, symbols, dup_lines, repeats], 1).astype(np.int64)
    w, c = np.maximum(n_words, 1), np.maximum(chars, 1)
    features = np.stack([
        np.log1p(n_words), chars / w, symbols / w, dup_lines / np.maximum(lines, 1), repeats / w, words.per_doc(_UPPER[data]) / c,
        words.per_doc(_DIGIT[data]) / c, words.per_doc(_MARK[data]) / w, distinct / w, np.log1p(lines),
    ], 1).astype(np.float64)
    return base, features


@dataclass
class Trees:
    """Trees flattened into node arrays: node i goes to left[i] if x[feature[i]] <= threshold[i], else right[i].

    Leaves lead to themselves, so every row takes `depth` steps in all trees at once.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float
    cut: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of being good."""
        at = np.repeat(self.roots[None, :], len(x), 0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            low = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(low, self.left[at], self.right[at])
        raw = self.base + self.value[at].sum(1)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))

    def keeps(self, x: np.ndarray) -> np.ndarray:
        return self.score(x) >= self.cut


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, l2: float = 1.0, least: float = 1.0, bins: int = 48, monotone: tuple[int, ...] = MONOTONE) -> Trees:
    """Second-order boosting of the logistic loss on binned features.

    A split on a constrained feature must order its children's values; each child then keeps to its
    side of their midpoint, so the whole tree is monotone.
    """
    good = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(good / (1 - good)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    raw = np.full(len(y), base)
    nodes: list[list] = []
    roots = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)

        def grow(rows: np.ndarray, level: int, lo: float, hi: float) -> int:
            g, h = grad[rows].sum(), hess[rows].sum()
            me = len(nodes)
            nodes.append([0, np.inf, me, me, float(np.clip(-g / (h + l2), lo, hi)) * rate])
            if level == depth or len(rows) < 2:
                raw[rows] += nodes[me][4]
                return me
            best = (1e-6, None)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                gs = np.cumsum(np.bincount(code[rows, j], grad[rows], len(e) + 1))[:-1]
                hs = np.cumsum(np.bincount(code[rows, j], hess[rows], len(e) + 1))[:-1]
                vl, vr = np.clip(-gs / (hs + l2), lo, hi), np.clip(-(g - gs) / (h - hs + l2), lo, hi)
                gain = gs**2 / (hs + l2) + (g - gs) ** 2 / (h - hs + l2) - g**2 / (h + l2)
                ok = (hs >= least) & (h - hs >= least)
                if monotone[j]:
                    ok &= (vr - vl) * monotone[j] >= 0
                if ok.any():
                    k = int(np.argmax(np.where(ok, gain, -np.inf)))
                    if gain[k] > best[0]:
                        best = (gain[k], (j, k, vl[k], vr[k]))
            if best[1] is None:
                raw[rows] += nodes[me][4]
                return me
            j, k, vl, vr = best[1]
            low = code[rows, j] <= k
            mid = (vl + vr) / 2
            bound_l, bound_r = ((lo, mid), (mid, hi)) if monotone[j] > 0 else ((mid, hi), (lo, mid)) if monotone[j] < 0 else ((lo, hi), (lo, hi))
            nodes[me][0], nodes[me][1] = j, float(edges[j][k])
            nodes[me][2] = grow(rows[low], level + 1, *bound_l)
            nodes[me][3] = grow(rows[~low], level + 1, *bound_r)
            return me

        roots.append(grow(np.arange(len(y)), 0, -4.0, 4.0))
    feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes, strict=True))
    return Trees(feature.astype(np.int64), threshold.astype(float), left.astype(np.int64), right.astype(np.int64), value.astype(float), np.array(roots, np.int64), depth, base)


def train(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> Trees | None:
    """Trees from at most `max_labels` labelled documents; None if the labels hold fewer than two classes.

    Labels with a null id or quality are left out; of conflicting labels the lowest counts; documents
    that the base rules reject are left out, as no tree will judge such. The cut is the largest score
    up to 0.5 that keeps 999 in 1000 of the good training documents.
    """
    sample = labels.select("doc_id", F.col("quality").cast("int").alias("good")).dropna().groupBy("doc_id").agg(F.min("good").alias("good")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("good", pa.int32()), ("x", pa.list_(pa.float64()))])
        for batch in common.slices(batches, "text"):
            base, x = statistics(batch.column(1))
            judged = np.flatnonzero(~_base_fails(base))
            yield common.batch_of(schema, batch.column(0).take(pa.array(judged)), list(x[judged]))

    # The sample has at most max_labels rows of 12 bytes, so it may be broadcast at any input size.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("good", "text").mapInArrow(run, "good int, x array<double>").toArrow()
    y = rows["good"].to_numpy().astype(float) if rows.num_rows else np.zeros(0)
    y = (y > 0).astype(float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.array(rows["x"].to_pylist())
    order = np.lexsort([*x.T, y])
    x, y = x[order], y[order]
    trees = fit_trees(x, y)
    trees.cut = float(min(0.5, np.quantile(trees.score(x[y == 1]), 0.001)))
    return trees


def _base_fails(base: np.ndarray) -> np.ndarray:
    return (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])


def _verdict(column: pa.Array, trees: Trees | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    base, x = statistics(column)
    failed = _base_fails(base)
    score = trees.score(x) if trees else np.ones(len(x))
    return base, failed, score, ~failed & (score >= (trees.cut if trees else 0))


def judge_quality(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """Base statistics and verdict of each row.

    One row per input row, repeated rows included. A null or empty text has no words and fails; a very
    long text is counted whole by one worker; a null doc_id stays null; a score equal to the cut keeps.
    An empty table gives an empty one, and without labels of two classes (none at all included) the
    base rules alone decide. Only doc_id and text are read, so other columns can't clash. One scan
    trains, one scores; nothing but the labels is shuffled.
    """
    spark = common.prepare(docs.sparkSession)
    trees = spark.sparkContext.broadcast(train(docs, labels, max_labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in names), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("score", pa.float64())])
        for batch in common.slices(batches, "text"):
            base, failed, score, kept = _verdict(batch.column(1), trees.value)
            yield common.batch_of(schema, batch.column(0), *base.T, failed, kept, score)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double")


def keep_good(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """The rows of docs that `judge_quality` keeps, with all their columns, of any name; what is said there of nulls, long texts, ties, repeated rows and empty tables holds here."""
    spark = common.prepare(docs.sparkSession)
    trees = spark.sparkContext.broadcast(train(docs, labels, max_labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            yield batch.filter(pa.array(_verdict(batch.column("text"), trees.value)[3]))

    return docs.mapInArrow(run, docs.schema)
