"""A hidden Markov language model: Baum-Welch counts from every partition, exact scores by the forward recursion.

A state emits a class, a class emits a word. Frequent words have classes of their own; the others
share classes by their last bytes. The words' counts are exact over the whole corpus: scan tasks
gather *segments* (documents as numbers into a segment's own vocabulary), the vocabularies go to
buckets by word hash, and each bucket sends a segment the corpus counts of its own words. So no
task ever holds the corpus vocabulary.
"""

from __future__ import annotations


import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import common

STATES = 8
TOP_WORDS = 1000
ENDINGS = 511
SEGMENT_TOKENS = 1_000_000
#: Passes over all training documents: of the mixture that the states begin from, and of Baum-Welch.
MIXTURES = 8
PASSES = 2
#: Documents whose class counts stand side by side in the mixture.
BLOCK = 256
_END_HASH = np.uint64(0x5EED_0E4D)


def held_out(doc_id: int | None) -> bool:
    """crc32 of the id as text, modulo 5, is 1; a null id is in training."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


# ---- the model ----


@dataclass
class Model:
    """start: K; move: K x K; emit: C x K (class given state); top: sorted hashes with their classes;
    mass, kinds: count and distinct words of the shared classes."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    top: np.ndarray
    mass: np.ndarray
    kinds: np.ndarray

    def classes(self, vocabulary: np.ndarray, endings: np.ndarray) -> np.ndarray:
        if not len(self.top):
            return endings.astype(np.int64)
        at = np.minimum(np.searchsorted(self.top, vocabulary), len(self.top) - 1)
        return np.where(self.top[at] == vocabulary, ENDINGS + 1 + at, endings)


class Sequences:
    """Documents in time-major order: the tokens at place t of all that are longer than t stand together."""

    def __init__(self, observed: np.ndarray, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        ordered = sizes[self.order]
        begin = (np.cumsum(sizes) - sizes)[self.order]
        longest = int(ordered[0]) if len(ordered) else 0
        self.active = np.searchsorted(-ordered, -np.arange(longest), "left") if longest else np.zeros(0, np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.active)]).astype(np.int64)
        rank = np.repeat(np.arange(len(ordered)), ordered)
        place = np.arange(len(observed)) - np.repeat(np.cumsum(ordered) - ordered, ordered)
        self.slot = self.offset[place] + rank
        self.rank = np.empty(len(observed), np.int64)
        self.rank[self.slot] = rank
        self.seen = np.empty(len(observed), np.int64)
        self.seen[self.slot] = observed[np.repeat(begin, ordered) + place]

    def forward(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """Scaled forward probabilities and scales of every token."""
        emit = model.emit[self.seen]
        alpha, scale = emit, np.empty(len(emit))
        for t, n in enumerate(self.active.tolist()):
            a = self.offset[t]
            row = alpha[a : a + n]
            if t:
                row *= alpha[before : before + n] @ model.move  # noqa: F821
            else:
                row *= model.start
            total = row.sum(1)
            row /= total[:, None]
            scale[a : a + n] = total
            before = a  # noqa: F841
        return alpha, scale

    def log_likelihood(self, model: Model) -> np.ndarray:
        """log10 probability of each document's classes, in the documents' own order."""
        _, scale = self.forward(model)
        out = np.zeros(len(self.order))
        out[self.order] = np.bincount(self.rank, np.log10(scale), len(self.order))
        return out

    def counts(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions (the E step)."""
        k = len(model.start)
        alpha, scale = self.forward(model)
        emit = model.emit[self.seen]
        beta = np.ones_like(alpha)
        for t in range(len(self.active) - 2, -1, -1):
            a, b, n = self.offset[t], self.offset[t + 1], int(self.active[t + 1])
            ahead = beta[b : b + n] * emit[b : b + n] / scale[b : b + n, None]
            emit[b : b + n] = ahead
            beta[a : a + n] = ahead @ model.move.T
        gamma = alpha * beta
        first = int(self.active[0]) if len(self.active) else 0
        later = np.arange(first, len(alpha))
        place = np.repeat(np.arange(len(self.active)), self.active)[first:]
        previous = self.offset[place - 1] + later - self.offset[place]
        moves = (alpha[previous].T @ emit[first:]) * model.move if len(later) else np.zeros((k, k))
        emissions = np.stack([np.bincount(self.seen, gamma[:, j], len(model.emit)) for j in range(k)], 1)
        return gamma[:first].sum(0), moves, emissions


def _groups(observed: np.ndarray, sizes: np.ndarray, most: int = 250_000) -> Iterator[tuple[np.ndarray, Sequences]]:
    """Documents of similar length, about `most` tokens together: (their positions, sequences)."""
    order = np.argsort(-sizes, kind="stable")
    begin = np.cumsum(sizes) - sizes
    part = np.cumsum(sizes[order]) // most
    for own in np.split(order, np.flatnonzero(np.diff(part)) + 1):
        if len(own):
            at = np.repeat(begin[own] - (np.cumsum(sizes[own]) - sizes[own]), sizes[own]) + np.arange(sizes[own].sum())
            yield own, Sequences(observed[at], sizes[own])


def _estimated(start: np.ndarray, moves: np.ndarray, emissions: np.ndarray, old: Model) -> Model:
    """The M step, with a little mass everywhere, so that every sequence has a probability."""
    emit = emissions + 0.01
    return Model((start + 0.1) / (start + 0.1).sum(), (moves + 0.1) / (moves + 0.1).sum(1, keepdims=True), emit / emit.sum(0), old.top, old.mass, old.kinds)


def _mixture(model: Model, observed: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The E step of a mixture of documents: each state's share of the documents, then their class counts by share."""
    c, k = model.emit.shape
    logs, weight = np.log(model.emit), np.log(model.start)
    shares, emissions = np.zeros(k), np.zeros((c, k))
    stop = np.concatenate([[0], np.cumsum(sizes)])
    for a in range(0, len(sizes), BLOCK):
        own = sizes[a : a + BLOCK]
        n = len(own)
        cell = np.repeat(np.arange(n) * c, own) + observed[stop[a] : stop[a + n]]
        counts = np.bincount(cell, minlength=n * c).reshape(n, c).astype(float)
        total = counts @ logs * 0.2 + weight
        share = np.exp(total - total.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        shares += share.sum(0)
        emissions += counts.T @ share
    return np.concatenate([shares, emissions.ravel()])


def _expected(model: Model, observed: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The E step of Baum-Welch: starts, moves and emissions."""
    c, k = model.emit.shape
    total = np.zeros(k + k * k + c * k)
    for _, sequences in _groups(observed, sizes):
        total += np.concatenate([x.ravel() for x in sequences.counts(model)])
    return total


# ---- segments and corpus counts ----

_SEGMENT_DDL = "seg long, ids array<long>, sizes binary, tokens binary, vocabulary binary, endings binary, counts binary"
_SEGMENT = pa.schema([("seg", pa.int64()), ("ids", pa.list_(pa.int64())), *((n, pa.binary()) for n in ("sizes", "tokens", "vocabulary", "endings", "counts"))])


def _endings(words: common.Words) -> np.ndarray:
    """The shared class of each word, from its last three bytes; class 0 is kept for the end token."""
    start = np.maximum(words.end - 3, words.start)
    return (common.hash_spans(words.data, start, words.end) % np.uint64(ENDINGS)).astype(np.uint16) + 1


def _segments(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        ids: list = []
        hashes: list[np.ndarray] = []
        endings: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, number
            codes, vocabulary = pd.factorize(np.concatenate(hashes))
            size = np.concatenate(sizes)
            kind = np.zeros(len(vocabulary), np.uint16)
            kind[codes] = np.concatenate(endings)
            trains = np.repeat([not held_out(i) for i in ids], size)
            counts = np.bincount(codes[trains], minlength=len(vocabulary))
            row = [[number], [list(ids)], *([x.tobytes()] for x in (size.astype("<u4"), codes.astype("<u4"), vocabulary.astype("<u8"), kind.astype("<u2"), counts.astype("<u4")))]
            for x in (ids, hashes, endings, sizes):
                x.clear()
            held, number = 0, number + 1
            return common.batch_of(_SEGMENT, *row)

        for batch in common.slices(batches, "text"):
            words = common.Words(batch.column(1), lower=True)
            stop = words.first[1:]
            hashes.append(np.insert(words.hashes(), stop, _END_HASH))
            endings.append(np.insert(_endings(words), stop, 0))
            sizes.append(words.counts() + 1)
            ids += batch.column(0).to_pylist()
            held += int(sizes[-1].sum())
            if held >= SEGMENT_TOKENS:
                yield flush()
        if ids:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, _SEGMENT_DDL)


def _numbers(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(blob, kind)


def _corpus_counts(segments: DataFrame, buckets: int, top_words: int) -> DataFrame:
    """Per bucket and segment the corpus counts of the segment's words (seg >= 0), and per bucket its totals (seg = -1)."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("seg", pa.int64()), ("vocabulary", pa.binary()), ("endings", pa.binary()), ("counts", pa.binary())])
        for batch in batches:
            for seg, v, e, c in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                words, kind, count = _numbers(v, "<u8"), _numbers(e, "<u2"), _numbers(c, "<u4")
                home = (words % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(home, kind="stable")
                edge = np.searchsorted(home[order], np.arange(buckets + 1))
                parts = [(b, order[edge[b] : edge[b + 1]]) for b in range(buckets) if edge[b] < edge[b + 1]]
                yield common.batch_of(schema, [b for b, _ in parts], [seg] * len(parts), *([x[o].tobytes() for _, o in parts] for x in (words, kind, count)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("seg", pa.int64()), ("counts", pa.binary()), ("totals", pa.binary()), ("top", pa.binary())])
        held: list[tuple] = []

        def close() -> Iterator[pa.RecordBatch]:
            words = np.concatenate([_numbers(r[2], "<u8") for r in held])
            codes, unique = pd.factorize(words)
            kind = np.zeros(len(unique), np.int64)
            kind[codes] = np.concatenate([_numbers(r[3], "<u2") for r in held])
            total = np.bincount(codes, np.concatenate([_numbers(r[4], "<u4") for r in held])).astype(np.int64)
            at = 0
            for bucket, seg, blob, *_ in held:
                n = len(blob) // 8
                yield common.batch_of(schema, [bucket], [seg], [total[codes[at : at + n]].astype("<u4").tobytes()], [None], [None])
                at += n
            mass = np.bincount(kind, total, ENDINGS + 1)
            kinds = np.bincount(kind[total > 0], minlength=ENDINGS + 1)
            best = np.lexsort([unique, -total])[:top_words]
            best = best[total[best] > 0]
            top = np.stack([unique[best], total[best].astype(np.uint64), kind[best].astype(np.uint64)])
            yield common.batch_of(schema, [held[0][0]], [-1], [None], [np.stack([mass, kinds]).astype("<f8").tobytes()], [top.astype("<u8").tobytes()])
            held.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    yield from close()
                held.append(row)
        if held:
            yield from close()

    dealt = segments.select("seg", "vocabulary", "endings", "counts").mapInArrow(deal, "bucket int, seg long, vocabulary binary, endings binary, counts binary")
    return dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket", "seg").mapInArrow(count, "bucket int, seg long, counts binary, totals binary, top binary")


def _totals(counted: DataFrame, top_words: int) -> tuple[int, int, Model]:
    """(training tokens, distinct ones, a model of one state), from the buckets' totals added up in groups."""
    rows = counted.where("seg < 0").select("totals", "top")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("totals", pa.binary()), ("top", pa.binary())])
        totals, tops = np.zeros((2, ENDINGS + 1)), []
        for batch in batches:
            for t, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                totals += _numbers(t, "<f8").reshape(2, -1)
                tops.append(_numbers(p, "<u8").reshape(3, -1))
        if tops:
            top = np.concatenate(tops, 1)
            top = top[:, np.lexsort([top[0], -top[1].astype(np.int64)])[:top_words]]
            yield common.batch_of(schema, [totals.astype("<f8").tobytes()], [top.astype("<u8").tobytes()])

    # At most 16 rows of some 35 KB come back, at any input size.
    found = rows.repartition(16).mapInArrow(add, "totals binary, top binary").collect()
    totals = sum((_numbers(r[0], "<f8").reshape(2, -1) for r in found), np.zeros((2, ENDINGS + 1)))
    top = np.concatenate([_numbers(r[1], "<u8").reshape(3, -1) for r in found] or [np.zeros((3, 0), np.uint64)], 1)
    top = top[:, np.lexsort([top[0], -top[1].astype(np.int64)])[:top_words]]
    top = top[:, np.argsort(top[0])]
    kind = top[2].astype(np.int64)
    mass = totals[0] - np.bincount(kind, top[1].astype(float), ENDINGS + 1)
    kinds = totals[1] - np.bincount(kind, minlength=ENDINGS + 1)
    emit = np.concatenate([mass, top[1].astype(float)])[:, None] + 0.1
    return int(totals[0].sum()), int(totals[1].sum()), Model(np.ones(1), np.ones((1, 1)), emit / emit.sum(), top[0], mass, kinds)


def _read(row: dict, model: Model, trains: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes of the tokens, sizes, positions) of a segment's documents; only training ones if asked."""
    sizes = _numbers(row["sizes"], "<u4").astype(np.int64)
    kind = model.classes(_numbers(row["vocabulary"], "<u8"), _numbers(row["endings"], "<u2"))
    seen = kind[_numbers(row["tokens"], "<u4")]
    if trains:
        use = np.array([not held_out(i) for i in row["ids"]], bool)
        return seen[np.repeat(use, sizes)], sizes[use], np.flatnonzero(use)
    return seen, sizes, np.arange(len(sizes))


def _summed(segments: DataFrame, step: Callable[[Model, np.ndarray, np.ndarray], np.ndarray], model: Model, length: int) -> np.ndarray:
    """The `length` numbers that step makes of a segment's training documents, added up over all segments."""
    held = segments.sparkSession.sparkContext.broadcast(model)  # (C + K + 1) x K numbers: bounded by the parameters
    schema = pa.schema([("counts", pa.binary())])

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            for row in batch.to_pylist():
                seen, sizes, _ = _read(row, held.value, True)
                total += step(held.value, seen, sizes)
        yield common.batch_of(schema, [total.tobytes()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += _numbers(x, "<f8")
        yield common.batch_of(schema, [total.tobytes()])

    parts = segments.mapInArrow(expect, "counts binary").repartition(16).mapInArrow(add, "counts binary").collect()
    held.unpersist()
    return sum(_numbers(r[0], "<f8") for r in parts)


def _fit(segments: DataFrame, model: Model, tokens: int, states: int, passes: int) -> Model:
    """States from a model of one state; every pass is over all training documents.

    The corpus counts of the classes, each state's moved by random factors, begin a mixture of
    documents; MIXTURES passes over them part the states, and `passes` of Baum-Welch follow. The
    factors don't shrink as the corpus grows, as random shares of its documents would in their mean.
    """
    c, k = len(model.emit), states
    if not tokens:
        return Model(np.full(k, 1 / k), np.full((k, k), 1 / k), np.full((c, k), 1 / c), model.top, model.mass, model.kinds)
    segments = segments.select("ids", "sizes", "tokens", "vocabulary", "endings")
    start, move = np.full(k, 1 / k), np.full((k, k), 0.1 / k) + 0.9 * np.eye(k)
    emit = model.emit * np.exp(np.random.default_rng(7).uniform(-1, 1, (c, k)))
    model = Model(start, move, emit / emit.sum(0), model.top, model.mass, model.kinds)
    for _ in range(MIXTURES):
        total = _summed(segments, _mixture, model, k + c * k)
        start, emit = total[:k] / total[:k].sum() + 1e-3, total[k:].reshape(c, k) + 0.1
        model = Model(start / start.sum(), move, emit / emit.sum(0), model.top, model.mass, model.kinds)
    for _ in range(passes):
        total = _summed(segments, _expected, model, k + k * k + c * k)
        model = _estimated(total[:k], total[k : k + k * k].reshape(k, k), total[k + k * k :].reshape(c, k), model)
    return model


_SCORE = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def score_documents(docs: DataFrame, states: int = STATES, top_words: int = TOP_WORDS, passes: int = PASSES) -> DataFrame:
    """Exact unigram and hidden Markov scores (log10) of each row.

    Learns from the rows whose id is not held out. One output row per input row, repeated rows
    included (each counts in training). A null or empty text is the end token alone; a very long text
    is one sequence, held by one worker with its forward probabilities. A null doc_id is in training
    and stays null; words of equal count are ranked by their hash. With no training rows the counts
    are 0 and states are uniform; an empty table gives an empty one. Only doc_id and text are read, so
    other columns can't clash.
    """
    spark = common.prepare(docs.sparkSession)
    segments = common.settle(_segments(docs), "lm-segments")
    buckets = common.partitions(spark)
    counted = common.settle(_corpus_counts(segments, buckets, top_words), "lm-counts")
    tokens, distinct, model = _totals(counted, top_words)
    held = spark.sparkContext.broadcast(_fit(segments, model, tokens, states, passes))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row, model = left.to_pylist()[0], held.value
        vocabulary = _numbers(row["vocabulary"], "<u8")
        home = (vocabulary % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        blobs = dict(zip(right["bucket"].to_pylist(), right["counts"].to_pylist(), strict=True))
        count = np.zeros(len(vocabulary), np.int64)
        count[order] = np.concatenate([_numbers(blobs[b], "<u4") for b in sorted(blobs)])
        codes = _numbers(row["tokens"], "<u4")
        kind = model.classes(vocabulary, _numbers(row["endings"], "<u2"))
        base = np.log10((count + 0.5) / (tokens + 0.5 * (distinct + 1)))
        own = kind > ENDINGS
        shared = np.where(own, 0, kind)
        within = np.where(own, 0.0, np.log10((count + 0.5) / (model.mass[shared] + 0.5 * (model.kinds[shared] + 1))))
        seen, sizes, _ = _read(row, model, False)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        by_doc = lambda x: np.bincount(doc, x[codes], len(sizes))
        scores = by_doc(within)
        for at, sequences in _groups(seen, sizes):
            scores[at] += sequences.log_likelihood(model)
        ids = row["ids"]
        return pa.Table.from_batches([common.batch_of(_SCORE, ids, [held_out(i) for i in ids], sizes, by_doc((count > 0).astype(float)).astype(np.int64), np.full(len(ids), tokens), by_doc(base), scores)])

    ddl = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    wide = segments.select("seg", "ids", "sizes", "tokens", "vocabulary", "endings").groupBy("seg")
    return wide.cogroup(counted.where("seg >= 0").select("seg", "bucket", "counts").groupBy("seg")).applyInArrow(score, ddl)
