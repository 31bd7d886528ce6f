"""Removal of passages that also stand in a document with a smaller id.

The corpus is its own reference, so no automaton of all of it may be broadcast. It is cut into
shards, runs of a document's words that overlap by a window less one word: a window index tells each
document which smaller document (the *hub*) shares its passages and in which shards, passages go to
their shard, and the shard's suffix automaton yields their matching statistics. What matches over
the window length is removed. A window that the automaton refuses was sent by a collision of
hashes; those are sought again under other hashes, until none is left.

The window index needs no row per window. Equal windows have equal smallest and greatest k-grams
(together the anchor), and neighbouring windows mostly share them, so windows are dealt by their
anchor, packed into one row per scan segment and bucket; of windows that meet in a segment only those
of its smallest document go on, so a passage that a third of the documents share sends one entry per
segment. A frequent k-gram alone does not bring windows together: their other anchor differs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 13
GRAM = 5
SEGMENT_WORDS = 700_000
#: Words of a shard of a reference document; its automaton takes about 1 KB a word.
SHARD_WORDS = 20_000
#: Documents whose passages one task streams past a shard.
SHARD_MEMBERS = 4096
#: Bits of a window's hash; fewer only in tests. Hashes tried while windows collide.
HASH_BITS, SEEDS = 64, 20
_ODD = np.uint64(0xD6E8FEB86659FD93)


class SuffixAutomaton:
    """The suffix automaton of a row of symbols, and matching statistics against it."""

    def __init__(self, symbols: list):
        self.step: list[dict] = [{}]
        self.link, self.size = [-1], [0]
        last = 0
        for c in symbols:
            last = self._add(last, c)

    def _add(self, last: int, c) -> int:
        step, link, size = self.step, self.link, self.size
        new = len(step)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        at = last
        while at >= 0 and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at >= 0:
            to = step[at][c]
            if size[to] == size[at] + 1:
                link[new] = to
            else:
                copy = len(step)
                step.append(step[to].copy())
                link.append(link[to])
                size.append(size[at] + 1)
                while at >= 0 and step[at].get(c) == to:
                    step[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        return new

    def matches(self, symbols: list) -> list[int]:
        """For each place, the length of the longest suffix ending there that stands in the automaton's text."""
        at, held, out = 0, 0, []
        step, link, size = self.step, self.link, self.size
        for c in symbols:
            while at and c not in step[at]:
                at = link[at]
                held = size[at]
            if c in step[at]:
                at, held = step[at][c], held + 1
            else:
                at, held = 0, 0
            out.append(held)
        return out


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = min(len(a), len(b))
    return common.mix(a[:n] * _ODD + b[:n])


def windows(h: np.ndarray, window: int = WINDOW, gram: int = GRAM, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash, anchor) of every window of a row of word hashes, by doubling. Other seeds give other hashes."""
    h = common.mix(h + np.uint64(seed)) if seed else h
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def spans(width: int) -> np.ndarray:
        out, covered, power, reach = None, 0, h, 1
        while width >> (reach.bit_length() - 1):
            if width & reach:
                out = power if out is None else _pair(out, power[covered:])
                covered += reach
            power, reach = _pair(power, power[reach:]), reach * 2
        return out

    least, most, held = spans(gram), spans(gram), 1
    width = window - gram + 1
    while held < width:
        shift = min(held, width - held)
        least, most = np.minimum(least[:-shift], least[shift:]), np.maximum(most[:-shift], most[shift:])
        held += shift
    return spans(window)[:n] >> np.uint64(64 - HASH_BITS), _pair(least, most)[:n]


# ---- the window index ----

_PLACE = ("doc_id", "row_key", "hub", "hub_key", "shard")
_SPAN_DDL = ", ".join(f"{n} long" for n in _PLACE) + ", starts binary"
_SPAN = pa.schema([*((n, pa.int64()) for n in _PLACE), ("starts", pa.binary())])
_ENTRY_DDL = "bucket int, docs binary, runs binary, codes binary, " + _SPAN_DDL
_ENTRY = pa.schema([("bucket", pa.int32()), *((n, pa.binary()) for n in ("docs", "runs", "codes")), *_SPAN])
_RUN = np.dtype([("doc", "<u4"), ("at", "<u4"), ("n", "u1")])
_PACK_DDL = "home int, pairs binary, starts binary"
_PACK = pa.schema([("home", pa.int32()), ("pairs", pa.binary()), ("starts", pa.binary())])


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... count[i] times, for all i."""
    stop = np.cumsum(count)
    return np.repeat(first - (stop - count), count) + np.arange(stop[-1] if len(stop) else 0)


def _found(doc: np.ndarray, hub: np.ndarray, shard: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(doc, hub, shard, number of starts) per document and shard of a hub, and all starts in that order."""
    order = np.lexsort((at, shard, hub, doc))
    doc, hub, shard, at = doc[order], hub[order], shard[order], at[order]
    edge = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (hub[1:] != hub[:-1]) | (shard[1:] != shard[:-1])])) if len(doc) else np.zeros(0, int)
    return doc[edge], hub[edge], shard[edge], np.diff(np.append(edge, len(doc))), at


def _window_index(docs: DataFrame, window: int, buckets: int, seed: int = 0) -> DataFrame:
    """(doc_id, row_key, hub, hub_key, shard, starts): windows of a document that also start in that shard of the smaller document hub.

    starts is null where the hub has the same words from first to last.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, np.ndarray, str]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            held.sort(key=lambda r: (r[0], r[1]))
            chosen, whole, seen = [], [], {}
            for doc_id, key, h, text in held:
                other = seen.setdefault((len(h), int(common.mix(h + np.arange(len(h), dtype=np.uint64) * _ODD).sum(dtype=np.uint64))), (doc_id, key, text))
                if other[0] < doc_id and _split(other[2]) == _split(text):
                    whole.append((doc_id, key, *other[:2], 0))
                elif not chosen or chosen[-1][:2] != (doc_id, key):  # else the same row again
                    chosen.append((doc_id, key, h))
            held.clear()
            if whole:
                none = [None] * len(whole)
                yield common.batch_of(_ENTRY, np.arange(len(whole)) % buckets, none, none, none, *zip(*whole, strict=True), none)
            if not chosen:
                return
            ids, keys = (np.array([r[k] for r in chosen], np.int64) for k in (0, 1))
            sizes = np.array([len(r[2]) for r in chosen])
            code, anchor = windows(np.concatenate([r[2] for r in chosen]), window, seed=seed)
            first = np.cumsum(sizes) - sizes
            at = _spread(first, sizes - window + 1)
            code, anchor = code[at], anchor[at]
            doc = np.repeat(np.arange(len(chosen)), sizes - window + 1)
            at = at - first[doc]
            order = np.argsort(code, kind="stable")
            # Windows with another anchor differ, whatever their hashes: they go on, and none hides another.
            lead = np.concatenate([[True], (code[order][1:] != code[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])])
            origin = np.empty(len(code), np.int64)  # the first window of equal hash, in the smallest document
            origin[order] = order[np.flatnonzero(lead)][np.cumsum(lead) - 1]
            owner, shard = doc[origin], at[origin] // SHARD_WORDS
            later = ids[owner] < ids[doc]
            if later.any():
                own, hub, part, n, starts = _found(doc[later], owner[later], shard[later], at[later])
                none = [None] * len(own)
                blobs = [x.astype("<u4").tobytes() for x in np.split(starts, np.cumsum(n)[:-1])]
                yield common.batch_of(_ENTRY, np.arange(len(own)) % buckets, none, none, none, ids[own], keys[own], ids[hub], keys[hub], part, blobs)
            stay = np.flatnonzero(~later)
            code, doc, at = code[stay], doc[stay], at[stay]
            home = (anchor[stay] % np.uint64(buckets)).astype(np.int64)
            begins = np.flatnonzero(np.concatenate([[True], (home[1:] != home[:-1]) | (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)]))
            count = np.diff(np.append(begins, len(code)))
            parts = -(-count // 255)  # a run's length takes one byte; periodic text has longer runs
            within = _spread(np.zeros(len(begins), np.int64), parts) * 255
            begins, count = np.repeat(begins, parts) + within, np.minimum(255, np.repeat(count, parts) - within)
            home = home[begins]
            order = np.argsort(home, kind="stable")
            edge = np.searchsorted(home[order], np.arange(buckets + 1))
            for b in range(buckets):
                own = order[edge[b] : edge[b + 1]]
                if not len(own):
                    continue
                used, number = np.unique(doc[begins[own]], return_inverse=True)
                packed = np.empty(len(own), _RUN)
                packed["doc"], packed["at"], packed["n"] = number, at[begins[own]], count[own]
                codes = code[_spread(begins[own], count[own])].astype("<u8").tobytes()
                blob = np.stack([ids[used], keys[used]]).astype("<i8").tobytes()
                # Field by field, so that like bytes stand together.
                fields = b"".join(np.ascontiguousarray(packed[f]).tobytes() for f in _RUN.names)
                yield common.batch_of(_ENTRY, [b], [blob], [fields], [codes], *[[None]] * len(_SPAN))

        for batch in common.slices(batches, "text"):
            words = common.Words(batch.column(1))
            h = words.hashes()
            for i, (doc_id, text, key) in enumerate(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                own = h[words.first[i] : words.first[i + 1]]
                if doc_id is not None and len(own) >= window:
                    held.append((doc_id, key, own.copy(), text))
                    size += len(own)
            if size >= SEGMENT_WORDS:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    def packed(doc_id, row_key, hub, hub_key, shard, n, starts) -> Iterator[pa.RecordBatch]:
        """Entries packed by the home bucket of their document: a row per home, however many entries."""
        home = (row_key.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        table = np.stack([doc_id, row_key, hub, hub_key, shard, n]).astype("<i8")
        first = np.cumsum(n) - n
        edge = np.searchsorted(home[order], np.arange(buckets + 1))
        for b in np.flatnonzero(edge[1:] > edge[:-1]).tolist():
            own = order[edge[b] : edge[b + 1]]
            yield common.batch_of(_PACK, [b], [table[:, own].tobytes()], [starts[_spread(first[own], n[own])].astype("<u4").tobytes()])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, ready = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            if held:
                tables = [np.frombuffer(d, "<i8").reshape(2, -1) for d, _, _ in held]
                base = np.cumsum([0, *(t.shape[1] for t in tables)])
                ids, keys = np.concatenate(tables, 1)
                parts: dict[str, list] = {f: [] for f in _RUN.names}
                for k, (_, fields, _) in enumerate(held):
                    n, skip = len(fields) // _RUN.itemsize, 0
                    for f in _RUN.names:
                        kind = _RUN[f]
                        column = np.frombuffer(fields, kind, n, skip)
                        parts[f].append(column + base[k] if f == "doc" else column)
                        skip += n * kind.itemsize
                doc, at, count = (np.concatenate(parts[f]) for f in _RUN.names)
                count = count.astype(np.int64)
                # Whole codes: windows that are taken for equal are sent to one document, so others under their code would be lost.
                code = np.frombuffer(b"".join(c for _, _, c in held), "<u8")
                held.clear()
                # Documents numbered in the order of their ids: the first of equal codes is the smallest.
                rank = np.empty(len(ids), np.int64)
                by_id = np.lexsort((keys, ids))
                rank[by_id] = np.arange(len(ids))
                ids, keys = ids[by_id], keys[by_id]
                doc = np.repeat(rank[doc], count)
                at = _spread(at.astype(np.int64), count)
                order = np.lexsort((doc, code))
                code, doc, at = code[order], doc[order], at[order]
                lead = np.concatenate([[True], code[1:] != code[:-1]])
                origin = np.flatnonzero(lead)[np.cumsum(lead) - 1]
                later = ids[doc[origin]] < ids[doc]
                own, hub, part, n, starts = _found(doc[later], doc[origin][later], at[origin][later] // SHARD_WORDS, at[later])
                yield from packed(ids[own], keys[own], ids[hub], keys[hub], part, n, starts)
            if ready:
                whole = np.array([x[:5] for x in ready], np.int64).T
                blobs = [x[5] or b"" for x in ready]
                ready.clear()
                yield from packed(*whole, np.array([len(x) // 4 for x in blobs]), np.frombuffer(b"".join(blobs), "<u4"))

        for batch in batches:
            for b, docs_blob, fields, codes, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket:
                    yield from close()
                bucket = b
                if docs_blob is None:
                    ready.append(rest)
                else:
                    held.append((docs_blob, fields, codes))
        yield from close()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per document and shard, from all buckets; no starts stand for the whole document."""
        home, tables, starts = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            if not tables:
                return
            table, all_starts = np.concatenate(tables, 1), np.concatenate(starts)
            tables.clear()
            starts.clear()
            first = np.cumsum(table[5]) - table[5]
            order = np.lexsort(table[4::-1])
            pairs = table[:5, order]
            edge = np.flatnonzero(np.concatenate([[True], (pairs[:, 1:] != pairs[:, :-1]).any(0)]))
            count = np.add.reduceat(table[5, order], edge)
            joined = all_starts[_spread(first[order], table[5, order])].astype("<u4")
            for k in range(0, len(edge), 4096):
                part = slice(k, k + 4096)
                stop = np.cumsum(count[part]) + count[:k].sum()
                blobs = [joined[b - n : b].tobytes() or None for b, n in zip(stop.tolist(), count[part].tolist(), strict=True)]
                yield common.batch_of(_SPAN, *pairs[:, edge[part]], blobs)

        for batch in batches:
            for b, table, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != home:
                    yield from close()
                home = b
                tables.append(np.frombuffer(table, "<i8").reshape(6, -1))
                starts.append(np.frombuffer(own, "<u4"))
        yield from close()

    entries = docs.select("doc_id", "text", "row_key").mapInArrow(deal, _ENTRY_DDL)
    met = entries.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, _PACK_DDL)
    return met.repartition(buckets, "home").sortWithinPartitions("home").mapInArrow(gather, _SPAN_DDL)


# ---- matching against the shards ----

_PIECE_DDL = "hub long, hub_key long, shard long, salt int, member int, doc_id long, row_key long, starts binary, words binary"
_PIECE = pa.schema([("hub", pa.int64()), ("hub_key", pa.int64()), ("shard", pa.int64()), ("salt", pa.int32()), ("member", pa.int32()), ("doc_id", pa.int64()), ("row_key", pa.int64()), ("starts", pa.binary()), ("words", pa.binary())])


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _covered(starts: np.ndarray, window: int) -> np.ndarray:
    """Maximal spans [first, last) of words that the windows cover; starts ascend."""
    edge = np.flatnonzero(np.concatenate([[True], np.diff(starts) != 1]))
    return np.stack([starts[edge], np.append(starts[edge[1:] - 1], starts[-1]) + window], 1)


def _matched(docs: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """(doc_id, row_key, spans, refused): spans whose windows the shard's automaton confirms, and how many it refuses."""
    found = found.where("starts is not null")
    place = ["hub", "hub_key", "shard"]
    hot = found.groupBy(*place).agg(F.ceil(F.count("*") / SHARD_MEMBERS).cast("int").alias("parts")).where("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    salted = found.join(hot, place, "left").withColumn("salt", F.pmod(F.xxhash64("row_key"), parts).cast("int")).drop("parts")
    shards = found.select(*place).distinct().join(hot, place, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    shards = shards.select(F.col("hub").alias("doc_id"), F.col("hub_key").alias("row_key"), *place, F.lit(None).cast("binary").alias("starts"), "salt")
    uses = salted.withColumn("member", F.lit(1)).unionByName(shards.withColumn("member", F.lit(0)))
    texts = docs.join(uses, ["doc_id", "row_key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, words = None, []
        for batch in common.slices(batches, "text"):
            out, size = [], 0
            for text, hub, hub_key, shard, salt, member, doc_id, row_key, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last != (doc_id, row_key):
                    last, words = (doc_id, row_key), _split(text)
                if member:
                    starts = np.frombuffer(blob, "<u4").astype(np.int64)
                    out.append((hub, hub_key, shard, salt, 1, doc_id, row_key, blob, b"\n".join(b" ".join(words[a:b]) for a, b in _covered(starts, window).tolist())))
                else:
                    own = words[shard * SHARD_WORDS : (shard + 1) * SHARD_WORDS + window - 1]
                    out.append((hub, hub_key, shard, salt, 0, None, None, None, b" ".join(own)))
                size += len(out[-1][-1])
                if size > common.SLICE_BYTES:
                    yield common.batch_of(_PIECE, *zip(*out, strict=True))
                    out, size = [], 0
            if out:
                yield common.batch_of(_PIECE, *zip(*out, strict=True))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("spans", pa.binary()), ("refused", pa.int64())])
        now, automaton = None, None
        for batch in batches:
            out = []
            for hub, hub_key, shard, salt, member, doc_id, row_key, blob, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (hub, hub_key, shard, salt):
                    now, automaton = (hub, hub_key, shard, salt), None
                if not member:
                    automaton = automaton or SuffixAutomaton(words.split(b" "))
                    continue
                starts = np.frombuffer(blob, "<u4").astype(np.int64)
                spans = _covered(starts, window)
                sure = []
                for (first, _), passage in zip(spans.tolist(), words.split(b"\n"), strict=True):
                    ends = np.flatnonzero(np.array(automaton.matches(passage.split(b" "))) >= window)
                    sure.append(first + ends - window + 1)
                sure = np.concatenate(sure)
                sure_spans = _covered(sure, window) if len(sure) else np.zeros((0, 2), np.int64)
                out.append((doc_id, row_key, sure_spans.astype("<u4").tobytes(), len(np.setdiff1d(starts, sure, True))))
            if out:
                yield common.batch_of(schema, *zip(*out, strict=True))

    pieces = texts.select("text", *place, "salt", "member", "doc_id", "row_key", "starts").mapInArrow(cut, _PIECE_DDL)
    dealt = pieces.repartition(common.partitions(docs.sparkSession), *place, "salt").sortWithinPartitions(*place, "salt", "member")
    return dealt.mapInArrow(match, "doc_id long, row_key long, spans binary, refused long")


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """Each row's words without those covered by a window that also starts in a document of smaller id.

    Windows are judged on the input. One output row per input row; rows with the same doc_id don't
    remove each other's windows, and repeated rows give equal results; of equal passages in several
    documents the smallest doc_id's stays. A row without doc_id takes no part and keeps all its words.
    Null, empty and blank texts have no words and the digest of the empty string; texts shorter than
    a window keep all words; very long texts are cut into shards, so an automaton never holds more
    than SHARD_WORDS words and a window. An empty table gives an empty one. Only doc_id and text are
    read, so other columns can't clash. kept_text (words joined by one space) comes with with_text.
    """
    spark = common.prepare(docs.sparkSession)
    keyed = docs.select("doc_id", "text").withColumn("row_key", F.xxhash64("doc_id", "text"))
    whole, sure, sought = None, None, None
    for seed in range(SEEDS):
        found = _window_index(keyed, window, common.partitions(spark), seed)
        found = common.settle(found if sought is None else found.join(sought, ["doc_id", "row_key"], "left_semi"), "repeat-windows")
        common.release(spark)
        matched = common.settle(_matched(keyed, found, window), "repeat-matches")
        common.release(spark)
        if sought is None:
            whole = found.where("starts is null").select("doc_id", "row_key", F.lit(None).cast("binary").alias("spans"), F.lit(1).alias("whole"))
        now = matched.select("doc_id", "row_key", "spans")
        sure = now if sure is None else sure.unionByName(now)
        sought = matched.where("refused > 0").select("doc_id", "row_key").distinct()
        if sought.isEmpty():
            break
    else:
        raise RuntimeError("windows still collide under every hash")
    spans = sure.withColumn("whole", F.lit(0)).unionByName(whole).groupBy("doc_id", "row_key").agg(F.collect_list("spans").alias("spans"), F.max("whole").alias("whole"))
    schema = _RESULT if with_text else _RESULT.remove(4)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            out = []
            for doc_id, text, parts, whole in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = kept = _split(text)
                if whole:
                    kept = []
                elif parts:
                    gone = np.zeros(len(words), bool)
                    for a, b in np.concatenate([np.frombuffer(p, "<u4").reshape(-1, 2) for p in parts]).tolist():
                        gone[a:b] = True
                    kept = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
                left = b" ".join(kept)
                out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(left).hexdigest(), *([left.decode()] if with_text else [])))
            yield common.batch_of(schema, *zip(*out, strict=True))

    joined = keyed.join(spans, ["doc_id", "row_key"], "left").select("doc_id", "text", "spans", "whole")
    return joined.mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)
