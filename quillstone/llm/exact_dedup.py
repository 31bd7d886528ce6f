"""Exact deduplication with Patricia tries that own each distinct text.

A scan task first folds its own copies in a local trie, so a text sends one row per task however
many copies it has. Those rows are dealt by length and content hash; each run of equal length and
hash is inserted, full byte strings, into a compressed trie whose terminals hold the best row.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WHITE = b" \t\n\x0b\x0c\r"
HELD_BYTES = 48 << 20


class Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes, value=None):
        self.label, self.children, self.value = label, {}, value


def _shared(a: bytes, b: bytes) -> int:
    """The length of the common prefix, by bisection over slices."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo + (a[lo:hi] == b[lo:hi]) * (hi - lo)


class PatriciaTrie:
    """A compressed radix trie over byte strings; `insert` returns the key's terminal node."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes) -> Node:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                leaf = node.children[key[at]] = Node(key[at:])
                return leaf
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            n = _shared(label, key[at : at + len(label)])
            fork = Node(label[:n])
            node.children[key[at]] = fork
            child.label = label[n:]
            fork.children[child.label[0]] = child
            node, at = fork, at + n
        return node

    def drop(self, first: int) -> None:
        """Forget the subtree under a first byte."""
        self.root.children.pop(first, None)


def better(a: tuple, b: tuple | None) -> tuple:
    """The row that stays: most code points, then smallest doc_id (null last), then row number."""
    order = lambda r: (-r[0], r[1] is None, r[1] or 0, r[2])
    return a if b is None or order(a) < order(b) else b


_LOCAL = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("text_sha256", pa.string()), ("rid", pa.int64()), ("rep", pa.int64()), ("copies", pa.int64()), ("size", pa.int64()), ("content", pa.binary())])
_LOCAL_DDL = "doc_id long, n_chars long, text_sha256 string, rid long, rep long, copies long, size long, content binary"


def _fold(batches: Iterator[pa.RecordBatch], held_bytes: int) -> Iterator[list[tuple]]:
    """Groups of (doc_id, n_chars, sha, rid, extra..., terminal) rows, a subtree at a time.

    When the local trie holds more than `held_bytes`, its largest subtree is spilled: its rows go on
    with the owners known so far, and later copies of its texts begin a new one.
    """
    top = TaskContext.get().partitionId() << 33
    trie, rid = PatriciaTrie(), top
    rows: dict[int, list] = {}
    weight: dict[int, int] = {}
    for batch in batches:
        others = [batch.column(i).to_pylist() for i in range(2, batch.num_columns)]
        for i, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            content = (text or "").encode().translate(None, WHITE)
            terminal = trie.insert(content)
            first = content[0] if content else -1
            row = (len(text or ""), doc_id, rid)
            extra = tuple(o[i] for o in others)
            if terminal.value is None:
                terminal.value = [row, 1, content, (text, extra)]
                weight[first] = weight.get(first, 0) + len(content) + len(text or "") + 400
            else:
                best = better(row, terminal.value[0])
                if best is row:
                    terminal.value[3] = (text, extra)
                terminal.value[0], terminal.value[1] = best, terminal.value[1] + 1
            rows.setdefault(first, []).append((row, terminal))
            weight[first] = weight.get(first, 0) + 200
            rid += 1
        while sum(weight.values()) > held_bytes:
            largest = max(weight, key=weight.get)
            yield rows.pop(largest)
            del weight[largest]
            if largest < 0:
                trie.root.value = None
            else:
                trie.drop(largest)
    for group in rows.values():
        yield group


def _runs(batches: Iterator[pa.RecordBatch], size: int, sha: int) -> Iterator[Iterator[tuple]]:
    """Rows of a partition sorted by (size, sha): an iterator for each run of equal keys, so no run is held whole."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    return (run for _, run in itertools.groupby(rows, key=lambda row: (row[size], row[sha])))


def exact_duplicates(docs: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """For each row: the doc_id of the row that stays, the group's size, and the content's digest.

    Texts are equal when identical without white space (space, 0x09-0x0D); null counts as empty, so
    null, empty and blank texts are one group. The row with the most code points stays, then the
    smallest doc_id (null last); of rows that tie in both (repeated rows, or one id with texts of one
    length) exactly one stays. One output row per input row; an empty table gives an empty one. A very
    long text is held whole by one worker at a time. Only doc_id and text are read, so other columns
    can't clash.

    One shuffle carries each distinct text once per scan task. The copies of a hot text stream through
    the task that owns it, which holds one of them and a number for each; owners come back by a join on
    the local group, which has no more rows than a scan task, so its rows are spread over the tasks.
    """
    common.prepare(docs.sparkSession)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _fold(common.slices(batches, "text"), held_bytes):
            digest: dict[int, str] = {}
            for k in range(0, len(group), 2000):
                out = []
                for row, terminal in group[k : k + 2000]:
                    best, copies, content, _ = terminal.value
                    if id(terminal) not in digest:
                        digest[id(terminal)] = hashlib.sha256(content).hexdigest()
                    own = row[2] == best[2]
                    out.append((row[1], row[0], digest[id(terminal)], row[2], best[2], copies if own else None, len(content), content if own else None))
                yield common.batch_of(_LOCAL, *zip(*out, strict=True))

    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("rep", pa.int64()), ("keep_id", pa.int64()), ("keep_rid", pa.int64()), ("group_size", pa.int64())])
        out: list[tuple] = []
        for run in _runs(batches, 4, 5):
            trie = PatriciaTrie()
            ends = []
            for rep, doc_id, n_chars, copies, _, _, content in run:
                terminal = trie.insert(content)
                best, total = terminal.value or (None, 0)
                terminal.value = better((n_chars, doc_id, rep), best), total + copies
                ends.append((rep, terminal))
            out += [(rep, t.value[0][1], t.value[0][2], t.value[1]) for rep, t in ends]
            if len(out) >= 5000:
                yield common.batch_of(schema, *zip(*out, strict=True))
                out = []
        if out:
            yield common.batch_of(schema, *zip(*out, strict=True))

    folded = common.settle(docs.select("doc_id", "text").mapInArrow(local, _LOCAL_DDL), "exact-dedup")
    reps = folded.where(F.col("content").isNotNull()).select("rep", "doc_id", "n_chars", "copies", "size", "text_sha256", "content")
    dealt = reps.repartition(common.partitions(docs.sparkSession), "size", "text_sha256").sortWithinPartitions("size", "text_sha256")
    owned = dealt.mapInArrow(owners, "rep long, keep_id long, keep_rid long, group_size long")
    return folded.select("doc_id", "text_sha256", "rid", "rep").join(owned, "rep").select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """The rows of `docs` that stay, with all their columns, by the rules of `exact_duplicates`.

    Columns of any name pass through; docs needs doc_id and text.
    """
    common.prepare(docs.sparkSession)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    wide = docs.select("doc_id", "text", *[F.col(f"`{c}`") for c in others])
    # Positions, not names, carry the operator's own columns: c0 and c1 are doc_id and text.
    plain = wide.toDF(*[f"c{i}" for i in range(len(wide.columns))])
    kinds = [f.dataType.simpleString() for f in plain.schema.fields]
    carried = ", ".join(f"c{i} {k}" for i, k in enumerate(kinds))
    arrow = plain.limit(0).toArrow().schema

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*arrow, ("rid", pa.int64()), ("size", pa.int64()), ("sha", pa.string())])
        for group in _fold(common.slices(batches, "c1"), held_bytes):
            best = {id(t): t for _, t in group}
            ends = list(best.values())
            for k in range(0, len(ends), 500):
                out = [(t.value[0][1], t.value[3][0], *t.value[3][1], t.value[0][2], len(t.value[2]), hashlib.sha256(t.value[2]).hexdigest()) for t in ends[k : k + 500]]
                yield common.batch_of(schema, *zip(*out, strict=True))

    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(arrow)
        out: list[tuple] = []
        for run in _runs(batches, n + 1, n + 2):
            trie, ends = PatriciaTrie(), {}
            for row in run:
                terminal = trie.insert((row[1] or "").encode().translate(None, WHITE))
                mine = (len(row[1] or ""), row[0], row[n])
                held = terminal.value
                if held is None or better(mine, held[0]) is mine:
                    terminal.value = mine, row[:n]
                ends[id(terminal)] = terminal
            out += [t.value[1] for t in ends.values()]
            if len(out) >= 500:
                yield common.batch_of(pa.schema(arrow), *zip(*out, strict=True))
                out = []
        if out:
            yield common.batch_of(pa.schema(arrow), *zip(*out, strict=True))

    folded = plain.mapInArrow(local, carried + ", rid long, size long, sha string")
    dealt = folded.repartition(common.partitions(docs.sparkSession), "size", "sha").sortWithinPartitions("size", "sha")
    kept = dealt.mapInArrow(owners, carried).toDF(*wide.columns)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
