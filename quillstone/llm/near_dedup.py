"""Near-duplicate groups by SetSketch registers.

A document's shingle set is sketched in M registers: the smallest of exponentially distributed hash
values, kept as its place on an exponentially spaced scale. Registers of a union are the maxima of
the parts' registers, and equal registers are likely where sets are alike, so bands of registers
bring like sets together. Every link is confirmed on the full sets.

No bucket is expanded into all pairs, and no link between its members is lost:

1. Each member of a bucket is compared with the bucket's pivot, its smallest id. Members and pivots
   are reduced to distinct pairs before any text is attached: a pair that meets in thirty bands is
   compared once.
2. Those links give components. Members that share a bucket share its pivot, so from here on a
   pivot's members, of all its buckets, stand for them. Jaccard distance is a metric: of a pivot
   some of whose members are in other components than its own, only those members (the outsiders),
   and the pivot's own members that are near enough to the nearest outsider, can have links not
   found yet. They are compared by the likelihood of their registers, and what may reach the
   threshold is confirmed in the task where they meet. Where they are many, they are dealt into
   blocks of bounded size, and a task holds one pair of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

REGISTERS, ROWS = 200, 5  # 40 bands of 5: a pair at similarity 0.8 is missed with probability 1e-7
BASE = 1.001
#: Members of a hub whose texts one task streams past the hub's.
HUB_MEMBERS = 4096
#: A likelihood estimate this far below the threshold rules a pair out (7 standard errors).
SLACK = 0.2
#: Shingles and members of a pivot's open part that one block holds; a member counts for its shingles and MEMBER more.
BLOCK, MEMBER = 2_000_000, 400

_SCALE = np.random.default_rng(20240229).integers(0, 2**63, REGISTERS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = np.random.default_rng(5).integers(0, 2**63, REGISTERS // ROWS, dtype=np.int64).astype(np.uint64)


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text: `size` words, or all of a shorter text's."""
    words = common.Words(column, lower=True)
    h, first = words.hashes(), words.first
    grams = common.runs(h, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            out.append(common.mix(common.runs(h[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Registers of non-empty sets, one row each."""
    out = np.empty((len(sets), REGISTERS), np.uint16)
    if not sets:
        return out
    joined, begin = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    held = np.empty_like(joined)
    for i, scale in enumerate(_SCALE):
        np.multiply(joined, scale, out=held)
        u = (np.minimum.reduceat(held, begin).astype(np.float64) + 0.5) / 2.0**64
        x = -np.log1p(-np.minimum(u, 1 - 1e-16))
        out[:, i] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 65535)
    return out


def likely_similarity(greater: np.ndarray, smaller: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity, given how many registers are greater and smaller and the sets' sizes.

    With BASE near 1 a register is greater with probability u - v J, smaller with v - u J and equal
    with J, where u and v are the sets' shares of the sum of their sizes. The likelihood's derivative
    is a quadratic in J, and its smaller root is the maximum.
    """
    u = size_a / (size_a + size_b)
    v = 1 - u
    equal = REGISTERS - greater - smaller
    b = equal * (u * u + v * v) + greater * v * v + smaller * u * u
    root = np.sqrt(np.maximum(b * b - 4 * REGISTERS * equal * (u * v) ** 2, 0))
    return np.minimum((b - root) / (2 * REGISTERS * u * v), np.minimum(u / v, v / u))


_ROW_DDL = "doc_id long, rid long, rep long, n_shingles long, set_key binary, registers binary"
_ROW = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("rep", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("registers", pa.binary())])
_HELD_ROWS = 30_000


def _described(docs: DataFrame, size: int) -> DataFrame:
    """A row per document; one row of each local group of equal sets also has the registers and the group's smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 33
        groups: dict[bytes, int] = {}
        held: list[list] = []

        def flush() -> pa.RecordBatch:
            out = common.batch_of(_ROW, *zip(*held, strict=True))
            held.clear()
            groups.clear()
            return out

        for batch in common.slices(batches, "text", 1 << 20):
            sets = shingle_sets(batch.column(1), size)
            fresh: list[tuple[int, np.ndarray]] = []
            for doc_id, own in zip(batch.column(0).to_pylist(), sets, strict=True):
                key, rep = None, None
                if len(own) and doc_id is not None:
                    key = int(common.mix(own).sum(dtype=np.uint64)).to_bytes(8, "big") + int(common.mix(own ^ common._M2).sum(dtype=np.uint64)).to_bytes(8, "big") + len(own).to_bytes(4, "big")
                    at = groups.get(key)
                    if at is None:
                        groups[key] = len(held)
                        fresh.append((len(held), own))
                        rep = rid
                    else:
                        rep = held[at][1]
                held.append([doc_id, rid, rep, len(own), key, None])
                rid += 1
            for (at, _), registers in zip(fresh, sketches([s for _, s in fresh]), strict=True):
                held[at][5] = registers.astype("<u2").tobytes()
            if len(held) >= _HELD_ROWS:
                yield flush()
        if held:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, _ROW_DDL)


def _bands(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("band", pa.int64()), ("id", pa.int64())])
        for batch in batches:
            if not batch.num_rows:
                continue
            registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, REGISTERS // ROWS, ROWS).astype(np.uint64)
            h = np.repeat(_BAND[None, :], len(registers), 0)
            for k in range(ROWS):
                h = common.mix(h + registers[:, :, k])
            yield common.batch_of(schema, h.ravel().view(np.int64), np.repeat(batch.column(0).to_numpy(), h.shape[1]))

    return classes.select("id", "registers").mapInArrow(run, "band long, id long")


def confirm(docs: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """pairs (a, b) with `shared` and `joint`: exact sizes of intersection and union of the sets.

    Texts are dealt by their hub b, a hub of many members in as many parts as its counted size needs:
    a task reads the hub's text once, then streams the members' texts past it, and holds two sets at
    a time. `pairs` is read twice, so it should be a written table.
    """
    parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / HUB_MEMBERS).cast("int").alias("parts"))
    salted = pairs.join(parts, "b").select("a", "b", F.pmod(F.xxhash64("a"), "parts").cast("int").alias("salt"))
    members = salted.select(F.col("a").alias("doc_id"), F.col("b").alias("hub"), "salt", F.lit(1).alias("member"))
    hubs = parts.select(F.col("b").alias("doc_id"), F.col("b").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.lit(0).alias("member"))
    # Dealt by a shuffle at any size, so that a small input shows what a large one costs.
    texts = docs.select("doc_id", "text").join(members.unionByName(hubs).hint("merge"), "doc_id")
    dealt = texts.repartition(common.partitions(docs.sparkSession), "hub", "salt").sortWithinPartitions("hub", "salt", "member", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int64()), ("joint", pa.int64())])
        now, own = None, []
        for batch in common.slices(batches, "text", 1 << 20):
            ids, _, hub, salt, member = (batch.column(i).to_pylist() for i in range(5))
            out = []
            for i, mine in enumerate(shingle_sets(batch.column(1), size)):
                if now != (hub[i], salt[i]):
                    now, own = (hub[i], salt[i]), []
                if not member[i]:
                    own.append(mine)
                    continue
                for other in own:
                    shared = len(np.intersect1d(mine, other, assume_unique=True))
                    out.append((ids[i], hub[i], shared, len(mine) + len(other) - shared))
            if out:
                yield common.batch_of(schema, *zip(*out, strict=True))

    found = dealt.select("doc_id", "text", "hub", "salt", "member").mapInArrow(run, "a long, b long, shared long, joint long")
    return found.where("joint > 0")


_MET_DDL = "pivot long, low int, high int, id long, component long, block int, d double, registers binary, text string"


def _rest(docs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between open members of a pivot (id, component, own, d, n, registers) that are in different components.

    `own` members are in the pivot's component, which holds no links to be found; the others are its
    outsiders. A pivot's members are one block if they are few. Otherwise each kind is dealt into as
    many blocks as its counted size needs, own blocks numbered below 0, and a task takes the texts of
    a pair of blocks with an outsiders' block among them, so that memory has a bound and a large pivot
    is shared out. Registers and the distances d to the pivot say which pairs may be linked; those are
    confirmed on the full sets right there, and only links that join parts not joined before go on:
    fewer than the task has members.
    """
    weight = F.col("n") + MEMBER
    need = lambda when: F.ceil(F.coalesce(F.sum(F.when(when, weight)), F.lit(0)) / BLOCK).cast("int")
    sizes = rows.groupBy("pivot").agg(need(F.col("own")).alias("inner"), need(~F.col("own")).alias("outer"), need(F.lit(True)).alias("whole"))
    placed = rows.join(sizes, "pivot")
    mine = F.pmod(F.xxhash64("id", "pivot"), F.when(F.col("own"), F.col("inner")).otherwise(F.col("outer"))).cast("int")
    placed = placed.withColumn("block", F.when(F.col("whole") <= 1, F.lit(0)).when(F.col("own"), -1 - mine).otherwise(mine))
    others = F.when(F.col("whole") <= 1, F.array(F.lit(0))).when(F.col("own"), F.sequence(F.lit(0), F.col("outer") - 1)).otherwise(F.sequence(-F.col("inner"), F.col("outer") - 1))
    met = placed.withColumn("other", F.explode(others))
    met = met.select("pivot", "id", "component", "d", "registers", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    keys = ["pivot", "low", "high"]
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(met.hint("merge"), "id")
    dealt = texts.repartition(common.partitions(docs.sparkSession), *keys).sortWithinPartitions(*keys, "id")
    reach = 1 - percent / 100 + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        held: list[tuple] = []

        def close() -> list[tuple[int, int]]:
            held.sort(key=lambda r: (len(r[6]), r[1]))
            one_block = held[0][0][1] == held[0][0][2]
            ids, block, d = (np.array([r[k] for r in held]) for k in (1, 3, 4))
            _, label = np.unique([r[2] for r in held], return_inverse=True)
            registers = np.frombuffer(b"".join(r[5] for r in held), "<u2").reshape(-1, REGISTERS)
            sets = [r[6] for r in held]
            n = np.array([len(x) for x in sets], np.int64)
            held.clear()
            values, code = np.unique(np.concatenate(sets), return_inverse=True)
            edge = np.concatenate([[0], np.cumsum(n)])
            mine = np.zeros(len(values), bool)
            out = []
            for i in range(1, len(ids)):
                able = np.flatnonzero((label[:i] != label[i]) & (n[:i] * 100 >= n[i] * percent) & (np.abs(d[:i] - d[i]) <= reach) & (one_block | (block[:i] != block[i])))
                if not len(able):
                    continue
                gap = registers[able].astype(np.int32) - registers[i]
                likely = able[likely_similarity((gap > 0).sum(1), (gap < 0).sum(1), n[able], n[i]) >= percent / 100 - SLACK]
                if not len(likely):
                    continue
                mine[code[edge[i] : edge[i + 1]]] = True
                stop = np.cumsum(n[likely])
                at = np.repeat(edge[likely] - (stop - n[likely]), n[likely]) + np.arange(stop[-1])
                shared = np.add.reduceat(mine[code[at]], stop - n[likely], dtype=np.int64)
                mine[code[edge[i] : edge[i + 1]]] = False
                for j in likely[shared * 100 >= (n[likely] + n[i] - shared) * percent].tolist():
                    if label[j] != label[i]:
                        out.append((int(max(ids[i], ids[j])), int(min(ids[i], ids[j]))))
                        label[label == label[j]] = label[i]
            return out

        for batch in common.slices(batches, "text", 1 << 20):
            pivot, low, high, ids, parts, blocks, d, registers = (batch.column(k).to_pylist() for k in range(8))
            out = []
            for row in zip(zip(pivot, low, high, strict=True), ids, parts, blocks, d, registers, shingle_sets(batch.column(8), size), strict=True):
                if held and held[0][0] != row[0]:
                    out += close()
                if len(row[6]):
                    held.append(row)
            if out:
                yield common.batch_of(schema, *zip(*out, strict=True))
        if held and (out := close()):
            yield common.batch_of(schema, *zip(*out, strict=True))

    return dealt.select(*[c.split()[0] for c in _MET_DDL.split(", ")]).mapInArrow(run, "a long, b long").where("a <> b").distinct()


def near_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Size of each row's shingle set and the smallest doc_id its links lead to.

    Words are runs without white space, A-Z in lower case; a set is the distinct `size`-word shingles,
    or a shorter text's whole sequence. Two rows are linked when 100 * intersection >= percent * union.
    Null and empty texts have the empty set and no links; a very long text's set is held whole, two
    such at a time. One output row per input row, repeated rows included; rows that share a doc_id
    count as one document and so share its component. A similarity of just percent is a link. A row
    without doc_id is linked with nothing, has no component and is kept. An empty table gives an empty
    one. Only doc_id and text are read, so other columns can't clash.
    """
    spark = common.prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    rows = common.settle(_described(docs, size), "near-rows")
    sets = rows.where("rep is not null")
    ids = sets.groupBy("rep").agg(F.min("doc_id").alias("least"))
    local = sets.where("registers is not null").select("rep", "set_key", "n_shingles", "registers").join(ids, "rep")
    classes = common.settle(local.groupBy("set_key").agg(F.min("least").alias("id"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")), "near-classes")
    # Different sets of three shingles or fewer are never alike enough (for five in six and less).
    least = 1 + percent // (100 - percent) if percent < 100 else 1
    able = classes.where(F.col("n") >= least - 1)
    bands = common.settle(_bands(able), "near-bands")
    pivots = bands.groupBy("band").agg(F.min("id").alias("pivot"), F.max("id").alias("top")).where("pivot <> top").select("band", "pivot")
    # Both sides of this join are plain exchanges of written tables, so adaptive execution splits a hot band.
    pivots = common.settle(pivots, "near-pivots")
    stars = common.settle(bands.join(pivots, "band").where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct(), "near-stars")
    common.release(spark)
    tested = common.settle(confirm(docs, stars, size), "near-tested")
    common.release(spark)
    links = tested.where(F.col("shared") * 100 >= F.col("joint") * percent).select("a", "b")
    found = components(links)

    # What the pivots leave open: members of other components, and who of the pivot's could reach them.
    distance = tested.groupBy(F.col("a").alias("id"), F.col("b").alias("pivot")).agg(F.min(1 - F.col("shared") / F.col("joint")).alias("d"))
    member = found.select(F.col("node").alias("id"), F.col("component").alias("member"))
    hub = found.select(F.col("node").alias("pivot"), F.col("component").alias("hub"))
    placed = distance.join(member, "id", "left").join(hub, "pivot", "left").withColumn("component", F.coalesce("member", "id"))
    placed = placed.select("pivot", "id", "d", "component", (F.col("component") == F.coalesce("hub", "pivot")).alias("own"))
    placed = common.settle(placed, "near-placed")
    outside = F.when(~F.col("own"), F.col("d"))
    nearest = placed.groupBy("pivot").agg(F.min(outside).alias("near"), F.count(outside).alias("n_out"), F.max(F.when(F.col("own"), F.col("d"))).alias("far"))
    reach = 1 - percent / 100 + 1e-9
    # A pivot is open where two outsiders may meet, or one outsider and an own member.
    nearest = nearest.where((F.col("n_out") > 1) | ((F.col("n_out") == 1) & (F.col("far") >= F.col("near") - reach)))
    rest = placed.join(nearest, "pivot").where(~F.col("own") | (F.col("d") >= F.col("near") - reach)).select("pivot", "id", "d", "component", "own")
    rest = common.settle(rest.join(able.select("id", "n", "registers"), "id"), "near-open")
    more = common.settle(_rest(docs, rest, size, percent), "near-rest")
    common.release(spark)
    if not more.isEmpty():
        found = components(links.unionByName(more))

    roots = classes.select("set_key", "id").join(found.select(F.col("node").alias("id"), "component"), "id", "left").select("set_key", F.coalesce("component", "id").alias("root"))
    owners = sets.where("registers is not null").select("rep", "set_key").join(roots, "set_key").select("rep", "root")
    some = sets.select("doc_id", "n_shingles", "rep").join(owners, "rep").select("doc_id", "n_shingles", F.col("root").alias("component_id"))
    none = rows.where("rep is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.unionByName(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that `near_groups` keeps, with all their columns: one document of each group.

    A row without doc_id stays.
    """
    kept = near_groups(docs, size, percent).where("kept").select(F.col("doc_id").alias("kept_doc_id")).distinct()
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("carried"))
    chosen = wide.join(kept, F.col("carried.doc_id") == F.col("kept_doc_id"), "left_semi").unionByName(wide.where("carried.doc_id is null"))
    return chosen.select(*[F.col("carried").getField(c).alias(c) for c in docs.columns])
