"""N-gram Jaccard join by chosen paths.

A document is the set of its five-word shingles; documents of one set are one
class from the start. Each run splits all sets again and again: a bucket picks
one or two positions of a min-hash signature, and sets that hold the same value
there go on together. Buckets that are small enough are compared pair by pair;
buckets that hardly shrink, or stay large to the last level, are compared in
square blocks, so that none is too large for a task and none is left out. How likely a pair at the
least similarity meets in a run is known from the way buckets branch, and runs are repeated until
even a pair whose buckets go on to the last level is found with the target recall.

Sets that are alike stay together run after run. Their buckets of all runs are put together, so that
a large group of near copies is compared once instead of once a run.

A pair may meet in several buckets. It counts in the first of them only, which
every task can tell from the list of buckets a set is in, so no pair is ever
written out: tasks return counts of links and local components.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import freed, staged
from quayside.llm.components import components
from quayside.llm.wu_manber import _WORDS

WORDS = 5
#: Least similarity of a link, in tenths.
TENTHS = 8
SIGNATURE = 64
#: Buckets up to this many sets are compared at once; larger ones are split, at the last level into blocks.
SMALL = 128
BLOCK = 2048
DEPTH = 4
#: A bucket that keeps more than this share of the one it came from holds sets that are alike; it is not split again.
ALIKE = 0.5
#: Alike buckets are put together if that makes them at most so many times as large as the largest of them.
GROWN = 1.5
TARGET_RECALL = 0.999
#: Positions of the signature that a pair must agree in to be compared by shingles: a linked pair does with
#: a probability of more than 1 - 1e-6, as it agrees in 51 of 64 in the mean.
LEAST_AGREEING = 34
#: What ends a bucket, in the low bits of its number: its level where it is small, or one of these.
ALIKE_END, BLOCK_END = DEPTH + 1, DEPTH + 2

_PRIME = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_held: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if "up" not in _held or len(_held["up"]) < n:
        size = max(1 << 14, 1 << n.bit_length())
        for name, base in (("up", _PRIME), ("down", pow(_PRIME, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _held[name] = np.cumprod(steps, dtype=np.uint64)
    return _held["up"], _held["down"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles; fewer words, but some, are one shingle."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_WORDS), dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = raw != 32
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(raw * up[: len(raw)], dtype=np.uint64, out=sums[1:])
    words = _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    wide = min(WORDS, len(words))
    found = np.zeros(len(words) - wide + 1, dtype=np.uint64)
    for step in range(wide):
        found = found * np.uint64(_PRIME) + words[step : step + len(found)]
    return np.unique(_mixed(found))


def _multipliers() -> np.ndarray:
    if "by" not in _held:
        _held["by"] = np.random.default_rng(2).integers(0, 1 << 63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return _held["by"]


def signature(held: np.ndarray) -> np.ndarray:
    """Min-hash values of a set that is not empty."""
    by, low = _multipliers(), np.full(SIGNATURE, _MASK, dtype=np.uint64)
    for at in range(0, len(held), 2048):
        np.minimum(low, (held[at : at + 2048, None] * by[None, :]).min(axis=0), out=low)
    return (low >> np.uint64(33)).astype(np.int32)


SKETCH = T.StructType(
    [T.StructField("k", T.BinaryType()), T.StructField("sig", T.ArrayType(T.IntegerType(), False))]
)


def _sketched(texts: pa.Array) -> pa.Array:
    keys, signatures = [], []
    for text in texts.to_pylist():
        held = shingles(text)
        some = len(held) > 0
        keys.append(hashlib.blake2b(held.tobytes(), digest_size=16).digest() if some else None)
        signatures.append(signature(held) if some else None)
    return pa.StructArray.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(signatures, pa.list_(pa.int32()))], names=SKETCH.names
    )


def _shingled(texts: pa.Array) -> pa.Array:
    return pa.array([shingles(t).view(np.int64) for t in texts.to_pylist()], pa.list_(pa.int64()))


def sketches(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, k, sig)`` a row: a hash of the text, the key of its set (null if empty) and its signature."""
    sketch = F.arrow_udf(_sketched, SKETCH).asNondeterministic()
    return docs.select(
        F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("th"), sketch(F.col("text")).alias("s")
    ).select("doc_id", "th", "s.k", "s.sig")


def meets(agreeing: float, depth: int = DEPTH) -> float:
    """How likely a pair that agrees in this share of its signature is together at a level of a run.

    A bucket has one child, or two in a quarter of the cases, and the pair goes on in each child
    whose position it agrees in: a branching process that dies out for a pair at the least
    similarity only slowly, as it has one common child in the mean.
    """
    two = 10 / TENTHS - 1
    share = 1.0
    for _ in range(depth):
        share = (1 - two) * agreeing * share + two * (1 - (1 - agreeing * share) ** 2)
    return share


def runs_for(target: float = TARGET_RECALL) -> int:
    """Runs after which a pair at the least similarity is found with this recall, were all its buckets split to the end.

    The signature is drawn once for all runs, so the mean is over how many of its positions agree.
    """
    similar = TENTHS / 10
    agree = [math.comb(SIGNATURE, n) * similar**n * (1 - similar) ** (SIGNATURE - n) for n in range(SIGNATURE + 1)]
    runs = 1
    while sum(p * (1 - meets(n / SIGNATURE)) ** runs for n, p in enumerate(agree)) > 1 - target:
        runs += 1
    return runs


def _children(node: Column, sig: Column) -> Column:
    """The buckets a set goes on to: one position of the signature, in a quarter of the buckets two."""
    first = F.pmod(F.xxhash64(node, F.lit(1)), F.lit(SIGNATURE))
    second = F.pmod(first + 1 + F.pmod(F.xxhash64(node, F.lit(2)), F.lit(SIGNATURE - 1)), F.lit(SIGNATURE))

    def child(at: Column) -> Column:
        value = F.element_at(sig, (at + 1).cast("int"))
        run = F.shiftleft(F.shiftright(node, 56), 56)
        return run.bitwiseOR(F.shiftrightunsigned(F.xxhash64(node, at, value), 8))

    two = F.pmod(F.xxhash64(node, F.lit(3)), F.lit(100)) < 100 * (10 / TENTHS - 1)
    return F.when(two, F.array(child(first), child(second))).otherwise(F.array(child(first)))


def buckets(spark: SparkSession, sets: DataFrame, runs: int) -> DataFrame:
    """``(node, k, n)``: the buckets of two sets or more that these runs end in, with their sizes."""
    roots = F.explode(F.array(*[F.lit(run << 56).cast("long") for run in range(runs)]))
    rows = sets.select("k", "sig", F.lit(None).cast("long").alias("up"), roots.alias("node"))
    ended: DataFrame | None = None
    folders: list[str] = []
    for depth in range(1, DEPTH + 1):
        rows = staged(spark, rows.select("k", "up", F.explode(_children(F.col("node"), F.col("sig"))).alias("node")), "paths", folders)
        sizes = staged(spark, rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes", folders)
        told = staged(spark, rows.join(sizes, "node").select("node", "k", "n", "up"), "told", folders)
        alike = F.coalesce(F.col("n") > ALIKE * F.col("up"), F.lit(False))
        ends = F.lit(True) if depth == DEPTH else (F.col("n") <= SMALL) | alike
        end = F.when(F.col("n") <= SMALL, depth).when(alike, ALIKE_END).otherwise(BLOCK_END).cast("long")
        named = F.shiftleft(F.shiftright("node", 3), 3).bitwiseOR(end)
        done = told.where(ends).select(named.alias("node"), "k", "n")
        ended = done if ended is None else ended.unionByName(done)
        large = told.where(~ends)
        if depth == DEPTH or large.isEmpty():
            break
        rows = large.select("node", "k", F.col("n").alias("up")).join(sets.select("k", "sig"), "k")
    ended = staged(spark, ended, "ends")
    freed(spark, folders)
    return ended


def put_together(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """The same buckets, with those of one large group of alike sets made one.

    Such buckets share most sets, and so mostly their least one, by which they are told. All pairs that met
    still meet. Buckets whose union would be much larger than each of them are left alone.
    """
    is_alike = F.col("node").bitwiseAND(F.lit(7)) == ALIKE_END
    alike = ends.where(is_alike)
    labels = staged(spark, alike.groupBy("node").agg(F.min("k").alias("label"), F.max("n").alias("n")), "alike-labels")
    together = staged(spark, alike.join(labels.select("node", "label"), "node").select("label", "k").distinct(), "alike-sets")
    whole = together.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    largest = labels.groupBy("label").agg(F.max("n").alias("most"), F.min("node").alias("first"), F.count(F.lit(1)).alias("buckets"))
    good = whole.join(largest, "label").where((F.col("n") <= GROWN * F.col("most")) & (F.col("buckets") > 1))
    good = staged(spark, good.select("label", "n", F.col("first").alias("node")), "alike-groups")
    gone = staged(spark, labels.join(good.select("label"), "label", "left_semi").select("node"), "alike-gone")
    one = together.join(good, "label").select("node", "k", "n")
    return staged(spark, ends.join(gone, "node", "left_anti").unionByName(one), "buckets")


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows ``(node, k, sig)`` sorted by bucket, the members that agree well with another one, with their number."""
    nodes, keys, signatures = np.empty(0, dtype=np.int64), [], np.empty((0, SIGNATURE), dtype=np.int32)

    def settled(until: int) -> pa.RecordBatch:
        out: list[tuple] = []
        starts = np.flatnonzero(np.diff(nodes[:until], prepend=-1))
        for low, high in zip(starts, [*starts[1:], until], strict=True):
            group = signatures[low:high]
            agree = (group[:, None, :] == group[None, :, :]).sum(axis=2)
            np.fill_diagonal(agree, 0)
            near = np.flatnonzero((agree >= LEAST_AGREEING).any(axis=1))
            out += [(int(nodes[low]), keys[low + at], len(near)) for at in near]
        columns = list(zip(*out, strict=True)) if out else [[], [], []]
        kinds = (pa.int64(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["node", "k", "n"])

    for batch in batches:
        nodes = np.concatenate([nodes, batch.column("node").to_numpy()])
        keys += batch.column("k").to_pylist()
        flat = batch.column("sig").flatten().to_numpy(zero_copy_only=False)
        signatures = np.concatenate([signatures, flat.reshape(-1, SIGNATURE)])
        # The last bucket may go on in the next batch.
        until = int(np.searchsorted(nodes, nodes[-1])) if len(nodes) else 0
        yield settled(until)
        nodes, keys, signatures = nodes[until:], keys[until:], signatures[until:]
    yield settled(len(nodes))


def likely(spark: SparkSession, ends: DataFrame, sets: DataFrame) -> DataFrame:
    """The buckets without the sets that met no similar one there, as far as signatures tell.

    Most sets meet others by one equal position only. They go before shingles are moved; large
    buckets are left as they are.
    """
    small = F.col("n") <= SMALL
    signed = ends.where(small).select("node", "k").join(sets.select("k", "sig"), "k").select("node", "k", "sig")
    near = signed.repartition("node").sortWithinPartitions("node").mapInArrow(_agreeing, "node long, k binary, n long")
    return staged(spark, near.unionByName(ends.where(~small)), "likely")


def _pairs(group: list[tuple], square: bool) -> np.ndarray:
    """Which members of a group are linked, of the pairs a task may look at."""
    m = len(group)
    sizes = np.array([len(g[2]) for g in group])
    every = np.concatenate([g[2] for g in group])
    _, token, times = np.unique(every, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), sizes)
    shared = times[token] > 1
    owner, token = owner[shared], token[shared]
    _, token = np.unique(token, return_inverse=True)
    common = np.zeros((m, m), dtype=np.float32)
    wide = max(256, (1 << 21) // m)
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    last = int(token[-1]) + 1 if len(token) else 0
    for low in range(0, last, wide):
        a, b = np.searchsorted(token, (low, low + wide))
        held = np.zeros((m, min(wide, last - low)), dtype=np.float32)
        held[owner[a:b], token[a:b] - low] = 1
        common += held @ held.T
    either = sizes[:, None] + sizes[None, :] - common
    side = np.array([g[0] for g in group])
    asked = ~np.eye(m, dtype=bool) if square else side[:, None] != side[None, :]
    return (10 * common >= TENTHS * either) & asked


def _met(group: list[tuple], node: int) -> np.ndarray:
    """For each pair whether it meets in an earlier bucket."""
    m = len(group)
    owner = np.repeat(np.arange(m), [len(g[3]) for g in group])
    every = np.concatenate([g[3] for g in group])
    names, at, times = np.unique(every, return_inverse=True, return_counts=True)
    told = (times[at] > 1) & (every < node)
    _, place = np.unique(at[told], return_inverse=True)
    held = np.zeros((m, int(place.max()) + 1 if len(place) else 0), dtype=np.float32)
    held[owner[told], place] = 1
    return (held @ held.T) > 0


def _roots(linked: np.ndarray) -> np.ndarray:
    """The least index of every member's component."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(label)).min(axis=1)
        low = np.minimum(label, near)
        low = low[low]
        if (low == label).all():
            return label
        label = low


FOUND = "k binary, links long, root binary"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of every group of rows ``(node, i, j, side, k, shingles, nodes)``, which come sorted by group."""
    names = [name.split()[0] for name in FOUND.split(", ")]

    def settled(key: tuple, group: list[tuple]) -> list[tuple]:
        if len(group) < 2:
            return []
        node, i, j = key
        group.sort(key=lambda g: g[1])
        linked = _pairs(group, i == j)
        if not linked.any():
            return []
        links, roots = (linked & ~_met(group, node)).sum(axis=1), _roots(linked)
        return [(group[a][1], int(links[a]), group[roots[a]][1]) for a in np.flatnonzero(linked.any(axis=1))]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        kinds = [pa.binary(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names
        )

    key, group = None, []
    for batch in batches:
        out: list[tuple] = []
        nodes, first, second, sides, keys = (batch.column(n).to_pylist() for n in ("node", "i", "j", "side", "k"))
        lists = {}
        for name in ("shingles", "nodes"):
            column = batch.column(name)
            lists[name] = (column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy())
        for row in range(batch.num_rows):
            now = (nodes[row], first[row], second[row])
            if now != key:
                if key is not None:
                    out += settled(key, group)
                key, group = now, []
            held = [values[at[row] : at[row + 1]].copy() for values, at in lists.values()]
            group.append((sides[row], keys[row], held[0], held[1]))
        yield batch_of(out)
    if key is not None:
        yield batch_of(settled(key, group))


def compared(spark: SparkSession, ends: DataFrame, held: DataFrame) -> DataFrame:
    """Compare the sets of every bucket: the links each set gains, and its root in the bucket.

    ``held`` has the shingles of a set and all buckets it is in. Of buckets with the same members the first is compared.
    """
    same_members = ends.groupBy("node").agg(
        F.max("n").alias("n"), F.bit_xor(F.xxhash64("k")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "k")).alias("y")
    ).groupBy("n", "x", "y").agg(F.min("node").alias("node"))
    kept = ends.join(staged(spark, same_members.select("node"), "kept-buckets"), "node", "left_semi")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    side = F.pmod(F.xxhash64(F.lit("side"), "k"), blocks).cast("int")
    dealt = kept.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select(
        "node", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "k"
    )
    rows = dealt.join(held, "k").select("node", "i", "j", "side", "k", "shingles", "nodes")
    sorted_rows = rows.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j")
    return sorted_rows.mapInArrow(_compared, FOUND)


def joined(spark: SparkSession, docs: DataFrame, target: float = TARGET_RECALL) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, th, k, class_id, class_th, n_links, n_copies)``.

    A class holds all documents that links connect; its id is its least
    ``doc_id`` (rows without an id last), and ``class_th`` tells that row's
    text. ``n_links`` counts the other sets of similarity 0.8 or more,
    ``n_copies`` the rows of the same set, this one included. Texts without a
    word have no shingle: each is a class of its own without links.
    """
    sketched = staged(spark, sketches(docs), "sketches")
    some = sketched.where("k is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("first")
    sets = staged(
        spark,
        some.groupBy("k").agg(first, F.count(F.lit(1)).alias("n_copies"), F.min("sig").alias("sig")),
        "sets",
    )
    ends = likely(spark, put_together(spark, buckets(spark, sets, runs_for(target))), sets)
    folders: list[str] = []
    nodes = staged(spark, ends.groupBy("k").agg(F.collect_list("node").alias("nodes")), "nodes", folders)
    wanted = nodes.join(sets, "k").select("k", "nodes", "first.doc_id", "first.th")
    wanted = staged(spark, wanted, "wanted", folders)
    shingle = F.arrow_udf(_shingled, T.ArrayType(T.LongType(), False)).asNondeterministic()
    texts = docs.select(F.col("doc_id").alias("d"), F.col("text").alias("text"), F.xxhash64("text").alias("h"))
    # Rows that repeat give the same set again; one of them is enough.
    given = texts.join(wanted, texts["d"].eqNullSafe(wanted["doc_id"]) & (texts["h"] == wanted["th"]))
    given = staged(spark, given.select("k", "nodes", shingle(F.col("text")).alias("shingles")), "shingles", folders)
    links = staged(spark, compared(spark, ends, given.dropDuplicates(["k"])), "links")
    freed(spark, folders)
    edges = links.select(F.col("k").alias("u"), F.col("root").alias("v"))
    roots = components(spark, edges)
    counted = links.groupBy("k").agg(F.sum("links").alias("n_links"))
    classes = sets.join(counted, "k", "left").join(roots.withColumnRenamed("u", "k"), "k", "left")
    classes = staged(
        spark,
        classes.select("k", "first", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "k").alias("root")),
        "classes",
    )
    heads = staged(spark, classes.groupBy("root").agg(F.min("first").alias("head")), "heads")
    classes = staged(
        spark, classes.join(heads, "root").select(F.col("k").alias("c"), "n_copies", "n_links", "head"), "settled"
    )
    return sketched.join(classes, sketched["k"] == classes["c"], "left").select(
        "doc_id", "th", "k",
        F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.when(F.col("k").isNull(), F.col("th")).otherwise(F.col("head.th")).alias("class_th"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document its class, how many other sets it is linked to, and how many rows have its own set; see ``joined``."""
    return joined(spark, docs).select("doc_id", "class_id", "n_links", "n_copies")


def one_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The first document of every class, with all columns; of rows that repeat one stays.

    Documents without words are classes of their own; all of them stay.
    """
    classes = joined(spark, docs)
    first = classes.where(
        F.col("k").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("th") == F.col("class_th"))
    )
    stay = first.groupBy("doc_id", "th").agg(
        F.when(F.max(F.col("k").isNotNull()), F.count(F.lit(1))).otherwise(1).alias("times")
    ).select(F.col("doc_id").alias("__d"), F.col("th").alias("__h"), F.col("times").alias("__times"))
    stay = staged(spark, stay, "stay")
    found = docs.withColumn("__th", F.xxhash64(docs["text"]))
    found = found.join(stay, found["doc_id"].eqNullSafe(stay["__d"]) & (found["__th"] == stay["__h"]))
    once = found.where("__times = 1").select(*docs.columns)
    again = found.where("__times > 1").dropDuplicates(["__d", "__h"]).select(*docs.columns)
    return once.unionByName(again)
