"""Approximate nearest neighbours by a permutation index.

A vector is known by the order in which it sees the pivots, nearest first: vectors that lie close
see them in a like order. The index is a table of segments. A segment holds its vectors and an
inverted file for each pivot, which posts the vectors by the place the pivot has in their orders.
A search adds up, pivot file by pivot file, how far the places of a vector are from those of the
query (Spearman's footrule), ranks the segment by that, and measures the exact distance to the first ranks only.

How many ranks are enough depends on the data, so it is measured: a few queries are answered by
brute force over the same segments, and the ranks in which their true neighbours stand tell which
share of a segment reaches the target recall. No vector is left out of the index, and a share of 1 is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import staged

#: Pivots, and how many of the nearest ones a vector's order keeps.
PIVOTS = 128
KEPT = 128
#: Rows that pivots are chosen from, by hash, and queries that the share of ranks is learned from.
SAMPLE = 1024
TAUGHT = 64
#: Vectors of a segment, and queries that are searched for in one pass over the index.
SEGMENT = 2048
QUERIES = 4096
#: Queries whose footrules are held at once in a task.
AT_ONCE = 64
#: Share of the taught queries' neighbours that the ranks must reach.
TARGET = 0.97
NEIGHBOURS = 10

INDEX = (
    "segment long, ids array<long>, asked array<boolean>, vectors array<double>, "
    "slots array<binary>, places array<binary>"
)


@dataclass(frozen=True)
class Index:
    """The segments, the pivots and the components of a vector."""

    segments: DataFrame
    pivots: np.ndarray
    width: int


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector can be compared: finite components, not all zero, and as many as most rows have.

    Vectors that are null, empty, zero, hold a null or a number that is not finite, or have another
    length than most (of equally frequent lengths the shortest counts) take no part.
    """
    held = F.col(f"`{vector}`")
    finite = F.forall(held, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(held.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(held, lambda x: x != 0))
    lengths = rows.groupBy(F.size(held).alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), "width").first()
    return rows.where(F.lit(False)) if most is None else rows.where(F.size(held) == most["width"])


def chosen_pivots(rows: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Of the sampled vectors, those that lie farthest from the ones chosen before; no vector twice."""
    if not len(rows):
        return rows
    picked = [0]
    far = ((rows - rows[0]) ** 2).sum(axis=1)
    while len(picked) < min(pivots, len(rows)):
        at = int(far.argmax())
        if far[at] <= 0:
            break
        picked.append(at)
        far = np.minimum(far, ((rows - rows[at]) ** 2).sum(axis=1))
    return rows[picked]


def places(vectors: np.ndarray, pivots: np.ndarray, kept: int) -> np.ndarray:
    """By vector and pivot, the place of the pivot in the vector's order; ``kept`` for all behind the kept ones."""
    kept = min(kept, len(pivots))
    far = (pivots**2).sum(axis=1)[None, :] - 2 * vectors @ pivots.T
    order = np.argsort(far, axis=1, kind="stable")[:, :kept]
    found = np.full(far.shape, kept, dtype=np.int16)
    np.put_along_axis(found, order, np.arange(kept, dtype=np.int16)[None, :], axis=1)
    return found


def _segments(pivots: np.ndarray, kept: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    width = pivots.shape[1]

    def made(number: int, ids: list, asked: list, vectors: np.ndarray) -> pa.RecordBatch:
        at = places(vectors, pivots, kept)
        slots, ranks = [], []
        for pivot in range(len(pivots)):
            posted = np.flatnonzero(at[:, pivot] < min(kept, len(pivots)))
            posted = posted[np.argsort(at[posted, pivot], kind="stable")]
            slots.append(posted.astype("<i4").tobytes())
            ranks.append(at[posted, pivot].astype("<i2").tobytes())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([asked], pa.list_(pa.bool_())), pa.array([vectors.ravel()], pa.list_(pa.float64())),
                pa.array([slots], pa.list_(pa.binary())), pa.array([ranks], pa.list_(pa.binary())),
            ],
            names=[field.split()[0] for field in INDEX.split(", ")],
        )

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        asked: list = []
        parts: list[np.ndarray] = []
        for batch in batches:
            for low in range(0, batch.num_rows, size):
                rows = batch.slice(low, size)
                ids += rows.column("id").to_pylist()
                asked += rows.column("asked").to_pylist()
                parts.append(rows.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
                if len(ids) >= size:
                    every = np.concatenate(parts)
                    yield made(number, ids[:size], asked[:size], every[:size])
                    number, ids, asked, parts = number + 1, ids[size:], asked[size:], [every[size:]]
        if ids:
            yield made(number, ids, asked, np.concatenate(parts))

    return indexed


def build(
    vectors: DataFrame, asked: Column, vector: str = "embedding", identity: str = "vec_id", pivots: int = PIVOTS,
    kept: int = KEPT, size: int = SEGMENT,
) -> Index:
    """Index every usable row; ``asked`` marks those that are queries. The index is written to the shared folder."""
    spark = vectors.sparkSession
    rows = usable(vectors, vector).select(
        F.col(f"`{identity}`").cast("long").alias("id"), F.coalesce(asked, F.lit(False)).alias("asked"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    sample = rows.select("vector").orderBy(F.xxhash64("vector"), "id").limit(SAMPLE).collect()
    chosen = chosen_pivots(np.array([row["vector"] for row in sample], dtype=np.float64), pivots)
    if not len(chosen):
        return Index(spark.createDataFrame([], INDEX), chosen, 0)
    segments = rows.mapInArrow(_segments(chosen, kept, size), INDEX)
    return Index(staged(spark, segments, "permutation-index"), chosen, chosen.shape[1])


FOUND = "query long, segment long, slot long, vec_id long, score double, needed double"


#: A block of queries as plain arrays: their segments and slots in the index, vectors, and pivots' places.
Asked = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _footrules(asked: np.ndarray, slots: list[bytes], ranks: list[bytes], n: int, kept: int) -> np.ndarray:
    """By query and vector of the segment: the places' differences, added up one pivot file after another."""
    total = np.zeros((len(asked), n), dtype=np.int32)
    for pivot, (posted, at) in enumerate(zip(slots, ranks, strict=True)):
        held = np.full(n, kept, dtype=np.int16)
        held[np.frombuffer(posted, "<i4")] = np.frombuffer(at, "<i2")
        total += np.abs(asked[:, pivot, None] - held[None, :])
    return total


def _searched(block, k: int, share: float, kept: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each task's ``k`` nearest of every query, and the share of ranks by which each of them was reached."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_segments, at_slots, asked, asked_places = block.value
        m = len(asked)
        score = np.full((m, k), np.inf)
        no_id = np.ones((m, k), dtype=bool)
        held = {name: np.zeros((m, k), dtype=np.int64) for name in ("vec_id", "segment", "slot")}
        needed = np.zeros((m, k))

        def keep(rows: np.ndarray, near: np.ndarray, new: dict[str, np.ndarray], missing: np.ndarray, ranks: np.ndarray) -> None:
            """Put found vectors beside the best so far and keep the ``k`` first of both."""
            both = np.concatenate([score[rows], near], axis=1)
            gone = np.concatenate([no_id[rows], missing], axis=1)
            every = {name: np.concatenate([held[name][rows], new[name]], axis=1) for name in held}
            reached = np.concatenate([needed[rows], ranks], axis=1)
            order = np.lexsort((every["slot"], every["segment"], every["vec_id"], gone, both), axis=1)[:, :k]
            score[rows] = np.take_along_axis(both, order, axis=1)
            no_id[rows] = np.take_along_axis(gone, order, axis=1)
            needed[rows] = np.take_along_axis(reached, order, axis=1)
            for name in held:
                held[name][rows] = np.take_along_axis(every[name], order, axis=1)

        for batch in batches:
            for row in range(batch.num_rows):
                number = batch.column("segment")[row].as_py()
                ids = batch.column("ids")[row].as_py()
                vectors = batch.column("vectors")[row].values.to_numpy(zero_copy_only=False).reshape(-1, width)
                slots, ranks = (batch.column(name)[row].as_py() for name in ("slots", "places"))
                n = len(ids)
                missing = np.array([x is None for x in ids])
                known = np.array([x or 0 for x in ids], dtype=np.int64)
                # Never less than k + 1 ranks, as one of them may be the query itself.
                wide = min(n, max(k + 1, math.ceil(share * n)))
                for low in range(0, m, AT_ONCE):
                    part = np.arange(low, min(low + AT_ONCE, m))
                    rule = _footrules(asked_places[part], slots, ranks, n, kept)
                    here = np.argpartition(rule, wide - 1, axis=1)[:, :wide] if wide < n else np.tile(np.arange(n), (len(part), 1))
                    away = vectors[here] - asked[part][:, None, :]
                    near = np.sqrt((away * away).sum(axis=2))
                    own = (at_segments[part, None] == number) & (here == at_slots[part, None])
                    near[own] = np.inf
                    first = np.argpartition(near, k - 1, axis=1)[:, :k] if wide > 4 * k else None
                    if first is not None:
                        # Ties with the k-th have to stay in, so that the smaller id wins.
                        last = np.take_along_axis(near, first, axis=1).max(axis=1, keepdims=True)
                        most = int((near <= last).sum(axis=1).max())
                        order = np.argsort(near, axis=1, kind="stable")[:, :most]
                        here, near = np.take_along_axis(here, order, axis=1), np.take_along_axis(near, order, axis=1)
                    at = np.take_along_axis(rule, here, axis=1)
                    sorted_rule = np.sort(rule, axis=1)
                    reached = np.stack([np.searchsorted(sorted_rule[i], at[i], side="right") for i in range(len(part))]) / n
                    new = {"vec_id": known[here], "segment": np.full(here.shape, number), "slot": here}
                    keep(part, near, new, missing[here], reached)
        some = np.isfinite(score)
        query = np.nonzero(some)[0]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(query, pa.int64()), pa.array(held["segment"][some], pa.int64()), pa.array(held["slot"][some], pa.int64()),
                pa.array(held["vec_id"][some], pa.int64(), mask=no_id[some]), pa.array(score[some]), pa.array(needed[some]),
            ],
            names=[field.split()[0] for field in FOUND.split(", ")],
        )

    return search


def _search(spark: SparkSession, index: Index, asked: Asked, k: int, share: float, kept: int) -> DataFrame:
    """``(query, rank, vec_id, score, needed)`` for a block of queries."""
    block = spark.sparkContext.broadcast(asked)
    kept = min(kept, len(index.pivots))
    found = index.segments.select("segment", "ids", "vectors", "slots", "places").mapInArrow(
        _searched(block, k, share, kept, index.width), FOUND
    )
    order = Window.partitionBy("query").orderBy("score", F.col("vec_id").asc_nulls_last(), "segment", "slot")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _asked_rows(index: Index) -> DataFrame:
    """``(segment, slot, vec_id, vector)`` of every query."""
    marked = index.segments.select("segment", "ids", "vectors", F.posexplode("asked").alias("slot", "is")).where("is")
    at = F.col("slot") * index.width + 1
    return marked.select(
        "segment", "slot", F.get("ids", "slot").alias("vec_id"), F.slice("vectors", at, index.width).alias("vector")
    )


def _block(rows: list, index: Index, kept: int) -> Asked:
    vectors = np.array([row["vector"] for row in rows], dtype=np.float64)
    at = [np.array([row[name] for row in rows]) for name in ("segment", "slot")]
    return at[0], at[1], vectors, places(vectors, index.pivots, kept)


def share_needed(spark: SparkSession, index: Index, queries: DataFrame, k: int, target: float = TARGET, kept: int = KEPT) -> float:
    """The share of a segment's ranks in which ``target`` of the true neighbours of a few queries stand.

    ``TAUGHT`` queries, the first by a hash of their vectors, are answered by brute force.
    """
    taught = queries.orderBy(F.xxhash64("vector"), "segment", "slot").limit(TAUGHT).collect()
    if not taught:
        return 1.0
    exact = _search(spark, index, _block(taught, index, kept), k, 1.0, kept)
    found = exact.agg(F.percentile("needed", F.lit(target)).alias("share")).first()["share"]
    return 1.0 if found is None else found


def nearest(
    vectors: DataFrame, asked: Column, k: int = NEIGHBOURS, vector: str = "embedding", identity: str = "vec_id",
    pivots: int = PIVOTS, kept: int = KEPT, target: float = TARGET, size: int = SEGMENT, block: int = QUERIES,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found of each asked row, by Euclidean distance.

    A query's own row is no neighbour of it; rows that repeat are queries and neighbours each by itself.
    Ties go to the smaller id, rows without an id last. Rows that ``usable`` leaves out are
    neither; an empty table, or one without an asked row, has no result. Queries are
    searched for in blocks, each broadcast to one pass over the index.
    """
    spark = vectors.sparkSession
    index = build(vectors, asked, vector, identity, pivots, kept, size)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not index.width:
        return empty
    queries = staged(spark, _asked_rows(index), "queries")
    share = share_needed(spark, index, queries, k, target, kept)
    blocks = math.ceil(queries.count() / block)
    number = F.pmod(F.xxhash64("segment", "slot"), F.lit(max(blocks, 1)))
    out = empty
    for at in range(blocks):
        rows = queries.where(number == at).collect()
        if not rows:
            continue
        ids = spark.createDataFrame([(i, row["vec_id"]) for i, row in enumerate(rows)], "query long, query_id long")
        found = _search(spark, index, _block(rows, index, kept), k, share, kept)
        named = found.join(F.broadcast(ids), "query").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
        out = named if out is empty else out.unionByName(named)
    return out
