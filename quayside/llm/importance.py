"""Importance resampling towards a target, with an exact cutoff by weighted median-of-medians.

Texts become bags of hashed word runs. Counting the buckets of the corpus and of the target gives
an array of gains, the scaled logarithm of how much likelier a bucket is in the target; a document's
weight is the sum of the gains of its features. Adding Gumbel noise to the weights and taking the
highest scores draws documents without replacement in proportion to their weights.

How many are drawn is known, the score that the last of them has is not. It is found by selection,
without sorting the table: every partition names the median of the keys it has left and how many
there are, the median of these medians by weight is counted against all keys, and the side that
cannot hold the cutoff is given up, at least a quarter of what was left. Only the winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import staged
from quayside.llm.wu_manber import words_of

#: Longest run of words that is a feature, and the buckets the features are hashed into.
RUN = 3
BUCKETS = 10_000
SCALE = 1000
#: Documents of fewer words are not drawn; of the others this many hundredths are.
LEAST_WORDS = 20
DRAWN = 5
SEED = 42
#: Words up to this many bytes are appended to a checksum by table, longer ones by running over them.
TABLED = 64

_held: dict[str, np.ndarray] = {}


def _tables() -> np.ndarray:
    """What appending 0 to ``TABLED`` zero bytes does to each byte of a CRC-32, built from its 32 bits."""
    if "zeros" not in _held:
        found = np.zeros((TABLED + 1, 4, 256), dtype=np.uint32)
        for n in range(TABLED + 1):
            blank = zlib.crc32(bytes(n))
            for bit in range(32):
                effect = np.uint32(zlib.crc32(bytes(n), 1 << bit) ^ blank)
                at, low = divmod(bit, 8)
                found[n, at, 1 << low : 2 << low] = found[n, at, : 1 << low] ^ effect
        _held["zeros"] = found
    return _held["zeros"]


def _appended(sums: np.ndarray, lengths: np.ndarray, added: np.ndarray) -> np.ndarray:
    """CRC-32 of texts with sums ``sums``, each followed by a text of this length and sum."""
    tables, short = _tables(), np.minimum(lengths, TABLED)
    out = tables[short, 0, sums & 255]
    for at in range(1, 4):
        out ^= tables[short, at, (sums >> np.uint32(8 * at)) & 255]
    for row in np.flatnonzero(lengths > TABLED):
        zeros = bytes(int(lengths[row]))
        out[row] = zlib.crc32(zeros, int(sums[row])) ^ zlib.crc32(zeros)
    return out ^ added


def feature_buckets(words: list[bytes]) -> np.ndarray:
    """The bucket of every run of one to three words, joined by a space: its CRC-32 modulo ``BUCKETS``."""
    sums = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    space, one = np.uint32(zlib.crc32(b" ")), np.ones(len(words), dtype=np.int64)
    found, run = [sums], sums
    for more in range(1, RUN):
        run = run[: max(len(words) - more, 0)]
        spaced = _appended(run, one[: len(run)], space)
        run = _appended(spaced, lengths[more:], sums[more:])
        found.append(run)
    return np.concatenate(found) % np.uint32(BUCKETS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets of a partition's texts with their counts."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                total += np.bincount(feature_buckets(words_of(text)), minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket comes in the texts; ``BUCKETS`` sums reach the driver, whatever the corpus."""
    partial = texts.select(F.col("text").alias("text")).mapInArrow(_counted, "bucket long, n long")
    found = np.zeros(BUCKETS, dtype=np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row["bucket"]] = row["n"]
    return found


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight: the floor of the scaled log ratio of the smoothed shares."""
    s, t = float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(SCALE * math.log((float(y) + 1) * (s + BUCKETS) / ((float(x) + 1) * (t + BUCKETS))))
            for x, y in zip(corpus, target, strict=True)
        ],
        dtype=np.int64,
    )


WEIGHED = T.StructType([T.StructField(name, T.LongType(), False) for name in ("n_words", "n_features", "weight")])


def weigher(spark: SparkSession, gained: np.ndarray) -> Callable[[Column], Column]:
    """A column function from a text to its words, features and weight. Null and wordless texts have none of them."""
    held = spark.sparkContext.broadcast(gained)

    def weigh(texts: pa.Array) -> pa.Array:
        out = np.zeros((3, len(texts)), dtype=np.int64)
        for row, text in enumerate(texts.to_pylist()):
            if text:
                words = words_of(text)
                found = feature_buckets(words)
                out[:, row] = len(words), len(found), held.value[found].sum()
        return pa.StructArray.from_arrays([pa.array(column) for column in out], names=WEIGHED.names)

    return F.arrow_udf(weigh, WEIGHED).asNondeterministic()


def noise(identity: Column, seed: int = SEED) -> Column:
    """Gumbel noise, scaled and floored, that depends on the id and the seed only; a null id counts as ``null``."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.ln(-F.ln((h + 0.5) / float(1 << 32)))).cast("long")


class Key(NamedTuple):
    """What the rows are ordered by, first ones first: no two rows have the same key."""

    low: int  #: the score, negated
    no_id: bool
    doc_id: int  #: 0 where there is none
    th: int
    row: int


KEY = "low long, no_id boolean, doc_id long, th long, row long"


def _before(keys: np.ndarray, key: Key) -> np.ndarray:
    """Which keys come before this one."""
    found, tied = np.zeros(len(keys), dtype=bool), np.ones(len(keys), dtype=bool)
    for name, value in zip(Key._fields, key, strict=True):
        found |= tied & (keys[name] < value)
        tied &= keys[name] == value
    return found


_KEYS = np.dtype([("low", "i8"), ("no_id", "?"), ("doc_id", "i8"), ("th", "i8"), ("row", "i8")])


def _medians(after: Key | None, until: Key | None, at: Key | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per partition, of its keys between two bounds: how many lie before and after a third, each with their median."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            keys = np.empty(batch.num_rows, dtype=_KEYS)
            for name in Key._fields:
                keys[name] = batch.column(name).to_numpy(zero_copy_only=False)
            if after is not None:
                keys = keys[~_before(keys, after) & (keys["row"] != after.row)]
            if until is not None:
                keys = keys[_before(keys, until)]
            parts.append(keys)
        keys = np.concatenate(parts) if parts else np.empty(0, dtype=_KEYS)
        if at is None:
            sides = [(0, keys)]
        else:
            early = _before(keys, at)
            sides = [(0, keys[early]), (1, keys[~early & (keys["row"] != at.row)])]
        rows = []
        for side, held in sides:
            if len(held):
                order = np.lexsort([held[name] for name in reversed(Key._fields)])
                rows.append((side, len(held), *held[order[(len(held) - 1) // 2]].tolist()))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * (2 + len(Key._fields))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["side", "n", *Key._fields]
        )

    return found


def weighted_median(medians: list[tuple[int, Key]]) -> Key:
    """The median at or before which half of the weight lies."""
    half, upto = sum(n for n, _ in medians) / 2, 0
    for n, key in sorted(medians, key=lambda found: found[1]):
        upto += n
        if upto >= half:
            return key
    raise ValueError("no medians")


def cutoff(keys: DataFrame, wanted: int) -> Key | None:
    """The ``wanted``-th of the keys, counted from 1; none if there are not so many.

    One pass over what is left a round, at most two rows of each partition to the driver. A median
    of medians leaves at most three quarters of the keys, so the rounds grow with the logarithm of the table.
    """
    if wanted < 1:
        return None
    keys = keys.select(*Key._fields)
    after: Key | None = None
    until: Key | None = None
    at: Key | None = None
    while True:
        left = keys
        if after is not None:
            left = left.where(F.col("low") >= after.low)
        if until is not None:
            left = left.where(F.col("low") <= until.low)
        rows = left.mapInArrow(_medians(after, until, at), f"side long, n long, {KEY}").collect()
        sides: list[list[tuple[int, Key]]] = [[], []]
        for side, n, *key in rows:
            sides[side].append((n, Key(*key)))
        first, second = (sum(n for n, _ in side) for side in sides)
        if at is None:
            if first < wanted:
                return None
            at = weighted_median(sides[0])
        elif wanted == first + 1:
            return at
        elif wanted <= first:
            until, at = at, weighted_median(sides[0])
        else:
            wanted, after, at = wanted - first - 1, at, weighted_median(sides[1])


def upto(key: Key) -> Column:
    """Whether a row's key is this one or comes before it."""
    found = F.lit(True)
    for name, value in reversed(list(zip(Key._fields, key, strict=True))):
        found = (F.col(name) < F.lit(value)) | ((F.col(name) == F.lit(value)) & found)
    return found


def _ranked(winners: DataFrame) -> DataFrame:
    """The rows in the order of their keys, numbered from 1: sorted in ranges, of which only the sizes meet."""
    spark = winners.sparkSession
    ranges = winners.repartitionByRange(*Key._fields).sortWithinPartitions(*Key._fields)
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    ranges = staged(spark, ranges.withColumn("part", part).withColumn("place", place), "winners")
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    starts = staged(spark, starts, "range-starts")
    return ranges.join(starts, "part").withColumn("rank", F.col("start") + F.col("place") + 1)


def _weighed(docs: DataFrame, target: DataFrame, seed: int) -> DataFrame:
    spark = docs.sparkSession
    weigh = weigher(spark, gains(bucket_counts(docs), bucket_counts(target)))
    weighed = docs.select(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), weigh(F.col("text")).alias("w")
    ).select("id", "th", "w.*", (F.col("w.weight") + noise(F.col("id"), seed)).alias("score"))
    return staged(spark, weighed.select(
        "*", (-F.col("score")).alias("low"), F.col("id").isNull().alias("no_id"),
        F.coalesce("id", F.lit(0)).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
    ), "weighed")


def _last(rows: DataFrame, drawn: int) -> Key | None:
    long = rows.where(F.col("n_words") >= LEAST_WORDS)
    return cutoff(long, drawn * long.count() // 100)


def _won(last: Key | None) -> Column:
    return F.lit(False) if last is None else (F.col("n_words") >= LEAST_WORDS) & upto(last)


def resampled(docs: DataFrame, target: DataFrame, drawn: int = DRAWN, seed: int = SEED) -> DataFrame:
    """One row per document: ``(doc_id, n_features, weight, score, rank)``; ``rank`` is null where it is not drawn.

    Null and wordless texts have no feature and weight 0, and count as too short to be drawn; those
    of the target count nothing. Equal scores go by ``doc_id``, rows without one last; rows of one id by
    a hash of their text, and rows that repeat are drawn one by one. An empty table has no rows,
    and without a target all shares are alike up to smoothing. ``doc_id`` is an integer.
    """
    rows = _weighed(docs, target, seed)
    last = _last(rows, drawn)
    won = _won(last)
    lost = rows.where(~won).withColumn("rank", F.lit(None).cast("long"))
    names = [F.col("id").alias("doc_id"), "n_features", "weight", "score", F.col("rank").cast("long").alias("rank")]
    if last is None:
        return lost.select(*names)
    return lost.select(*names).unionByName(_ranked(rows.where(won)).select(*names))


def drawn_documents(docs: DataFrame, target: DataFrame, drawn: int = DRAWN, seed: int = SEED) -> DataFrame:
    """The documents that are drawn, with all their columns.

    Ids and text hashes of the winners find them. Only the rows like the last winner may be drawn in
    part: of rows that repeat, as many as were drawn stay.
    """
    rows = _weighed(docs, target, seed)
    last = _last(rows, drawn)
    if last is None:
        return docs.limit(0)
    won = rows.where(_won(last))
    like_last = F.col("no_id").eqNullSafe(last.no_id) & (F.col("doc_id") == last.doc_id) & (F.col("th") == last.th)
    others = staged(docs.sparkSession, won.where(~like_last).select("id", "th").distinct(), "drawn")
    hashed = F.xxhash64(docs["text"])
    whole = docs.join(others, docs["doc_id"].eqNullSafe(others["id"]) & (hashed == others["th"]), "left_semi")
    owner = docs["doc_id"].isNull() if last.no_id else docs["doc_id"] == last.doc_id
    return whole.unionByName(docs.where(owner & (hashed == last.th)).limit(won.where(like_last).count()))
