"""A log-bilinear language model, trained in numpy with noise-contrastive estimation.

Words are counted over all training texts. So many of the commonest have vectors
of their own, a number that grows with the distinct words; all others share one,
and have the probability of their count inside it. Words with vectors are put into
classes by their rank, and the model predicts the class and then the word in its
class from the two words before it: their vectors, weighted position by position,
are added up and multiplied with those of the classes and those of the words in
the class. Both steps are trained against noise, drawn from the classes and from
the words of the class. Partitions train on their own texts from common
parameters; the parameters are averaged, each row by how often it was met, round
after round, and each training text is used once. For scoring, the contexts of a
batch are made distinct and both steps are normalised by matrix products, so
probabilities are exact and cost about two square roots of the words each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import staged

#: Words whose counts every task holds, which bounds what is broadcast; of these the commonest have vectors.
HEAD = 262_144
LEAST_VECTORS, GROWTH = 1024, 0.75
DIMENSIONS = 16
#: Noise classes of a batch, and noise words of a token.
NOISE, NOISE_WORDS = 48, 4
BATCH = 1024
ROUNDS = 2
RATE = 0.3
FOLDS, HELD_OUT = 7, 2
#: Trainers of a round for each core at the most: each sends all the rows it met, whatever the length of its texts.
TASKS = 2


def fold(doc_id: Column) -> Column:
    """The fold of a document; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


#: Distinct words that a task counts before it passes the counts on.
COUNTED = 500_000


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their counts, a word again whenever more than ``COUNTED`` were held."""
    held: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            held.update(_words(text))
            if len(held) > COUNTED:
                yield _counts(held)
                held.clear()
    yield _counts(held)


def _counts(held: Counter[bytes]) -> pa.RecordBatch:
    words = pa.array(list(held), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "c"])


def _words(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8, A-Z lower-cased."""
    return text.lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, c)`` over all texts."""
    some = texts.where(F.col("text").isNotNull()).select("text").mapInArrow(_counted, "word string, c long")
    return some.groupBy("word").agg(F.sum("c").alias("c"))


def _head(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """The commonest words, ``most`` at the most: all those above a step of the counts' logarithm."""
    step = F.floor(F.log2("c") * 16).cast("int")
    rows = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, total = None, 0
    for row in sorted(rows, key=lambda r: -r["step"]):
        total += row["n"]
        if total > most:
            break
        least = row["step"]
    if least is None:
        return []
    found = [(row["word"], row["c"]) for row in counts.where(step >= least).collect()]
    return sorted(found, key=lambda x: (-x[1], x[0]))


def vector_words(distinct: int) -> int:
    """Words with vectors of their own: a power of the distinct words, and ``HEAD`` at the most."""
    return min(HEAD, max(LEAST_VECTORS, int(distinct**GROWTH)))


class Vocabulary:
    """Counts of the training texts: totals, and the commonest words by falling count."""

    def __init__(self, counts: DataFrame, n_texts: int, vectors: int | None = None, head: int = HEAD):
        totals = counts.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
        common = _head(counts, head)
        self.words = [word.encode("utf-8", "surrogatepass") for word, _ in common]
        self.counts = np.array([c for _, c in common], dtype=np.int64)
        self.n_texts = n_texts
        self.tokens = totals["n"] + n_texts
        self.distinct = totals["v"] + (1 if n_texts else 0)
        self.vectors = min(vector_words(totals["v"]) if vectors is None else vectors, len(common))
        top = int(self.counts[: self.vectors].sum())
        self.rest_tokens, self.rest_distinct = totals["n"] - top, totals["v"] - self.vectors

    def unit_shares(self) -> np.ndarray:
        """Smoothed shares of the units: all other words, the end, and the words with vectors by falling count."""
        found = np.concatenate([[self.rest_tokens, self.n_texts], self.counts[: self.vectors]]) + 1.0
        return found / found.sum()


def _token_ids(words: list[bytes], index: dict[bytes, int]) -> np.ndarray:
    return np.fromiter(map(index.get, words, repeat(-1)), dtype=np.int32, count=len(words))


def _commonest(index: dict[bytes, int], most: int) -> dict[bytes, int]:
    """The first words of an index, which are most tokens: a small table is found in the processor's caches."""
    return dict(islice(index.items(), most))


#: The unit of all words without a vector and that of the end; word ``i`` is unit ``i + FIRST``.
REST, END, FIRST = 0, 1, 2


def _units(ids: np.ndarray, vectors: int) -> np.ndarray:
    return np.where((ids >= 0) & (ids < vectors), ids + FIRST, REST).astype(np.int32)


def _contexts(targets: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Targets of all texts with their end, and the two units before each; a text begins with two starts."""
    whole = np.concatenate([np.concatenate([[start, start], t, [END]]) for t in targets]).astype(np.int32)
    inside = whole != start
    at = np.flatnonzero(inside)
    return whole[at], whole[at - 1], whole[at - 2]


Parameters = dict[str, np.ndarray]


def class_width(units: int) -> int:
    """Units of a class, as many as there are classes."""
    return max(1, int(np.ceil(np.sqrt(units))))


def first_parameters(shares: np.ndarray, dimensions: int = DIMENSIONS) -> Parameters:
    """Vectors of context units (the last is the start), target units and classes; the last number of the latter is a bias."""
    random = np.random.default_rng(7)
    units, width = len(shares), class_width(len(shares))
    of_classes = np.add.reduceat(shares, np.arange(0, units, width))

    def rows(n: int) -> np.ndarray:
        return random.normal(0, 0.1, (n, dimensions)).astype(np.float32)

    return {
        "context": rows(units + 1),
        "target": np.column_stack([rows(units), np.log(shares / of_classes[np.arange(units) // width])]).astype(np.float32),
        "class": np.column_stack([rows(len(of_classes)), np.log(of_classes)]).astype(np.float32),
        "place": np.ones((2, dimensions), dtype=np.float32),
    }


def _ranked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places that are named, the order that brings equal ones together, and where each begins in it."""
    bits = len(at).bit_length()
    keys = np.sort((at.astype(np.int64) << bits) | np.arange(len(at)))
    order, ranked = keys & ((1 << bits) - 1), keys >> bits
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    return ranked[starts], order, starts


def _sums(rows: np.ndarray, order: np.ndarray, starts: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows in this order from each start to the next, times these numbers, and how many each adds up."""
    numbers = np.diff(starts, append=len(order))
    # Most are alone and are taken as they are: adding up costs more than that, even of one row.
    sums = rows.take(order.take(starts), axis=0)
    if times is not None:
        sums *= times.take(starts)[:, None]
    several = np.flatnonzero(numbers > 1)
    if len(several):
        of = np.flatnonzero(np.repeat(numbers > 1, numbers))
        added = rows.take(order.take(of), axis=0)
        if times is not None:
            added *= times.take(of)[:, None]
        begins = np.cumsum(numbers[several]) - numbers[several]
        sums[several] = np.add.reduceat(added, begins, axis=0)
    return sums, numbers


def _falling(x: np.ndarray) -> np.ndarray:
    """``1 / (1 + exp(x))`` of numbers that are used up."""
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _with_one(rows: np.ndarray) -> np.ndarray:
    return np.column_stack([rows, np.ones(len(rows), dtype=np.float32)])


class Trainer:
    """Noise-contrastive steps on batches, which change the rows they meet and no others."""

    def __init__(self, parameters: Parameters, shares: np.ndarray, seed: int):
        self.p = {name: value.copy() for name, value in parameters.items()}
        self.squares = {name: np.full(value.shape, 0.1, dtype=np.float32) for name, value in parameters.items()}
        self.met = {name: np.zeros(len(value), dtype=np.float32) for name, value in parameters.items()}
        self.width = class_width(len(shares))
        self.upto = np.concatenate([[0.0], np.cumsum(shares)])
        self.bounds = self.upto[np.minimum(np.arange(len(parameters["class"]) + 1) * self.width, len(shares))]
        of_classes = np.diff(self.bounds)
        self.log_class = np.log(of_classes).astype(np.float32)
        self.log_word = np.log(shares / of_classes[np.arange(len(shares)) // self.width]).astype(np.float32)
        # Where draws from each of equal cells of a class begin to look; a power of two, for which a cell's begin is exact.
        self.cells = 2 << (self.width - 1).bit_length()
        low, share = self.bounds[:-1, None], of_classes[:, None]
        begins = np.searchsorted(self.upto, low + share * (np.arange(self.cells) / self.cells), side="right") - 1
        self.first = np.minimum(begins, len(shares) - 1).astype(np.int32)
        self.random = np.random.default_rng(seed)
        self.seen = 0

    def _drawn(self, classes: np.ndarray) -> np.ndarray:
        """Noise words for every token, out of the class of its target."""
        low, high = self.bounds[classes][:, None], self.bounds[classes + 1][:, None]
        drawn = self.random.random((len(classes), NOISE_WORDS))
        cell = (drawn * self.cells).astype(np.int32) + classes[:, None] * self.cells
        found, value = self.first.take(cell).ravel(), (low + (high - low) * drawn).ravel()
        late = np.flatnonzero(self.upto.take(found + 1) <= value)
        while len(late):
            found[late] += 1
            late = late[found[late] + 1 < len(self.upto)]
            late = late[self.upto[found[late] + 1] <= value[late]]
        first = classes[:, None] * self.width
        return np.clip(found.reshape(cell.shape), first, np.minimum(first + self.width, len(self.upto) - 1) - 1)

    def step(self, target: np.ndarray, last: np.ndarray, before: np.ndarray) -> None:
        p, n = self.p, len(target)
        self.seen += n
        self.batch = n
        one, two = p["context"].take(last, axis=0), p["context"].take(before, axis=0)
        predicted = _with_one(one * p["place"][0] + two * p["place"][1])
        # The class against noise classes that the batch shares.
        kind = target // self.width
        noise = np.minimum(np.searchsorted(self.bounds[1:], self.random.random(NOISE), side="right"), len(self.log_class) - 1)
        offset = self.log_class + np.float32(np.log(NOISE))
        true, false = p["class"].take(kind, axis=0), p["class"][noise]
        up = _falling(np.einsum("ij,ij->i", predicted, true) - offset[kind])
        down = -_falling(offset[noise] - predicted @ false.T)
        back = up[:, None] * true + down @ false
        by_class = np.concatenate([up[:, None] * predicted, down.T @ predicted]), np.concatenate([kind, noise])
        # The word against noise words of its class.
        words = self._drawn(kind)
        offset = self.log_word + np.float32(np.log(NOISE_WORDS))
        true, false = p["target"].take(target, axis=0), p["target"].take(words, axis=0)
        up = _falling(np.einsum("ij,ij->i", predicted, true) - offset[target])
        down = -_falling(offset[words] - np.einsum("ijk,ik->ij", false, predicted))
        back += up[:, None] * true + np.einsum("ij,ijk->ik", down, false)
        back = back[:, :-1]
        by_context = np.concatenate([back * p["place"][0], back * p["place"][1]]), np.concatenate([last, before])
        by_place = np.stack([np.einsum("ij,ij->j", back, one), np.einsum("ij,ij->j", back, two)])
        for name, (rows, at) in {"class": by_class, "context": by_context}.items():
            at, order, starts = _ranked(at)
            self._change(name, at, *_sums(rows, order, starts))
        self._change("place", np.arange(2), by_place, 1)
        # A change of a word is its prediction times a number; they are multiplied in the order of the words.
        at, order, starts = _ranked(np.concatenate([target, words.ravel()]))
        of_token = np.concatenate([np.arange(n), np.repeat(np.arange(n), NOISE_WORDS)])
        self._change("target", at, *_sums(predicted, of_token.take(order), starts, np.concatenate([up, down.ravel()]).take(order)))

    def _change(self, name: str, at: np.ndarray, change: np.ndarray, numbers: np.ndarray | int) -> None:
        """Step along the sums of the rows of each place, which so many met."""
        change /= np.float32(np.sqrt(self.batch))
        squares = self.squares[name].take(at, axis=0)
        squares += change * change
        self.squares[name][at] = squares
        change *= np.float32(RATE)
        change /= np.sqrt(squares, out=squares)
        change += self.p[name].take(at, axis=0)
        self.p[name][at] = change
        self.met[name][at] += numbers


#: Rows of a table of parameters that travel together.
ROWS = 256
REACHED = "name string, block int, met array<float>, sums array<float>"


def _blocks(trainer: Trainer) -> Iterator[pa.RecordBatch]:
    """What a partition reached, every row times how often it was met; blocks it never met stay at home."""
    for name, value in trainer.p.items():
        for block, low in enumerate(range(0, len(value), ROWS)):
            met = trainer.met[name][low : low + ROWS]
            if met.any():
                sums = (value[low : low + ROWS] * met[:, None].astype(np.float64)).ravel()
                yield _block(name, block, met, sums)


def _block(name: str, block: int, met: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([name]), pa.array([block], pa.int32()), pa.array([met], pa.list_(pa.float32())), pa.array([sums.astype(np.float32)], pa.list_(pa.float32()))]
    return pa.RecordBatch.from_arrays(columns, names=["name", "block", "met", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of equal blocks, added in double precision; a task holds those it was dealt once, whatever their number of copies."""
    held: dict[tuple[str, int], list[np.ndarray]] = {}
    for batch in batches:
        names, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, key in enumerate(zip(names, blocks, strict=True)):
            met, sums = (np.asarray(batch.column(j)[i].values) for j in (2, 3))
            if key in held:
                held[key][0] += met
                held[key][1] += sums
            else:
                held[key] = [met.copy(), sums.astype(np.float64)]
    for (name, block), (met, sums) in held.items():
        yield _block(name, block, met, sums)


def trained(spark: SparkSession, texts: DataFrame, vocabulary: Vocabulary, index, rounds: int = ROUNDS) -> Parameters:
    """Average the parameters that each partition reaches on its own texts, ``rounds`` times.

    A round uses the texts of one hash class, so that all rounds together use
    every text once. The sums are made by Spark, block by block; the driver sees
    one set of parameters, whose size ``HEAD`` bounds. ``index`` is a broadcast
    pair that begins with the numbers of the words.
    """
    shares, vectors = vocabulary.unit_shares(), vocabulary.vectors
    parameters = first_parameters(shares)

    def learn(batches: Iterator[pa.RecordBatch], start) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(start.value, shares, 11)
        common = _commonest(index.value[0], vectors)
        for batch in batches:
            targets, held = [], 0
            for text in [*batch.column(0).cast(pa.binary()).to_pylist(), None]:
                if text is not None:
                    words = _words(text)
                    targets.append(_units(_token_ids(words, common), vectors))
                    held += len(words) + 1
                if targets and (text is None or held > 256 * BATCH):
                    target, last, before = _contexts(targets, len(shares))
                    for low in range(0, len(target), BATCH):
                        trainer.step(target[low : low + BATCH], last[low : low + BATCH], before[low : low + BATCH])
                    targets, held = [], 0
        if trainer.seen:
            yield from _blocks(trainer)

    for number in range(rounds):
        start = spark.sparkContext.broadcast(parameters)
        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == number).select(
            F.coalesce(F.col("text"), F.lit("")).alias("text")
        ).coalesce(TASKS * spark.sparkContext.defaultParallelism)
        reached = part.mapInArrow(lambda batches, start=start: learn(batches, start), REACHED)
        together = reached.repartition("name", "block").mapInArrow(_added, REACHED)
        parameters = {name: value.copy() for name, value in parameters.items()}
        for row in together.toArrow().to_pylist():
            met = np.array(row["met"], dtype=np.float64)
            value = parameters[row["name"]][row["block"] * ROWS :][: len(met)]
            sums = np.array(row["sums"], dtype=np.float64).reshape(value.shape)
            value[met > 0] = sums[met > 0] / met[met > 0, None]
    return parameters


SCORED = T.StructType(
    [
        T.StructField("n_tokens", T.LongType(), False),
        T.StructField("n_head", T.LongType(), False),
        T.StructField("head_log", T.DoubleType(), False),
        T.StructField("class_log", T.DoubleType(), False),
        T.StructField("rest_log", T.DoubleType(), False),
        T.StructField("n_rest", T.LongType(), False),
        T.StructField("tail", T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())]))),
    ]
)


#: Scores of which no exponential overflows and no sum of them vanishes.
SAFE = 80.0


def _log_sums(scores: np.ndarray, largest: float) -> np.ndarray:
    """Logarithms of the rows' sums of exponentials, of scores no further from zero than ``largest``; they are used up."""
    if largest < SAFE:
        np.exp(scores, out=scores)
        return np.log(scores.sum(axis=1))
    top = scores.max(axis=1)
    scores -= top[:, None]
    np.exp(scores, out=scores)
    return top + np.log(scores.sum(axis=1))


def _longest(rows: np.ndarray) -> float:
    return float(np.sqrt(np.einsum("ij,ij->i", rows, rows).max()))


class Normaliser:
    """Logarithms of unit probabilities; a context, and a context with a class, is normalised once a call."""

    def __init__(self, parameters: Parameters, numbers: int = 1 << 17):
        self.p, self.numbers = parameters, numbers
        self.width = class_width(len(parameters["target"]))

    def predicted(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        p = self.p
        return _with_one(p["context"].take(last, axis=0) * p["place"][0] + p["context"].take(before, axis=0) * p["place"][1])

    def _normalisers(self, predicted: np.ndarray, rows: np.ndarray) -> np.ndarray:
        step = max(1, self.numbers // len(rows))
        largest = _longest(predicted) * _longest(rows)
        parts = [_log_sums(predicted[low : low + step] @ rows.T, largest) for low in range(0, len(predicted), step)]
        return np.concatenate(parts)

    def log_probability(self, target: np.ndarray, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        p, units = self.p, len(self.p["context"])
        contexts, context = np.unique(last.astype(np.int64) * units + before, return_inverse=True)
        predicted = self.predicted(contexts // units, contexts % units)
        kind = target // self.width
        of_context = predicted.take(context, axis=0)
        of_class = np.einsum("ij,ij->i", of_context, p["class"].take(kind, axis=0)) - self._normalisers(predicted, p["class"])[context]
        pairs, pair = np.unique(kind.astype(np.int64) * len(contexts) + context, return_inverse=True)
        kinds = pairs // len(contexts)
        total = np.empty(len(pairs), dtype=np.float32)
        bounds = np.append(np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1])), len(kinds))
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            first = int(kinds[low]) * self.width
            total[low:high] = self._normalisers(predicted.take(pairs[low:high] % len(contexts), axis=0), p["target"][first : first + self.width])
        of_word = np.einsum("ij,ij->i", of_context, p["target"].take(target, axis=0)) - total[pair]
        return of_class.astype(np.float64) + of_word


def _scorer(head, start, vectors: int) -> Column:
    """Per text: its tokens, sums of logarithms over what every task knows, and its rare words."""
    held: dict[str, Normaliser] = {}
    common: dict[bytes, int] = {}

    def score(texts: pa.Array) -> pa.Array:
        if "model" not in held:
            held["model"] = Normaliser(start.value)
            common.update(_commonest(head.value[0], vectors))
        index, logs = head.value
        columns: list[list] = [[] for _ in SCORED.names]
        rare, times = [], []
        pending: list[tuple[np.ndarray, int]] = []

        def settle() -> None:
            if not pending:
                return
            target, last, before = _contexts([t for t, _ in pending], len(start.value["target"]))
            found = np.concatenate([[0.0], np.cumsum(held["model"].log_probability(target, last, before))])
            ends = np.cumsum([len(t) + 1 for t, _ in pending])
            columns[3].extend(np.diff(found[np.concatenate([[0], ends])]).tolist())
            pending.clear()

        size = 0
        for text in texts.cast(pa.binary()).to_pylist():
            words = _words(text or b"")
            ids = _token_ids(words, common)
            others = np.flatnonzero(ids < 0)
            ids[others] = _token_ids([words[i] for i in others.tolist()], index)
            known = ids[ids >= 0]
            units = _units(ids, vectors)
            tail = Counter([words[i] for i in np.flatnonzero(ids < 0).tolist()])
            columns[0].append(len(words) + 1)
            columns[1].append(len(known))
            columns[2].append(float(logs[known].sum()))
            columns[4].append(float(logs[known[known >= vectors]].sum()))
            columns[5].append(int((units == REST).sum()))
            rare.extend(tail)
            times.extend(tail.values())
            columns[6].append(len(rare))
            pending.append((units, len(words)))
            size += len(words)
            if size > 500_000:
                settle()
                size = 0
        settle()
        types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
        pairs = pa.StructArray.from_arrays([pa.array(rare, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())], names=["word", "n"])
        tails = pa.ListArray.from_arrays(pa.array([0, *columns.pop()], pa.int32()), pairs)
        return pa.StructArray.from_arrays(
            [*(pa.array(c, kind) for c, kind in zip(columns, types, strict=True)), tails], names=SCORED.names
        )

    return F.arrow_udf(score, SCORED).asNondeterministic()


def scored(spark: SparkSession, docs: DataFrame, vectors: int | None = None, head: int = HEAD) -> DataFrame:
    """One row per row of ``docs`` with the counts, ``base_score`` and ``score`` (log10 of the text's probability).

    Null texts are empty and hold one token, the end. Training texts are those
    whose fold is not ``HELD_OUT``. The probability of a word is that of its
    class after the two words before it times that of the word in its class; words
    without a vector share one and have add-one probabilities inside it. Without a training text the score is
    the base score. Rows that repeat are scored alike and train once each.
    """
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    texts = rows.where(fold(F.col("doc_id")) != HELD_OUT).select("text")
    counts = staged(spark, word_counts(texts), "word-counts")
    vocabulary = Vocabulary(counts, texts.count(), vectors, head)
    index = {w: i for i, w in enumerate(vocabulary.words)}
    known = spark.sparkContext.broadcast((index, np.log10(vocabulary.counts + 1.0)))
    parameters = trained(spark, texts, vocabulary, known)
    model = spark.sparkContext.broadcast(parameters)
    score = _scorer(known, model, vocabulary.vectors)
    first = staged(
        spark,
        rows.select("doc_id", score(F.col("text")).alias("s")).select(F.monotonically_increasing_id().alias("row"), "doc_id", "s.*"),
        "scores",
    )
    # Words that only the table of counts knows, by the number of their row, which is written.
    tail = first.select("row", F.inline("tail")).join(counts, "word", "left")
    seen = tail.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(1.0))).alias("tail_log"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("tail_known"),
    )
    both = first.drop("tail").join(seen, "row", "left")
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    has_end = 1 if vocabulary.n_texts else 0
    whole = float(np.log10(vocabulary.tokens + 1.0 * (vocabulary.distinct + 1)))
    inside = float(np.log10(vocabulary.rest_tokens + vocabulary.rest_distinct + 1.0))
    end_log = float(np.log10(vocabulary.n_texts + 1.0))
    base = F.col("head_log") + tail_log + end_log - F.col("n_tokens") * F.lit(whole)
    model_score = F.col("class_log") / F.lit(float(np.log(10))) + F.col("rest_log") + tail_log - F.col("n_rest") * F.lit(inside)
    return both.select(
        "doc_id",
        (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        "n_tokens",
        (F.col("n_head") + F.coalesce("tail_known", F.lit(0)) + has_end).cast("long").alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (model_score if has_end else base).alias("score"),
    )
