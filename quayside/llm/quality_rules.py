"""Decision lists of text statistics, learned by sequential covering.

Rules are grown one after another on labelled documents: each is a conjunction
of thresholds that is extended by the condition of highest information gain
and then pruned on rows it was not grown on. A rule that stays precise is kept,
the rows it covers are set aside, and the search goes on with the rest. The
ordered rules come out as one ``CASE WHEN`` expression, so applying them is a
projection.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import hash_bound

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_top", "n_upper", "n_marks",
)
BASE = COUNTS[:5]
SYMBOLS = b"#*$%&|<>"
MARKS = b"!?=~^_\"'()[]{}@+-/\\:;"

#: At most about this many labelled documents are looked at for learning.
LABELLED = 20_000
#: A rule must be this pure on the rows it covers, and cover so many rejects.
PRECISION = 0.9
SUPPORT = 5
FOLDS = 3


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(ids) < 4:
        return 0
    pairs, width = ids[:-2] * distinct + ids[1:-1], distinct
    if distinct >= 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs * width + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    again = ranked[1:] == ranked[:-1]
    if not again.any():
        return 0
    hit = np.zeros(len(ids), dtype=bool)
    starts = np.concatenate([order[1:][again], order[:-1][again]])
    for step in range(3):
        hit[starts + step] = True
    return int(hit.sum())


def count_text(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``; null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    bytes_ = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    continued = int(bytes_[0x80:0xC0].sum())
    blank = int(bytes_[9:14].sum() + bytes_[32])
    lines = raw.split(b"\n")
    repeats = sum(n - 1 for line, n in Counter(lines).items() if n > 1 and line.split())
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), dtype=np.int64, count=len(words))
    top = int(np.bincount(ids).max()) if len(ids) else 0
    return (
        len(words),
        len(raw) - continued - blank,
        int(sum(bytes_[c] for c in SYMBOLS)),
        repeats,
        repeated_words(ids, max(len(codes), 1)),
        len(lines),
        len(codes),
        top,
        int(bytes_[65:91].sum()),
        int(sum(bytes_[c] for c in MARKS)),
    )


COUNTED = T.StructType([T.StructField(name, T.LongType(), False) for name in COUNTS])


def _counted(texts: pa.Array) -> pa.Array:
    found = np.array([count_text(t) for t in texts.to_pylist()], dtype=np.int64).reshape(-1, len(COUNTS))
    return pa.StructArray.from_arrays([pa.array(found[:, i]) for i in range(len(COUNTS))], names=list(COUNTS))


def counts(text: Column) -> Column:
    """A struct of ``COUNTS`` of every text, whole; taken once a row and never pushed below a filter."""
    return F.arrow_udf(_counted, COUNTED).asNondeterministic()(text)


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def features(c: Column) -> dict[str, Column]:
    """What the rules set thresholds on: shares, so that long and short texts compare."""

    def share(part: str, whole: str) -> Column:
        return c[part].cast("double") / F.greatest(c[whole], F.lit(1)).cast("double")

    return {
        "words": c["n_words"].cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "word_chars"),
        "symbols_a_word": share("n_symbols", "n_words"),
        "mark_share": share("n_marks", "word_chars"),
        "upper_share": share("n_upper", "word_chars"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
        "top_share": share("n_top", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "words_a_line": share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, found: dict[str, Column]) -> Column:
        value = found[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def mask(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        value = x[:, names.index(self.feature)]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    found = np.ones(len(x), dtype=bool)
    for condition in rule:
        found &= condition.mask(x, names)
    return found


def _grow(x: np.ndarray, reject: np.ndarray, names: list[str], longest: int, cuts: int) -> Rule:
    """Add the condition of highest gain until no kept row is covered or nothing gains."""
    rule: list[Condition] = []
    while len(rule) < longest and reject.any() and not reject.all():
        p0, n0 = reject.sum(), (~reject).sum()
        before, best, chosen = np.log2(p0 / (p0 + n0)), 1e-9, None
        for i, name in enumerate(names):
            seen = np.unique(np.quantile(x[:, i], np.linspace(0, 1, cuts + 1)))
            points = (seen[:-1] + seen[1:]) / 2  # half-way, so that rows near a class stay with it
            if not len(points):
                continue
            bins = np.searchsorted(points, x[:, i], side="left")
            p = np.cumsum(np.bincount(bins[reject], minlength=len(points) + 1))[: len(points)]
            n = np.cumsum(np.bincount(bins[~reject], minlength=len(points) + 1))[: len(points)]
            for above in (False, True):
                pos, neg = (p0 - p, n0 - n) if above else (p, n)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pos > 0, pos * (np.log2(pos / (pos + neg)) - before), 0.0)
                at = int(np.argmax(gain))
                if gain[at] > best:
                    best, chosen = gain[at], Condition(name, above, float(points[at]))
        if chosen is None:
            break
        rule.append(chosen)
        inside = chosen.mask(x, names)
        x, reject = x[inside], reject[inside]
    return tuple(rule)


def _pruned(rule: Rule, x: np.ndarray, reject: np.ndarray, names: list[str]) -> Rule:
    """The beginning of the rule that separates the held-out rows best; the shortest of equals."""

    def worth(part: Rule) -> float:
        inside = _covers(part, x, names)
        p, n = (inside & reject).sum(), (inside & ~reject).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=worth)


def learn(
    x: np.ndarray, reject: np.ndarray, fold: np.ndarray, names: list[str],
    most: int = 16, longest: int = 4, cuts: int = 64,
) -> list[Rule]:
    """Ordered rejecting rules; none when a class is missing. Fold 0 prunes, the other folds grow."""
    rules: list[Rule] = []
    while len(rules) < most and reject.any():
        grown = fold != 0
        rule = _grow(x[grown], reject[grown], names, longest, cuts)
        if not rule:
            break
        rule = _pruned(rule, x[~grown], reject[~grown], names)
        inside = _covers(rule, x, names)
        caught = int((inside & reject).sum())
        if caught < SUPPORT or caught < PRECISION * inside.sum():
            break
        rules.append(rule)
        x, reject, fold = x[~inside], reject[~inside], fold[~inside]
    return rules


def labelled_sample(labels: DataFrame, label: str, most: int = LABELLED) -> DataFrame:
    """About ``most`` labelled ids as ``(doc_id, label)``, chosen by a hash of the id.

    Null ids and null labels are left out. An id that is labelled more than
    once counts once, with the label of most of its rows; a tie leaves it out.
    """
    found = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col("doc_id").alias("doc_id"))
        .agg(F.avg(F.col(label).cast("double")).alias("mean"))
        .where("mean <> 0.5")
        .select("doc_id", (F.col("mean") > 0.5).cast("int").alias("label"))
    )
    total = found.count()
    return found.where(F.xxhash64("doc_id") <= F.lit(hash_bound(most, total)))


def learn_from(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> list[Rule]:
    """Rules learned from the labelled documents; what is collected is bounded by ``most`` rows.

    A document that is absent from ``docs`` teaches nothing, and an id teaches
    once: of the rows of one id that with the smallest hash of its text is taken.
    """
    sample = labelled_sample(labels, "quality", most)
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    held = texts.join(F.broadcast(sample), "doc_id").select(
        "doc_id", "label", F.xxhash64("text").alias("th"), counts(F.col("text")).alias("c")
    )
    rows = held.groupBy("doc_id", "label").agg(F.min_by("c", F.struct("th", "c")).alias("c"))
    found = features(F.col("c"))
    taught = rows.where(~base_failed(F.col("c"))).select(
        "label", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold"),
        *[value.alias(name) for name, value in found.items()],
    ).toPandas().sort_values(["fold", "label", *found], kind="stable")
    names = list(found)
    return learn(taught[names].to_numpy(float), taught["label"].to_numpy() == 0, taught["fold"].to_numpy(), names)


def verdict(c: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """``kept`` and the number of the rule that rejected (0 the base, null none), as ordered conditions."""
    found = features(c)
    kept, fired = F.when(base_failed(c), False), F.when(base_failed(c), 0)
    for number, rule in enumerate(rules, 1):
        test = F.lit(True)
        for condition in rule:
            test = test & condition.column(found)
        kept, fired = kept.when(test, False), fired.when(test, number)
    return kept.otherwise(True), fired


def describe(rules: list[Rule]) -> list[str]:
    return [" AND ".join(map(str, rule)) for rule in rules]


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per document: its counts, ``base_failed``, ``kept`` and ``rule``.

    Null and empty texts have no words, so the base rejects them. Repeated
    rows are judged one by one; other columns are not looked at.
    """
    c = F.col("counted")
    kept, fired = verdict(c, rules)
    return docs.select(F.col("doc_id").alias("doc_id"), counts(F.col("text")).alias("counted")).select(
        "doc_id", *[c[name].alias(name) for name in COUNTS],
        base_failed(c).alias("base_failed"), kept.alias("kept"), fired.alias("rule"),
    )


def kept_documents(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The documents the rules keep, with all their columns."""
    marked = docs.withColumn("__quality_counts", counts(F.col("text")))
    return marked.where(verdict(F.col("__quality_counts"), rules)[0]).select(*[docs[c] for c in docs.columns])
