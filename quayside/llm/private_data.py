"""Personal data by bootstrapped contexts.

Base patterns find emails, addresses, cards and phones. They are the seeds: the
words around them are lexical patterns. Spark builds the graph of patterns and
of the things found in them - seeds, and tokens and runs of tokens that look
like identifiers but that no base pattern takes - and scores both in turn: a
pattern by the share of its things that are of a kind, a thing by its patterns.
What scores high supports further patterns. In the end, things in patterns of
high confidence are personal data of the pattern's kind too.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
#: Fixed forms of the base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")
_EDGES = ".,;:!?\"'()[]<>"

#: A token or a run of tokens is looked at as an identifier from this length on, with this many digits or an at sign:
#: every kind told here is written with one or the other.
TOKEN_CHARS, TOKEN_DIGITS = 6, 4
#: Rounds end once no confidence moves by more than this.
STEP = 0.001
#: A pattern is trusted from so many different seeds and confident instances on, and at this confidence.
SUPPORT, CONFIDENCE = 5, 0.8


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if at % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches that do not overlap, found from the at signs: the time is linear in the text."""
    found, after = [], 0
    at = text.find("@")
    while at >= 0:
        low = at
        while low > after and text[low - 1].isascii() and (text[low - 1].isalnum() or text[low - 1] in "._%+-"):
            low -= 1
        domain = _DOMAIN.match(text, at + 1) if low < at else None
        if domain:
            found.append((low, domain.end()))
            after = domain.end()
        at = text.find("@", max(at + 1, after))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in code points, kind after kind; a match that fails its test is dropped."""
    found = [(0, *span) for span in emails(text)]
    if _DIGIT.search(text) is None:
        return found
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            for m in _IP.finditer(text, run.start(), run.end()):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((3, *m.span()))
    return found


def _plain(word: str) -> str:
    return _DIGIT.sub("", word).lower().strip(_EDGES)


def contexts(words: list[tuple[int, int, str]], first: int, last: int) -> list[str]:
    """The patterns around the words from ``first`` to ``last``: the words before, after, and on both sides."""

    def at(i: int) -> str:
        return _plain(words[i][2]) if 0 <= i < len(words) else "^" if i < 0 else "$"

    return [
        f"{at(first - 2)} {at(first - 1)} _", f"{at(first - 1)} _ {at(last + 1)}", f"_ {at(last + 1)} {at(last + 2)}",
    ]


def digit_runs(text: str, words: list[tuple[int, int, str]], taken: set[int]) -> list[tuple[int, int]]:
    """First and last words of the runs of two or more words with digits, and of their parts.

    A part ends with its line or with a punctuation mark, so that numbers in a
    list or a table are told apart; of every word there are one run and one part.
    """
    found: set[tuple[int, int]] = set()
    run = part = None
    for i, (_, end, word) in enumerate(words):
        if i in taken or _DIGIT.search(word) is None:
            run = part = None
            continue
        run, part = i if run is None else run, i if part is None else part
        after = words[i + 1] if i + 1 < len(words) and i + 1 not in taken else None
        last = after is None or _DIGIT.search(after[2]) is None
        if last or word[-1] in ".,;:!?" or "\n" in text[end : after[0]]:
            found.add((part, i))
            part = None
        if last:
            found.add((run, i))
    return sorted(pair for pair in found if pair[0] < pair[1])


def looked_at(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple]]:
    """The base spans of a text, and ``(kind or None, start, end, instance, patterns)`` of seeds, other tokens and runs of them."""
    text = text or ""
    base = base_spans(text)
    if not base and _DIGIT.search(text) is None and "@" not in text:
        return base, []
    words = [(m.start(), m.end(), m[0]) for m in _WORD.finditer(text)]
    starts = [w[0] for w in words]
    found, taken = [], set()
    for kind, start, end in base:
        first, last = bisect_right(starts, start) - 1, bisect_right(starts, end - 1) - 1
        taken.update(range(first, last + 1))
        found.append((kind, start, end, text[start:end].lower(), contexts(words, first, last)))
    for i, (start, end, word) in enumerate(words):
        if i in taken:
            continue
        bare = word.strip(_EDGES)
        if len(bare) < TOKEN_CHARS or ("@" not in bare and len(_DIGIT.findall(bare)) < TOKEN_DIGITS):
            continue
        low = start + word.index(bare)
        found.append((None, low, low + len(bare), bare.lower(), contexts(words, i, i)))
    for first, last in digit_runs(text, words, taken):
        whole = text[words[first][0] : words[last][1]]
        low = words[first][0] + len(whole) - len(whole.lstrip(_EDGES))
        high = low + len(whole.strip(_EDGES))
        if text.count(")", low, high) > text.count("(", low, high) and low > 0 and text[low - 1] == "(":
            low -= 1
        if high - low >= TOKEN_CHARS and len(_DIGIT.findall(text, low, high)) >= TOKEN_DIGITS:
            instance = " ".join(_WORD.findall(text, low, high)).lower()
            found.append((None, low, high, instance, contexts(words, first, last)))
    return base, found


SEEN = T.StructType([
    T.StructField("base", T.ArrayType(T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    ]))),
    T.StructField("things", T.ArrayType(T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("instance", T.StringType()), T.StructField("patterns", T.ArrayType(T.StringType())),
    ]))),
])


def _seen(texts: pa.Array) -> pa.Array:
    span = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
    thing = pa.struct([*span, ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])
    base, things = [], []
    for text in texts.to_pylist():
        spans, found = looked_at(text)
        base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in sorted(spans)])
        things.append([dict(zip(("kind", "start", "end", "instance", "patterns"), x, strict=True)) for x in found])
    return pa.StructArray.from_arrays([pa.array(base, pa.list_(span)), pa.array(things, pa.list_(thing))], names=SEEN.names)


def trusted_patterns(spark: SparkSession, things: DataFrame, step: float = STEP) -> DataFrame:
    """``(pattern, kind, confidence)`` of the patterns that may discover, from ``things`` of all documents.

    The graph has one edge for every pattern and different instance. A seed
    scores 1 for its kind; another instance scores by the patterns it is in:
    one minus the product of their doubts. A pattern's confidence in a kind is
    the sum of its instances' scores over their number, plus one. Every round
    counts anew which patterns are supported: by seeds, and by what scores as
    high as a trusted pattern. Confidences only rise from round to round, as do
    the scores and the support that follow from them; rounds go on until none
    rises by more than ``step``.
    """
    edges = staged(
        spark,
        things.select("kind", "instance", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "instance").agg(F.max("kind").alias("seed")),
        "pattern-edges",
    )
    # Support never exceeds the number of instances, so that smaller patterns need no scores.
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SUPPORT)
    near = staged(spark, edges.join(sizes, "pattern"), "near-edges")
    seeds = near.where("seed is not null").select("pattern", "n", F.col("seed").alias("kind"), F.lit(1.0).alias("score"))
    others = near.where("seed is null")
    scores = before = None
    while True:
        given = seeds
        if scores is not None:
            given = seeds.unionByName(others.join(scores, "instance").select("pattern", "n", "kind", "score"))
        summed = given.groupBy("pattern", "n", "kind").agg(
            F.sum("score").alias("score"), F.count_if(F.col("score") >= CONFIDENCE).alias("support")
        ).withColumn("most", F.max("support").over(Window.partitionBy("pattern")))
        confident = summed.where(F.col("most") >= SUPPORT).select(
            "pattern", "kind", "support", (F.col("score") / (F.col("n") + 1)).alias("confidence")
        )
        confident = staged(spark, confident, "pattern-scores")
        rise = F.col("confidence")
        moved = confident
        if before is not None:
            moved = confident.join(before, ["pattern", "kind"], "left")
            rise = rise - F.coalesce("earlier", F.lit(0.0))
        most = moved.agg(F.max(rise).alias("most")).first()["most"]
        if most is None or most <= step:
            break
        before = confident.select("pattern", "kind", F.col("confidence").alias("earlier"))
        doubts = others.join(confident, "pattern").groupBy("instance", "kind").agg(
            (1 - F.exp(F.sum(F.ln(1 - F.least("confidence", F.lit(0.999)))))).alias("score")
        )
        scores = staged(spark, doubts, "instance-scores")
    return confident.where((F.col("support") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE)).select(
        "pattern", "kind", "confidence"
    )


def spans(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``(doc_id, th, base, all)``: arrays of ``(kind, start, end)`` of every row of ``docs``, in order.

    Spans count code points. Null texts are empty. Rows that repeat have the
    same spans, and teach as one document does: the graph has each edge once.
    A discovered token or run has the kind of the most confident pattern it is
    in, the first kind of equals; inside a discovered run no part is told again.
    Base spans always stay.
    """
    see = F.arrow_udf(_seen, SEEN).asNondeterministic()
    seen = staged(
        spark,
        docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
        .select("doc_id", F.xxhash64("text").alias("th"), see(F.col("text")).alias("s"))
        .select("doc_id", "th", "s.base", "s.things"),
        "seen",
    )
    things = seen.where(F.size("things") > 0).select("doc_id", "th", F.inline("things"))
    trusted = staged(spark, trusted_patterns(spark, things), "trusted-patterns")
    tokens = things.where("kind is null").select("doc_id", "th", "start", "end", F.explode("patterns").alias("pattern")).distinct()
    best = tokens.join(trusted, "pattern").groupBy("doc_id", "th", "start", "end").agg(
        F.max(F.struct("confidence", (-F.col("kind")).alias("k"))).alias("best")
    )
    outer = F.max("end").over(
        Window.partitionBy("doc_id", "th").orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    best = best.withColumn("upto", outer).where(F.col("upto").isNull() | (F.col("upto") < F.col("end")))
    new = best.select("doc_id", "th", F.struct((-F.col("best.k")).alias("kind"), "start", "end").alias("span"))
    new = new.groupBy("doc_id", "th").agg(F.collect_list("span").alias("new"))
    new = new.select(F.col("doc_id").alias("d"), F.col("th").alias("h"), "new")
    joined = seen.select("doc_id", "th", "base").join(
        new, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("th").eqNullSafe(F.col("h")), "left"
    )
    everything = F.when(F.col("new").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "new")))
    return joined.select("doc_id", "th", "base", everything.alias("all"))


def _told(spans_: str) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(spans_, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` the number of base spans of each kind, their hash, and all spans as text; see ``spans``."""
    found = spans(spark, docs)

    def n(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[n(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(_told("base").cast("binary"), 256).alias("base_sha256"), _told("all").alias("spans"),
    )
