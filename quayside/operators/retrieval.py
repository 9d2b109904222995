"""Keyword retrieval over document tables: term index, BM25 ranking, prompts."""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import workspace
from quayside.functions.names import plain_path
from quayside.functions.text import col, fill_template

# What separates tokens, and the usual BM25 parameters.
SEPARATOR = r"[^\p{L}\p{N}]+"
K1 = 1.2
B = 0.75

# Fixed value: the sentence to answer with when the context does not help.
NO_ANSWER = "Sorry, I don't know the answer"
PROMPT = (
    "Answer the question from the context alone.\n\n"
    "Context:\n{context}\n\n"
    f'If the context does not hold the answer, reply with "{NO_ANSWER}".\n\n'
    "Question: {question}\n\nAnswer:"
)

# Scores are added up in units of one hundred-millionth.
UNITS = 100_000_000
#: Characters of text whose postings are one folder of a segment: a search reads the folders of its terms. Up to so
#: many folders the first number holds, so that a segment is sorted by as many tasks; beyond them the second.
SMALL_CHARS, FEW_PARTS, PART_CHARS = 1_000_000, 64, 64_000_000
#: Segments of like size that are merged into one.
FANOUT = 8
#: Pairs of question and document whose scores a task adds up, which bounds its memory.
PAIRS = 500_000


def tokens(text: Column | str) -> Column:
    """Lower-cased runs of letters and digits, in order, repeats kept."""
    return F.array_remove(F.split(F.lower(col(text)), SEPARATOR), "")


def term_index(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings ``(term, doc_id, tf, doc_len)`` over whole texts.

    A document's words are sorted inside its row, and each run of equal words
    becomes one posting whose length is the count. Nothing is shuffled.
    """
    sorted_words = documents.select(doc_id, text).select(
        F.col(doc_id).alias("doc_id"), F.sort_array(tokens(text)).alias("words")
    )
    last = F.size("words") - 1
    ends = F.filter(
        F.sequence(F.lit(0), last),
        lambda at: F.coalesce(F.get("words", at + 1) != F.get("words", at), F.lit(True)),
    )
    # Not a filter: it would be pushed below the exchange and split every text twice.
    ends = F.when(last >= 0, ends)
    runs = sorted_words.select("doc_id", "words", ends.alias("ends"))
    postings = F.transform(
        "ends",
        lambda end, n: F.struct(
            F.get("words", end).alias("term"),
            (end - F.coalesce(F.get("ends", n - 1), F.lit(-1))).alias("tf"),
        ),
    )
    found = runs.select("doc_id", F.size("words").alias("doc_len"), F.explode(postings).alias("p"))
    return found.select("p.term", "doc_id", F.col("p.tf").cast("bigint").alias("tf"), "doc_len")


def term_stats(index: DataFrame) -> DataFrame:
    """Documents and occurrences per term."""
    return index.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("occurrences")
    )


@dataclass(frozen=True)
class Segment:
    """A part of the documents with postings of its own, in ``parts`` folders of terms."""

    path: str
    documents: int
    words: int
    parts: int

    @property
    def name(self) -> str:
        return self.path.rsplit("=", 1)[1]


@dataclass(frozen=True)
class Index:
    """The live segments, the documents of each term, the totals, and which documents of a segment are deleted."""

    segments: list[Segment]
    terms: DataFrame
    documents: int
    average_length: float
    deleted: DataFrame | None


def _part(parts: int) -> Column:
    """The folder that holds a term's postings."""
    return F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int")


def _write_postings(postings: DataFrame, path: str, parts: int) -> DataFrame:
    """Postings by folder, sorted, and the counts of their terms. The rebalance splits a folder whose term most documents hold."""
    dealt = postings.withColumn("part", _part(parts)).hint("rebalance", "part")
    dealt.sortWithinPartitions("part", "term", "doc_id").write.partitionBy("part").parquet(f"{path}/postings")
    spark = postings.sparkSession
    schema = T.StructType([*postings.schema.fields, T.StructField("part", T.IntegerType())])
    # A segment without a posting has no folder to read.
    written = spark.read.schema(schema).parquet(f"{path}/postings")
    term_stats(written).write.parquet(f"{path}/terms")
    return written


def _finish(spark: SparkSession, path: str, documents: int, parts: int, replaced: list[str]) -> None:
    """Write a segment's totals, which come last: it counts from then on, and what it replaces no longer does."""
    words = spark.read.parquet(f"{path}/terms").agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("words"))
    told = {"documents": F.lit(documents).cast("bigint"), "parts": F.lit(parts), "replaced": F.lit(replaced).cast("array<string>")}
    words.withColumns(told).write.parquet(f"{path}/totals")


def _new(path: str, kind: str) -> str:
    return f"{path}/{kind}={time.time_ns():020d}"


def write_index(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Index all documents anew: one segment."""
    if workspace.exists(documents.sparkSession, path):
        workspace.delete(documents.sparkSession, path)
    add_documents(documents, path, doc_id, text)


def add_documents(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Index further documents as a segment of their own; the segments that are there stay as they are.

    Texts are split once, and postings move once, to their folder. How many folders there are follows
    the length of the texts. One writer at a time.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    told = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.char_length("text")), F.lit(0)).alias("chars")).first()
    segment = _new(path, "segment")
    parts = min(told["chars"] // SMALL_CHARS + 1, FEW_PARTS + told["chars"] // PART_CHARS)
    _write_postings(term_index(rows), segment, parts)
    rows.select("doc_id").write.parquet(f"{segment}/documents")
    _finish(spark, segment, told["n"], parts, [])


def segments(spark: SparkSession, path: str) -> list[Segment]:
    """The segments that count, oldest first."""
    done = [found.rsplit("/", 2)[0] for found in workspace.glob(spark, f"{path}/segment=*/totals/_SUCCESS")]
    if not done:
        return []
    totals = spark.read.parquet(*[f"{found}/totals" for found in done]).select(
        F.regexp_extract(plain_path("_metadata.file_path"), "/segment=([0-9]+)/", 1).alias("name"), "*"
    )
    told = {row["name"]: row for row in totals.collect()}
    replaced = {name for row in told.values() for name in row["replaced"]}
    live = [found for found in done if found.rsplit("=", 1)[1] not in replaced]
    return [Segment(at, *[told[at.rsplit("=", 1)[1]][name] for name in ("documents", "words", "parts")]) for at in live]


def _all(frames: list[DataFrame]) -> DataFrame:
    found = frames[0]
    for frame in frames[1:]:
        found = found.unionByName(frame)
    return found


def _deletions(spark: SparkSession, path: str, live: list[Segment], what: str) -> DataFrame | None:
    """``ids`` or ``terms`` of all deletions in live segments."""
    done = [found.rsplit("/", 2)[0] for found in workspace.glob(spark, f"{path}/deleted=*/terms/_SUCCESS")]
    if not done:
        return None
    found = spark.read.parquet(*[f"{at}/{what}" for at in done])
    return found.where(F.col("segment").isin([segment.name for segment in live]))


def open_index(spark: SparkSession, path: str) -> Index:
    """Read a written index: its counts are those of its segments, less the deleted documents."""
    live = segments(spark, path)
    if not live:
        raise FileNotFoundError(f"no index below {path}")
    terms = _all([spark.read.parquet(f"{segment.path}/terms") for segment in live])
    documents, words = (sum(getattr(segment, name) for segment in live) for name in ("documents", "words"))
    gone = _deletions(spark, path, live, "terms")
    deleted = None
    if gone is not None:
        less = gone.select("term", (-F.col("df")).alias("df"), (-F.col("occurrences")).alias("occurrences"))
        terms = terms.unionByName(less)
        deleted = _deletions(spark, path, live, "ids")
        words -= gone.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("n")).first()["n"]
        documents -= deleted.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"]
    if gone is not None or len(live) > 1:
        terms = terms.groupBy("term").agg(F.sum("df").alias("df"), F.sum("occurrences").alias("occurrences")).where("df > 0")
    return Index(live, terms, documents, words / documents if documents else 0.0, deleted)


def _live_postings(spark: SparkSession, index: Index, parts: dict[int, list[int]] | None = None) -> DataFrame:
    """``(term, doc_id, tf, doc_len)`` of documents that are not deleted, of some folders by how many a segment has."""
    frames = []
    for segment in index.segments:
        held = spark.read.parquet(f"{segment.path}/postings") if segment.words else None
        if held is not None:
            held = held if parts is None else held.where(F.col("part").isin(parts[segment.parts]))
            frames.append(held.drop("part").withColumn("segment", F.lit(segment.name)))
    if not frames:
        return index.terms.select("term", F.lit(None).alias("doc_id"), F.lit(0).cast("bigint").alias("tf"), F.lit(0).alias("doc_len"))
    found = _all(frames)
    if index.deleted is not None:
        gone = index.deleted.select(F.col("segment").alias("in"), F.col("doc_id").alias("gone"))
        found = found.join(gone, (F.col("segment") == F.col("in")) & F.col("doc_id").eqNullSafe(F.col("gone")), "left_anti")
    return found.drop("segment")


def delete_documents(ids: DataFrame, path: str, doc_id: str = "doc_id") -> None:
    """Take documents out of the index: a list of them by segment, and the counts they are to be less by.

    No posting is written; they go when their segment is merged. Ids that the index does not hold change
    nothing, and a document that is added again afterwards is found again. One writer at a time.
    """
    spark = ids.sparkSession
    index = open_index(spark, path)
    held = _all([
        spark.read.parquet(f"{segment.path}/documents").withColumn("segment", F.lit(segment.name)) for segment in index.segments
    ])
    wanted = ids.select(F.col(doc_id).alias("wanted")).distinct()
    found = held.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    if index.deleted is not None:
        gone = index.deleted.select(F.col("segment").alias("in"), F.col("doc_id").alias("gone"))
        found = found.join(gone, (F.col("segment") == F.col("in")) & F.col("doc_id").eqNullSafe(F.col("gone")), "left_anti")
    at = _new(path, "deleted")
    found.groupBy("segment", "doc_id").agg(F.count(F.lit(1)).alias("copies")).write.parquet(f"{at}/ids")
    listed = spark.read.parquet(f"{at}/ids").select(F.col("segment").alias("in"), F.col("doc_id").alias("gone"))
    counts = []
    for segment in index.segments:
        if segment.words:
            postings = spark.read.parquet(f"{segment.path}/postings").withColumn("segment", F.lit(segment.name))
            mine = listed.where(F.col("in") == segment.name)
            less = postings.join(mine, F.col("doc_id").eqNullSafe(F.col("gone")), "left_semi")
            counts.append(less.groupBy("segment", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("occurrences")))
    none = spark.createDataFrame([], "segment string, term string, df bigint, occurrences bigint")
    _all([none, *counts]).write.parquet(f"{at}/terms")


def merge_segments(spark: SparkSession, path: str, fanout: int = FANOUT) -> bool:
    """Merge segments of like size once ``fanout`` of them are there; whether any were.

    Sizes are alike that have the same logarithm, so a document is written anew once for each power of ``fanout`` that the
    index has grown by. Deleted documents are left out for good. The segments that were merged count until the new one
    does, and are then deleted.
    """
    index = open_index(spark, path)
    levels: dict[int, list[Segment]] = {}
    for segment in index.segments:
        levels.setdefault(int(math.log(max(segment.documents, 1), fanout)), []).append(segment)
    full = [found for _, found in sorted(levels.items()) if len(found) >= fanout]
    if not full:
        return False
    chosen = full[0]
    part = Index(chosen, index.terms, 0, 0.0, index.deleted)
    at, parts = _new(path, "segment"), max(sum(segment.parts for segment in chosen) - len(chosen), 0) + 1
    _write_postings(_live_postings(spark, part), at, parts)
    held = _all([
        spark.read.parquet(f"{segment.path}/documents").withColumn("segment", F.lit(segment.name)) for segment in chosen
    ])
    if index.deleted is not None:
        gone = index.deleted.select(F.col("segment").alias("in"), F.col("doc_id").alias("gone"))
        held = held.join(gone, (F.col("segment") == F.col("in")) & F.col("doc_id").eqNullSafe(F.col("gone")), "left_anti")
    held.select("doc_id").write.parquet(f"{at}/documents")
    documents = spark.read.parquet(f"{at}/documents").count()
    _finish(spark, at, documents, parts, [segment.name for segment in chosen])
    for segment in chosen:
        workspace.delete(spark, segment.path)
    return True


def retrieve(
    index: Index, questions: DataFrame, k: int, query_id: str = "query_id", question: str = "question"
) -> DataFrame:
    """The ``k`` best documents of each question: ``(query_id, rank, doc_id, score)``.

    The question terms are weighed by the stored counts and written; only folders that
    hold one of them are read. Their size is known then: while Spark may broadcast them, the postings of question terms move
    once, to the task that owns their document, and scores are added up in place. How many tasks there are follows the
    pairs of question and document that the counts allow, so that none holds more as the documents grow. A
    question's candidates are cut to ``k`` in every task before they meet
    (WindowGroupLimit). Beyond that size both sides meet by term, where adaptive
    execution splits a common term.

    Contributions are added as whole numbers, so the sum does not depend on the
    order of rows, and equal scores rank by document.
    """
    spark = questions.sparkSession
    wanted = (
        questions.select(F.col(query_id).alias("query_id"), F.explode(tokens(question)).alias("term"))
        .distinct()
    )
    rarity = F.log(1 + (F.lit(index.documents) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    path = workspace.scratch(spark, "asked-terms")
    wanted.join(index.terms, "term").select("query_id", "term", "df", rarity.alias("idf")).write.parquet(path)
    weights = spark.read.parquet(path)
    told = weights.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("met"), F.countDistinct(F.struct("query_id")).alias("asked")).first()
    pairs = min(told["met"], told["asked"] * index.documents)
    tasks = max(-(-pairs // PAIRS), spark.sparkContext.defaultParallelism)
    weights = weights.drop("df")
    parts = {
        n: [row.part for row in weights.select(_part(n).alias("part")).distinct().collect()]
        for n in {segment.parts for segment in index.segments}
    }
    held = _live_postings(spark, index, parts)
    asked = held.join(weights.select("term").distinct(), "term", "left_semi")
    met = asked.repartition(tasks, "doc_id").join(weights, "term")
    length = F.col("doc_len") / F.lit(max(index.average_length, 1e-9))
    saturation = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * length))
    contribution = F.floor(F.col("idf") * saturation * UNITS + 0.5)
    scores = met.groupBy("query_id", "doc_id").agg(F.sum(contribution).alias("total"))
    order = Window.partitionBy("query_id").orderBy(F.col("total").desc(), F.col("doc_id"))
    four_digits = F.floor((F.col("total") + UNITS // 20_000) / (UNITS // 10_000)) / F.lit(10_000.0)
    return (
        scores.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "doc_id", four_digits.alias("score"))
    )


def assemble_prompts(
    ranked: DataFrame,
    documents: DataFrame,
    questions: DataFrame,
    template: str = PROMPT,
    doc_id: str = "doc_id",
    text: str = "text",
    query_id: str = "query_id",
    question: str = "question",
) -> DataFrame:
    """One prompt per question with its retrieved texts, best first, as context.

    A group holds the ``k`` ranked documents of a question and no more. A question
    without a hit keeps an empty context. The ranking is written first: it is
    computed once, and its size is then known, so Spark can send it to the documents
    instead of shuffling their texts.
    """
    spark = ranked.sparkSession
    path = workspace.scratch(spark, "ranking")
    ranked.write.parquet(path)
    ranked = spark.read.parquet(path)
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = ranked.join(texts, "doc_id").groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "doc_id", "text"))).alias("hits")
    )
    asked = questions.select(F.col(query_id).alias("query_id"), F.col(question).alias("question"))
    context = F.array_join(F.transform("hits", lambda h: F.coalesce(h["text"], F.lit(""))), "\n\n")
    return asked.join(found, "query_id", "left").select(
        "query_id",
        fill_template(template, {"context": context, "question": F.col("question")}).alias("prompt"),
        F.coalesce(
            F.transform("hits", lambda h: h["doc_id"]), F.array().cast(T.ArrayType(ranked.schema["doc_id"].dataType))
        ).alias("source_documents"),
    )
