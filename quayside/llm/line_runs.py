"""Line dedup with levelled sorted runs of line hashes.

A run is a bucketed, sorted table of line hashes with the number of documents
that hold the line and the largest of their ids. Each batch of documents is
merge-anti-joined with the runs: lines they do not hold yet go into the run
that the batch adds as new, lines they do hold go in as increments. ``FANOUT``
runs of one level are merged into one run of the next level. Runs are bucketed
as a counted batch lies, so joining a batch with them moves no row of a run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import workspace
from quayside.llm.common import BLANKS, fingerprint, lower_ascii, staged

#: Shortest key in code points, and the documents a line must be found in to be dropped.
SHORTEST = 20
DOCUMENTS = 3
FANOUT = 4
BATCHES = 4


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _long(key: Column) -> Column:
    return F.char_length(key) >= SHORTEST


class LineRuns:
    """The runs of one corpus, below one folder of the shared store."""

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int | None = None):
        self.spark = spark
        #: As many as a shuffle makes, so that a counted batch already lies as the runs do.
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = folder or workspace.scratch(spark, "line-runs")
        self.levels: list[list[str]] = [[]]

    def _write(self, rows: DataFrame, level: int) -> None:
        """Store a run; it counts once it is whole, so a failed attempt leaves nothing behind."""
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.select("h1", "h2", "n_docs", "owner", "fresh")
            .write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
            .option("path", f"{self.folder}/level-{level}/{name}").saveAsTable(name)
        )
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The lines that no run holds: one merge anti-join a run, none of which moves the run."""
        for run in self.runs():
            lines = lines.join(_keys(run).hint("merge"), ["h1", "h2"], "left_anti")
        return lines

    def add(self, held: DataFrame) -> None:
        """Add a batch of ``(h1, h2, owner)`` rows, one for each document that holds a line.

        No document may come in two batches. A key is fresh in exactly one run,
        that of the batch it first came with; later batches add increments.
        """
        counted = held.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("owner").alias("owner"))
        marked = self.unseen(counted).withColumn("fresh", F.lit(True))
        for run in self.runs():
            again = counted.join(_keys(run).hint("merge"), ["h1", "h2"], "left_semi")
            marked = marked.unionByName(again.withColumn("fresh", F.lit(False)))
        self._write(marked, 0)
        level = 0
        while len(self.levels[level]) >= FANOUT:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        names, self.levels[level] = self.levels[level], []
        self._write(merged([self.spark.table(name) for name in names]), level + 1)
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def totals(self) -> DataFrame:
        """Every key with the number of documents that hold it and the largest of their ids."""
        return merged(self.runs())

    def drop(self) -> None:
        """Take the runs out of the catalogue and delete their files."""
        for level in self.levels:
            while level:
                self.spark.sql(f"DROP TABLE IF EXISTS {level.pop()}")
        workspace.delete(self.spark, self.folder)


def _keys(run: DataFrame) -> DataFrame:
    return run.where("fresh").select("h1", "h2")


def merged(runs: list[DataFrame]) -> DataFrame:
    """One row a key. The union of bucketed tables is written plainly first: it does not lie as its parts do."""
    found = runs[0]
    for run in runs[1:]:
        found = found.unionByName(run)
    return staged(found.sparkSession, found, "runs-together").groupBy("h1", "h2").agg(
        F.sum("n_docs").alias("n_docs"), F.max("owner").alias("owner"), F.max("fresh").alias("fresh")
    )


def held_lines(docs: DataFrame) -> DataFrame:
    """``(h1, h2, owner, th, at)``: every long line of every document, by the hash of its text and its place there."""
    lines = docs.select(
        F.col("doc_id").alias("owner"), F.xxhash64("text").alias("th"),
        F.posexplode(F.split(F.col("text"), "\n", -1)).alias("at", "line"),
    ).select("owner", "th", "at", line_key(F.col("line")).alias("key")).where(_long(F.col("key")))
    h1, h2 = fingerprint(F.col("key"))
    return lines.select(h1.alias("h1"), h2.alias("h2"), "owner", "th", "at")


def dropped_lines(spark: SparkSession, docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The places of the lines that a text loses, as ``(owner, th, lost)``."""
    batch = F.pmod(F.xxhash64("owner"), F.lit(batches))
    held = staged(spark, held_lines(docs), "held-lines")
    runs = LineRuns(spark)
    for number in range(batches):
        runs.add(held.where(batch == number).select("h1", "h2", "owner").distinct())
    common = runs.totals().where(F.col("n_docs") >= DOCUMENTS).select("h1", "h2", F.col("owner").alias("holder"))
    common = staged(spark, common, "common-lines")
    runs.drop()
    lost = held.join(common, ["h1", "h2"]).where(~F.col("owner").eqNullSafe(F.col("holder")))
    return lost.groupBy("owner", "th").agg(F.collect_list("at").alias("lost"))


def without_lost(text: Column, lost: Column) -> Column:
    """The lines of a text whose places are not lost, in their order.

    The lost places are taken away as a set, so the time is linear in the lines.
    """
    # The struct holds the lines once: written into the inner lambda, the text would be split for every line.
    lines = F.array(F.struct(F.split(text, "\n", -1).alias("lines"), lost.alias("lost")))

    def staying(both: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(both["lines"]) - 1), both["lost"])
        return F.transform(places, lambda at: F.get(both["lines"], at))

    return F.when(lost.isNull(), F.split(text, "\n", -1)).otherwise(F.transform(lines, staying)[0])


def deduplicated(spark: SparkSession, docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``docs`` with ``__lines`` (before) and ``__kept`` (the lines that stay, null for a null text).

    A line is lost when its key has at least ``SHORTEST`` code points, is found
    in at least ``DOCUMENTS`` documents and the document is not the largest of
    them. Rows of one id are one document, rows without an id together are one
    too and lower than all others. Null texts hold no line.
    """
    lost = dropped_lines(spark, docs, batches)
    mine = docs["doc_id"].eqNullSafe(lost["owner"]) & (F.xxhash64(docs["text"]) == lost["th"])
    return docs.join(lost, mine, "left").select(
        *[docs[c] for c in docs.columns],
        F.size(F.split(F.coalesce(docs["text"], F.lit("")), "\n", -1)).cast("long").alias("__lines"),
        without_lost(docs["text"], lost["lost"]).alias("__kept"),
    )


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document its lines, the dropped ones, and the hash of what stays; a null text is one empty line."""
    kept = F.coalesce(F.col("__kept"), F.array(F.lit("")))
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    return deduplicated(spark, texts).select(
        "doc_id",
        F.col("__lines").alias("n_lines"),
        (F.col("__lines") - F.size(kept)).alias("n_dropped"),
        F.sha2(F.array_join(kept, "\n").cast("binary"), 256).alias("kept_sha256"),
    )


def cleaned_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with the lost lines taken out of their texts; all columns and all rows stay."""
    found = deduplicated(spark, docs)
    return found.select(
        *[
            F.array_join("__kept", "\n").alias("text") if c == "text" else F.col(c)
            for c in docs.columns
        ]
    )
