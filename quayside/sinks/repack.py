"""Landing zone to dated gzip folders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside import workspace
from quayside.functions.names import clean_file_name, is_blank_name, plain_path
from quayside.operators.manifest import (
    complete_at_least,
    complete_exactly,
    manifest_report,
    only_required,
)
from quayside.sinks.runlog import mark_run
from quayside.sources.delimited import read_typed_csv
from quayside.sources.landing import list_files


FILES_AT_ONCE = 5
#: Bytes of a landed part that go into one gzip member, which a single task reads back.
MEMBER_BYTES = 128 * 1024 * 1024


class IncompleteDelivery(RuntimeError):
    """Required files are missing, or files arrived that the gate does not allow."""


@dataclass(frozen=True)
class Repacked:
    files: dict[str, int]
    folder: str


def arrivals(spark: SparkSession, landing: str, lower: bool = True) -> DataFrame:
    """``(arrival, file)``: what lies directly below the landing folder, and its clean name.

    A landed file may be a single object or a folder of parts under the file's name.
    """
    root = workspace.qualified(spark, landing)
    below = F.substr(F.col("path"), F.lit(len(root) + 2))
    named = list_files(spark, landing).select(F.split_part(below, F.lit("/"), F.lit(1)).alias("arrival"))
    return named.distinct().withColumn("file", clean_file_name("arrival", lower)).where(
        ~is_blank_name("file")
    )


def landed(spark: SparkSession, landing: str, moved: dict[str, list[str]]) -> dict[str, list]:
    """The files below each file's arrivals, as ``(path, size, modified)``, in path order: one listing of the landing."""
    root = workspace.qualified(spark, landing)
    owner = {arrival: name for name, arrivals_ in moved.items() for arrival in arrivals_}
    found: dict[str, list] = {name: [] for name in moved}
    for row in list_files(spark, landing).orderBy("path").toLocalIterator():
        name = owner.get(row.path[len(root) + 1 :].split("/")[0])
        if name is not None:
            found[name].append(tuple(row))
    return found


def _lines(spark: SparkSession, landing: str, parts: DataFrame) -> DataFrame:
    """Every line of the parts with its path, the start of the split that read it, and its order there.

    The splits depend on the files alone, so every pass over them counts the lines alike.
    """
    paths = [row["path"] for row in parts.collect()]
    path = plain_path("_metadata.file_path")
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(landing).where(path.isin(paths))
    return text.select(
        "value", path.alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )


def _blocks(lines: DataFrame, parts: DataFrame, member_bytes: int, quoted: bool) -> DataFrame:
    """One row a split: its lines, their hash, the member it belongs to, and from which line on.

    A record may hold line breaks between quotes, and must not be torn: the lines that end a record begun in
    an earlier split go into the member of that split.
    """
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    odd = (quotes % 2) if quoted else F.lit(0)
    counted = lines.select("path", "block", "at", odd.alias("odd"), F.xxhash64("value").alias("h"))
    inside = F.lit(0)
    if quoted:
        in_split = Window.partitionBy("path", "block").orderBy("at")
        inside = F.coalesce(F.sum("odd").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    blocks = counted.withColumn("inside", inside).groupBy("path", "block").agg(
        F.count(F.lit(1)).alias("lines"), F.bit_xor("h").alias("h"), (F.sum("odd") % 2).alias("odd"),
        F.min("at").alias("first_even"), F.min(F.when(F.col("inside") == 1, F.col("at"))).alias("first_odd"),
    )
    order = Window.partitionBy("path").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    begun = F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2
    start = F.when(F.col("begun") == 0, F.col("first_even")).otherwise(F.col("first_odd"))
    own = F.col("first_member") + F.floor(F.col("block") / F.lit(member_bytes)).cast("int")
    placed = blocks.join(parts, "path").withColumn("begun", begun).withColumn("start", start).withColumn("own", own)
    carried = F.last(F.when(F.col("start").isNotNull(), F.col("own")), ignorenulls=True).over(earlier)
    return placed.withColumn("carried", F.coalesce(carried, "first_member")).select(
        "path", "block", "lines", "h", "start", "own", "carried", "first_member"
    )


def _member() -> Column:
    return F.when(F.col("at") >= F.col("start"), F.col("own")).otherwise(F.col("carried"))


def copy_lines(
    spark: SparkSession, landing: str, files: Sequence[tuple], out: str, member_bytes: int = MEMBER_BYTES, quoted: bool = True
) -> int:
    """Copy the files' lines to gzip members in byte order; returns how many lines there were.

    Many tasks copy one file: each member holds the records that begin in ``member_bytes`` of a file,
    and starts with the file's first line, its header. ``quoted`` keeps records whole that hold line breaks between quotes.
    Counts and hashes of the copy are compared with those of the source.
    """
    members, rows = 0, []
    for path, size, _ in files:
        rows.append((path, members))
        members += max(1, -(-size // member_bytes))
    parts = spark.createDataFrame(rows, "path string, first_member int")
    lines = _lines(spark, landing, parts)
    folder = workspace.scratch(spark, "blocks")
    # A file that is one member is not cut, wherever its records end.
    _blocks(lines, parts, member_bytes, quoted and members > len(files)).write.parquet(folder)
    blocks = spark.read.parquet(folder)
    dealt = lines.join(blocks, ["path", "block"]).select(_member().alias("member"), "block", "at", "value")
    headers = lines.where("block = 0").groupBy("path").agg(F.min_by("value", "at").alias("value"))
    added = None
    if members > len(files):
        begun = blocks.where("start IS NOT NULL AND own > first_member").select("path", F.col("own").alias("member"))
        added = begun.distinct().join(headers, "path")
    if added is not None:
        added_folder = workspace.scratch(spark, "headers")
        added.write.parquet(added_folder)
        added = spark.read.parquet(added_folder)
        first = added.select("member", F.lit(-1).cast("long").alias("block"), F.lit(-1).cast("long").alias("at"), "value")
        dealt = dealt.unionByName(first)
    ordered = dealt.repartitionById(max(members, 1), F.col("member")).sortWithinPartitions("block", "at")
    ordered.select("value").write.mode("overwrite").option("compression", "gzip").option("lineSep", "\n").text(out)

    told = [F.coalesce(F.sum("lines"), F.lit(0)).alias("n"), F.bit_xor("h").alias("h")]
    source = blocks.agg(*told).first()
    wanted = (source["n"], source["h"] or 0)
    if added is not None:
        more = added.select(F.lit(1).alias("lines"), F.xxhash64("value").alias("h")).agg(*told).first()
        wanted = (wanted[0] + more["n"], wanted[1] ^ (more["h"] or 0))
    copy = spark.read.option("lineSep", "\n").text(workspace.literal(out)).select(F.lit(1).alias("lines"), F.xxhash64("value").alias("h"))
    got = copy.agg(*told).first()
    if (got["n"], got["h"] or 0) != wanted:
        raise OSError(f"{out}: {got['n']} lines of {wanted[0]}, or other ones")
    return source["n"]


def repack(
    spark: SparkSession,
    landing: str,
    destination: str,
    required: Sequence[str],
    day: dt.date,
    source: str,
    log: str,
    exact: bool = True,
    lower: bool = True,
    multi_line: bool = True,
    member_bytes: int = MEMBER_BYTES,
) -> Repacked:
    """Gate a delivery, copy each required file to ``{destination}/{yyyyMMdd}/{file}.gz``
    line by line, record the run, and only then delete what was copied.

    A copy has one gzip part for each landed part, header and all, or one for every ``member_bytes``
    of a larger one; cells are not looked at. Only files that were listed, copied in full and have not changed
    since are deleted; what arrives meanwhile stays, as do files that are not
    required. A rerun after a failure writes the same folders again; nothing is
    deleted before the record exists.
    """
    present = arrivals(spark, landing, lower)
    report = manifest_report(present.select("file"), required)
    verdict = (complete_exactly if exact else complete_at_least)(report).first()
    if not verdict.complete:
        raise IncompleteDelivery(f"{source} on {day:%Y-%m-%d}: {verdict.asDict()}")
    moved: dict[str, list[str]] = {}
    for row in only_required(present, required).orderBy("arrival").collect():
        moved.setdefault(row.file, []).append(row.arrival)
    folder = f"{destination}/{day:%Y%m%d}"
    files = landed(spark, landing, moved)

    def write(name: str) -> int:
        out = f"{folder}/{name}.gz"
        copy_lines(spark, landing, files[name], out, member_bytes, multi_line)
        return read_typed_csv(spark, workspace.literal(out), "first string", mode="PERMISSIVE", multi_line=multi_line).count()

    with ThreadPoolExecutor(max_workers=FILES_AT_ONCE) as pool:
        counts = dict(zip(sorted(moved), pool.map(write, sorted(moved))))
    mark_run(spark, log, source, day, counts)
    now = {entry for entries in landed(spark, landing, moved).values() for entry in entries}
    workspace.delete_all(spark, sorted(entry[0] for entries in files.values() for entry in entries if entry in now))
    return Repacked(counts, folder)
