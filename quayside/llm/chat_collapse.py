"""Chat formatting after collapsing cumulative snapshots.

A logged conversation is often the beginning of a longer log of the same
conversation. Every turn gets a hash of the turns up to it, which is the
exclusive-or of one hash for each position, so that it can be rolled on in
pieces. Conversations whose last hash is an inner hash of another are the
snapshots; an anti-join removes them, and what stays is rendered.

A conversation of any length is spread over tasks: turns are dealt by ranges
of conversation and turn, positions and hashes are rolled inside a range, and
the ranges are put together by their totals. Long conversations are rendered
in parts of ``PART`` turns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import staged

#: Turns in one rendered row.
PART = 256


def _content() -> list:
    """The values two turns must share, with nulls told apart."""
    return [
        F.col("role").isNull(), F.coalesce("role", F.lit("")),
        F.col("text").isNull(), F.coalesce("text", F.lit("")),
    ]


def rolled(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, n, p1, p2, role, text)``: turns in order with their prefix hashes.

    A turn that is logged again with the same values is one turn. Turns that
    share a number go by role, then text; nulls come first. Rows without a
    conversation are one conversation.
    """
    order = ["turn", "role", "text"]
    turns = conversations.select(
        F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"), F.col("role").alias("role"), F.col("text").alias("text")
    ).distinct()
    dealt = turns.repartitionByRange("conv_id", *order).withColumn("range", F.spark_partition_id())
    dealt = staged(spark, dealt, "turns")
    local = Window.partitionBy("range", "conv_id").orderBy(*order)
    placed = staged(spark, dealt.withColumn("at", F.row_number().over(local)), "placed-turns")
    ranges = Window.partitionBy("conv_id").orderBy("range")
    held = placed.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("m")).select(
        F.col("conv_id").alias("c"), F.col("range").alias("r"),
        (F.sum("m").over(ranges) - F.col("m")).alias("before"),
        F.sum("m").over(Window.partitionBy("conv_id")).alias("n"),
    )
    here = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("range") == F.col("r"))
    hashed = placed.join(staged(spark, held, "range-counts"), here).select(
        "conv_id", "range", (F.col("at") + F.col("before")).alias("pos"), "n", "role", "text"
    )
    hashed = staged(
        spark,
        hashed.withColumn("x1", F.xxhash64("pos", *_content())).withColumn("x2", F.xxhash64(F.lit("second"), "pos", *_content())),
        "hashed-turns",
    )
    pieces = hashed.groupBy("conv_id", "range").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")).select(
        F.col("conv_id").alias("c"), F.col("range").alias("r"),
        *[F.coalesce(F.bit_xor(x).over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"b{x}") for x in ("x1", "x2")],
    )
    upto = Window.partitionBy("range", "conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolling = hashed.withColumn("r1", F.bit_xor("x1").over(upto)).withColumn("r2", F.bit_xor("x2").over(upto))
    return rolling.join(staged(spark, pieces, "range-hashes"), here).select(
        "conv_id", "pos", "n",
        F.col("r1").bitwiseXOR(F.col("bx1")).alias("p1"), F.col("r2").bitwiseXOR(F.col("bx2")).alias("p2"),
        "role", "text",
    )


def maximal(turns: DataFrame) -> DataFrame:
    """``(conv_id, n, n_copies)``: conversations that no longer one begins with; of equal ones the least id stays."""
    whole = turns.where("pos = n").groupBy("n", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies")
    )
    inner = turns.where("pos < n").select(F.col("pos").alias("n"), "p1", "p2").distinct()
    return whole.join(inner, ["n", "p1", "p2"], "left_anti").select("conv_id", "n", "n_copies")


def rendered(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """``(conv_id, part, n_turns, n_copies, text)`` of the maximal conversations.

    A null role is rendered as ``unknown`` and a null text as empty. Parts
    count from 0; joined in order they are the conversation.
    """
    turns = staged(spark, rolled(spark, conversations), "rolled-turns")
    stay = staged(spark, maximal(turns), "maximal").select(F.col("conv_id").alias("c"), "n_copies")
    told = F.concat(
        F.lit("<|im_start|>"), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n")
    )
    kept = turns.join(stay, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", F.floor((F.col("pos") - 1) / PART).cast("long").alias("part"), "n", "n_copies", F.struct("pos", told.alias("told")).alias("turn")
    )
    return kept.groupBy("conv_id", "part", "n", "n_copies").agg(F.sort_array(F.collect_list("turn")).alias("turns")).select(
        "conv_id", "part", F.col("n").cast("long").alias("n_turns"), "n_copies", F.array_join("turns.told", "").alias("text")
    )
