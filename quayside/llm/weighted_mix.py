"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a budget of words. As many whole epochs of a source as fit
into its budget are taken; the rest is a weighted sample without replacement:
a document's key is an exponential variable divided by its quality weight, and
the documents of smallest key are taken until the budget is full.

The keys of a source are never sorted in one task. Sizes are summed in a fine
grid of key ranges, the grid's running sums show in which range the budget
ends, and only the documents of that range are ordered one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import BLANKS, staged

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix, as a share of all words.
SHARE = 1.5
#: A source gives at most this many times its words.
MOST = 2
SEED = "mix-1"
#: Key ranges of a level; two levels are summed before documents are ordered.
GRID = 4096


def size_of(text: Column) -> Column:
    """Words of a text; none of a null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """From 1 for plain prose down to 0.1 for text full of symbols; 1 for null and empty texts."""
    plain = F.char_length(F.translate(text, "#*$%&|<>" + BLANKS, ""))
    solid = F.char_length(F.translate(text, BLANKS, ""))
    clean = (10 * plain - 9 * solid) / solid
    return F.coalesce(F.when(solid > 0, F.greatest(F.lit(0.1), clean)), F.lit(1.0))


def sampling_key(identity: Column, weight: Column, seed: str = SEED) -> Column:
    """``E / (1 + E)`` of an exponential ``E`` of rate ``weight``: in [0, 1), the same in every run."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), identity).cast("binary")), 1, 12)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**48)
    drawn = -F.ln(uniform) / weight
    return drawn / (1.0 + drawn)


def budgets(sizes: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size, target)`` from one ``(source, source_size)`` row a source.

    The total is shared by weight; a source that would give more than ``most``
    times its size gives just that, and the others share what is left. Sources
    are in code-point order with null last. The sources, not the documents,
    meet in one task here.
    """
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    ranked = sizes.withColumn(
        "weight", F.element_at(weights, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    ).withColumn("total", F.sum("source_size").over(everything))
    # The first sources to be full are those of the smallest size against their weight.
    fullest = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    rest = fullest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (
        share * F.col("total") - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    ) / F.sum("weight").over(rest)
    levelled = ranked.withColumn("level", level).withColumn("full", F.col("weight") * F.col("level") > most * F.col("source_size"))
    # The share of a unit of weight that is left once every full source has given all.
    settled = levelled.withColumn("unit", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
    return settled.select(
        "source", "source_size",
        F.when(F.col("full") | F.col("unit").isNull(), F.col("source_size").cast("double") * most)
        .otherwise(F.least(F.col("weight") * F.col("unit"), F.col("source_size").cast("double") * most))
        .alias("target"),
    )


def mixed(docs: DataFrame, weight: Column | None = None, seed: str = SEED) -> DataFrame:
    """One row per document with its size, its source's size and target, and the words taken of it.

    Null texts have no words, documents without a source form a source of
    their own, and rows that repeat are taken or left one by one in a fixed
    order; equal keys go by id. An empty table has no rows. Whole epochs come
    first, so nothing is taken more than ``MOST`` times.
    """
    text = F.col("text")
    # Rows without an id are told apart by their texts, so that they do not share one key.
    identity = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.coalesce(F.md5(text.cast("binary")), F.lit(""))))
    rows = staged(docs.sparkSession, docs.select(
        F.col("doc_id").alias("doc_id"),
        F.col("source").alias("source"),
        size_of(text).alias("size"),
        sampling_key(identity, weight if weight is not None else quality_weight(text), seed).alias("key"),
    ), "mix-sizes")
    spark = docs.sparkSession
    summed = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Small tables are written out, so that what joins them is planned by their real size: one side
    # is broadcast if it is small, and otherwise both are plain shuffles whose hot sources Spark splits.
    targets = budgets(summed).withColumn(
        "epochs", F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)).cast("long")
    ).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    targets = staged(spark, targets, "mix-targets")
    fine = F.floor(F.col("key") * (GRID * GRID)).cast("long")
    placed = rows.withColumn("coarse", F.floor(fine / GRID).cast("long")).withColumn("fine", fine)

    # Where the budget ends: first among the coarse ranges, then among the fine ones of that range.
    named = targets.select(F.col("source").alias("s"), "budget")
    coarse = _ending(placed.groupBy("source", "coarse").agg(F.sum("size").alias("size")), "coarse", named)
    coarse = staged(spark, coarse, "mix-coarse")
    inside = placed.join(coarse, placed["source"].eqNullSafe(coarse["s"]) & (placed["coarse"] == coarse["at"]), "left_semi")
    fine_sums = inside.groupBy("source", "fine").agg(F.sum("size").alias("size"))
    fine_end = _ending(fine_sums, "fine", coarse.select("s", (F.col("budget") - F.col("before")).alias("budget")))
    ends = targets.join(fine_end.select(F.col("s").alias("s1"), F.col("at"), F.col("before"), F.col("budget").alias("left")), F.col("source").eqNullSafe(F.col("s1")), "left")
    ends = ends.select(F.col("source").alias("s"), "source_size", "target", "epochs", "at", (F.col("left") - F.col("before")).alias("left"))
    ends = staged(spark, ends, "mix-ends")

    whole = placed.join(ends, placed["source"].eqNullSafe(ends["s"]), "left")
    last = F.col("fine") == F.col("at")
    order = Window.partitionBy("source", "fine").orderBy("key", "doc_id", "size")
    middle = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size") / 2
    cut = whole.where(last).withColumn("taken_once", middle <= F.col("left"))
    sure = whole.where(~F.coalesce(last, F.lit(False))).withColumn("taken_once", F.coalesce(F.col("fine") < F.col("at"), F.lit(False)))
    return sure.unionByName(cut).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * (F.col("epochs") + F.col("taken_once").cast("long"))).alias("taken"),
    )


def _ending(sums: DataFrame, grid: str, budgets_: DataFrame) -> DataFrame:
    """``(s, at, before, budget)``: the range of a source's grid in which its budget ends, if it does end."""
    running = F.sum("size").over(Window.partitionBy("source").orderBy(grid))
    told = sums.withColumn("upto", running)
    joined = told.join(budgets_, told["source"].eqNullSafe(budgets_["s"]))
    return (
        joined.where(F.col("upto") > F.col("budget"))
        .groupBy("s")
        .agg(F.min_by(F.struct(F.col(grid).alias("at"), (F.col("upto") - F.col("size")).alias("before"), F.col("budget")), F.col(grid)).alias("x"))
        .select("s", "x.at", "x.before", "x.budget")
    )
