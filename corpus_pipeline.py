"""From raw documents to a training mix: every stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import chosen_path, line_runs, quality_rules, weighted_mix, wu_manber
from quayside.llm.common import staged, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base nor a learned rule rejects."""
    rules = quality_rules.learn_from(docs, table(spark, sf_dir, "labels"))
    return quality_rules.kept_documents(docs, rules)


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a later document holds too, where three or more do."""
    return line_runs.cleaned_documents(spark, docs)


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return chosen_path.one_of_each(spark, docs)


def unleaked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return wu_manber.clean_documents(spark, docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    return weighted_mix.mixed(docs)


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", own_lines),
    ("n-gram Jaccard join", different_documents),
    ("benchmark decontamination", unleaked_documents),
    ("mixing sources", mix),
]

#: The learned rules and the similarity join cannot be said in SQL; tests check the stages, not every row of run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
