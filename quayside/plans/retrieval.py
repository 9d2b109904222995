"""Term index, ranked retrieval and prompts over the document table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import workspace
from quayside.operators import retrieval
from quayside.plans.tables import spread, table
from quayside.sinks.documents import write_documents
from quayside.sinks.runlog import require_samples
from quayside.sources.landing import read_documents

TOP_K = 5


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question")
    )


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    path = workspace.scratch(spark, "term-index")
    retrieval.write_index(documents, path)
    index = retrieval.open_index(spark, path)
    return retrieval.retrieve(index, _questions(spark, sf_dir), TOP_K)


def doc_term_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.term_index(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def doc_term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.term_stats(retrieval.term_index(table(spark, sf_dir, "documents")))


def doc_retrieve_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir)


def prompt_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = retrieval.assemble_prompts(
        _ranked(spark, sf_dir), table(spark, sf_dir, "documents"), _questions(spark, sf_dir)
    )
    sources = F.array_join(F.col("source_documents").cast("array<string>"), ",")
    return prompts.withColumn("source_documents", sources)


def doc_folder_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document landed as a text file of its own, gated on samples, then scanned below a prefix.

    The files are read once, and what the scan found is kept in a table below scratch.
    """
    root = workspace.scratch(spark, "document-files")
    write_documents(table(spark, sf_dir, "documents"), f"{root}/landed")
    found = read_documents(spark, root, "landed")
    require_samples(found)
    number = F.regexp_extract("doc_id", "/doc_id=([0-9]+)/", 1).cast("bigint")
    scanned = found.select(number.alias("doc_id"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    scanned.write.parquet(f"{root}/scanned")
    return spark.read.schema(scanned.schema).parquet(f"{root}/scanned")


QUERIES = {
    "doc_folder_scan": doc_folder_scan,
    "doc_term_index": doc_term_index,
    "doc_term_stats": doc_term_stats,
    "doc_retrieve_topk": doc_retrieve_topk,
    "prompt_assemble": prompt_assemble,
}

_TOKENS = r"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+')"
_INDEX = f"""
tokenized AS (
  SELECT row_number() OVER () AS document, doc_id, {_TOKENS.format(text='text')} AS tokens FROM documents
),
postings AS (
  SELECT term, doc_id, doc_len, count(*) AS tf
  FROM (SELECT document, doc_id, len(tokens) AS doc_len, unnest(tokens) AS term FROM tokenized)
  GROUP BY document, term, doc_id, doc_len
)"""
_RANKED = f"""
{_INDEX},
totals AS (SELECT count(*) AS n, sum(len(tokens)) / count(*) AS avg_len FROM tokenized),
frequency AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
wanted AS (
  SELECT DISTINCT item_id AS query_id, unnest({_TOKENS.format(text='text')}) AS term FROM benchmark
),
scores AS (
  SELECT query_id, doc_id, sum(CAST(floor(
           ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE))
           * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * (doc_len / avg_len))))
           * 100000000 + 0.5::DOUBLE) AS BIGINT)) AS total
  FROM wanted JOIN postings USING (term) JOIN frequency USING (term), totals
  GROUP BY query_id, doc_id
),
ranked AS (
  SELECT query_id, rank, doc_id, total FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY total DESC, doc_id) AS rank FROM scores)
  WHERE rank <= {TOP_K}
)"""
_HEAD, _REST = retrieval.PROMPT.split("{context}")
_MIDDLE, _TAIL = _REST.split("{question}")


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


ORACLE = {
    "doc_folder_scan": "SELECT doc_id, sha256(coalesce(text, '') || chr(10)) AS sha256 FROM documents",
    "doc_term_index": f"WITH {_INDEX} SELECT term, doc_id, CAST(doc_len AS INTEGER) AS doc_len, tf FROM postings",
    "doc_term_stats": (
        f"WITH {_INDEX} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS occurrences FROM postings GROUP BY term"
    ),
    "doc_retrieve_topk": (
        f"WITH {_RANKED} SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, floor((total + 5000) / 10000) / 10000.0::DOUBLE AS score FROM ranked"
    ),
    "prompt_assemble": f"""
WITH {_RANKED},
found AS (
  SELECT query_id, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY rank) AS context,
         string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rank) AS source_documents
  FROM ranked JOIN documents USING (doc_id) GROUP BY query_id
)
SELECT item_id AS query_id,
       {_text(_HEAD)} || coalesce(context, '') || {_text(_MIDDLE)} || coalesce(text, '') || {_text(_TAIL)} AS prompt,
       coalesce(source_documents, '') AS source_documents
FROM benchmark LEFT JOIN found ON item_id = query_id""",
}
