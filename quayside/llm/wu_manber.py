"""Benchmark decontamination by Wu-Manber search over words.

The test strings are the windows of ten consecutive words of every benchmark
item. Each block of items becomes three tables: how far a pair of words lets
the search shift, the strings that end in a pair, and the items a string comes
from. A document is scanned once for each block; most positions are skipped by
the shift table, and a string counts only after its words were compared. The
scan is a projection: no row of the documents is moved.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Consecutive words of an item that are one test string.
WINDOW = 10
#: Characters of benchmark text in one block, which is what a broadcast and the driver hold at once.
BLOCK_CHARS = 1_000_000

_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and all other non-ASCII characters; none of a null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


#: Tables of the strings of one length: the length, how far each block of two words lets the search
#: shift, and by the last block the strings with the items they come from.
Tables = tuple[int, dict, dict]


def tables(items: list[tuple[str, str | None]]) -> list[Tables]:
    """The tables of a block of items, one set for each length of test string."""
    found: dict[int, Tables] = {}
    for item, text in items:
        words = tuple(words_of(text))
        if not words:
            continue
        length = min(len(words), WINDOW)
        _, shift, ending = found.setdefault(length, (length, {}, {}))
        for start in range(len(words) - length + 1):
            string = words[start : start + length]
            for end in range(min(length, 2), length + 1):
                block = string[max(end - 2, 0) : end]
                shift[block] = min(length - end, shift.get(block, length))
            ending.setdefault(string[-2:], {}).setdefault(string, set()).add(item)
    return list(found.values())


def search(words: tuple[bytes, ...], held: Tables, hits: list[tuple[int, int]], items: set[str]) -> None:
    """Add the spans and items of every occurrence of the strings of one length."""
    length, shift, ending = held
    wide = min(length, 2)
    far, end, n = length - wide + 1, length, len(words)
    while end <= n:
        block = words[end - wide : end]
        step = shift.get(block, far)
        if step:
            end += step
            continue
        string = words[end - length : end]
        owners = ending[block].get(string)
        if owners:
            hits.append((end - length, end))
            items |= owners
        end += 1


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans put together."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("spans", T.ArrayType(T.LongType(), False), False),
        T.StructField("items", T.ArrayType(T.StringType(), False), False),
    ]
)


def _scanner(block) -> Column:
    """The search for the test strings of one broadcast block, added to what earlier blocks found."""

    def scan(texts: pa.Array, before: pa.Array) -> pa.Array:
        counts, spans, owners = [], [], []
        for text, old in zip(texts.to_pylist(), before.to_pylist(), strict=True):
            words = tuple(words_of(text))
            hits: list[tuple[int, int]] = []
            items: set[str] = set()
            for held in block.value:
                search(words, held, hits, items)
            if old is not None:
                flat = old["spans"]
                hits += zip(flat[::2], flat[1::2], strict=True)
                items |= set(old["items"])
            counts.append(len(words))
            spans.append([x for span in merged_spans(hits) for x in span])
            owners.append(sorted(items))
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(owners, pa.list_(pa.string()))],
            names=FOUND.names,
        )

    return F.arrow_udf(scan, FOUND).asNondeterministic()


def searched(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``__found``: its words, the flat merged spans of hit words, and the item ids as text.

    Every block of the benchmark is searched for in every document; blocks are
    read one after another and each is bounded by ``block_chars`` in the mean.
    Null and wordless texts hold no test string, and null items are none. An
    item without an id goes by the id ``null``. An id that comes twice counts
    once for a document.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.col("text").alias("text")
    ).where("text is not null")
    chars = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = chars // block_chars + 1
    number = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    found = docs.withColumn("__found", F.lit(None).cast(FOUND))
    for block in range(blocks):
        held = [(row["item"], row["text"]) for row in items.where(number == block).collect()]
        scan = _scanner(spark.sparkContext.broadcast(tables(held)))
        found = found.withColumn("__found", scan(F.col("text"), F.col("__found")))
    return found


def n_hit(found: Column) -> Column:
    """Words inside the spans: the ends less the starts."""
    spans = found["spans"]
    signed = F.transform(spans, lambda at, i: F.when(i % 2 == 0, -at).otherwise(at))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda total, at: total + at)


def report(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document its words, how many are hit, and which items its windows come from."""
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    found = F.col("__found")
    return searched(spark, texts, benchmark).select("doc_id", "__found").select(
        "doc_id",
        found["n_words"].alias("n_words"),
        n_hit(found).alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(found["items"]), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(found["items"]) > 0).alias("contaminated"),
    )


def clean_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    return searched(spark, docs, benchmark).where(F.size("__found.items") == 0).select(*docs.columns)
