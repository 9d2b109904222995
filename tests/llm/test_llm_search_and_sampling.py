"""The permutation index, importance resampling and the piece table: brute force, edge cases, round trips."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import importance, permutation_index, piece_table, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "\n".join(" ".join(f"word{i}x{j}" for j in range(40)) for i in range(2000))
TEXT = " ".join(f"common{i}" for i in range(60))
DOCS = [
    (1, TEXT), (1, TEXT), (1, TEXT + " more"), (2, None), (3, ""), (None, TEXT), (None, None), (4, LONG), (5, "a\nb"), (6, "\n\n"),
    (7, "x <P> y\nz"), (8, "no break"), (9, "é€😀\nüber\r\n" * 30), (10, "A" * 300 + " b " + "é" * 90), (11, " \t\n"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(DOCS, "doc_id long, text string")
    return rows.withColumns({name: F.lit(1) for name in ("th", "row", "id", "cut", "n", "rank", "score", "form", "__of_docs")})


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {name: F.lit(1) for name in ("id", "segment", "slot", "query", "rank", "asked")})


# Nearest neighbours


def nearest_by_hand(rows, k=10):
    """Every query's exact neighbours, of rows that can be compared."""
    kept = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows]
    out = {}
    for at, (query, x) in enumerate(kept):
        if query is not None and query % 100 == 0:
            far = sorted(
                (math.sqrt(((x - y) ** 2).sum()), i is None, i or 0) for b, (i, y) in enumerate(kept) if b != at
            )
            out.setdefault(query, []).extend((s, None if none else i) for s, none, i in far[:k])
    return out


@pytest.mark.parametrize("folder", ["sf_small", "sf_check"])
def test_neighbours_reach_the_recall(spark, request, folder):
    sf_dir = request.getfixturevalue(folder)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = nearest_by_hand(rows)
    got = {}
    for row in queries.op11_permutation_index(spark, sf_dir).collect():
        got.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    assert got.keys() == want.keys()
    held = dict(rows)
    hits = 0
    for query, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        for _, i, s in found:
            assert s == pytest.approx(math.dist(held[query], held[i]), rel=1e-12)
        hits += len({i for _, i, _ in found} & {i for _, i in want[query]})
    assert hits >= 0.9 * 10 * len(want)


def test_all_ranks_give_the_exact_neighbours(spark):
    random = np.random.default_rng(5)
    rows = [(i, random.normal(size=6).astype(np.float32).tolist()) for i in range(700)]
    rows += [(800, rows[300][1]), (900, rows[300][1]), (900, rows[300][1]), (None, rows[300][1])]
    table = vectors_of(spark, rows).repartition(3)
    index = permutation_index.build(table, F.col("vec_id") % 100 == 0, pivots=16, kept=5, size=64)
    assert index.segments.agg(F.sum(F.size("ids"))).first()[0] == len(rows)
    assert max(r.n for r in index.segments.select(F.size("ids").alias("n")).collect()) <= 64
    asked = permutation_index._asked_rows(index).collect()
    block = permutation_index._block(asked, index, 5)
    got = {}
    for row in permutation_index._search(spark, index, block, 4, 1.0, 5).collect():
        got.setdefault(asked[row.query].vec_id, []).append((row.score, row.vec_id))
    want = nearest_by_hand(rows, 4)
    assert got.keys() == want.keys()
    for query in want:
        assert sorted(map(str, got[query])) == sorted(map(str, want[query]))


def test_footrules_add_up_the_differences_of_places():
    random = np.random.default_rng(1)
    vectors, pivots = random.normal(size=(30, 8)), random.normal(size=(12, 8))
    places = permutation_index.places(vectors, pivots, 5)
    for x, row in zip(vectors, places, strict=True):
        order = sorted(range(12), key=lambda p: math.dist(x, pivots[p]))
        assert [order.index(p) if order.index(p) < 5 else 5 for p in range(12)] == row.tolist()
    slots, ranks = [], []
    for pivot in range(12):
        posted = np.flatnonzero(places[:, pivot] < 5)
        slots.append(posted.astype("<i4").tobytes())
        ranks.append(places[posted, pivot].astype("<i2").tobytes())
    found = permutation_index._footrules(places[:3], slots, ranks, 30, 5)
    assert (found == np.abs(places[:3, None, :].astype(int) - places[None, :, :]).sum(axis=2)).all()


def test_vectors_that_cannot_be_compared_take_no_part(spark):
    good = [(100, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0]), (200, [1.0, 0.0]), (None, [3.0, 0.0])]
    bad = [(300, None), (400, []), (500, [0.0, 0.0]), (600, [1.0, None]), (700, [float("nan"), 1.0]), (800, [float("inf"), 1.0]), (3, [1.0])]
    out = permutation_index.nearest(vectors_of(spark, good + bad), F.col("vec_id") % 100 == 0).collect()
    got = sorted((r.query_id, r.rank, str(r.vec_id), round(r.score, 6)) for r in out)
    assert got == sorted(
        (q, n, str(i), s) for q, other in ((100, 200), (200, 100))
        for n, (i, s) in enumerate([(other, 0.0), (1, 1.0), (2, round(math.sqrt(2), 6)), (None, 2.0)], start=1))
    for rows in ([], bad[:6], [(1, [1.0, 2.0])], [(100, [1.0, 2.0])]):
        assert permutation_index.nearest(vectors_of(spark, rows), F.col("vec_id") % 100 == 0).collect() == []


def test_blocks_of_queries_and_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(1000 + i, [float(i), 1.0, 0.5]) for i in range(300)]
    table = vectors_of(spark, rows)
    whole, parted = (
        sorted(map(tuple, permutation_index.nearest(table, F.col("vec_id") % 100 == 0, block=block, size=50).collect()))
        for block in (4096, 2)
    )
    assert whole == parted
    assert [r[2] for r in whole if r[0] == 200] == list(range(10)) and [r[2] for r in whole if r[0] == 0] == list(range(1, 11))


# Importance resampling


def resampled_by_hand(docs, items, drawn=5):
    def features(text):
        words = WORD.findall((text or "").translate(LOWER))
        runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(run.encode()) % 10000 for run in runs]

    corpus, target = Counter(), Counter()
    for _, text in docs:
        corpus.update(features(text)[1])
    for text in items:
        target.update(features(text)[1])
    s, t = sum(corpus.values()), sum(target.values())
    gain = [math.floor(1000 * math.log((target[b] + 1) * (s + 10000) / ((corpus[b] + 1) * (t + 10000)))) for b in range(10000)]
    rows = []
    for doc_id, text in docs:
        n_words, found = features(text)
        name = "null" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"42:{name}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        rows.append((doc_id, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    long = sorted((-r[4], r[0] is None, r[0] or 0, at) for at, r in enumerate(rows) if r[1] >= 20)
    rank = {at: place for place, (*_, at) in enumerate(long[: drawn * len(long) // 100], start=1)}
    return sorted(((r[0], *r[2:], rank.get(at)) for at, r in enumerate(rows)), key=str)


def test_resampling_matches_brute_force(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    got = queries.op12_importance(spark, sf_small).collect()
    assert sorted(map(tuple, got), key=str) == resampled_by_hand(docs, items)
    assert sum(r.rank is not None for r in got) > 0


@pytest.mark.parametrize("drawn", [0, 17, 40, 100])
def test_resampling_of_odd_texts(spark, docs, drawn):
    items = spark.createDataFrame([(TEXT,), (None,), ("",)], "text string")
    got = sorted(map(tuple, importance.resampled(docs, items, drawn).collect()), key=str)
    want = resampled_by_hand(DOCS, [TEXT], drawn)
    # Rows of one id and score may change places: compare what they hold, and the ranks.
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert sorted(str(r[4]) for r in got) == sorted(str(r[4]) for r in want)
    ranked = sorted(((r[4], r[3]) for r in got if r[4]), key=lambda r: r[0])
    assert [s for _, s in ranked] == sorted((s for _, s in ranked), reverse=True)
    kept = importance.drawn_documents(docs, items, drawn)
    assert kept.columns == docs.columns and kept.count() == len(ranked)


def test_resampling_of_nothing(spark, docs):
    empty = docs.where("false")
    assert importance.resampled(empty, docs).collect() == [] and importance.drawn_documents(empty, docs).collect() == []
    assert {r.rank for r in importance.resampled(docs, empty).collect()} == {None}


def test_one_row_repeated_is_drawn_as_often_as_asked(spark):
    docs = spark.range(400).select(F.lit(5).alias("doc_id"), F.lit(TEXT).alias("text"), F.lit("x").alias("th"))
    got = importance.resampled(docs, docs.limit(1), 25).collect()
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 101))
    assert importance.drawn_documents(docs, docs.limit(1), 25).count() == 100


def test_checksums_of_word_runs():
    words = [b"a", b"x" * 63, b"y" * 64, b"z" * 65, b"w" * 700, "é€".encode(), b"last"]
    runs = [b" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    assert importance.feature_buckets(words).tolist() == [zlib.crc32(run) % 10000 for run in runs]
    assert importance.feature_buckets([]).tolist() == [] and len(importance.feature_buckets(words[:2])) == 3


def test_every_place_is_selected(spark):
    random = np.random.default_rng(3)
    rows = [(int(random.integers(-3, 3)), bool(random.integers(2)), int(random.integers(3)), int(random.integers(2)), i) for i in range(120)]
    keys = spark.createDataFrame(rows, importance.KEY).repartition(7).cache()
    for wanted in (1, 2, 59, 60, 119, 120):
        assert tuple(importance.cutoff(keys, wanted)) == sorted(rows)[wanted - 1]
        assert keys.where(importance.upto(importance.cutoff(keys, wanted))).count() == wanted
    assert importance.cutoff(keys, 121) is None and importance.cutoff(keys, 0) is None


def test_a_median_of_medians_gives_up_a_quarter():
    random = np.random.default_rng(4)
    parts = [sorted(random.integers(0, 10**6, size=random.integers(1, 400)).tolist()) for _ in range(50)]
    medians = [(len(p), importance.Key(p[(len(p) - 1) // 2], False, 0, 0, 0)) for p in parts]
    at = importance.weighted_median(medians).low
    every = [x for p in parts for x in p]
    for side in (sum(x <= at for x in every), sum(x >= at for x in every)):
        assert side >= len(every) / 4


# Piece tables


def arranged_by_hand(doc_id, text, share=100):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, digits = len(lines), hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= share:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(lines[low:high]) for low, high in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle_of_odd_texts(spark, docs):
    got = sorted((str(tuple(r)) for r in piece_table.report(docs).collect()))
    want = []
    for doc_id, text in DOCS:
        *head, output = arranged_by_hand(doc_id, text)
        want.append(str((doc_id, *head, *(hashlib.sha256(t.encode()).hexdigest() for t in (output, text or "")))))
    assert got == sorted(want)
    assert piece_table.report(docs.where("false")).collect() == []


@pytest.mark.parametrize("share", [0, 50, 100])
def test_texts_are_arranged_and_come_back(spark, docs, share):
    more = docs.unionByName(spark.range(100, 160).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc\nd\n<").alias("text")), True)
    out = piece_table.filled_in(more, share)
    assert out.columns == docs.columns
    got = sorted((str(r.doc_id), r.text) for r in out.collect())
    assert got == sorted((str(r.doc_id), arranged_by_hand(r.doc_id, r.text, share)[4]) for r in more.collect())
    cut = piece_table.cut_column(F.col("text"), F.col("doc_id"), share)
    back = more.select("text", cut.alias("c")).select(
        "text", piece_table.text_of(piece_table.output_of(F.col("text"), F.col("c.pieces")), F.col("c.form")).alias("again"))
    assert all((r.text or "") == r.again for r in back.collect())


def test_cuts_split_pieces_and_permutations_come_back():
    text = b"0123456789"
    pieces = [piece_table.Piece(0, 4, 3), piece_table.Piece(0, 0, 4), piece_table.Piece(0, 7, 3)]
    spelled = b"".join(piece_table.spelled(text, pieces))
    assert spelled == b"4560123789"
    for at in range(len(text) + 1):
        before, after = piece_table.cut(pieces, at)
        parts = [b"".join(piece_table.spelled(text, part)) for part in (before, after)]
        assert parts == [spelled[:at], spelled[at:]] and all(p.length for p in before + after)
        for order in piece_table.ORDERS.values():
            put = piece_table.arranged((before, after, []), order)
            output = b"".join(piece_table.spelled(text, put))
            assert piece_table.digest(text, put) == hashlib.sha256(output).hexdigest()
            assert b"".join(piece_table.spelled(output, piece_table.restored(output, order))) == spelled
