"""The language model against plain sums over all units, and on held-out texts."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import log_bilinear as lb

WORDS = "a b c d e f g h".split()


def some_parameters(units, dimensions=4, seed=1):
    random = np.random.default_rng(seed)
    width = lb.class_width(units)
    return {
        "context": random.normal(size=(units + 1, dimensions)).astype("f4"),
        "target": random.normal(size=(units, dimensions + 1)).astype("f4"),
        "class": random.normal(size=(-(-units // width), dimensions + 1)).astype("f4"),
        "place": random.normal(size=(2, dimensions)).astype("f4"),
    }


def plain_log(p, unit, last, before):
    """The logarithm of a unit's probability, by sums over all classes and all units of its class."""
    width = lb.class_width(len(p["target"]))
    v = p["context"][last].astype(float) * p["place"][0] + p["context"][before].astype(float) * p["place"][1]

    def score(row):
        return float(v @ row[:-1] + row[-1])

    kind = unit // width
    classes = [score(row) for row in p["class"]]
    inside = {u: score(p["target"][u]) for u in range(len(p["target"])) if u // width == kind}
    return classes[kind] - np.log(np.sum(np.exp(classes))) + inside[unit] - np.log(np.sum(np.exp(list(inside.values()))))


@pytest.mark.parametrize("units", [2, 3, 5, 9, 10, 23])
def test_units_are_normalised(units):
    p = some_parameters(units)
    for numbers in (1, 1 << 22):
        model = lb.Normaliser(p, numbers)
        every = np.arange(units)
        got = model.log_probability(every, np.full(units, units), np.full(units, 1))
        assert abs(np.exp(got).sum() - 1) < 1e-5
        assert np.allclose(got, [plain_log(p, u, units, 1) for u in every], atol=1e-4)


def test_scores_of_given_parameters(spark, monkeypatch):
    """Whole scores, with words without a vector and words that no training text holds."""
    random = np.random.default_rng(2)
    texts = [" ".join(random.choice([*WORDS, *"xyzw"], int(n), p=[0.1] * 8 + [0.05] * 4)) for n in random.integers(0, 30, 40)]
    docs = spark.createDataFrame([*enumerate([*texts, "A new b", None])], "doc_id long, text string")
    held = {r.doc_id: r.h for r in docs.select("doc_id", (lb.fold(F.col("doc_id")) == lb.HELD_OUT).alias("h")).collect()}
    taught = [text for i, text in enumerate([*texts, "A new b", None]) if not held[i]]
    counts = {}
    for text in taught:
        for word in (text or "").lower().split():
            counts[word] = counts.get(word, 0) + 1
    common = sorted(counts, key=lambda w: (-counts[w], w))[:7]
    p = some_parameters(9)
    monkeypatch.setattr(lb, "trained", lambda *args: p)
    rest = {w: c for w, c in counts.items() if w not in common}
    inside = sum(rest.values()) + len(rest) + 1
    for row in lb.scored(spark, docs, vectors=7).collect():
        text = ([*texts, "A new b", None])[row.doc_id] or ""
        last = before = 9
        total = 0.0
        for word in [*text.lower().split(), None]:
            unit = lb.END if word is None else lb.FIRST + common.index(word) if word in common else lb.REST
            total += plain_log(p, unit, last, before) / np.log(10)
            if unit == lb.REST:
                total += np.log10((rest.get(word, 0) + 1) / inside)
            last, before = unit, last
        assert row.score == pytest.approx(total, rel=1e-4)


def test_steps_change_the_rows_they_meet_alone():
    shares = np.array([4, 1, 8, 6, 5, 4, 3, 2, 1, 1.0])
    trainer = lb.Trainer(lb.first_parameters(shares / shares.sum()), shares / shares.sum(), 3)
    first = {name: value.copy() for name, value in trainer.p.items()}
    trainer.step(np.array([2, 2, 3]), np.array([10, 2, 2]), np.array([10, 10, 2]))
    width = lb.class_width(10)
    assert set(np.flatnonzero((trainer.p["target"] != first["target"]).any(axis=1))) <= set(range(0, width))
    assert set(np.flatnonzero(trainer.met["context"])) == {2, 10}
    assert (trainer.p["context"][[0, 1, 3, 4, 5]] == first["context"][[0, 1, 3, 4, 5]]).all()


def test_noise_words_come_from_the_class_of_the_target():
    shares = np.random.default_rng(5).random(23)
    trainer = lb.Trainer(lb.first_parameters(shares / shares.sum()), shares / shares.sum(), 3)
    kinds = np.repeat(np.arange(len(trainer.log_class)), 4000)
    drawn = trainer._drawn(kinds)
    assert (drawn // trainer.width == kinds[:, None]).all()
    found = np.bincount(drawn.ravel(), minlength=23) / 4000 / lb.NOISE_WORDS
    assert np.allclose(found, np.exp(trainer.log_word), atol=0.02)


def test_blocks_are_averaged_by_what_met_them():
    shares = np.full(600, 1 / 600)
    one, two = (lb.Trainer(lb.first_parameters(shares), shares, seed) for seed in (1, 2))
    one.p["context"][5], one.met["context"][5] = 1.0, 3
    two.p["context"][5], two.met["context"][5] = 5.0, 1
    two.p["context"][599], two.met["context"][599] = 7.0, 2
    told = [row for batch in lb._added([*lb._blocks(one), *lb._blocks(two)]) for row in batch.to_pylist()]
    blocks = {row["block"]: (np.array(row["met"]), np.array(row["sums"]).reshape(-1, lb.DIMENSIONS)) for row in told}
    assert set(blocks) == {0, 2} and {row["name"] for row in told} == {"context"}
    assert np.allclose(blocks[0][1][5] / blocks[0][0][5], 2.0) and np.allclose(blocks[2][1][599 - 512] / 2, 7.0)


def test_vectors_grow_with_the_words():
    found = [lb.vector_words(10**n) for n in range(10)]
    assert found == sorted(found) and found[3] == lb.LEAST_VECTORS < found[5] < found[7] < found[8] == lb.HEAD


def test_held_out_texts_are_likelier_than_by_counts(spark):
    """A text's next word depends on the two before it, among more words than one class holds."""
    random = np.random.default_rng(4)
    texts = []
    for _ in range(1400):
        at, words = int(random.integers(400)), []
        for _ in range(80):
            at = (at * 7 + int(random.integers(3))) % 400
            words.append(f"w{at}")
        texts.append(" ".join(words))
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(2)
    rows = lb.scored(spark, docs).where("held_out").collect()
    gain = sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows)
    assert gain > 0.1 and np.mean([r.score > r.base_score for r in rows]) > 0.9


def test_normalisers_of_large_scores():
    """Scores whose exponentials overflow or vanish are shifted first; others need not be."""
    random = np.random.default_rng(6)
    for size in (1.0, 60.0, 400.0):
        scores = (random.random((5, 9)) * 2 - 1).astype("f4") * size
        want = [np.logaddexp.reduce(row.astype(float)) for row in scores]
        assert np.allclose(lb._log_sums(scores.copy(), float(np.abs(scores).max())), want, rtol=1e-5)


def test_trainers_follow_the_cores(spark, monkeypatch):
    """Each trainer sends all the rows it met, so there are no more of them when the input has more partitions."""
    docs = spark.createDataFrame([(n, f"w{n % 50} w{n % 7} w{n % 3}") for n in range(600)], "doc_id long, text string").repartition(40)
    sent = []
    real = type(docs).mapInArrow

    def counted(self, function, schema):
        if schema == lb.REACHED:
            sent.append(self.rdd.getNumPartitions())
        return real(self, function, schema)

    monkeypatch.setattr(type(docs), "mapInArrow", counted)
    assert lb.scored(spark, docs).count() == 600
    assert sent[0::2] == [lb.TASKS * spark.sparkContext.defaultParallelism] * lb.ROUNDS


def test_rows_that_repeat_keep_their_own_rare_words(spark):
    texts = [(1, "a b rare1 rare2 rare2"), (1, "a b rare1 rare2 rare2"), (1, "a c rare3"), (None, "a b rare1"), (2, None)]
    docs = spark.createDataFrame(texts * 3, "doc_id long, text string").repartition(3)
    rows = lb.scored(spark, docs, head=2).collect()
    assert len(rows) == 15
    whole = lb.scored(spark, docs).collect()
    for found in (rows, whole):
        assert len({(r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 9)) for r in found}) == 4
    assert {(r.doc_id, r.n_tokens): round(r.base_score, 9) for r in rows} == {(r.doc_id, r.n_tokens): round(r.base_score, 9) for r in whole}


def test_words_are_counted_in_the_tasks(spark, monkeypatch):
    """Counts leave a task instead of words: equal words of a text never become rows."""
    texts = ["B a\x0bb\x1c\u00c9  \n", None, "", "b\u00a0b B A a", " \t", "c C c"]
    want = {"a": 3, "b": 2, "b\x1c\u00c9": 1, "b\u00a0b": 1, "c": 3}
    counts = lb.word_counts(spark.createDataFrame([(t,) for t in texts * 2], "text string").repartition(3))
    assert "Generate" not in counts._jdf.queryExecution().executedPlan().toString()
    assert {r.word: r.c for r in counts.collect()} == {w: 2 * c for w, c in want.items()}
    monkeypatch.setattr(lb, "COUNTED", 1)
    parts = [dict(zip(*b.to_pydict().values(), strict=True)) for b in lb._counted([pa.record_batch({"text": [t for t in texts if t is not None]})])]
    assert len(parts) > 2 and {w: sum(part.get(w, 0) for part in parts) for w in want} == want


@pytest.mark.parametrize("units", [2, 9, 10, 700])
def test_cells_find_the_words_that_a_search_finds(units):
    """Also where one word holds nearly all of its class, so that all others begin in one cell."""
    shares = np.random.default_rng(8).random(units) ** 4
    shares[units // 2] = 1e4
    shares /= shares.sum()
    trainer = lb.Trainer(lb.first_parameters(shares), shares, 3)
    kinds = np.repeat(np.arange(len(trainer.log_class)), 3000)
    low, high = trainer.bounds[kinds][:, None], trainer.bounds[kinds + 1][:, None]
    value = low + (high - low) * np.random.default_rng(3).random((len(kinds), lb.NOISE_WORDS))
    first = kinds[:, None] * trainer.width
    want = np.clip(np.searchsorted(trainer.upto, value, side="right") - 1, first, np.minimum(first + trainer.width, units) - 1)
    assert (trainer._drawn(kinds) == want).all() and trainer.cells >= trainer.width


def test_rows_of_a_place_are_added_up():
    random = np.random.default_rng(9)
    for places, n in ((1, 1), (1, 40), (60, 40), (7, 200)):
        at, rows, times = random.integers(0, places, n), random.random((n, 3)).astype("f4"), random.random(n).astype("f4")
        named, order, starts = lb._ranked(at)
        for factor in (None, times):
            want = np.zeros((places, 3))
            np.add.at(want, at, rows if factor is None else rows * factor[:, None])
            sums, numbers = lb._sums(rows, order, starts, None if factor is None else factor.take(order))
            assert np.allclose(sums, want[named], rtol=1e-5) and (numbers == np.bincount(at)[named]).all()


def test_commonest_words_come_first():
    words = [b"w%d" % n for n in range(50)]
    index = {w: i for i, w in enumerate(words)}
    for most in (0, 7, 50, 99):
        found = lb._units(lb._token_ids([*words, b"new"], lb._commonest(index, most)), most)
        assert (found == lb._units(lb._token_ids([*words, b"new"], index), most)).all()
