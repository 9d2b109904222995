"""Reading pages, and the chain of labels against an enumeration of all labelings."""

import itertools
import time

import numpy as np
import pytest

from quayside.llm import block_crf, weighted_mix
from quayside.llm.page_blocks import blocks


@pytest.mark.parametrize("html, texts", [
    ("<article>a<canvas>c<p>rest</article><p>after", ["a c", "rest", "after"]),
    ("<article><p>one</p><noscript><p>two</p></noscript><p>three</p></article>", ["one", "two", "three"]),
    ("<p>a <svg viewBox='0'><title>icon</title><text>t</text></svg> b</p>", ["a b"]),
    ("<p>a <svg/> b <select><option>x<option>y</select> c</p>d", ["a b c", "d"]),
    ("<div><template><p>no</p></div><p>yes", ["yes"]),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>", ["so x=1 holds"]),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", ["a", "b", "c"]),
    ("<p>a<script>x<p>y</script> b<style>z", ["a b"]),
    ("<p>a</b></i></div>b", ["ab"]),
    ("</svg><p>kept", ["kept"]),
])
def test_texts_of_blocks(html, texts):
    found = [b.text for b in blocks(html.replace("a<canvas>", "a <canvas>"))]
    assert found == texts


def test_places_of_blocks():
    found = {b.text: b.place for b in blocks("<body><div class='post side-bar' id=x1><p>a</p><h2>b</h2></div>c")}
    assert (found["a"].tag, found["a"].inside, found["a"].named) == ("p", {"body", "div", "p"}, {"post", "side", "bar", "x"})
    assert (found["b"].tag, found["c"].inside, found["c"].named) == ("h2", {"body"}, set())


@pytest.mark.parametrize("page", [
    lambda n: "<div>" * n + "x",
    lambda n: "<div>x" * n,
    lambda n: "<div class='a b'>x<i>" * n,
    lambda n: "<b>" * n + "<p>x" * n,
    lambda n: "<canvas>x<svg>" * n,
])
def test_reading_is_linear_in_open_elements(page):
    begun = time.time()
    for html in (page(40_000),):
        block_crf.described(html)
    assert time.time() - begun < 6


def enumerated(scores, change):
    """Every labeling of a page with the logarithm of its weight."""
    for labels in itertools.product((0, 1), repeat=len(scores)):
        yield labels, sum(scores[j][b] for j, b in enumerate(labels)) + sum(change[a][b] for a, b in zip(labels, labels[1:]))


@pytest.mark.parametrize("seed", range(8))
def test_viterbi_finds_the_best_of_all_labelings(seed):
    random = np.random.default_rng(seed)
    n = int(random.integers(1, 9))
    weights = {f"f{i}": float(x) for i, x in enumerate(random.normal(0, 2, 12))}
    change = random.normal(0, 2, (2, 2)).tolist()
    page = [[f"f{i}" for i in random.choice(14, 3, replace=False)] for _ in range(n)]
    scores = [(0.0, sum(weights.get(name, 0.0) for name in names)) for names in page]
    best = max(enumerated(scores, change), key=lambda x: x[1])[0]
    assert block_crf.Model(weights, change).labels(page) == [bool(b) for b in best]


def test_forward_and_backward_sums_are_those_of_all_labelings():
    random = np.random.default_rng(3)
    lengths, change = [1, 4, 6, 3], random.normal(0, 1, (2, 2))
    there = np.arange(max(lengths)) < np.array(lengths)[:, None]
    scores = random.normal(0, 1, (len(lengths), max(lengths), 2)) * there[:, :, None]
    single, pairs = np.zeros_like(scores), np.zeros((2, 2))
    for i, n in enumerate(lengths):
        told = list(enumerated(scores[i, :n], change))
        total = sum(np.exp(x) for _, x in told)
        for labels, x in told:
            for j, b in enumerate(labels):
                single[i, j, b] += np.exp(x) / total
            for a, b in zip(labels, labels[1:]):
                pairs[a, b] += np.exp(x) / total
    got_single, got_pairs = block_crf._expected(scores, change, there)
    assert np.allclose(got_single, single) and np.allclose(got_pairs, pairs)


def test_rows_without_an_id_have_keys_of_their_own(spark):
    rows = [(None, " ".join(["w"] * 3 + [f"t{i}"]), "a") for i in range(200)] + [(1, "x", "b"), (None, None, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = weighted_mix.mixed(docs).where("source_size = 800").collect()
    took, target = sum(r.taken for r in out), out[0].target
    assert len(out) == 200 and abs(took - target) <= 4 and len({r.taken for r in out}) <= 2
