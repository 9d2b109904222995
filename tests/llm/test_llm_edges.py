"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import (
    block_crf, chat_collapse, chosen_path, line_runs, log_bilinear, private_data, quality_rules, warc_derivatives,
    weighted_mix, wu_manber,
)

LONG = " ".join(f"word{i % 4000}" for i in range(20000))
TEXT = " ".join(f"common{i}" for i in range(60))
DOCS = [
    (1, TEXT, "a", 7), (1, TEXT, "a", 7), (2, None, None, 7), (3, "", "a", 7), (None, TEXT, None, 7), (None, None, "b", None),
    (4, LONG, "b", 7), (5, "A line that is long enough\nrest", "b", 7), (6, "a line that is long enough \nother", "b", 7),
    (7, "\x0bA LINE that is long enough", "c", 7), (8, TEXT + " more", "c", 7),
]
SCHEMA = "doc_id long, text string, source string, size long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).withColumn("th", F.lit("x")).withColumn("k", F.lit(1)).withColumn("kept", F.lit(0))


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def test_quality(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (None, 1), (5, None)], "doc_id long, quality int")
    out = quality_rules.judged(docs, quality_rules.learn_from(docs, labels)).collect()
    assert len(out) == len(DOCS) and [r.base_failed for r in out if r.doc_id == 2] == [True]
    assert {r.kept for r in out if r.doc_id == 1} == {True}
    assert quality_rules.learn_from(nothing, labels.where("false")) == [] and quality_rules.judged(nothing, []).collect() == []
    assert quality_rules.kept_documents(docs, []).columns == docs.columns


def test_rules_find_the_threshold():
    import numpy as np

    x = np.array([[i % 10, i / 300] for i in range(300)], float)
    rules = quality_rules.learn(x, x[:, 0] > 6, np.arange(300) // 10 % 3, ["a", "b"])
    assert len(rules) == 1 and (quality_rules._covers(rules[0], x, ["a", "b"]) == (x[:, 0] > 6)).all()


def test_lines(spark, docs, nothing):
    out = {(r.doc_id, r.n_lines): r for r in line_runs.report(spark, docs).collect()}
    assert (out[5, 2].n_dropped, out[6, 2].n_dropped, out[7, 1].n_dropped, out[2, 1].n_dropped) == (1, 1, 0, 0)
    clean = line_runs.cleaned_documents(spark, docs)
    assert clean.columns == docs.columns and clean.count() == len(DOCS)
    assert [r.text for r in clean.where("doc_id = 5").collect()] == ["rest"]
    assert [r.text for r in clean.where("doc_id = 2").collect()] == [None]
    assert line_runs.report(spark, nothing).collect() == []


def test_runs_are_compacted_and_count_all_batches(spark):
    runs = line_runs.LineRuns(spark)
    for batch in range(5):
        rows = [(k, k, batch) for k in range(batch, 8)]
        runs.add(spark.createDataFrame(rows, "h1 long, h2 long, owner long"))
    assert [len(level) for level in runs.levels] == [1, 1]
    got = {r.h1: (r.n_docs, r.owner) for r in runs.totals().collect()}
    assert got == {k: (min(k, 4) + 1, min(k, 4)) for k in range(8)}
    fresh = [r.h1 for run in runs.runs() for r in run.where("fresh").collect()]
    assert sorted(fresh) == list(range(8))
    runs.drop()
    assert runs.runs() == []


def test_similar(spark, docs, nothing):
    out = chosen_path.report(spark, docs).collect()
    assert len(out) == len(DOCS)
    assert {(r.class_id, r.n_links, r.n_copies) for r in out if r.doc_id in (1, 8)} == {(1, 1, 3), (1, 1, 1)}
    assert {(r.doc_id, r.class_id, r.n_links) for r in out if r.doc_id in (2, 3)} == {(2, 2, 0), (3, 3, 0)}
    kept = chosen_path.one_of_each(spark, docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]
    assert chosen_path.report(spark, nothing).collect() == []


def test_large_group_of_near_copies_is_linked_whole(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(60)) + f" tail{i}") for i in range(300)]
    out = chosen_path.report(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in out} == {0} and {r.n_links for r in out} == {299}


def test_runs_reach_the_recall_of_the_hardest_pairs():
    runs = chosen_path.runs_for(0.999)
    random = np.random.default_rng(6)

    def together(agree, node, depth):
        """Whether a pair with these equal positions is together at the last level, in one simulated run."""
        if depth == chosen_path.DEPTH:
            return True
        picked = random.choice(len(agree), 2 if random.random() < 10 / chosen_path.TENTHS - 1 else 1, replace=False)
        return any(agree[at] and together(agree, None, depth + 1) for at in picked)

    missed = tried = 0
    for _ in range(4000):
        agree = random.random(chosen_path.SIGNATURE) < chosen_path.TENTHS / 10
        tried += 1
        missed += not any(together(agree, None, 0) for _ in range(runs))
    assert missed <= 0.003 * tried and chosen_path.runs_for(0.9) < runs < chosen_path.runs_for(0.99999)


def test_buckets_of_one_group_are_put_together(spark):
    def bucket(run, members):
        return [((run << 56) + 16 + chosen_path.ALIKE_END, bytes([m // 256, m % 256]), len(members)) for m in members]

    rows = bucket(0, range(200)) + bucket(1, range(190)) + bucket(2, range(0, 200, 2))
    rows += bucket(3, range(500, 700)) + bucket(4, [500, *range(900, 1100)])  # one set in common, else different
    rows += [((5 << 56) + 1, bytes([0, m]), 2) for m in (1, 2)]
    got = {}
    for row in chosen_path.put_together(spark, spark.createDataFrame(rows, "node long, k binary, n long")).collect():
        got.setdefault((row.node, row.n), set()).add(int.from_bytes(row.k, "big"))
    end = 16 + chosen_path.ALIKE_END
    assert got == {
        (end, 200): set(range(200)), ((3 << 56) + end, 200): set(range(500, 700)),
        ((4 << 56) + end, 201): {500, *range(900, 1100)}, ((5 << 56) + 1, 2): {1, 2}}


def test_only_sets_that_agree_with_another_stay_in_a_bucket(spark):
    base = list(range(chosen_path.SIGNATURE))
    far = [-1 - x for x in base]
    just = [x if at < chosen_path.LEAST_AGREEING else -9 for at, x in enumerate(base)]
    sets = spark.createDataFrame([(b"a", base), (b"b", just), (b"c", far), (b"d", far[:-1] + [5])], "k binary, sig array<int>")
    rows = [(1, k, 3) for k in (b"a", b"b", b"c")] + [(2, k, 2) for k in (b"b", b"c")] + [(3, k, 2) for k in (b"c", b"d")]
    rows += [(4, k, chosen_path.SMALL + 1) for k in (b"a", b"c")]
    ends = spark.createDataFrame(rows, "node long, k binary, n long")
    got = sorted(map(tuple, chosen_path.likely(spark, ends, sets).collect()))
    large = chosen_path.SMALL + 1
    assert got == [(1, b"a", 2), (1, b"b", 2), (3, b"c", 2), (3, b"d", 2), (4, b"a", large), (4, b"c", large)]


def test_borderline_pairs_and_a_large_group_are_found(spark):
    random = np.random.default_rng(8)
    rows, want = [], {}
    for pair in range(1500):  # 100 shingles each, of which 90 are common: 90 / 110 is just above 0.8
        words = [f"p{pair}w{random.integers(10**9)}" for _ in range(104)]
        rows.append((2 * pair, " ".join(words)))
        rows.append((2 * pair + 1, " ".join(words[:94] + [f"q{pair}x{i}" for i in range(10)])))
        want[2 * pair] = want[2 * pair + 1] = (2 * pair, 1)
    common = [f"c{i}" for i in range(60)]
    for copy in range(2500):
        rows.append((10_000 + copy, " ".join([*common, f"tail{copy}"])))
        want[10_000 + copy] = (10_000, 2499)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.report(spark, docs).collect()}
    wrong = [i for i in want if got[i] != want[i]]
    assert len(wrong) <= 2 * 0.002 * 1500 and not [i for i in wrong if i >= 10_000]


def test_links_count_in_the_first_bucket_only():
    group = [(0, k, np.arange(9, dtype=np.uint64), np.array(nodes)) for k, nodes in ((b"a", [8, 16]), (b"b", [8, 16]), (b"c", [16, 24]))]
    assert chosen_path._pairs(group, True).sum() == 6
    assert chosen_path._met(group, 16).tolist() == [[True, True, False], [True, True, False], [False, False, False]]
    assert not chosen_path._met(group, 8).any()


def test_benchmark(spark, docs, nothing):
    items = spark.createDataFrame([(9, TEXT), (9, TEXT), (10, None), (11, "rest"), (None, "other")], "item_id long, text string")
    out = {r.doc_id: r for r in wu_manber.report(spark, docs, items).collect()}
    assert (out[1].n_hit, out[1].n_items, out[5].n_hit, out[6].n_items, out[2].n_words) == (60, 1, 1, 1, 0)
    blocks = wu_manber.searched(spark, docs, items, block_chars=100)
    assert sorted(map(str, blocks.select("__found").collect())) == sorted(
        map(str, wu_manber.searched(spark, docs, items).select("__found").collect()))
    assert wu_manber.clean_documents(spark, docs, items.where("false")).count() == len(DOCS)
    assert wu_manber.report(spark, nothing, items).collect() == []


def test_mix(docs, nothing):
    out = weighted_mix.mixed(docs).collect()
    assert len(out) == len(DOCS) and all(0 <= r.taken <= 2 * r.size for r in out)
    assert sorted(map(str, out)) == sorted(map(str, weighted_mix.mixed(docs).collect()))
    assert weighted_mix.mixed(nothing).collect() == []


def test_language_model(spark, docs, nothing):
    out = log_bilinear.scored(spark, docs).collect()
    assert len(out) == len(DOCS) and {r.n_tokens for r in out if r.doc_id in (2, 3)} == {1}
    assert log_bilinear.scored(spark, nothing).collect() == []
    held = spark.createDataFrame([(i, "a b") for i in range(40)], "doc_id long, text string").where(
        log_bilinear.fold(F.col("doc_id")) == log_bilinear.HELD_OUT)
    assert {(r.base_score, r.score, r.n_known) for r in log_bilinear.scored(spark, held).collect()} == {(0.0, 0.0, 0)}


def test_private_contexts_discover(spark, nothing):
    rows = [(i, f"please call me on +1 456 555 {1000 + i} now thanks") for i in range(12)]
    rows += [(50, "please call me on 0456/5559876 now thanks"), (51, "version 0456/5559876 of it"), (52, None), (50, "")]
    out = [(r.doc_id, r.spans) for r in private_data.report(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert ("phone:18:30") in dict((a, b) for a, b in out if b and a == 50).values()
    assert (51, "") in out and (52, "") in out and (50, "") in out and len(out) == len(rows)
    assert private_data.report(spark, nothing).collect() == []


def test_private_contexts_support_each_other(spark):
    rows = [(i, f"please call me on +1 456 555 {1000 + i} now thanks") for i in range(12)]
    rows += [(100 + i, f"please call me on 0456/555{7000 + i} now thanks") for i in range(6)]
    rows += [(200 + i, f"their office fax is 0456/555{7000 + i} since then") for i in range(6)]
    rows += [(300 + i, f"their office fax is +1 456 555 {2000 + i} since then") for i in range(4)]
    rows += [(400, "their office fax is 0999/1234567 since then"), (401, "the version is 0999/1234567 of it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.spans for r in private_data.report(spark, docs).collect()}
    assert out[100] == "phone:18:30" and out[200] == out[400] == "phone:20:32" and out[401] == ""


@pytest.mark.parametrize("told", ["(456) 555 2186", "4111 1111 1111 1112", "456  555\n2186"])
def test_private_contexts_discover_several_words(spark, told):
    rows = [(i, f"please call me on +1 456 555 {1000 + i} now thanks") for i in range(12)]
    rows += [(50, f"please call me on {told} now thanks"), (51, f"the version is {told} of it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.spans for r in private_data.report(spark, docs).collect()}
    assert out[50] == f"phone:18:{18 + len(told)}" and out[51] == ""


def test_runs_of_numbers_and_their_parts():
    found = private_data.looked_at("a (12) 345 67, 89 1011 b 55 x1\n123456 7")[1]
    assert [x[3] for x in found] == ["123456", "(12) 345 67", "(12) 345 67, 89 1011", "89 1011", "55 x1 123456 7", "123456 7"]


def test_pages(spark):
    body = "<nav><a href='/a'>Home</a></nav><article><h1>Title&amp;</h1><p>First  one.<br>And <b>more</b>.<p>Second</article><footer>x</footer>"
    rows = [(1, "u", f"<html><body>{body}"), (1, "u", f"<html><body>{body}"), (None, None, None), (3, "u", ""), (4, "u", "<p class='"), (5, "u", "<div>" * 3000 + "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    out = block_crf.extracted(spark, pages).collect()
    assert len(out) == len(rows)
    assert {r.text for r in out if r.page_id == 1} == {"Title&\nFirst one. And more.\nSecond"}
    assert {r.text for r in out if r.page_id in (None, 3, 4)} == {""}
    assert block_crf.extracted(spark, pages.where("false"), block_crf.Model({}, [[0, 0], [0, 0]])).collect() == []


def test_block_labels_hold_on_unseen_layouts():
    taught = [block_crf._labelled(*page) for page in block_crf.laid_out_pages(160)]
    model = block_crf.fitted(taught)
    wrong = total = 0
    for page, labels in (block_crf._labelled(*page) for page in block_crf.laid_out_pages(60, seed=77)):
        wrong += sum(a != b for a, b in zip(labels, model.labels(page), strict=True))
        total += len(labels)
    assert wrong < 0.02 * total


def test_warc_round_trip(spark, tmp_path):
    html = "<title>t</title><a href='/x'>Link</a>\r\n\r\n<p>é WARC/1.0</p>"
    pages = spark.createDataFrame([(1, "http://a/\r\nb", html), (2, None, None), (2, None, None)], "page_id long, url string, html string")
    warc_derivatives.write_warc(warc_derivatives.response_records(pages), f"{tmp_path}/w")
    read = warc_derivatives.read_warc(spark, f"{tmp_path}/w")
    out = warc_derivatives.derived(read)
    got = sorted(map(tuple, out.select("page_id", "record_type", "refers_to", "n_links").collect()))
    ids = {r.page_id: r.record_id for r in read.collect()}
    assert got == sorted([("1", t, ids["1"], 1) for t in ("conversion", "metadata")] + [("2", t, ids["2"], 0) for t in ("conversion", "metadata")] * 2)
    assert [r.block for r in out.where("page_id = 1 AND record_type = 'conversion'").collect()] == ["Link\né WARC/1.0"]
    warc_derivatives.write_warc(warc_derivatives.derivative_records(out), f"{tmp_path}/d")
    again = warc_derivatives.read_warc(spark, f"{tmp_path}/d").collect()
    assert sorted(dict(r.headers)["warc-refers-to"] for r in again) == sorted([ids["1"]] * 2 + [ids["2"]] * 4)
    assert warc_derivatives.derived(read.where("false")).collect() == []


@pytest.mark.parametrize("html, links", [
    ("<a href='/a'><img></a><a href=/b><img></a>", ["/a", "/b"]),
    ("<p>text <a href='/a'>one</a></p><footer><a href='/b?x&amp;y'><img></a></footer>", ["/a", "/b?x&y"]),
    ("<noscript><a href='/n'>n</a></noscript><svg><a xlink:href='/s'/></svg><object><!--<a href='/no'>--><a href='/o'></object>", ["/n", "/s", "/o"]),
    ("<p>x</p><script>'<a href=\"/no\">'</script><textarea><a href='/no'></textarea><noscript><a href='/n'>", ["/n"]),
])
def test_every_anchor_is_an_outlink(html, links):
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + html.encode()
    told = warc_derivatives.derivatives([("warc-record-id", "<urn:x>")], block)
    assert [r["n_links"] for r in told] == [len(links)] * 2
    assert re.findall("outlink: (.*) L a/@href", told[0]["block"]) == links


def test_chat(spark):
    rows = [(1, 0, "user", "a"), (2, 5, "user", "a"), (2, 6, "x", None), (2, 6, "x", None), (3, 0, "user", "a"), (4, 0, None, "a"),
            (5, 1, "user", "a"), (5, 2, "x", ""), (None, None, None, None)]
    rows += [(9, i, "user", str(i)) for i in range(600)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("n", F.lit(1))
    out = chat_collapse.rendered(spark, turns).collect()
    assert sorted(((r.conv_id or 0), r.part, r.n_turns, r.n_copies) for r in out) == [
        (0, 0, 1, 1), (2, 0, 2, 1), (4, 0, 1, 1), (5, 0, 2, 1), (9, 0, 600, 1), (9, 1, 600, 1), (9, 2, 600, 1)]
    whole = "".join(r.text for r in sorted((r for r in out if r.conv_id == 9), key=lambda r: r.part))
    assert whole == "".join(f"<|im_start|>user\n{i}<|im_end|>\n" for i in range(600))
    assert chat_collapse.rendered(spark, turns.where("false")).collect() == []
