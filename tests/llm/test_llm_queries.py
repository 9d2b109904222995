"""The registered queries against their SQL, or against brute force on whole tables."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from checking import compare

import __spark_entry__ as registry
from quayside.llm import chosen_path, private_data, queries, wu_manber

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def collected(df, key):
    return {row[key]: row.asDict() for row in df.collect()}


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, sf_small, name):
    assert compare(spark, sf_small, queries.QUERIES[name], queries.ORACLE[name]) > 0


def test_quality_counts(spark, sf_small):
    texts = collected(spark.read.parquet(f"{sf_small}/documents.parquet"), "doc_id")
    got = collected(queries.op1_quality_rules(spark, sf_small), "doc_id")
    assert got.keys() == texts.keys()
    for doc_id, row in got.items():
        text = texts[doc_id]["text"]
        words = WORD.findall(text)
        windows = Counter(zip(words, words[1:], words[2:]))
        hit = {i + s for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for s in range(3)}
        lines = Counter(line for line in text.split("\n") if WORD.search(line))
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(lines.values()) - len(lines), len(hit))
        assert tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
        assert row["base_failed"] == failed and not (failed and row["kept"])


def test_language_model(spark, sf_small):
    docs = collected(spark.read.parquet(f"{sf_small}/documents.parquet"), "doc_id")
    tokens = {i: [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in WORD.findall(d["text"])] + [None] for i, d in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts = Counter(t for i in docs if not held[i] for t in tokens[i])
    total, distinct = sum(counts.values()), len(counts)
    import math

    got = collected(queries.op4_log_bilinear(spark, sf_small), "doc_id")
    for i, row in got.items():
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens[i])
        assert row["held_out"] == held[i] and row["train_tokens"] == total and row["n_tokens"] == len(tokens[i])
        assert row["n_known"] == sum(t in counts for t in tokens[i])
        assert math.isclose(row["base_score"], base, rel_tol=1e-9) and row["score"] < 0


def test_similar_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    sets = {d.doc_id: frozenset(chosen_path.shingles(d.text).tolist()) for d in docs}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    links = {i: set() for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 10 * both >= 8 * len(sets[a] | sets[b]):
                label[max(root(a), root(b))] = min(root(a), root(b))
                if sets[a] != sets[b]:
                    links[a].add(sets[b])
                    links[b].add(sets[a])
    got = collected(queries.op5_chosen_path(spark, sf_small), "doc_id")
    assert {i: (r["class_id"], r["n_links"]) for i, r in got.items()} == {i: (root(i), len(links[i])) for i in sets}


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def brute_spans(text):
    found = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 13 <= len(digits) <= 19 and private_data.luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def test_private_data(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    got = collected(queries.op10_private_data(spark, sf_small), "doc_id")
    for d in docs:
        want = brute_spans(d.text)
        assert got[d.doc_id]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(got[d.doc_id]["spans"].split(",")) or not want
        assert [got[d.doc_id][f"n_{k}"] for k, _ in BASE] == [sum(s.startswith(k) for s in want) for k, _ in BASE]


def test_base_spans_of_odd_texts():
    for text in ("a@b.c@d.e", "a@b.c_d@e.f", "@x.y a.@.b z@q", "1.2.3.4.5.6.7.8 256.1.1.1 1..2.3.4", "4111 1111-1111 1111 0",
                 "+1 (456) 555-2186. +12", "x" * 5000 + "@" + "y." * 50, "٣.1.1.1.1 é@a.b", "+1" * 40):
        spans = private_data.base_spans(text)
        assert [f"{private_data.KINDS[k]}:{s}:{e}" for k, s, e in spans] == brute_spans(text)


def test_pipeline_keeps_what_every_stage_keeps(spark, sf_small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    good = corpus_pipeline.good_documents(spark, docs, sf_small)
    judged = collected(queries.op1_quality_rules(spark, sf_small), "doc_id")
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == {i for i, r in judged.items() if r["kept"]}
    out = collected(corpus_pipeline.run(spark, sf_small), "doc_id")
    assert out and all(0 <= r["taken"] <= 2 * r["size"] for r in out.values())
    test = [t for row in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect() for t in wu_manber.tables([("x", row.text)])]
    for row in docs.where(docs.doc_id.isin(list(out))).collect():
        hits = []
        for held in test:
            wu_manber.search(tuple(wu_manber.words_of(row.text)), held, hits, set())
        assert not hits
