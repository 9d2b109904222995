"""Damaged, hot and planted input against plain Python versions of the operators."""

import gzip
import math
import time
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quayside.llm import line_runs, private_data, quality_rules, warc_derivatives


def record(block, *fields, kind="response", length=None):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:r>", *fields]
    lines += [f"Content-Length: {len(block) if length is None else length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def chunks(data, size=7):
    return (data[at : at + size] for at in range(0, len(data), size))


def plainly_parsed(data):
    """Sound records only, the whole text at once."""
    found = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        length = int([x for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")][0].split(b":")[1])
        found.append((head.count(b"\r\n"), rest[:length]))
        data = rest[length + 4 :]
    return found


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_sound_records_as_a_plain_parser_reads_them(size):
    data = b"".join(record(block, "X: 1", "X: 2") for block in (b"", b"a\r\n\r\nb", b"\r\nWARC/1.0\r\n\r\n", "é".encode() * 50))
    for stored in (data, gzip.compress(data), gzip.compress(data[:40]) + gzip.compress(data[40:])):
        got = list(warc_derivatives.parse_warc(chunks(stored, size)))
        assert [(len(f), b) for f, b, _ in got] == plainly_parsed(data) and not any(e for *_, e in got)
        assert [v for n, v in got[0][0] if n == "x"] == ["1", "2"]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_damaged_records_are_told_and_the_others_read(size):
    good = record(b"good")
    cases = {
        "no content length": (good + record(b"lost text", length="x") + good, [None, "no content length", None]),
        "no record": (b"junk\r\nmore\r\n\r\n" + good, ["no record", None]),
        "header": (good + b"WARC/1.0\r\nWARC-Type: resp", [None, "cut off in its header"]),
        "block": (good + record(b"x", length=900), [None, "cut off in its block"]),
        "nothing": (b"", []),
    }
    for data, errors in cases.values():
        got = list(warc_derivatives.parse_warc(chunks(data, size)))
        assert [e for *_, e in got] == errors
        assert all(b == b"good" for _, b, e in got if e is None)
    for bad in (gzip.compress(good)[:10] + b"\x07" * 30, gzip.compress(good)[:12], b"no gzip member"):
        got = list(warc_derivatives.parse_warc(chunks(gzip.compress(good) + bad, size)))
        assert (got[0][1], got[0][2], len(got)) == (b"good", None, 2)
        assert got[1][2].startswith("damaged gzip member")


def test_damaged_files_do_not_end_the_job(spark, tmp_path):
    page = b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\n\r\n<p>text</p>"
    good = record(page, "WARC-Concurrent-To: <urn:1>", "WARC-Concurrent-To: <urn:2>")
    (tmp_path / "a.gz").write_bytes(gzip.compress(good) + gzip.compress(record(page, length="x")) + gzip.compress(good))
    (tmp_path / "b.gz").write_bytes(gzip.compress(good)[:-20])
    (tmp_path / "c.gz").write_bytes(b"")
    read = warc_derivatives.read_warc(spark, str(tmp_path)).withColumn("kind", F.lit(1))
    assert read.where("error is not null").count() == 2 == read.where("record_type = 'damaged'").count()
    out = warc_derivatives.derived(read).collect()
    assert len(out) == 4 and {r.block for r in out if r.record_type == "conversion"} == {"text"}
    for told in (r.block for r in out if r.record_type == "metadata"):
        assert "http-set-cookie: a=1\r\nhttp-set-cookie: b=2\r\n" in told
        assert "warc-concurrent-to: <urn:1>\r\nwarc-concurrent-to: <urn:2>\r\n" in told


def in_chunks(data):
    return b"".join(b"%x;x=y\r\n%s\r\n" % (len(c), c) for c in chunks(data, 11)) + b"0\r\n\r\n"


@pytest.mark.parametrize("fields, made", [
    ("Content-Encoding: gzip", gzip.compress), ("Content-Encoding: deflate", zlib.compress),
    ("Content-Encoding: deflate", lambda b: zlib.compress(b)[2:-4]), ("Transfer-Encoding: chunked", in_chunks),
    ("Transfer-Encoding: chunked\r\nContent-Encoding: gzip", lambda b: in_chunks(gzip.compress(b))),
    ("Content-Encoding: gzip", lambda b: b), ("Transfer-Encoding: chunked", lambda b: b), ("Content-Encoding: br", lambda b: b),
])
def test_encoded_bodies(fields, made):
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{fields}\r\n\r\n".encode() + made("<p>Täxt one</p><p>two</p>".encode())
    assert warc_derivatives.derivatives([], block)[1]["block"] == "Täxt one\ntwo"


def test_very_long_pages_and_clashing_columns(spark, tmp_path):
    html = "".join(f"<p>block {i}</p>" for i in range(200_000))
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string").withColumn("value", F.lit(1)).withColumn("block", F.lit(2))
    warc_derivatives.write_warc(warc_derivatives.response_records(pages), f"{tmp_path}/w")
    out = warc_derivatives.derived(warc_derivatives.read_warc(spark, f"{tmp_path}/w")).where("record_type = 'conversion'").collect()
    assert out[0].block == "\n".join(f"block {i}" for i in range(200_000))


def plain_spans(docs):
    """The bootstrapped spans with dictionaries."""
    seen = [private_data.looked_at(text) for text in docs]
    edges, seeds = defaultdict(set), {}
    for _, things in seen:
        for kind, _, _, instance, patterns in things:
            for pattern in patterns:
                edges[pattern].add(instance)
                if kind is not None:
                    seeds[pattern, instance] = max(kind, seeds.get((pattern, instance), -1))
    confidence, support = {}, {}
    for _ in range(200):
        doubt = defaultdict(lambda: defaultdict(lambda: 1.0))
        for (pattern, kind), value in confidence.items():
            if max(support[pattern, k] for k in range(4) if (pattern, k) in support) >= private_data.SUPPORT:
                for instance in edges[pattern]:
                    doubt[instance][kind] *= 1 - min(value, 0.999)
        total, sure = defaultdict(float), defaultdict(int)
        for pattern, instances in edges.items():
            for instance in instances:
                seed = seeds.get((pattern, instance))
                scores = {seed: 1.0} if seed is not None else {k: 1 - d for k, d in doubt[instance].items()}
                for kind, score in scores.items():
                    total[pattern, kind] += score
                    sure[pattern, kind] += score >= private_data.CONFIDENCE
        support = sure
        confidence = {key: value / (len(edges[key[0]]) + 1) for key, value in total.items()}
    trusted = {k: v for k, v in confidence.items() if support[k] >= private_data.SUPPORT and v >= private_data.CONFIDENCE}
    out = []
    for base, things in seen:
        new = []
        for kind, start, end, _, patterns in things:
            told = [(value, -k) for (pattern, k), value in trusted.items() if pattern in patterns]
            if kind is None and told:
                new.append((-max(told)[1], start, end))
        new = [x for x in new if not any(y[1] <= x[1] and y[2] >= x[2] and y != x for y in new)]
        out.append(",".join(f"{private_data.KINDS[k]}:{a}:{b}" for k, a, b in sorted([*base, *new])))
    return out


def test_six_seeds_trust_five_other_tokens(spark):
    docs = [f"ring me at +1 456 555 {1000 + i} right away" for i in range(6)]
    docs += [f"ring me at 0456/555{7000 + i} right away" for i in range(5)]
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = [r.spans for r in private_data.report(spark, rows).orderBy("doc_id").collect()]
    assert got == plain_spans(docs) and all(x.startswith("phone:11:") for x in got)


def test_planted_contexts_as_a_plain_version_finds_them(spark):
    docs = [f"please call me on +1 456 555 {1000 + i} now thanks" for i in range(12)]
    docs += [f"please call me on 0456/555{7000 + i} now thanks" for i in range(9)]
    docs += [f"their office fax is 0456/555{7000 + i} since then" for i in range(7)]
    docs += ["their office fax is 0999/1234567 since then", "the version is 0999/1234567 of it"]
    docs += [f"write to user{i}@mail{i}.example.com or leave it" for i in range(8)]
    docs += ["write to user(at)1234 or leave it", "write to u@localhost1 or leave it", "", "no digits here"]
    docs += [f"the order {i}{i}1234{i} was sent to {i}.2.3.4 today" for i in range(9)]
    docs += [f"the host 10.0.0.{i} and the host 10.0.0.{i}/24 of net" for i in range(7)]
    docs = [*docs, *docs[:5]]
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    rows = rows.unionByName(spark.createDataFrame([(900, None)], "doc_id long, text string"))
    for name in ("kind", "pattern", "th", "instance", "base", "confidence"):
        rows = rows.withColumn(name, F.lit(1))
    got = [r.spans for r in private_data.report(spark, rows).orderBy("doc_id").collect()]
    assert got == [*plain_spans(docs), ""]


def test_very_long_text_of_private_data(spark):
    text = " ".join(f"word{i} 10.0.{i % 250}.{i % 200}" for i in range(60_000))
    row = private_data.report(spark, spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_ip == 60_000 and row.spans.count("ip:") >= 60_000


def lines_left(docs):
    """The lines that stay, with dictionaries."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})

    holders = defaultdict(set)
    for doc, text in docs:
        for line in text.split("\n"):
            holders[key(line)].add(doc)
    lost = {k: max(ids) for k, ids in holders.items() if len(k) >= line_runs.SHORTEST and len(ids) >= line_runs.DOCUMENTS}
    return {doc: "\n".join(x for x in text.split("\n") if lost.get(key(x), doc) == doc) for doc, text in docs}


def test_lost_lines_of_long_documents_in_linear_time(spark):
    common = [f"this is a common line of the dump, number {i}" for i in range(40_000)]
    docs = [(i, "\n".join([f"own {i}", *common, "", "short", f"An own line that is long enough, {i}"])) for i in range(3)]
    docs += [(7, "x\n\n" + common[5].upper() + " \n" + common[5]), (8, ""), (9, "short\nshort")]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("owner", "lost", "lines", "places", "h1"):
        rows = rows.withColumn(name, F.lit(1))
    begun = time.time()
    got = {r.doc_id: r.text for r in line_runs.cleaned_documents(spark, rows).collect()}
    assert time.time() - begun < 45
    assert got == lines_left(docs)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_one_id_of_several_texts_is_one_document(spark):
    line = "this line is long enough to be lost"
    docs = [(1, f"{line}\na"), (1, f"b\n{line}"), (1, f"{line}\na"), (None, f"c\n{line}\n{line}"), (None, line), (2, line)]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text) for r in line_runs.cleaned_documents(spark, rows).collect())
    assert got == [(0, ""), (0, "c"), (1, "a"), (1, "a"), (1, "b"), (2, line)]
    two = rows.where("doc_id is not null")
    assert sorted(r.text for r in line_runs.cleaned_documents(spark, two).collect()) == sorted(t for d, t in docs if d)


def test_a_repeated_id_teaches_the_rules_once(spark, monkeypatch):
    words = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(i, f"{words} x{i}") for i in range(60)] + [(0, f"{words} y{i % 3}") for i in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    taught = []
    monkeypatch.setattr(quality_rules, "learn", lambda x, reject, fold, names: taught.append(len(x)) or [])
    quality_rules.learn_from(docs, labels)
    assert taught == [60]


@pytest.mark.parametrize("total", [1, 60, 10**6, 3 * 10**8, 10**12])
def test_a_sample_by_hash_keeps_its_share_at_every_size(total):
    kept = (quality_rules.hash_bound(20_000, total) + (1 << 63)) / 2**64
    assert math.isclose(kept, min(1.0, 20_000 / total), rel_tol=1e-9)
