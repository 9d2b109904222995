"""Operators on hand-written rows, and against plain Python on random rows."""

import datetime as dt
import math
import random
import re
from pathlib import Path
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quayside.config import MIGRATION_FILES, NEW_CLIENT_FILES, endpoint_columns, required_files
from quayside.functions.patterns import Entity
from quayside.sinks import keyed
from quayside.operators import (
    children,
    combine,
    flatten,
    latest,
    load,
    manifest,
    monitor,
    privacy,
    profile,
    retrieval,
    upsert,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


STATUS = "customer string, source string, lrd timestamp_ntz, status string, info string, airflow string, run_id bigint"


def status(spark, items):
    return spark.createDataFrame(items, STATUS)


def test_current_status_breaks_ties_by_run(spark):
    day = dt.datetime(2024, 1, 1)
    runs = status(spark, [
        ("a", "x", day, "failed", None, "u", 1), ("a", "x", day, "success", None, "u", 2),
        ("a", "x", None, "failed", None, "u", 9), ("b", "x", None, "failed", "", "u", 3),
    ])
    assert [(r.customer, r.run_id) for r in monitor.current_status(runs).orderBy("customer").collect()] == [("a", 2), ("b", 3)]


def test_failure_filters_follow_sql_nulls(spark):
    day = dt.datetime(2024, 1, 1)
    items = [
        ("a", "s", day, "failed", None, "u", 1), ("b", "s", day, "failed", "", "u", 2),
        ("c", "s", day, "failed", "etlmonitor-daily", "u", 3), ("d", "s", day, None, None, "u", 4),
        ("e", None, day, "failed", None, "u", 5), ("f", "MTA Build", day, "failed", "x", "u", 6),
        ("g", "MTA Build", day, "success", "x", "u", 7), ("h", "s", day, "success", None, "u", 8),
    ]
    frame = status(spark, items)
    assert [r.customer for r in monitor.failed_daily(frame).collect()] == ["a", "b"]
    assert [r.customer for r in monitor.failed_mta(frame).collect()] == ["f"]


@pytest.mark.parametrize("schedule,days", [("etlmonitor-daily", 1), ("etlmonitor-weekly", 7), ("etlmonitor-monthly", 30)])
def test_lateness_boundary(spark, schedule, days):
    edge = dt.datetime(2024, 3, 31) - dt.timedelta(days=days)
    items = [
        ("on", "s", edge, "ok", schedule, "u", 1), ("after", "s", edge + dt.timedelta(seconds=1), "ok", schedule, "u", 2),
        ("before", "s", edge - dt.timedelta(days=90), "ok", schedule, "u", 3), ("other", "s", edge, "ok", "x", "u", 4),
        ("none", "s", None, "ok", schedule, "u", 5),
    ]
    late = monitor.late(status(spark, items), schedule, dt.date(2024, 3, 31))
    assert sorted(r.customer for r in late.collect()) == ["before", "on"]


def test_report_columns(spark):
    frame = monitor.report_columns(status(spark, [("a", "s", dt.datetime(2024, 1, 1, 0, 0, 30), "f", None, "u", 1)]))
    assert frame.columns == ["customer", "source", "last refresh", "status", "info", "airflow"]
    assert frame.first()["last refresh"] == dt.datetime(2024, 1, 1)


def test_latest_items_replace_whole_items(spark):
    items = [("k", "r", 1, "old", "kept?"), ("k", "r", 2, "new", None), ("k", "q", 1, "other", "x")]
    df = spark.createDataFrame(items, "id string, name string, at int, a string, b string")
    assert rows(latest.latest_items(df, ["id", "name"], "at")) == [("k", "q", 1, "other", "x"), ("k", "r", 2, "new", None)]


def test_project_follows_the_configuration(spark):
    config = {"Customer": {"X": {"Columns": {"Events": ["b", "missing", "a"]}}}}
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rows(combine.project(df, endpoint_columns(config, "X", "Events"))) == [(2, None, 1)]


def test_union_outer_ignores_column_order_and_keeps_copies(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("x", 1, True), ("y", 2, None)], "b string, a int, c boolean")
    wanted = sorted([(1, "x", None), (1, "x", True), (2, "y", None)], key=repr)
    assert rows(combine.union_outer([a, b]).select("a", "b", "c")) == wanted
    assert rows(combine.union_outer([b, a]).select("a", "b", "c")) == wanted


def test_union_outer_widens_without_losing_digits(spark):
    wide = spark.sql("SELECT CAST('12345678901234567890.12' AS decimal(38,2)) AS a, CAST(1.5 AS decimal(5,3)) AS b, 9223372036854775807L AS c")
    ints = spark.sql("SELECT CAST(7 AS int) AS a, 9223372036854775807L AS b, CAST(1 AS smallint) AS c")
    both = combine.union_outer([wide, ints])
    assert both.dtypes == [("a", "decimal(38,2)"), ("b", "decimal(22,3)"), ("c", "bigint")]
    got = both.select(*[F.col(c).cast("string") for c in "abc"])
    assert rows(got) == [("12345678901234567890.12", "1.500", "9223372036854775807"), ("7.00", "9223372036854775807.000", "1")]
    full = spark.sql("SELECT CAST('1e-30' AS decimal(38,30)) AS a")
    assert combine.union_outer([full, spark.sql("SELECT 9223372036854775807L AS a")]).dtypes == [("a", "string")]


def test_union_outer_mixes_types_as_text(spark):
    a = spark.createDataFrame([(1,)], "a int")
    b = spark.createDataFrame([("x",)], "a string")
    assert rows(combine.union_outer([a, b])) == [("1",), ("x",)]
    c = spark.createDataFrame([(2.5,)], "a double")
    assert combine.union_outer([a, c]).dtypes == [("a", "double")]


def test_union_strict_refuses_other_schemas(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    with pytest.raises(ValueError, match="frame 2"):
        combine.union_strict([a, a.withColumn("a", F.col("a").cast("bigint"))])
    with pytest.raises(ValueError):
        combine.union_strict([a, a.drop("b")])
    assert combine.union_strict([a, a.select("b", "a")]).count() == 2


def test_cast_to_text_adds_missing(spark):
    df = combine.cast_to_text(spark.createDataFrame([(1,)], "AccessDate int"), ["AccessDate", "DateExpires"])
    assert rows(df) == [("1", None)] and set(dict(df.dtypes).values()) == {"string"}


NESTED = [
    '{"id":1,"a":{"b":{"c":5},"l":[1,2]},"people":[{"n":"x","tags":["p"]},{"n":"y","tags":["q","r"]}],"e":[],"o":{}}',
    '{"id":2,"a":{"b":{"c":null},"l":[]},"people":[],"mixed":1}',
    '{"id":3,"mixed":"z"}',
]


def nested(spark, tmp_path):
    path = tmp_path / "n.json"
    path.write_text("\n".join(NESTED))
    return spark.read.json(str(path))


def test_flatten_names_and_values(spark, tmp_path):
    flat = flatten.drop_nested(flatten.flatten(nested(spark, tmp_path)))
    assert sorted(flat.columns) == sorted([
        "id", "mixed", "a_b_c", "a_l_0", "a_l_1", "people_0_n", "people_1_n", "people_0_tags_0",
        "people_1_tags_0", "people_1_tags_1",
    ])
    one = flat.where("id = 1").first()
    assert (one.a_b_c, one.a_l_1, one.people_1_n, one.people_1_tags_1) == (5, 2, "y", "r")
    assert flat.where("id = 3").first().mixed == "z"


def test_flatten_entries_hold_the_same(spark, tmp_path):
    df = nested(spark, tmp_path)
    flat = flatten.drop_nested(flatten.flatten(df))
    wide = {
        (r["id"], c, str(r[c])) for r in flat.collect() for c in flat.columns if c != "id" and r[c] is not None
    }
    assert {tuple(r) for r in flatten.flatten_entries(df, ["id"]).collect()} == wide


def test_flatten_merges_colliding_paths(spark):
    df = spark.createDataFrame([(1, (2,)), (3, (None,))], "a_b int, a struct<b: int>")
    assert rows(flatten.flatten(df)) == [(2,), (3,)]


def test_flatten_refuses_too_many_columns(spark):
    df = spark.createDataFrame([(list(range(30)), 1)], "a array<int>, b int")
    with pytest.raises(ValueError, match=r"a \(30\)"):
        flatten.flatten(df, max_columns=20)
    # The type follows what is asked for, whatever the data hold.
    for rows_ in (df, df.limit(0), spark.createDataFrame([([], 1), (None, 2)], df.schema)):
        assert flatten.flatten(rows_, max_columns=20, maps=["a"]).dtypes == [("a", "map<string,string>"), ("b", "int")]
    assert flatten.flatten(df, maps=["a"]).first().a["29"] == "29"


DEEP = "k int, a array<struct<b: array<array<int>>, c: string, e: array<int>>>, `a_0` array<int>, m map<string,int>"
DEEP_ROWS = [
    (1, [([[1, 2], []], "x", []), (None, "y", [])], [7], {"q": 1}),
    (2, [([[], None, [3, None, 5]], None, None)], None, None),
    (3, None, [], None), (4, [None], [None, 9], None),
]


def test_flatten_reads_all_depths_at_once(spark, monkeypatch):
    df = spark.createDataFrame(DEEP_ROWS, DEEP)
    taken = []
    longest = flatten._longest
    monkeypatch.setattr(flatten, "_longest", lambda rows_: taken.append(1) or longest(rows_))
    flat = flatten.flatten(df)
    assert taken == [1]
    assert flat.columns == [
        "k", "a_0_b_0_0", "a_0_b_0_1", "a_0_b_2_0", "a_0_b_2_1", "a_0_b_2_2", "a_0_c", "a_1_c", "a_0_0", "a_0_1", "m",
    ]
    got = {r.k: r.asDict() for r in flat.collect()}
    assert (got[1]["a_0_b_0_1"], got[1]["a_1_c"], got[1]["a_0_0"], got[1]["m"]) == (2, "y", 7, {"q": 1})
    assert (got[2]["a_0_b_2_0"], got[2]["a_0_b_2_1"], got[2]["a_0_b_2_2"], got[4]["a_0_1"]) == (3, None, 5, 9)
    inner = flatten.flatten(df, maps=["a_b"])
    assert [c for c in inner.columns if c.startswith("a_0_b")] == ["a_0_b"]
    assert {r.k: r["a_0_b"] for r in inner.collect()}[2] == {"2_0": "3", "2_2": "5"}


def test_list_widths_of_all_depths(spark):
    df = spark.createDataFrame(DEEP_ROWS, DEEP)
    got = sorted((r.path, r.width) for r in flatten.list_widths(df).collect())
    assert got == [("a", 2), ("a_0", 2), ("a_0_b", 3), ("a_0_b_0", 2), ("a_0_b_2", 3)]
    assert rows(flatten.list_widths(df.limit(0))) == []
    assert rows(flatten.list_widths(df.select("k", "m"))) == []


def test_array_widths(spark):
    df = spark.createDataFrame([([1, 2], None), (None, [])], "a array<int>, b array<int>")
    assert rows(flatten.array_widths(df)) == [("a", 2), ("b", 0)]


def test_children_of_parents(spark):
    kids = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "event_id int, v string")
    parents = spark.createDataFrame([(1,), (1,), (3,), (None,)], "id int")
    assert rows(children.of_parents(kids, parents, "event_id", "id")) == [(1, "a"), (1, "a")]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    staged = spark.createDataFrame([("c", 2, 1), ("d", 2, 2), ("e", 3, 1)], "v string, k int, at int")
    newest = upsert.upsert(target, staged, ["k"], [F.col("at").desc()])
    assert rows(newest) == sorted([(1, "a"), (None, "n"), (2, "d"), (3, "e")], key=repr)
    keyless = spark.createDataFrame([("x", None, 1), ("y", None, 2)], "v string, k int, at int")
    again = upsert.upsert(target, keyless, ["k"], [F.col("at").desc()])
    assert rows(again) == sorted([(1, "a"), (2, "b"), (None, "n"), (None, "y")], key=repr)


def test_upsert_into_a_keyed_table(spark, tmp_path, no_broadcast):
    schema = spark.createDataFrame([], "k int, v string").schema
    target = keyed.open_table(spark, "upserted", schema, ["k"], str(tmp_path), 16)
    keyed.merge(target, spark.createDataFrame([(None, "n"), *[(n, "a") for n in range(300)]], schema))
    before = set(spark.table("upserted").inputFiles())
    staged = spark.createDataFrame([("c", 2, 1), ("d", 2, 2), ("e", 999, 1), ("x", None, 1), ("y", None, 2)], "v string, k int, at int")
    touched = upsert.upsert_table(target, staged, [F.col("at").desc()])
    want = [(None, "n"), (None, "y"), (2, "d"), (999, "e"), *[(n, "a") for n in range(300) if n != 2]]
    assert rows(target.rows(spark)) == sorted(want, key=repr)
    left = {path for path in before if int(path.split(f"{keyed.BUCKET}=")[1].split("/")[0]) not in touched}
    assert len(touched) <= 3 and left == before & set(spark.table("upserted").inputFiles())


def test_the_target_of_an_upsert_is_not_shuffled(spark, tmp_path, no_broadcast):
    schema = spark.createDataFrame([], "k int, v string").schema
    target = keyed.open_table(spark, "not_shuffled", schema, ["k"], str(tmp_path), 16)
    keyed.merge(target, spark.createDataFrame([(n, "a") for n in range(300)], schema))
    fresh = spark.createDataFrame([(2, "d")], schema)
    plan = keyed.merged(spark, target, fresh, [3, 5])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    assert "Bucketed: true" in plan and "IN (3,5)" in plan.replace(" IN (3, 5)", " IN (3,5)")


def names(spark, paths):
    return manifest.present_files(spark.createDataFrame([(p,) for p in paths], "path string"))


@pytest.mark.parametrize("paths,exactly,at_least", [
    (["in/A - 1.csv", "in/b.csv"], True, True),
    (["in/a.csv"], False, False),
    (["in/a.csv", "in/b.csv", "in/c.csv"], False, True),
    (["in/a.csv", "in/b.csv", "in/B - 2.csv"], False, True),
    (["in/", "in/a.csv", "in/b.csv"], True, True),
    ([], False, False),
])
def test_manifest(spark, paths, exactly, at_least):
    report = manifest.manifest_report(names(spark, paths), ["a.csv", "b.csv"])
    assert manifest.complete_exactly(report).first().complete is exactly
    assert manifest.complete_at_least(report).first().complete is at_least


def test_a_delivery_of_markers_misses_everything(spark):
    df = spark.createDataFrame([(1, "in/"), (2, "in/a.csv"), (2, None)], "d int, path string")
    report = manifest.manifest_report(manifest.present_files(df, by=["d"]), ["a.csv"], ["d"])
    assert rows(report) == [(1, "a.csv", 0, 1, "missing"), (2, "a.csv", 1, 1, "ok")]


def test_manifest_equals_multiset_comparison(spark):
    random.seed(5)
    required = ["a.csv", "b.csv", "c.csv"]
    listed = [(d, random.choice(required + ["x.csv"])) for d in range(60) for _ in range(random.randrange(1, 5))]
    df = spark.createDataFrame(listed, "d int, path string")
    report = manifest.manifest_report(manifest.present_files(df, by=["d"]), required, ["d"])
    got = {r.d: r.complete for r in manifest.complete_exactly(report, ["d"]).collect()}
    assert got == {d: sorted(f for e, f in listed if e == d) == sorted(required) for d, _ in listed}


def test_required_files():
    assert len(required_files(MIGRATION_FILES)) == len(required_files(NEW_CLIENT_FILES)) == 10
    assert required_files("a.csv; b.csv;") == ["a.csv", "b.csv"]


def test_width_profile_measures_every_column(spark):
    df = spark.createDataFrame([("x", "y" * 500, "z"), (None, None, None)], "Aa string, Middle string, c string")
    measured = profile.width_profile(df)
    assert rows(measured) == [(1, "aa", 202), (2, "middle", 500), (3, "c", 201)]
    assert rows(profile.width_profile(df.limit(0))) == [(1, "aa", 202), (2, "middle", 206), (3, "c", 201)]
    schema = profile.staging_schema(measured)
    assert [(f.name, f.metadata["max_len"]) for f in schema] == [("aa", 202), ("middle", 500), ("c", 201)]


def test_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1)], "a int, b int")
    assert rows(profile.key_violations(df, ["a", "b"])) == [(1, 1, 2, "duplicate"), (None, 1, 1, "null")]


def test_any_rows(spark):
    assert profile.any_rows(spark.range(3)) and not profile.any_rows(spark.range(0))


def test_clean_for_load(spark):
    from pyspark.sql import types as T

    schema = T.StructType([
        T.StructField("a", T.StringType(), True, {"max_len": 4}), T.StructField("t", T.StringType(), True, {"max_len": 30}),
    ])
    df = spark.createDataFrame([("ab�defg", "01/31/2024 12:00:00 PM  "), (None, None)], "a string, t string")
    assert rows(load.clean_for_load(df, schema, ["t"])) == [("ab d", dt.datetime(2024, 1, 31, 12)), (None, None)]
    assert load.clean_for_load(df, schema, ["t"]).schema["a"].metadata == {"max_len": 4}


def test_column_report_threshold_and_nulls(spark):
    items = [("x@y.org", None)] + [("none", None)] * 9
    df = spark.createDataFrame(items, "firstName string, empty string")
    report = privacy.column_report(df, privacy.entities_of("universal"))
    found = {(r.column_name, r.entity): (r.matched, r.non_null, r.rate, r.flagged) for r in report.collect()}
    assert found[("firstName", "email")] == (1, 10, 0.1, True)
    assert found[("firstName", "person_name")] == (10, 10, 1.0, True)
    assert found[("empty", "email")] == (0, 0, 0.0, False)
    assert privacy.flagged_columns(report) == ["firstName"]
    strict = privacy.column_report(df, privacy.entities_of("universal"), threshold=0.11)
    assert strict.where("entity = 'email' AND flagged").count() == 0


def test_categories():
    assert {e.name for e in privacy.entities_of("networking")} == {"ip_v4", "mac_address"}
    assert [e.name for e in privacy.entities_of("custom", {"badge": "B[0-9]+"})] == ["badge"]
    with pytest.raises(ValueError, match="nope"):
        privacy.entities_of("universal,nope")


def test_mask_and_hash(spark):
    cells = ["mail a@b.org, card 4111111111111111 and 4111111111111112, ip 10.0.0.1", "plain", None]
    df = spark.createDataFrame([(c,) for c in cells], "t string")
    masked = privacy.mask_columns(df, ["t"], privacy.entities_of("universal,networking"))
    assert rows(masked) == sorted([
        ("mail [EMAIL], card [CARD_NUMBER] and 4111111111111112, ip [IP_V4]",), ("plain",), (None,)], key=repr)
    hashed = privacy.hash_columns(df.where("t = 'plain'"), ["t"]).first().t
    assert re.fullmatch("[0-9a-f]{64}", hashed)
    custom = [Entity("badge", "custom", "B[0-9]+")]
    assert privacy.mask_columns(spark.createDataFrame([("xB12y",)], "t string"), ["t"], custom).first().t == "x[BADGE]y"


def test_zones_split_every_row_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "a@b.org", None), (2, None, None), (3, "x", "10.0.0.1")], "id int, a string, b string")
    zoned = privacy.zoned(df, ["a", "b"], privacy.entities_of("universal,networking"))
    privacy.write_zones(zoned, f"{tmp_path}/z")
    assert rows(spark.read.parquet(f"{tmp_path}/z/zone=quarantine").select("id")) == [(1,), (3,)]
    assert rows(spark.read.parquet(f"{tmp_path}/z/zone=clean").select("id")) == [(2,)]


def test_sampling(spark):
    df = spark.range(1000)
    assert privacy.sampled(df, "id") is df
    part = privacy.sampled(df, "id", 0.5)
    assert 300 < part.count() < 700 and rows(part) == rows(privacy.sampled(df, "id", 0.5))


WORDS = "the of apple pear plum fig Äpfel 42 kiwi lemon".split()


def corpus():
    random.seed(9)
    texts = {i: " ".join(random.choice(WORDS[: 2 + i % 9]) for _ in range(random.randrange(0, 40))) for i in range(80)}
    texts[80] = texts[81] = "fig fig plum"
    texts[82] = None
    questions = {1: "The FIG, the plum!", 2: "nothing here", 3: None, 4: "äpfel kiwi lemon 42"}
    return texts, questions


def brute_force(texts, questions, k):
    split = lambda t: re.findall(r"\w+", (t or "").lower())
    docs = {d: Counter(split(t)) for d, t in texts.items()}
    average = sum(sum(c.values()) for c in docs.values()) / len(docs)
    ranked = []
    for q, text in questions.items():
        totals = Counter()
        for term in set(split(text)):
            df = sum(term in c for c in docs.values())
            for d, c in docs.items():
                if term in c:
                    idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                    norm = 1.2 * (1 - 0.75 + 0.75 * sum(c.values()) / average)
                    totals[d] += math.floor(idf * c[term] * 2.2 / (c[term] + norm) * 1e8 + 0.5)
        best = sorted(totals.items(), key=lambda x: (-x[1], x[0]))[:k]
        ranked += [(q, n, d) for n, (d, _) in enumerate(best, start=1)]
    return ranked


@pytest.mark.parametrize("broadcast_bytes", ["10MB", "-1"])
def test_retrieval_against_brute_force(spark, tmp_path, broadcast_bytes):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_bytes)
    try:
        _retrieval_agrees(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _retrieval_agrees(spark, tmp_path):
    texts, questions = corpus()
    documents = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    asked = spark.createDataFrame(list(questions.items()), "query_id bigint, question string")
    retrieval.write_index(documents, f"{tmp_path}/ix")
    index = retrieval.open_index(spark, f"{tmp_path}/ix")
    got = retrieval.retrieve(index, asked, 6)
    assert rows(got.select("query_id", "rank", "doc_id")) == sorted(brute_force(texts, questions, 6), key=repr)
    prompts = {r.query_id: r for r in retrieval.assemble_prompts(got, documents, asked).collect()}
    assert prompts[2].source_documents == [] and "Context:\n\n" in prompts[2].prompt
    assert "fig fig plum" in prompts[1].prompt and retrieval.NO_ANSWER in prompts[1].prompt
    assert len(prompts) == 4


def test_a_search_reads_the_folders_of_its_terms(spark, tmp_path):
    texts, _ = corpus()
    documents = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    retrieval.write_index(documents, f"{tmp_path}/ix")
    asked = spark.createDataFrame([(1, "fig")], "query_id bigint, question string")
    found = retrieval.retrieve(retrieval.open_index(spark, f"{tmp_path}/ix"), asked, 6)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 6
    assert re.search(r"PartitionFilters: \[(isnotnull\(part#\d+\), )?\(?part#\d+ (IN|=)", plan)


def posting_bytes(path):
    return {str(p): p.stat().st_size for p in Path(path).rglob("*.parquet") if "/postings/" in str(p)}


def test_an_index_grows_by_segments_and_forgets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(retrieval, "SMALL_CHARS", 4000)
    random_ = random.Random(3)
    words = [f"w{int(random_.expovariate(0.02))}" for _ in range(30_000)]
    texts = [(n, " ".join(words[20 * n : 20 * n + 20])) for n in range(1200)] + [(5000, None), (None, "w1 w2")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    asked = spark.createDataFrame([(q, " ".join(random_.choices(words, k=4))) for q in range(30)], "query_id bigint, question string")

    def found(path):
        index = retrieval.open_index(spark, path)
        return index, rows(retrieval.retrieve(index, asked, 10))

    def same(path, wanted):
        retrieval.write_index(wanted, f"{tmp_path}/full")
        (got, hits), (want, all_hits) = found(path), found(f"{tmp_path}/full")
        assert hits == all_hits and len(hits) > 100
        assert (got.documents, round(got.average_length, 9)) == (want.documents, round(want.average_length, 9))
        assert rows(got.terms) == rows(want.terms)

    path = f"{tmp_path}/ix"
    first = docs.where("doc_id IS NULL OR doc_id >= 12")
    retrieval.write_index(first, path)
    assert retrieval.segments(spark, path)[0].parts > 10
    before = posting_bytes(path)
    retrieval.add_documents(docs.where("doc_id < 12"), path)
    after = posting_bytes(path)
    assert before.items() <= after.items()
    count = lambda name: spark.read.parquet(f"{name}/postings").count()
    old, new = retrieval.segments(spark, path)
    assert count(new.path) < 0.02 * count(old.path)
    same(path, docs)
    gone = spark.createDataFrame([(3,), (700,), (5000,), (None,), (99999,)], "doc_id bigint")
    retrieval.delete_documents(gone, path)
    assert posting_bytes(path) == after
    left = docs.where("doc_id NOT IN (3, 700, 5000)")
    same(path, left)
    retrieval.delete_documents(gone, path)
    retrieval.add_documents(docs.where("doc_id = 700"), path)
    same(path, left.unionByName(docs.where("doc_id = 700")))
    assert not retrieval.merge_segments(spark, path, 5)
    for n in range(3):
        retrieval.add_documents(spark.createDataFrame([(7000 + n, "w1 w2 w3")], docs.schema), path)
    more = spark.createDataFrame([(7000 + n, "w1 w2 w3") for n in range(3)], docs.schema)
    assert retrieval.merge_segments(spark, path, 4) and len(retrieval.segments(spark, path)) == 3
    same(path, left.unionByName(docs.where("doc_id = 700")).unionByName(more))


def test_an_index_of_nothing(spark, tmp_path):
    documents = spark.createDataFrame([(1, None), (2, "...")], "doc_id bigint, text string")
    asked = spark.createDataFrame([(1, "fig")], "query_id bigint, question string")
    for number, docs in enumerate((documents, documents.limit(0))):
        retrieval.write_index(docs, f"{tmp_path}/ix{number}")
        index = retrieval.open_index(spark, f"{tmp_path}/ix{number}")
        assert rows(retrieval.retrieve(index, asked, 6)) == []
        assert len(retrieval.assemble_prompts(retrieval.retrieve(index, asked, 6), docs, asked).collect()) == 1


def test_documents_of_a_folder_are_found_by_path(spark, tmp_path):
    from quayside.sources.landing import read_documents

    (tmp_path / "docs").mkdir()
    for name, text in (("a.txt", "fig plum"), ("b.txt", "kiwi")):
        (tmp_path / "docs" / name).write_text(text)
    docs = read_documents(spark, f"{tmp_path}/docs")
    key = docs.columns[0]
    asked = spark.createDataFrame([(1, "a fig"), (2, "nothing")], "query_id bigint, question string")
    retrieval.write_index(docs, f"{tmp_path}/ix", key)
    found = retrieval.retrieve(retrieval.open_index(spark, f"{tmp_path}/ix"), asked, 3)
    prompts = {r.query_id: r for r in retrieval.assemble_prompts(found, docs, asked, doc_id=key).collect()}
    assert prompts[1].source_documents[0].endswith("a.txt") and prompts[2].source_documents == []


def test_term_index_counts(spark):
    df = spark.createDataFrame([(1, "b a, B! a a"), (2, ""), (3, None), (4, "...")], "doc_id bigint, text string")
    assert rows(retrieval.term_index(df)) == [("a", 1, 3, 5), ("b", 1, 2, 5)]
    assert rows(retrieval.term_stats(retrieval.term_index(df))) == [("a", 1, 3), ("b", 1, 2)]


def test_tasks_of_a_search_follow_its_pairs(spark, tmp_path, monkeypatch):
    from quayside.operators import retrieval

    documents = spark.createDataFrame([(n, f"common w{n % 9} rare{n}") for n in range(300)], "doc_id long, text string")
    asked = spark.createDataFrame([(q, f"common w{q}") for q in range(9)], "query_id long, question string")
    retrieval.write_index(documents, f"{tmp_path}/ix")
    index = retrieval.open_index(spark, f"{tmp_path}/ix")
    whole = sorted(retrieval.retrieve(index, asked, 4).collect())
    monkeypatch.setattr(retrieval, "PAIRS", 100)
    few = retrieval.retrieve(index, asked, 4)
    # 2,700 pairs of question and document, at most 100 in a task; a number that adaptive execution leaves alone.
    assert re.search(r"hashpartitioning\(doc_id#\d+L, 27\), REPARTITION_BY_NUM", few._jdf.queryExecution().executedPlan().toString())
    assert sorted(few.collect()) == whole and len(whole) == 36
