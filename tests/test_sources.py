"""Readers on hand-written files."""

import datetime as dt
import gzip
import json
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside import workspace
from quayside.sources import clickstream, delimited, items, landing, payloads, tables


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content) if isinstance(content, str) else path.write_bytes(content)
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_header_csv_is_all_text(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'Id,Name\n1,"a, ""b"""\n,\n')
    df = delimited.read_header_csv(spark, path)
    assert df.dtypes == [("Id", "string"), ("Name", "string")]
    assert rows(df) == [("1", 'a, "b"'), (None, None)]


def test_typed_csv_modes(spark, tmp_path):
    path = put(tmp_path / "a.csv", "x,y\n1,a\nbad,b\n")
    with pytest.raises(Exception, match="bad"):
        delimited.read_typed_csv(spark, path, "x int, y string").collect()
    kept = delimited.read_typed_csv(spark, path, "x int, y string", mode="PERMISSIVE")
    assert rows(kept) == [(1, "a"), (None, "b")]


def test_typed_csv_keeps_line_breaks(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'x,y\n1,"a\nb"\n')
    assert rows(delimited.read_typed_csv(spark, path, "x int, y string")) == [(1, "a\nb")]


def test_split_files_where_cells_stay_on_a_line(spark, tmp_path):
    plain = put(tmp_path / "plain.csv", "x,y\n" + "".join(f'{i},"a ""{i}"""\n' for i in range(2000)))
    broken = put(tmp_path / "broken.csv", 'x,y\n1,"a\n\nb"\n2,c\n')
    assert rows(delimited.read_header_csv(spark, broken)) == [("1", "a\n\nb"), ("2", "c")]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key in before:
            spark.conf.set(key, "4096")
        split = delimited.read_typed_csv(spark, plain, "x int, y string", multi_line=False)
        assert split.rdd.getNumPartitions() > 3 and split.count() == 2000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_misfit_rows_and_headers_stop_the_read(spark, tmp_path):
    extra = put(tmp_path / "extra.csv", "id,name\n1,x,EXTRA\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        delimited.read_header_csv(spark, extra).select("id").collect()
    assert rows(delimited.read_header_csv(spark, extra, mode="PERMISSIVE")) == [("1", "x")]
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        delimited.import_mapped_csv(spark, extra, "id int").collect()
    put(tmp_path / "parts" / "a.csv", "id,name\n1,x\n")
    put(tmp_path / "parts" / "b.csv", "name,id\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        delimited.read_header_csv(spark, str(tmp_path / "parts")).collect()


def test_broken_items_stop_the_read(spark, tmp_path):
    path = put(tmp_path / "items.json", '{"id":{"N":"7"},"ok":{"NULL":true}}\n')
    assert rows(items.read_items_export(spark, path, {"id": "int", "ok": "boolean"})) == [(7, None)]
    for line in ('{"id":{"N":"abc"}}', "no json"):
        broken = put(tmp_path / "broken.json", line + "\n")
        with pytest.raises(Exception):
            items.read_items_export(spark, broken, {"id": "int"}).collect()
        assert rows(items.read_items_export(spark, broken, {"id": "int"}, "PERMISSIVE")) == [(None,)]
    envelope = put(tmp_path / "env.json", '{"items":[{"id":1}]}\n{"items":[{"id":\n')
    with pytest.raises(Exception):
        payloads.read_items(spark, envelope, "id bigint").collect()


def test_scripts_of_several_statements(spark, tmp_path):
    script = "-- load; this\nCREATE OR REPLACE TEMP VIEW s2 AS SELECT '{day};' AS a; SELECT a FROM s2;"
    found = tables.run_scripts(spark, [script, "/* nothing; yet */"], folders={"day": "2024/01"})
    assert rows(found[-1]) == [("2024/01;",)] and len(found) == 2


def test_mapped_import(spark, tmp_path):
    path = put(tmp_path / "a.csv", "NAME,Number,Id,extra\nann,5,1,z\n,,2,z\n")
    df = delimited.import_mapped_csv(spark, path, "id int, name string, phone int", {"phone": "Number"})
    assert rows(df) == [(1, "ann", 5), (2, None, None)]
    broken = put(tmp_path / "b.csv", "id\nx\n")
    with pytest.raises(Exception, match="not a int: x"):
        delimited.import_mapped_csv(spark, broken, "id int").collect()


def test_json_table_modes(spark, tmp_path):
    path = put(tmp_path / "a.json", '{"element_clicked":"b","time_spent":3,"other":1}\nnot json\n')
    df = clickstream.read_json_table(spark, path, mode="PERMISSIVE")
    assert rows(df) == [("b", 3, None, None), (None, None, None, None)]
    with pytest.raises(Exception, match="(?i)malformed"):
        clickstream.read_json_table(spark, path).collect()


def hour_tree(tmp_path):
    for hour in ("2024/01/01/22", "2024/01/01/23", "2024/01/02/00", "2024/02/01/05"):
        put(tmp_path / hour / "batch-1" / "part-0.json", f'{{"element_clicked":"{hour}","time_spent":1}}\n')
    return str(tmp_path)


def test_a_broken_line_stops_the_hours(spark, tmp_path):
    root = hour_tree(tmp_path)
    put(tmp_path / "2024/01/02/00" / "batch-1" / "part-1.json", "not json\n")
    day = (dt.datetime(2024, 1, 2, 0), dt.datetime(2024, 1, 2, 1))
    with pytest.raises(Exception, match="(?i)malformed"):
        clickstream.read_hours(spark, root, *day).collect()
    kept = clickstream.read_hours(spark, root, *day, mode="PERMISSIVE").select("element_clicked")
    assert rows(kept) == sorted([("2024/01/02/00",), (None,)], key=repr)


def test_hours_are_found_by_range(spark, tmp_path):
    root = hour_tree(tmp_path)
    day = dt.datetime(2024, 1, 1, 23, 30)
    found = clickstream.read_hours(spark, root, day, day + dt.timedelta(hours=1))
    assert rows(found.select("element_clicked", "datehour")) == [
        ("2024/01/01/23", "2024/01/01/23"), ("2024/01/02/00", "2024/01/02/00"),
    ]
    whole = clickstream.hour_paths(spark, root, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 23))
    assert [p.rsplit("/2024/", 1)[1] for p in whole] == ["01/01", "01/02"]
    assert clickstream.read_hours(spark, root, dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 2)).count() == 0


def files_read(df):
    """Files that the scan opened, by its own count, once it has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().apply("numFiles").value()


@pytest.mark.parametrize("condition, hours", [
    ("datehour BETWEEN '2024/01/01/23' AND '2024/01/02/00'", 2), ("datehour IN ('2024/02/01/05', '1999/01/01/00')", 1),
    ("datehour LIKE '2024/01/%' AND time_spent > 0", 3), ("substr(datehour, 12) = '05' OR datehour < '2024/01/01/23'", 2), ("true", 4),
])
def test_a_filter_on_the_hour_opens_only_its_files(spark, tmp_path, condition, hours):
    put(tmp_path / "other" / "part-9.json", '{"element_clicked":"no hour","time_spent":1}\n')
    found = clickstream.hour_table(spark, hour_tree(tmp_path)).where(condition)
    assert files_read(found) == hours
    assert all(r.element_clicked == r.datehour for r in found.collect()) and found.count() == hours


def test_open_range_ends_now(spark, tmp_path):
    hours = clickstream.hours_between(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(hours=2))
    assert len(hours) == 3
    assert clickstream.read_hours(spark, hour_tree(tmp_path), dt.datetime(2024, 1, 2)).count() == 2


def test_hour_paths_leave_other_hours_alone(spark, tmp_path):
    root = hour_tree(tmp_path)
    paths = clickstream.hour_paths(spark, root, dt.datetime(2024, 1, 1, 22), dt.datetime(2024, 1, 1, 22))
    assert len(paths) == 1 and paths[0].endswith("2024/01/01/22")


def test_envelope(spark, tmp_path):
    lines = [{"items": [{"id": 1, "a": "x"}, {"id": 2}]}, {"items": []}, {"message": "none"}, {"items": [{"id": 3, "b": 4}]}]
    path = put(tmp_path / "e.json", "\n".join(json.dumps(x) for x in lines))
    inferred = payloads.read_items(spark, path)
    assert rows(inferred.select("id", "a", "b")) == [(1, "x", None), (2, None, None), (3, None, 4)]
    declared = payloads.read_items(spark, path, "id bigint, c string")
    assert rows(declared) == [(1, None), (2, None), (3, None)]
    assert payloads.read_items(spark, path, "id bigint", limit=2).count() == 2


def test_envelope_without_any_items(spark, tmp_path):
    path = put(tmp_path / "e.json", '{"message":"none"}\n')
    assert payloads.read_items(spark, path).count() == 0


def test_items_of_column_and_single_quotes(spark):
    df = spark.createDataFrame([(1, "{'items': [{'id': 7}]}"), (2, "{}"), (3, "broken"), (4, None)], "k int, body string")
    assert rows(payloads.items_of(df, "body", "id bigint", "PERMISSIVE")) == [(1, 7)]
    assert rows(payloads.items_of(df.where("k <> 3"), "body", "id bigint")) == [(1, 7)]
    with pytest.raises(Exception):
        payloads.items_of(df, "body", "id bigint").collect()


def test_bare_array(spark, tmp_path):
    path = put(tmp_path / "a.json", '[\n {"Id": 1},\n {"Id": 2, "n": {"x": 3}}\n]')
    assert rows(payloads.read_array(spark, path).select("Id", "n.x")) == [(1, None), (2, 3)]
    lines = put(tmp_path / "l.json", '[{"Id":1},{"Id":2}]\n[{"Id":3}]\n')
    assert rows(payloads.read_array(spark, lines, "Id bigint", multi_line=False)) == [(1,), (2,), (3,)]


def test_item_export_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", True, 2.5), ("2", None, None)], "id string, isActive boolean, n double")
    path = str(tmp_path / "items")
    items.tagged_item(df, {"id": "S", "isActive": "BOOL", "n": "N"}).write.text(path)
    back = items.read_items_export(spark, path, {"id": "string", "isActive": "boolean", "n": "double", "no": "int"})
    assert rows(back) == [("1", True, 2.5, None), ("2", None, None, None)]
    assert '{"id":{"S":"2"}}' in [r.value for r in spark.read.text(path).collect()]


class FakeReader:
    def __init__(self):
        self.options = {}

    def format(self, name):
        self.options["format"] = name
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self.options


class FakeSession:
    read = property(lambda self: FakeReader())


def test_jdbc_options():
    plain = tables.read_jdbc(FakeSession(), "jdbc:x", "t")
    assert plain == {"format": "jdbc", "url": "jdbc:x", "dbtable": "t", "fetchsize": "10000"}
    split = tables.read_jdbc(FakeSession(), "jdbc:x", "t", "id", 1, 100, 4, {"user": "u"})
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "100", "4")
    with pytest.raises(ValueError):
        tables.read_jdbc(FakeSession(), "jdbc:x", "t", "id")


def test_table_list_skips_blanks(spark, tmp_path):
    path = put(tmp_path / "tables.csv", "Tables,note\nregion,a\n ,b\nnation,c\n")
    assert tables.table_list(spark, path) == ["region", "nation"]


def test_a_crawl_reads_all_parts(spark, tmp_path):
    for n, name in enumerate(("only0", "only1", "only2")):
        spark.range(3).select(F.col("id").alias("a"), F.lit(n).alias(name)).write.mode("append").parquet(f"{tmp_path}/one/t")
    found = tables.crawl(spark, f"{tmp_path}/one").collect()
    assert found[0].column_name == "a" and {r.column_name for r in found} == {"a", "only0", "only1", "only2"}
    assert tables.crawl_changes(tables.crawl(spark, f"{tmp_path}/one"), tables.crawl(spark, f"{tmp_path}/one")).count() == 0
    spark.createDataFrame([("x",)], "a string").write.mode("append").parquet(f"{tmp_path}/one/t")
    with pytest.raises(Exception, match="MERGE_SCHEMA"):
        tables.crawl(spark, f"{tmp_path}/one")


def test_document_ids_are_the_paths_of_the_listing(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    for name in ("a b.txt", "c%20d.txt", "e+é.txt"):
        (tmp_path / "docs" / name).write_text("x")
    ids = {r.doc_id for r in landing.read_documents(spark, f"{tmp_path}/docs").collect()}
    assert ids == {r.path for r in landing.list_files(spark, f"{tmp_path}/docs").collect()} and len(ids) == 3


def test_crawl_reports_and_alters_nothing(spark, tmp_path):
    spark.range(1).selectExpr("id", "cast(id as int) n").write.parquet(f"{tmp_path}/one/t")
    spark.range(1).selectExpr("cast(id as string) id", "1.5D as d").write.parquet(f"{tmp_path}/two/t")
    before, after = tables.crawl(spark, f"{tmp_path}/one"), tables.crawl(spark, f"{tmp_path}/two")
    assert rows(before) == [("t", 1, "id", "bigint"), ("t", 2, "n", "int")]
    assert rows(tables.crawl_changes(before, after).select("column_name", "change")) == [
        ("d", "added"), ("id", "retyped"), ("n", "removed"),
    ]
    assert tables.crawl_changes(before, before).count() == 0


def test_queries_and_scripts(spark):
    spark.range(5).createOrReplaceTempView("five")
    assert tables.run_query(spark, "SELECT id FROM five WHERE id >= :low", low=3).count() == 2
    done = tables.run_scripts(spark, ["CREATE OR REPLACE TEMP VIEW s AS SELECT 1 AS a", "SELECT a + :n AS b FROM s"], {"n": 2})
    assert done[-1].first().b == 3
    assert tables.read_table(spark, "", "", "five").count() == 5


def test_file_listing_and_filters(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", "x\n")
    put(tmp_path / "in" / "sub" / "b.txt", "yy\n")
    found = landing.list_files(spark, f"{tmp_path}/in")
    assert sorted(r.size for r in found.collect()) == [2, 3]
    assert landing.list_files(spark, f"{tmp_path}/in", "*.csv").count() == 1
    prefix = workspace.qualified(spark, f"{tmp_path}/in/sub")
    assert landing.with_prefix_suffix(found, "path", prefix, ".txt").count() == 1


def test_documents_below_prefix(spark, tmp_path):
    put(tmp_path / "docs" / "a.txt", "one\ntwo\n")
    put(tmp_path / "other" / "b.txt", "no")
    found = landing.read_documents(spark, str(tmp_path), "docs").select("text", F.col("doc_id").endswith("a.txt"))
    assert rows(found) == [("one\ntwo\n", True)]


def texts(df):
    return rows(df.select("doc_id", F.col("text").cast("binary")))


def test_documents_read_by_tasks_are_those_of_sparks_reader(spark, tmp_path):
    """Names, hidden and empty files, links, bytes that are no text, packed files and Hadoop's checksums."""
    top = tmp_path / "d [x] {y} +%20é"
    names = (
        "a.txt _hidden.txt .dot _k=1.txt _metadata x._COPYING_ sub/deep/b.txt _sub/c.txt _sub=1/c.txt _metadata_of/d.txt "
        ".sub/e.txt y._COPYING_/f.txt doc_id=3/part-0.txt pl+us/pe%20r/ü😀.txt q?h#;&=.txt br[1]{2}*.txt"
    ).split()
    for n, name in enumerate([*names, "sp ace/l\nf.txt"]):
        put(top / name, f"{n}\né\r\n")
    put(top / "empty.txt", "")
    put(top / "bytes.txt", b"\xef\xbb\xbf\xff\x00\xc3")
    for name in ("z.gz", "br [1]/Z.txt.GZ"):
        put(top / name, gzip.compress(b"packed"))
    (top / "nothing").symlink_to("nowhere")
    (top / "linked").symlink_to(top / "sub")
    spark.range(300).selectExpr("repeat(id, 9)").coalesce(1).write.text(f"{tmp_path}/by-spark")
    (tmp_path / "none").mkdir()
    at = workspace.literal(str(top))
    wanted = {at: 14, f"{at}/*": 17, f"{at}/{{sub,doc_id=3}}": 2, f"{at}/a.txt": 1, f"{tmp_path}/by-spark": 1, f"{tmp_path}/none": 0}
    for place, number in wanted.items():
        found = texts(landing.read_documents(spark, place))
        assert found == texts(landing._read_with_spark(spark, place)) and len(found) == number
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landing.read_documents(spark, f"{tmp_path}/not-there")


def test_the_driver_holds_no_list_of_the_documents(spark, tmp_path, monkeypatch):
    from quayside.plans.retrieval import doc_folder_scan

    documents = spark.range(90).selectExpr("id doc_id", "nullif(concat('text ', id), 'text 7') text")
    documents.coalesce(1).write.parquet(f"{tmp_path}/in/documents.parquet")
    scanned = doc_folder_scan(spark, f"{tmp_path}/in")
    assert len(scanned.inputFiles()) < 20 and not any("doc_id=" in name for name in scanned.inputFiles())
    want = documents.selectExpr("doc_id", "sha2(coalesce(text, '') || chr(10), 256)")
    assert rows(scanned) == rows(want)
    for n in range(90):
        put(tmp_path / f"docs/{n % 9}/{n}.txt", "x" * (n + 1))
    monkeypatch.setattr(landing, "PATHS", 10)
    found = landing.read_documents(spark, f"{tmp_path}/docs")
    assert len(found.inputFiles()) < 20
    # Nine tasks for 90 files, ten each, a number that adaptive execution leaves alone.
    assert re.search(r"hashpartitioning\(path#\d+, 9\), REPARTITION_BY_NUM", found._jdf.queryExecution().executedPlan().toString())
    assert sorted(len(r.text) for r in found.collect()) == [*range(1, 91)]


def test_documents_stop_on_a_wrong_checksum(spark, tmp_path):
    spark.range(300).selectExpr("repeat(id, 9)").coalesce(1).write.text(f"{tmp_path}/docs")
    part = next((tmp_path / "docs").glob("part-*"))
    part.write_bytes(part.read_bytes().replace(b"7", b"8"))
    with pytest.raises(Exception, match="checksum error"):
        landing.read_documents(spark, f"{tmp_path}/docs").collect()


def test_a_sample_of_documents_reads_one_file(tmp_path):
    (tmp_path / "a.txt").write_text("one")
    paths = pa.array([f"{tmp_path}/{name}".encode() for name in ("a.txt", "gone.txt")], pa.binary())
    read = landing._read(iter([pa.RecordBatch.from_arrays([paths], ["path"])]))
    assert next(read).to_pylist() == [{"doc_id": f"file:{tmp_path}/a.txt", "content": b"one"}]
    with pytest.raises(FileNotFoundError):
        next(read)


def test_release_deletes_only_this_application(spark):
    other = f"{spark.conf.get('spark.checkpoint.dir')}/quayside/other/x"
    mine = workspace.scratch(spark, "mine")
    for path in (other, mine):
        spark.range(1).write.parquet(path)
    workspace.release(spark)
    assert workspace.exists(spark, other) and not workspace.exists(spark, mine)


def test_scratch_comes_from_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = workspace.scratch(spark, "x"), workspace.scratch(spark, "x")
    assert first.startswith(root) and first != second
