"""Streaming jobs: reruns, failures, late files, deletes."""

import datetime as dt
import json
import time
from pathlib import Path

from pyspark.sql import functions as F

import pytest
from quayside.functions.text import decode_base64, encode_base64
from quayside.sinks import keyed
from quayside.streaming.items import put_items
from quayside.sources.clickstream import DELIVERED, read_hive_hours, read_hours, stream_records, to_records
from quayside.sources.delimited import read_header_csv
from quayside.sources.landing import stream_arrivals
from quayside.streaming import arrivals, clickstream, counter
from quayside.streaming import items as items_stream

DAY = dt.date(2024, 1, 31)
FIRST, LAST = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def record(spark, items):
    df = spark.createDataFrame(items, "recordId string, body string, arrival_ts timestamp_ntz")
    return df.select("recordId", encode_base64("body").alias("data"), "arrival_ts")


def click(n, seconds=1):
    return json.dumps({"element_clicked": f"e{n}", "time_spent": seconds, "x": 1})


def at(text):
    return dt.datetime.fromisoformat(text)


ITEMS = [
    ("1", click(1), at("2024-01-01 00:59:59.999999")),
    ("2", click(2), at("2024-01-01 01:00:00")),
    ("3", click(3), at("2024-01-02 23:00:01")),
]
HOURS = [("e1", "2024/01/01/00"), ("e2", "2024/01/01/01"), ("e3", "2024/01/02/23")]


def deliver(spark, root):
    stream = stream_records(spark, f"{root}/in")
    return clickstream.deliver(stream, f"{root}/hours", f"{root}/checkpoint", interval=None)


def delivered(spark, root):
    return rows(read_hours(spark, f"{root}/hours", FIRST, LAST, layout=DELIVERED).select("element_clicked", "datehour"))


def test_transform_keeps_ids_and_adds_a_newline(spark):
    batch = record(spark, [("1", "é", None)]).unionByName(
        spark.createDataFrame([("2", "***", None)], "recordId string, data string, arrival_ts timestamp_ntz"))
    got = clickstream.transform_records(batch).select(
        "recordId", "result", F.coalesce(decode_base64("data"), "data"))
    assert rows(got) == [("1", "Ok", "é\n"), ("2", "ProcessingFailed", "***")]


def test_delivery_buckets_by_arrival_and_does_not_repeat(spark, tmp_path):
    record(spark, ITEMS).write.json(f"{tmp_path}/in")
    deliver(spark, tmp_path)
    assert delivered(spark, tmp_path) == HOURS
    deliver(spark, tmp_path)
    assert delivered(spark, tmp_path) == HOURS
    record(spark, [("4", click(4), at("2024-01-01 01:30:00"))]).write.mode("append").json(f"{tmp_path}/in")
    deliver(spark, tmp_path)
    assert delivered(spark, tmp_path) == sorted([*HOURS, ("e4", "2024/01/01/01")])


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    lines = clickstream.hourly_lines(clickstream.transform_records(record(spark, ITEMS)))
    root = f"{tmp_path}/hours"
    clickstream.write_hour_folders(lines.limit(1), 6, root)
    clickstream.write_hour_folders(lines, 7, root)
    # What a write that was cut off leaves: files in place, and a finished task that no job took over.
    left = Path(root, "_temporary/0/task_1_m_000000/result=Ok/year=2024/month=01/day=01/hour=01/batch=7")
    left.mkdir(parents=True)
    (left / "part-9.txt").write_text(click(9) + "\n")
    clickstream.write_hour_folders(lines, 7, root)
    assert delivered(spark, tmp_path) == sorted([*HOURS, *rows(lines.limit(1).select(F.lit("e1"), F.lit("2024/01/01/00")))])
    assert [p.name for p in Path(root, "_begun").iterdir()] == ["7"]
    assert not Path(root, "_temporary").exists()


def test_delivery_keeps_running_at_an_interval(spark, tmp_path):
    record(spark, ITEMS[:1]).write.json(f"{tmp_path}/in")
    stream = stream_records(spark, f"{tmp_path}/in")
    query = clickstream.deliver(stream, f"{tmp_path}/hours", f"{tmp_path}/checkpoint", interval="1 second")
    try:
        query.processAllAvailable()
        record(spark, ITEMS[1:]).write.mode("append").json(f"{tmp_path}/in")
        query.processAllAvailable()
        assert query.isActive and delivered(spark, tmp_path) == HOURS
    finally:
        query.stop()


def values_below(spark, root):
    if not list(Path(root).glob("result=*")):
        return []
    return sorted(r.value for r in spark.read.option("recursiveFileLookup", True).text(root).collect())


def settled(query, ready, seconds=90):
    """Wait until the query has done what is asked, and fail if it never does."""
    end = time.time() + seconds
    while not ready():
        if query.exception() or time.time() > end:
            raise AssertionError(query.exception() or "never came")
        time.sleep(0.3)


def test_a_full_buffer_is_written_before_its_time(spark, tmp_path):
    def put(first, n):
        items = [(str(i), click(i), ITEMS[0][2]) for i in range(first, first + n)]
        record(spark, items).coalesce(1).write.mode("append").json(f"{tmp_path}/in")

    def run(seconds):
        stream = stream_records(spark, f"{tmp_path}/in")
        return clickstream.deliver_buffered(
            stream, f"{tmp_path}/hours", f"{tmp_path}/checkpoint", 200, seconds, "1 second", 1)

    def there():
        return len(values_below(spark, f"{tmp_path}/hours"))

    put(0, 3)
    query = run(3600)
    try:
        settled(query, lambda: sum(p.numInputRows for p in query.recentProgress) == 3)
        assert there() == 0
        # Lines of 51 or 52 bytes with their ends: four fill a buffer of 200, the others are held back.
        put(3, 3)
        settled(query, lambda: there() == 4)
    finally:
        query.stop()
    # What is held back outlives a restart, and a big delivery leaves in buffers of bounded size.
    put(6, 20)
    query = run(3600)
    try:
        settled(query, lambda: there() == 24)
    finally:
        query.stop()
    assert set(values_below(spark, f"{tmp_path}/hours")) <= {click(i) for i in range(26)}


def test_lines_that_wait_long_enough_are_written(spark, tmp_path):
    record(spark, ITEMS).write.json(f"{tmp_path}/in")
    stream = stream_records(spark, f"{tmp_path}/in")
    query = clickstream.deliver_buffered(stream, f"{tmp_path}/hours", f"{tmp_path}/checkpoint", 10**9, 2, "1 second", 2)
    try:
        settled(query, lambda: len(values_below(spark, f"{tmp_path}/hours")) == 3)
        assert delivered(spark, tmp_path) == HOURS
    finally:
        query.stop()


def test_failed_records_are_kept_apart(spark, tmp_path):
    bad = spark.createDataFrame([("9", "***", ITEMS[0][2])], "recordId string, data string, arrival_ts timestamp_ntz")
    record(spark, ITEMS[:1]).unionByName(bad).write.json(f"{tmp_path}/in")
    deliver(spark, tmp_path)
    assert delivered(spark, tmp_path) == HOURS[:1]
    kept = spark.read.option("recursiveFileLookup", True).text(f"{tmp_path}/hours/result=ProcessingFailed")
    assert rows(kept) == [("***",)]


def test_message_frames_become_records(spark):
    df = spark.createDataFrame([(bytearray(b"k"), bytearray("é".encode()), at("2024-01-01 00:00:00"))],
                               "key binary, value binary, timestamp timestamp_ntz")
    got = to_records(df, "key", "value", "timestamp").first()
    assert (got.recordId, got.data, got.arrival_ts) == ("k", "w6k=", at("2024-01-01 00:00:00"))


def test_hook_is_any_frame_function(spark, tmp_path):
    record(spark, ITEMS).write.json(f"{tmp_path}/in")

    def only_late(df):
        return clickstream.transform_records(df.where("recordId <> '1'"))

    stream = stream_records(spark, f"{tmp_path}/in")
    clickstream.deliver(stream, f"{tmp_path}/hours", f"{tmp_path}/checkpoint", None, only_late)
    assert delivered(spark, tmp_path) == HOURS[1:]


def test_hive_folders_hold_the_same(spark, tmp_path):
    record(spark, ITEMS).write.json(f"{tmp_path}/in")
    for _ in range(2):
        stream = stream_records(spark, f"{tmp_path}/in", max_bytes=1)
        clickstream.deliver_hive(stream, f"{tmp_path}/hours", f"{tmp_path}/checkpoint", interval=None)
    got = read_hive_hours(spark, f"{tmp_path}/hours", FIRST, dt.datetime(2024, 1, 1, 23))
    assert rows(got.select("element_clicked", "datehour")) == HOURS[:2]
    assert {f.split("datehour=")[1][:13] for f in got.inputFiles()} == {"2024-01-01-00", "2024-01-01-01"}


ITEM = "id string, at int, v string"


def state_of(spark, tmp_path, name, columns, keys, buckets=8):
    return keyed.open_table(spark, name, spark.createDataFrame([], columns).schema, keys, f"{tmp_path}/state", buckets)


def test_puts_merge_and_replay(spark, tmp_path):
    state = state_of(spark, tmp_path, "puts_replayed", ITEM, ["id"])

    def put(items):
        spark.createDataFrame(items, ITEM).write.mode("append").json(f"{tmp_path}/in")
        stream = spark.readStream.schema(ITEM).json(f"{tmp_path}/in")
        items_stream.put_items(stream, ["at"], state, f"{tmp_path}/checkpoint")

    put([("a", 5, "x"), ("b", 1, "y"), (None, 1, "n"), ("d", None, "t")])
    put([("a", 4, "late"), ("b", 2, "z"), ("c", 1, "w"), (None, 2, "m"), ("d", None, "u")])
    wanted = sorted([("a", 5, "x"), ("b", 2, "z"), ("c", 1, "w"), (None, 2, "m"), ("d", None, "u")], key=repr)
    assert rows(state.rows(spark)) == wanted
    commits = sorted(Path(tmp_path, "checkpoint", "commits").glob("[0-9]*"))
    commits[-1].unlink()
    commits[-1].with_name(f".{commits[-1].name}.crc").unlink(missing_ok=True)
    put([])
    assert rows(state.rows(spark)) == wanted


def files_of(table, spark):
    return {(path, Path(path.removeprefix("file:")).stat().st_mtime_ns) for path in spark.table(table.name).inputFiles()}


def test_a_batch_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    state = state_of(spark, tmp_path, "puts_touched", ITEM, ["id"], 16)
    items_stream.put_items(landed(spark, tmp_path, [(f"k{n}", 1, "old") for n in range(400)]), ["at"], state, f"{tmp_path}/c")
    before = files_of(state, spark)
    assert len(before) == 16
    items_stream.put_items(landed(spark, tmp_path, [("k7", 2, "new")]), ["at"], state, f"{tmp_path}/c")
    after = files_of(state, spark)
    assert len(before - after) == len(after - before) == 1
    assert rows(state.rows(spark).where("at = 2")) == [("k7", 2, "new")] and state.rows(spark).count() == 400


def landed(spark, tmp_path, items):
    spark.createDataFrame(items, ITEM).write.mode("append").json(f"{tmp_path}/in")
    return spark.readStream.schema(ITEM).json(f"{tmp_path}/in")


def test_a_merge_that_fails_changes_nothing(spark, tmp_path):
    state = state_of(spark, tmp_path, "puts_failed", ITEM, ["id"])
    keyed.merge(state, spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], ITEM))
    bad = spark.range(1).select(F.lit("a").alias("id"), F.lit(2).alias("at"), F.raise_error(F.lit("torn")).cast("string").alias("v"))
    with pytest.raises(Exception, match="torn"):
        keyed.merge(state, bad)
    assert rows(state.rows(spark)) == [("a", 1, "x"), ("b", 1, "y")]


def csv_file(root, name, lines):
    path = Path(root, "raw", name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(["id,name", *lines]) + "\n")
    return path


def test_arrivals_to_parquet_take_each_file_once(spark, tmp_path):
    csv_file(tmp_path, "a.csv", ["1,x"])
    csv_file(tmp_path, "b.txt", ["9,no"])
    for name in ("b.csv", None):
        files = stream_arrivals(spark, f"{tmp_path}/raw", "id int, name string")
        arrivals.to_dated_parquet(files, f"{tmp_path}/out", DAY, f"{tmp_path}/checkpoint")
        if name:
            csv_file(tmp_path, name, ["2,y"])
    assert rows(spark.read.parquet(f"{tmp_path}/out/2024-01-31/*")) == [(1, "x"), (2, "y")]


def test_sources_are_deleted_only_after_their_batch(spark, tmp_path):
    first = csv_file(tmp_path, "a.csv", ["1,x"])

    def ingest():
        files = stream_arrivals(spark, f"{tmp_path}/raw", "id int, name string", delete_after=True, max_files=1)
        arrivals.to_gzip(files, f"{tmp_path}/out", DAY, f"{tmp_path}/checkpoint")

    ingest()
    second = csv_file(tmp_path, "b.csv", ["2,y"])
    ingest()
    third = csv_file(tmp_path, "c.csv", ["3,z"])
    ingest()
    assert rows(read_header_csv(spark, f"{tmp_path}/out/20240131/*")) == [("1", "x"), ("2", "y"), ("3", "z")]
    assert not first.exists() and not second.exists() and not third.exists()


def test_sources_with_odd_names_are_deleted(spark, tmp_path):
    names = ["CertifiedUsers - 03-29-2023.csv", "plain.csv", "a%20b+c.csv", "é[1]#?.csv", "two\nlines.csv"]
    paths = [csv_file(tmp_path, name, [f"{n},x"]) for n, name in enumerate(names)]
    files = stream_arrivals(spark, f"{tmp_path}/raw", "id int, name string", delete_after=True)
    arrivals.to_gzip(files, f"{tmp_path}/out", DAY, f"{tmp_path}/checkpoint")
    assert [r.id for r in read_header_csv(spark, f"{tmp_path}/out/20240131/*").orderBy("id").collect()] == ["0", "1", "2", "3", "4"]
    assert not any(path.exists() for path in paths)


def test_a_delete_that_fails_is_loud(spark, tmp_path, monkeypatch):
    from quayside import workspace

    path = csv_file(tmp_path, "a.csv", ["1,x"])
    monkeypatch.setattr(workspace, "delete", lambda *_: False)
    with pytest.raises(OSError, match="a.csv"):
        workspace.delete_all(spark, [str(path)])
    workspace.delete_all(spark, [f"{path}.gone"])


def test_torn_rows_stop_the_stream_and_keep_the_source(spark, tmp_path):
    path = csv_file(tmp_path, "a.csv", ['1,"x', 'y"'])
    files = stream_arrivals(spark, f"{tmp_path}/raw", "id int, name string", delete_after=True)
    arrivals.to_gzip(files, f"{tmp_path}/out", DAY, f"{tmp_path}/checkpoint")
    assert rows(read_header_csv(spark, f"{tmp_path}/out/20240131/*")) == [("1", "x\ny")] and not path.exists()
    broken = csv_file(tmp_path, "b.csv", ["2,b,extra"])
    with pytest.raises(Exception):
        files = stream_arrivals(spark, f"{tmp_path}/raw", "id int, name string", delete_after=True)
        arrivals.to_gzip(files, f"{tmp_path}/out", DAY, f"{tmp_path}/checkpoint")
    assert broken.exists()


def test_a_table_that_the_catalogue_lost_goes_on_from_its_folders(spark, tmp_path):
    schema = "k string, at int, v string"
    state = state_of(spark, tmp_path, "puts_lost", schema, ["k"], 4)
    keyed.merge(state, spark.createDataFrame([("a", 1, "old"), ("b", 1, "old")], schema))
    keyed.merge(state, spark.createDataFrame([("a", 2, "new"), ("c", 2, "new")], schema))
    unfinished = Path(tmp_path, "state", "load=99999999999999999999-x", f"{keyed.BUCKET}=0")
    unfinished.mkdir(parents=True)
    spark.sql("DROP TABLE puts_lost")
    state = state_of(spark, tmp_path, "puts_lost", schema, ["k"], 4)
    want = [("a", 2, "new"), ("b", 1, "old"), ("c", 2, "new")]
    assert rows(state.rows(spark)) == want
    with pytest.raises(keyed.BucketsDiffer):
        state_of(spark, tmp_path, "puts_lost", schema, ["k"], 5)
    assert rows(keyed.detached(spark, state)) == want and not spark.catalog.tableExists("puts_lost")


def test_counter_keeps_its_total_over_restarts(spark, tmp_path):
    totals = state_of(spark, tmp_path, "totals_kept", "page string, views long", ["page"])
    for n in range(3):
        before = files_of(totals, spark) if n else set()
        pages = [("home",)] * (n + 1) + ([(None,), ("rare",)] if n < 2 else [])
        spark.createDataFrame(pages, "page string").write.mode("append").json(f"{tmp_path}/in")
        visits = spark.readStream.schema("page string").json(f"{tmp_path}/in")
        query = counter.count_visits(visits, "page", totals, f"{tmp_path}/checkpoint")
    assert rows(totals.rows(spark)) == [("home", 6), ("rare", 2), (None, 2)]
    after = files_of(totals, spark)
    assert len(before - after) == len(after - before) == 1
    assert list(Path(tmp_path, "checkpoint", "state").rglob("*.changelog"))
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 3
