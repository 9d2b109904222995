"""Text, name and time functions on hand-written and generated values."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.functions import names, text, times
from quayside.functions.patterns import card_numbers, has_entity, passes_luhn
from quayside.operators.privacy import entities_of

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def values(spark, items, expr, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clean_file_name(spark):
    given_names = ["CertifiedUsers - 03-29-2023.csv", "courses.csv", "Courses.CSV", " tracks \t- x", "", "a.b", None]
    wanted = ["certifiedusers.csv", "courses.csv", "courses.csv", "tracks.csv", ".csv", "a.b.csv", None]
    assert values(spark, given_names, names.clean_file_name) == wanted
    kept = values(spark, given_names[:3], lambda c: names.clean_file_name(c, lower=False))
    assert kept == ["CertifiedUsers.csv", "courses.csv", "Courses.csv"]
    assert values(spark, ["", ".csv", "x.csv"], names.is_blank_name) == [True, True, False]


@SLOW
@given(st.lists(st.text(alphabet="abC .-\tcsv", max_size=12), min_size=1, max_size=40))
def test_clean_file_name_is_idempotent(spark, items):
    once = values(spark, items, names.clean_file_name)
    assert values(spark, once, names.clean_file_name) == once


def test_path_parts(spark):
    paths = ["a/b/c.tar.gz", "c", "a/b/", None]
    assert values(spark, paths, names.base_name) == ["c.tar.gz", "c", "", None]
    assert values(spark, paths, lambda c: names.path_level(c, 1)) == ["b", None, "b", None]
    assert values(spark, paths, names.stem) == ["c", "c", "", None]


def moment(text_value):
    return dt.datetime.fromisoformat(text_value)


def test_round_to_minute_ties_go_to_even(spark):
    items = ["2024-01-01 10:00:29.999999", "2024-01-01 10:02:30", "2024-01-01 10:03:30", "2024-01-01 10:00:59", "2024-12-31 23:59:30", "1969-12-31 23:58:30"]
    wanted = ["2024-01-01 10:00:00", "2024-01-01 10:02:00", "2024-01-01 10:04:00", "2024-01-01 10:01:00", "2025-01-01 00:00:00", "1969-12-31 23:58:00"]
    got = values(spark, [moment(i) for i in items] + [None], times.round_to_minute, "timestamp_ntz")
    assert got == [moment(w) for w in wanted] + [None]


@SLOW
@given(st.lists(st.integers(0, 4 * 10**15), min_size=1, max_size=50))
def test_round_to_minute_is_half_even(spark, micros):
    start = dt.datetime(1970, 1, 1)
    items = [start + dt.timedelta(microseconds=m) for m in micros]

    def rounded(m):
        whole, rest = divmod(m, 60_000_000)
        up = rest > 30_000_000 or (rest == 30_000_000 and whole % 2 == 1)
        return start + dt.timedelta(minutes=whole + up)

    assert values(spark, items, times.round_to_minute, "timestamp_ntz") == [rounded(m) for m in micros]


def test_twelve_hour_times(spark):
    items = ["01/31/2024 12:00:00 AM", "01/31/2024 12:00:00 PM", "12/01/2023 01:02:03 PM", "2024-01-31", "", None]
    assert values(spark, items, times.parse_twelve_hour) == [
        dt.datetime(2024, 1, 31), dt.datetime(2024, 1, 31, 12), dt.datetime(2023, 12, 1, 13, 2, 3), None, None, None,
    ]


def test_folders_and_days(spark):
    item = [dt.datetime(2024, 3, 1, 5, 59, 59)]
    assert values(spark, item, times.day_folder, "timestamp_ntz") == ["20240301"]
    assert values(spark, item, times.dashed_day, "timestamp_ntz") == ["2024-03-01"]
    assert values(spark, item, times.hour_folder, "timestamp_ntz") == ["2024/03/01/05"]
    assert values(spark, ["x"], lambda c: times.days_before("2024-03-01", 30)) == [dt.date(2024, 1, 31)]


@SLOW
@given(st.lists(st.text(max_size=12), min_size=1, max_size=30), st.integers(0, 16))
def test_byte_width_never_splits_a_character(spark, items, width):
    items = [i.encode("utf-8", "ignore").decode() for i in items]
    got = values(spark, items, lambda c: text.truncate(c, width, "bytes"))
    assert got == [i.encode()[:width].decode("utf-8", "ignore") for i in items]


def test_load_text(spark):
    assert values(spark, [" a  ", "b\t", None], text.trim_blanks) == [" a", "b\t", None]
    assert values(spark, ["aé€", "ab", None], lambda c: text.truncate(c, 2)) == ["aé", "ab", None]
    df = spark.createDataFrame([(bytearray(b"a\xffb\xc3"),)], "b binary")
    assert df.select(text.replace_invalid(F.col("b").cast("string")).alias("t")).first().t == "a b "


def test_codec(spark):
    items = ["", "é", "x" * 200, None]
    encoded = values(spark, items, text.encode_base64)
    assert encoded[:2] == ["", "w6k="] and "\n" not in encoded[2] and encoded[3] is None
    assert values(spark, encoded, text.decode_base64) == items
    assert values(spark, ["***"], text.decode_base64) == [None]


def test_templates(spark):
    filled = lambda c: text.fill_template("{a}/{b}/{a}", {"a": c, "b": F.lit("{a}")})
    assert values(spark, ["x", None], filled) == ["x/{a}/x", "/{a}/"]
    column = lambda c: text.fill_template(c, {"day": "20240131"})
    assert values(spark, ["in/{day}/", "{Day}", None], column) == ["in/20240131/", "{Day}", None]


def test_small_text(spark):
    assert values(spark, ["", "a", None], text.blank) == [True, False, True]
    assert values(spark, ["load_all_x"], text.label) == ["LOAD ALL X"]
    assert values(spark, ["False", "true", "0", "maybe", None], text.as_boolean) == [False, True, False, None, None]
    link = '<a target="_blank" href="h?a=1&amp;b=&quot;">LINK</a>'
    assert values(spark, ['h?a=1&b="', None], text.hyperlink) == [link, None]
    assert len(set(values(spark, ["a", "b"], lambda c: text.random_id()))) == 2


@SLOW
@given(st.lists(st.integers(-10**15, 10**15).map(lambda n: n / 100), min_size=1, max_size=60))
def test_number_text_is_plain(spark, items):
    assert values(spark, items, text.number_text, "double") == [repr(i) for i in items]


@SLOW
@given(st.lists(st.one_of(st.floats(), st.floats(1e-6, 1e-2), st.floats(1e15, 1e18)), min_size=1, max_size=60))
def test_number_text_reads_back(spark, items):
    got = values(spark, items, text.number_text, "double")
    assert [repr(float(g)) for g in got] == [repr(i) for i in items]


def test_number_text_exponents(spark):
    items = [1e16, 1.5e-5, 1e-4, 123456789012.25, -2.5e100, 0.0, -0.0, None]
    wanted = ["1e+16", "1.5e-05", "0.0001", "123456789012.25", "-2.5e+100", "0.0", "-0.0", None]
    assert values(spark, items, text.number_text, "double") == wanted


def test_luhn(spark):
    digits = ["4111111111111111", "4111111111111112", "378282246310005", "0"]
    assert values(spark, digits, passes_luhn) == [True, False, True, True]


def test_card_numbers(spark):
    cells = [
        "a 4111111111111111 b", "4111-1111-1111-1111", "4111 1111 1111 1112", "411111111111111111111",
        "4111111111111111,378282246310005", "", None,
    ]
    assert values(spark, cells, card_numbers) == [
        ["4111111111111111"], ["4111-1111-1111-1111"], [], [], ["4111111111111111", "378282246310005"], [], [],
    ]


def test_entities(spark):
    cases = {
        "email": ("write to a.b@c.org now", "a@b"),
        "ip_v4": ("from 10.0.0.255.", "1.2.3"),
        "mac_address": ("00:1B:44:11:3a:b7", "00:1B:44:11:3a"),
        "us_ssn": ("123-45-6789", "123-456-789"),
        "us_phone": ("+1 (743) 555-3824", "555-3824"),
        "us_driver_licence": ("D1234567", "d1234567"),
        "medicare_beneficiary": ("1EG4-TE5-MK73", "1EG4-TE5-MK7"),
    }
    known = {e.name: e for e in entities_of()}
    for name, (hit, miss) in cases.items():
        found = values(spark, [hit, miss, None], lambda c, n=name: has_entity(c, known[n]))
        assert found == [True, False, None], name
