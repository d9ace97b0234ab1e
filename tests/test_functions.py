import pytest
from datetime import datetime, timezone

from pyspark.sql import functions as F

from caseflow.functions import instants, text

AS_OF = "2024-01-16 12:00:00"


def one(spark, value, function):
    return spark.createDataFrame([(value,)], "v string").select(
        function(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("raw, expected", [
    ("Tue Oct 31 22:10:47 +0000 2017", "2017-10-31 22:10:47"),
    ("Tue Oct 31 22:10:47 +0530 2017", "2017-10-31 16:40:47"),
    ("Mon Oct 31 22:10:47 +0000 2017", "2017-10-31 22:10:47"),  # not a Monday
    ("Sun Oct 1 02:03:04 +0000 2017", "2017-10-01 02:03:04"),
    ("Sun Oct 01 02:03:04 +0000 2017", "2017-10-01 02:03:04"),
    ("Tue Oct 32 22:10:47 +0000 2017", None),
    ("garbage", None), ("", None), (None, None)])
def test_parse_created_at(spark, raw, expected):
    assert one(spark, raw, lambda v: instants.parse_created_at(v).cast("string")) == expected


@pytest.mark.parametrize("raw, hours", [
    ("2024-01-15 12:00:00.0", 24.0),
    ("2024-01-15 12:00:00.000", 24.0),
    ("2024-01-15T12:00:00", 24.0),
    ("2024-01-15T12:00:00+02:00", 26.0),
    ("2024-01-16 13:00:00.5", -(3600.5 / 3600)),  # in the future
    ("2024-01-15 12:00:00", 0.0),  # this form needs a fraction
    ("soon", 0.0), ("", 0.0), (None, 0.0)])
def test_hours_ago_text(spark, raw, hours):
    assert one(spark, raw, lambda v: instants.hours_ago_text(v, AS_OF)) == pytest.approx(hours)


@pytest.mark.parametrize("as_of", [
    AS_OF, "2024-01-16T12:00:00+00:00", "2024-01-16T14:00:00+02:00", datetime(2024, 1, 16, 12),
    datetime(2024, 1, 16, 12, tzinfo=timezone.utc)])
def test_as_of_forms(spark, as_of):
    assert one(spark, "2024-01-16 11:00:00", lambda v: instants.hours_ago(
        v.cast("timestamp"), as_of)) == 1.0


def test_iso_texts(spark):
    def texts(raw):
        return one(spark, raw, lambda v: F.concat_ws(
            " ", instants.iso_utc(v.cast("timestamp")), instants.iso_offset(v.cast("timestamp"))))
    assert texts("2024-01-02 03:04:05") == "2024-01-02T03:04:05Z 2024-01-02T03:04:05+00:00"
    assert texts("2024-01-02 03:04:05.12") == "2024-01-02T03:04:05Z 2024-01-02T03:04:05.120000+00:00"


@pytest.mark.parametrize("raw, cleaned", [
    ("see HTTP://x.y/z now", "see  now"),
    ("mail a@b.com please", "mail a please"),
    ("ends with #tag", "ends with "),
    ("bare http", "bare http"),
    ("http x", "http x"),
    ("https://a.b next", " next"),
    ("https://a.b\x1cnext @me　you", "\x1cnext 　you"),
    ("#a#b @c", " "),
    ("", ""), (None, None)])
def test_clean(spark, raw, cleaned):
    assert one(spark, raw, text.strip_links_and_tags) == cleaned


def test_strip_is_python_strip(spark):
    raw = " \x1f\n a b  \t"
    assert one(spark, raw, text.strip) == raw.strip() == "a b"


@pytest.mark.parametrize("raw, urgent", [
    ("I know", True), ("HELPFUL", True), ("Asap!", True), ("hurry", False), ("", False), (None, False)])
def test_urgent_words(spark, raw, urgent):
    assert one(spark, raw, lambda v: text.contains_any(v, text.URGENT)) is urgent


def test_one_decimal(spark):
    for raw, expected in (("24.04", "24.0"), ("0.25", "0.3"), ("67072.56", "67072.6"), ("-1.5", "-1.5")):
        assert one(spark, raw, lambda v: text.one_decimal(v.cast("double"))) == expected


def test_iso_of_zoneless_times(spark):
    row = spark.sql("select timestamp_ntz'2024-03-31 02:30:00.5' as t, timestamp_ntz'1969-12-31 23:59:59' as u")
    for zone in ("UTC", "Europe/Berlin", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = row.select(instants.iso_utc(F.col("t")), instants.iso_offset(F.col("t")), instants.iso_utc(F.col("u"))).first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert tuple(got) == ("2024-03-31T02:30:00Z", "2024-03-31T02:30:00.500000+00:00", "1969-12-31T23:59:59Z")
