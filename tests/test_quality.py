import pytest

from caseflow.operators import conform, normalize, quality
from caseflow.operators.rollup import batch_stats

AS_OF = "2024-01-16 12:00:00"


def flags(df, mode="line"):
    rows = df.selectExpr("*", "'twitter' as platform_type").transform(
        quality.flag_required).transform(quality.flag_length, mode).transform(quality.score)
    return {row["external_id"]: (bool(row["is_valid"]), row["quality_score"]) for row in rows.collect()}


def test_length_modes(interactions):
    df = interactions([
        (4, "a", AS_OF, "x" * 4), (5, "a", AS_OF, "x" * 5), (10000, "a", AS_OF, "x" * 10000),
        (10001, "a", AS_OF, "x" * 10001), (32, "a", AS_OF, "ab\ncd\nef"), (0, "a", AS_OF, None)])
    assert {k for k, (ok, score) in flags(df).items() if ok and score == 1.0} == {
        "5", "10000", "10001"}
    assert {k for k, (ok, score) in flags(df, "bounds").items() if ok and score == 1.0} == {
        "5", "10000", "32"}
    assert flags(df)["0"] == (False, 0.0)
    with pytest.raises(ValueError):
        quality.flag_length(df, "other")


def test_required_fields(spark):
    df = spark.createDataFrame(
        [("1", "t", "long text", "2024-01-01"), (None, "t", "long text", "2024-01-01"),
         ("3", None, "long text", "2024-01-01"), ("4", "t", "long text", None)],
        "external_id string, platform_type string, content_text string, interaction_timestamp string")
    assert [row["is_valid"] for row in quality.flag_required(df).collect()] == [
        True, False, False, False]


def test_quarantine_loses_nothing(interactions):
    df = interactions([(1, "a", AS_OF, "long enough"), (2, "a", None, "long enough"), (3, "a", AS_OF, None)])
    flagged = quality.apply_profile(df.selectExpr("*", "'t' as platform_type"), "flag")
    valid, rejected = quality.quarantine(flagged)
    assert [r["external_id"] for r in valid.collect()] == ["1"]
    assert {r["external_id"] for r in rejected.collect()} == {"2", "3"}
    stats = batch_stats(flagged).first()
    assert (stats["records"], stats["valid_records"]) == (3, 1)


def test_dedup_keeps_the_earliest(spark, interactions):
    df = interactions([
        ("a", "u", "2024-01-02", "late"), ("a", "u", "2024-01-01", "early"), ("a", "u", None, "no time"),
        ("b", "u", None, "only"), ("c", "u", "2024-01-01", "x"), ("c", "u", "2024-01-01", "x")])
    nulls = df.filter("external_id = 'a'").selectExpr(
        "cast(null as string) as external_id", "participant_external_id", "interaction_timestamp",
        "content_text")
    kept = quality.dedup_external(df.unionByName(nulls)).collect()
    assert sorted((r["external_id"] or "", r["content_text"]) for r in kept) == [
        ("", "early"), ("", "late"), ("", "no time"), ("a", "early"), ("b", "only"), ("c", "x")]


def test_missing_text_is_null_only(interactions):
    df = interactions([(1, "a", AS_OF, ""), (2, "a", AS_OF, None), (3, "a", AS_OF, " ")])
    assert {r["external_id"] for r in quality.drop_missing_text(df).collect()} == {"1", "3"}


def test_since(interactions):
    df = interactions([
        (1, "a", "2024-01-01 00:00:00", ""), (2, "a", "2024-01-01 00:00:00.000001", ""),
        (3, "a", None, ""), (4, "a", "2023-12-31 23:00:00.000001", "")])
    def ids(mark, lateness=None):
        return {r["external_id"] for r in quality.since(df, mark, lateness).collect()}
    assert ids("2024-01-01 00:00:00") == {"2"}
    assert ids("2024-01-01 00:00:00", "1 hour") == {"1", "2", "4"}
    assert ids(None) == {"1", "2", "3", "4"}


def test_open_only(spark):
    df = spark.createDataFrame([("a", "resolved"), ("b", "open"), ("c", None)],
                               "customer_id string, resolution_status string")
    assert {r["customer_id"] for r in quality.open_only(df).collect()} == {"b", "c"}
    assert quality.resolution_counts(df).first().asDict() == {
        "open_customers": 2, "skipped_customers": 1}


def test_unknown_profile(interactions):
    with pytest.raises(ValueError):
        quality.apply_profile(interactions([]), "strict")


def test_contains_skips_null(spark):
    df = spark.createDataFrame([("x820131y",), (None,), ("8",)], "author string")
    assert [r["author"] for r in quality.contains(df, "author", "820131").collect()] == ["x820131y"]


def test_model_rejects_by_field(spark):
    df = spark.createDataFrame(
        [("0" * 32, "1", "2024-01-01 00:00:00", "{}"), ("nope", "2", "soon", '{"a": "b"}'),
         (None, None, "2024-01-01 00:00:00", "[1]"), (None, "4", None, "not json")],
        "interaction_id string, external_id string, interaction_timestamp string, "
        "content_metadata string").selectExpr(
        "*", "'t' as platform_type", "'u' as participant_external_id", "'x' as content_text",
        "'tweet' as interaction_type")
    rejected = {
        row["external_id"]: row["rejected"] for row in conform.check_model(df).collect()}
    assert rejected == {
        "1": [], "2": ["interaction_id", "interaction_timestamp"],
        None: ["external_id", "content_metadata"],
        "4": ["content_metadata", "interaction_timestamp"]}
    ok, bad = conform.conform(df)
    assert (ok.count(), bad.count()) == (1, 3)
    assert ok.first()["content_metadata"] == {} and ok.first()["parent_interaction_id"] is None


def test_normalize_is_stable(spark):
    raw = spark.createDataFrame(
        [("7", "u", "True", "Tue Oct 31 22:10:47 +0000 2017", "hi", None, "6")],
        "tweet_id string, author_id string, inbound string, created_at string, text string, "
        "response_tweet_id string, in_response_to_tweet_id string")
    frame = normalize.normalize(raw.transform(normalize.parse_created_at), AS_OF)
    assert frame.collect() == frame.collect()
    row = frame.first()
    assert (row["external_id"], row["platform_type"], row["parent_interaction_id"]) == (
        "7", "twitter", "6")
    assert row["content_metadata"] == "{}" and len(row["interaction_id"]) == 32
