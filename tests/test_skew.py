import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from caseflow.operators import explore, limits, lookup, skew
from conftest import plan_of

KEYS = st.lists(st.one_of(st.none(), st.sampled_from("abcdefgh")), max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=KEYS, right=st.sets(st.sampled_from("abcdefghij")))
def test_join_unique_is_a_left_join(spark, left, right):
    frame = spark.createDataFrame(list(enumerate(left)), "n int, k string")
    other = spark.createDataFrame([(k, k.upper()) for k in right], "k string, v string")
    got = skew.join_unique(frame, other, "k").select("n", "k", "v").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        ((n, k, k.upper() if k in right else None) for n, k in enumerate(left)), key=str)


@pytest.mark.parametrize("frequent", [1, 3])
def test_join_unique_beyond_the_frequent_keys(spark, monkeypatch, frequent):
    """A third of the rows share one key; the list of frequent keys is shorter than the keys."""
    monkeypatch.setattr(skew.frequent_keys, "__defaults__", (frequent,))
    left = spark.range(9000).selectExpr("id", "if(id % 3 = 0, 0, id % 50) as k")
    right = spark.range(40).selectExpr("id as k", "id * 2 as v")
    got = skew.join_unique(left, right, "k")
    want = left.join(right, "k", "left").select(got.columns)
    assert got.count() == 9000
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_frequent_rows_are_not_shuffled(spark):
    left = spark.range(5000).selectExpr("id", "id % 5 as k")
    right = spark.range(5).selectExpr("id as k", "id as v")
    plan = plan_of(skew.join_unique(left, right, "k"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("small", [True, False])
def test_semi_join(spark, monkeypatch, small):
    monkeypatch.setattr(skew, "is_small", lambda keys: small)
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "n int, k string")
    right = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "k string")
    assert sorted(r["n"] for r in explore.semi_join(left, right, "k").collect()) == [1, 2]


def test_is_small(spark):
    assert skew.is_small(spark.range(10), 10) and not skew.is_small(spark.range(11), 10)


def test_latest_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 1, "o"), ("c", None, "p")],
        "k string, t int, id string")
    got = {r["k"]: r["id"] for r in lookup.latest(df, ["k"], "t", "id").collect()}
    assert got == {"a": "z", "b": "o", "c": "p"}


def test_latest_filters_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 as k", "id as t")
    plan = plan_of(lookup.latest(df, ["k"], "t"))
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_watermarks(spark):
    df = spark.createDataFrame(
        [("p", "t", "2024-01-01", "2024-01-05"), ("p", "t", "2024-01-03", "2024-01-04"),
         ("q", "t", "2024-01-01", "2024-01-05"), ("q", "t", "2024-01-02", "2024-01-05")],
        "pipeline_name string, platform_type string, m string, u string").selectExpr(
        "pipeline_name", "platform_type", "cast(m as timestamp) as last_processed_timestamp",
        "cast(u as timestamp) as updated_at")
    def mark(pipeline):
        return [str(r["last_processed_timestamp"])[:10] for r in lookup.last_watermark(
            df, pipeline, "t").collect()]
    assert mark("p") == ["2024-01-01"]  # the latest update, not the latest time
    assert mark("q") == ["2024-01-02"]  # the same update time: the larger mark
    assert mark("none") == []


def test_requests(spark):
    requests = spark.createDataFrame([(1, "a"), (2, "a"), (3, "x"), (4, None)], "n int, customer_id string")
    profiles = spark.createDataFrame(
        [("a", 1, 1), ("a", 2, 1), ("b", 1, 1)],
        "customer_id string, created_at int, last_interaction_timestamp int")
    got = {r["n"]: r["status"] for r in lookup.resolve_requests(requests, profiles).collect()}
    assert got == {1: "ok", 2: "ok", 3: "not_found", 4: "not_found"}


def test_profile_lookup_by_list_is_pushed_down(spark, folder):
    spark.range(10).selectExpr(
        "cast(id as string) as customer_id", "id as created_at", "id as last_interaction_timestamp"
    ).write.parquet(folder + "/p")
    found = lookup.profile_of(spark.read.parquet(folder + "/p"), ["3", "99"])
    assert [r["customer_id"] for r in found.collect()] == ["3"]
    assert "In(customer_id" in plan_of(found)


@pytest.mark.parametrize("n", [1, 49, 50, 51, 499, 500, 900])
def test_first_rows_without_one_task(spark, monkeypatch, n):
    """Half of the rows share one sort key and the rest of the order decides."""
    df = spark.range(500).selectExpr("if(id % 2 = 0, 7, id % 11) as k", "(id * 37) % 500 as u")
    want = [tuple(r) for r in df.orderBy("k", "u").limit(n).collect()]
    monkeypatch.setattr(limits, "SMALL_KEYS", 0)
    assert sorted(map(tuple, limits.first_rows(df, ["k", "u"], n).collect())) == want


def test_hot_broadcast_is_bounded(spark):
    assert skew.frequent_keys(spark.range(5000).withColumnRenamed("id", "k"), "k").count() == 1000
    counted = spark.range(30).selectExpr("if(id < 20, 7, id) as k")
    assert skew.frequent_keys(counted, "k", 1).first()["k"] == 7
