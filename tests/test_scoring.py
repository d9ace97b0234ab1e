import json
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from caseflow.operators import evaluate, features, predict, rollup, rules
from caseflow.schemas import EVALUATION_COLUMNS, LOG_COLUMNS, PREDICTION_COLUMNS
from conftest import plan_of

AS_OF = "2024-01-16 12:00:00"


def decided(df):
    out = rules.decide(features.activity(df, AS_OF))
    return {r["customer_id"]: (r["channel"], r["reasoning"]) for r in out.collect()}


def test_rule_thresholds(interactions):
    hour = "2024-01-16 11:00:00"
    rows = [(i, "five", hour, "") for i in range(5)] + [(i, "six", hour, "") for i in range(6)]
    rows += [(1, "day", "2024-01-15 12:00:00", ""), (1, "over", "2024-01-15 11:59:59.999999", "")]
    rows += [(i, "two", hour, "") for i in range(2)] + [(i, "three", hour, "") for i in range(3)]
    rows += [(1, "future", "2024-02-01", ""), (1, "none", None, "")]
    rows += [(i, "old", "2024-01-01", "") for i in range(5)] + [(9, "old", "2024-01-15 11:57:36", "")]
    got = decided(interactions(rows[:-1]))
    default = ("twitter_dm_reply", "Standard response for active issue")
    assert got["six"] == (
        "scheduling_phone_call", "Conversation has 6 interactions - phone call more efficient")
    assert got["five"] == (
        "twitter_dm_reply", "Customer very active (5 recent interactions) - respond on Twitter")
    assert got["three"][1].startswith("Customer very active (3 ")
    assert got["day"] == got["two"] == got["future"] == got["none"] == default
    assert got["over"] == (
        "email_reply", "Issue dormant for 24.0 hours - email follow-up needed. "
        "Last interaction was from customer.")
    assert got["old"][1].startswith("Issue dormant for 372.0 hours")


def test_features(interactions):
    rows = [(1, "gap", "2024-01-16 10:00:00", "I know"), (2, "gap", "2024-01-16 11:00:00", None),
            (1, "wide", "2024-01-16 10:00:00", "HELPFUL"), (2, "wide", "2024-01-16 11:00:01", "café\U0001f44d"),
            (1, "one", "2024-01-15 12:00:00", "Unacceptable"), (1, "none", None, ""),
            (1, None, "2024-01-15", "dropped")]
    got = {r["customer_id"]: r for r in features.extract_features(interactions(rows), AS_OF).collect()}
    assert set(got) == {"gap", "wide", "one", "none"}
    assert got["gap"]["response_pattern"] == "clustered"
    assert got["wide"]["response_pattern"] == "spread_out"
    assert got["one"]["response_pattern"] == "clustered"
    assert got["gap"]["contains_urgent_keywords"] and got["wide"]["contains_urgent_keywords"]
    assert got["one"]["has_escalation_words"] and not got["gap"]["has_escalation_words"]
    assert got["gap"]["avg_message_length"] == 3.0 and got["wide"]["avg_message_length"] == 6.0
    assert got["one"]["hours_since_last_interaction"] == 24.0
    assert got["none"]["hours_since_last_interaction"] == 0.0
    assert got["gap"]["total_interactions"] == got["gap"]["conversation_length"] == 2


def test_features_need_one_shuffle_and_no_python(interactions):
    plan = plan_of(features.extract_features(interactions([]), AS_OF))
    assert plan.count("Exchange") == 1 and "Python" not in plan


def test_activity_does_not_read_text(spark, interactions, folder):
    interactions([(1, "a", AS_OF, "x")]).write.parquet(folder + "/i")
    plan = plan_of(features.activity(spark.read.parquet(folder + "/i"), AS_OF))
    assert "content_text" not in plan and "external_id:" not in plan.replace("participant_external_id:", "")


TEXTS = st.sampled_from([None, "", "ok", "NOW please", "the manager", "café \U0001f44d", "knowledge"])
MINUTES = st.one_of(st.none(), st.integers(-600, 3000))
MESSAGES = st.lists(st.tuples(st.sampled_from("abc"), MINUTES, TEXTS), min_size=1, max_size=20)


def plain_outcome(messages):
    """Features and decision of one customer, message by message."""
    ages = [0.0 if age is None else age / 60 for age, _ in messages]
    known = [age / 60 for age, _ in messages if age is not None]
    last = min(known) if known else 0.0
    words = " ".join(text or "" for _, text in messages).lower()
    recent = sum(age <= 24 for age in ages)
    n = len(messages)
    channel = ("scheduling_phone_call" if n > 5 else "email_reply" if last > 24 else "twitter_dm_reply")
    return {
        "total_interactions": n, "hours_since_last_interaction": pytest.approx(last),
        "avg_message_length": sum(len(text or "") for _, text in messages) / n,
        "contains_urgent_keywords": any(w in words for w in ("urgent", "asap", "immediately", "now", "help")),
        "has_escalation_words": "manager" in words,
        "response_pattern": "spread_out" if known and max(known) - min(known) > 1 else "clustered",
        "channel": channel,
        "active": n <= 5 and last <= 24 and recent >= 3,
    }


@settings(max_examples=15, deadline=None)
@given(messages=MESSAGES)
def test_random_histories(spark, interactions, messages):
    as_of = datetime.fromisoformat(AS_OF)
    df = interactions([
        (i, who, None if age is None else str(as_of - timedelta(minutes=age)), text)
        for i, (who, age, text) in enumerate(messages)])
    joined = features.extract_features(df, AS_OF).join(
        rules.decide(features.activity(df, AS_OF)).drop("total_interactions"), "customer_id")
    rows = {r["customer_id"]: r for r in joined.collect()}
    assert set(rows) == {who for who, _, _ in messages}
    for who, row in rows.items():
        want = plain_outcome([(age, text) for person, age, text in messages if person == who])
        got = row.asDict() | {"active": "very active" in row["reasoning"]}
        assert {name: got[name] for name in want} == want


# Message counts of a published sample run: one customer with ten messages, nine with one or two, all long
# silent.
SAMPLE = {"10026": 2, "10103": 2, "10221": 2, "10286": 1, "10297": 2, "10298": 1, "10304": 10,
          "10423": 2, "10424": 2, "10449": 1}


def test_sample_run(spark, interactions):
    rows = [(f"{who}-{i}", who, "2017-10-31 22:10:47", "hello") for who, n in SAMPLE.items()
            for i in range(n)]
    df = interactions(rows)
    conversations = rollup.build_conversations(df, AS_OF)
    out = predict.predict(rollup.build_profiles(conversations, AS_OF), conversations, df, AS_OF)
    got = {r["customer_id"]: (r["channel"], r["issue_status"]) for r in out.collect()}
    assert got.pop("10304") == ("scheduling_phone_call", "escalated")
    assert set(got.values()) == {("email_reply", "pending_customer_response")} and len(got) == 9


@pytest.fixture(scope="module")
def world(spark, interactions):
    rows = [(i, "busy", "2024-01-01", f"m{i}") for i in range(7)]
    rows += [(i, "quiet", "2024-01-16 11:00:00", "x") for i in (20, 21)]
    rows += [(30, "done", "2024-01-01", "thanks")]
    df = interactions(rows)
    conversations = rollup.build_conversations(df, AS_OF).withColumn(
        "resolution_status", F.when(F.col("customer_id") == "done", "resolved").otherwise("open"))
    profiles = rollup.build_profiles(conversations, AS_OF)
    silent = spark.createDataFrame([("silent",)], "customer_id string")
    return profiles.unionByName(silent, allowMissingColumns=True), conversations.filter(
        "customer_id <> 'quiet'"), df


def by_customer(df):
    return {r["customer_id"]: r for r in df.collect()}


def test_predictions(world):
    got = by_customer(predict.predict(*world, AS_OF))
    assert set(got) == {"busy", "quiet", "silent"}
    assert got["busy"]["send_time"] == "2024-01-16T13:00:00+00:00"
    assert got["busy"]["message"] == got["busy"]["reasoning"]
    assert got["silent"]["channel"] == "twitter_dm_reply"
    assert all(r["error"] is None for r in got.values())


def test_limit_is_by_customer_id(world):
    assert set(by_customer(predict.predict(*world, AS_OF, limit=2))) == {"busy"}  # done is skipped
    assert set(by_customer(predict.predict(*world, AS_OF, limit=3))) == {"busy", "quiet"}


def test_chat_log_and_columns(world):
    out = predict.with_chat_log(predict.predict(*world, AS_OF), world[2])
    got = by_customer(predict.project_predictions(out))
    assert got["silent"]["chat_log"] == ""
    assert got["quiet"]["chat_log"] == "quiet: x\nquiet: x"
    assert tuple(got["quiet"].asDict()) == PREDICTION_COLUMNS + LOG_COLUMNS


@pytest.mark.parametrize("answer, message, reasoning, error", [
    ('{"message": "m", "reasoning": "r"}', "m", "r", None),
    ('{"reasoning": "r"}', "", "r", None),
    ('{"message": null}', "", "", None),
    ("{}", "", "", None),
    ("not json", "rule", "rule", "invalid_response"),
    ('{"message": "m"', "rule", "rule", "invalid_response"),
    ("[1]", "rule", "rule", "invalid_response"),
    ("7", "rule", "rule", "invalid_response"),
    ("", "rule", "rule", "invalid_response"),
    (None, "rule", "rule", None)])
def test_enhancement(spark, answer, message, reasoning, error):
    df = spark.createDataFrame([("rule", answer)], "reasoning string, answer string")
    row = predict.apply_enhancement(df, "answer").first()
    assert (row["message"], row["reasoning"], row["error"]) == (message, reasoning, error)


def test_bad_answer_does_not_stop_the_rest(spark, world):
    answers = spark.createDataFrame(
        [("busy", "broken"), ("quiet", json.dumps({"message": "hi", "reasoning": "why"}))],
        "customer_id string, response string")
    got = by_customer(predict.predict(*world, AS_OF, responses=answers))
    assert got["busy"]["error"] == "invalid_response" and got["quiet"]["message"] == "hi"


def test_prompts(world):
    profiles, conversations, df = world
    cases = predict.recommend(profiles.select("customer_id"), df, AS_OF)
    got = by_customer(predict.build_prompt(cases, df))
    assert predict.NO_HISTORY in got["silent"]["prompt"]
    assert "customer quiet" in got["quiet"]["prompt"]
    assert "Interaction 2 (2024-01-16T11:00:00Z) by quiet: x" in got["quiet"]["prompt"]
    parts = predict.build_prompt(cases, df, "{history}", part_bits=1).filter("customer_id = 'busy'")
    assert parts.count() >= 4


def test_answers_that_differ_are_not_chosen_from(spark, world):
    answers = spark.createDataFrame(
        [("busy", '{"message": "a"}'), ("busy", '{"message": "b"}'), ("quiet", '{"message": "c"}'),
         ("quiet", '{"message": "c"}')], "customer_id string, response string")
    got = by_customer(predict.predict(*world, AS_OF, responses=answers))
    assert got["busy"]["error"] == "conflicting_answers" and got["busy"]["message"] == got["busy"]["reasoning"]
    assert got["quiet"]["error"] is None and got["quiet"]["message"] == "c"


@pytest.mark.parametrize("last, error", [
    ("whole", None), ("twice", None), ("none", "missing_answer"), ("null", "missing_answer"),
    ("stale", "missing_answer"), ("broken", "invalid_response"), ("differs", "conflicting_answers")])
def test_answers_in_parts(spark, world, last, error):
    profiles, _, df = world
    cases = predict.recommend(profiles.select("customer_id"), df, AS_OF)
    prompts = predict.build_prompt(cases, df, "{history}", part_bits=1)
    asked = prompts.select("*", predict.prompt_hash("prompt").alias("hash")).collect()
    parts = max(r["parts"] for r in asked if r["customer_id"] == "busy")
    assert parts >= 4
    rows = []
    for r in asked:
        answer = json.dumps({"message": r["prompt"], "reasoning": str(r["part"])})
        one = (r["customer_id"], r["part"], r["hash"], answer)
        if (r["customer_id"], r["part"]) != ("busy", parts - 1):
            rows.append(one)
            continue
        rows += {
            "whole": [one], "twice": [one, one], "none": [], "null": [(*one[:3], None)], "stale": [(*one[:2], "old", answer)],
            "broken": [(*one[:3], "{")], "differs": [one, (*one[:3], "{}")]}[last]
    answers = spark.createDataFrame(rows, "customer_id string, part long, prompt_hash string, response string")
    got = predict.answer_prompts(cases, prompts, answers, AS_OF).collect()
    busy = sorted((r for r in got if r["customer_id"] == "busy"), key=lambda r: r["part"])
    if error is None:
        assert [(r["part"], r["parts"], r["reasoning"]) for r in busy] == [(i, parts, str(i)) for i in range(parts)]
        whole = sorted((r["part"], r["prompt"]) for r in asked if r["customer_id"] == "busy")
        assert [r["message"] for r in busy] == [prompt for _, prompt in whole]
    else:
        assert [(r["part"], r["parts"], r["error"]) for r in busy] == [(0, 1, error)]
        assert busy[0]["message"] == busy[0]["reasoning"] and busy[0]["channel"] == "scheduling_phone_call"
    assert {r["customer_id"] for r in got} == {r["customer_id"] for r in cases.collect()}
    assert all(r["error"] is None for r in got if r["customer_id"] != "busy")


@pytest.mark.parametrize("few", [True, False])
def test_score_requests(spark, world, monkeypatch, few):
    monkeypatch.setattr(predict, "is_small", lambda ids: few)
    requests = spark.createDataFrame(
        [(i, who) for i, who in enumerate(["busy"] * 5 + ["nobody", None, "done"])],
        "n int, customer_id string")
    got = {r["n"]: r for r in predict.score_requests(requests, *world, AS_OF).collect()}
    assert len(got) == 8
    assert [got[i]["status"] for i in range(8)] == ["ok"] * 5 + ["not_found"] * 2 + ["ok"]
    assert got[4]["channel"] == "scheduling_phone_call" and got[5]["channel"] is None


def test_evaluation(world):
    profiles, _, df = world
    got = by_customer(evaluate.project_evaluation(evaluate.evaluate(profiles, df, AS_OF)))
    assert set(got) == {"busy", "done", "quiet", "silent"}
    assert {k: r["issue_status"] for k, r in got.items()} == {
        "busy": "escalated", "done": "pending_customer_reply", "quiet": "resolved",
        "silent": "resolved"}
    assert got["done"]["chat_log"] == "Customer: thanks\n" and got["silent"]["chat_log"] == ""
    assert tuple(got["done"].asDict()) == EVALUATION_COLUMNS + LOG_COLUMNS
    assert evaluate.evaluate(profiles, df, AS_OF, n=2).count() == 2


def test_rollup_edges(spark, interactions):
    df = interactions([(1, None, AS_OF, "x"), (2, "a", AS_OF, "x"), (3, "a", None, "y")])
    row = rollup.build_conversations(df, AS_OF).collect()
    assert len(row) == 1 and row[0]["total_interactions"] == 2
    assert row[0]["conversation_start_timestamp"] == row[0]["conversation_end_timestamp"]
    assert rollup.build_conversations(interactions([]), AS_OF).count() == 0


def test_predict_plan(world):
    plan = plan_of(predict.predict(*world, AS_OF))
    assert "Python" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
