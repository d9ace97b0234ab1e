"""Predictions: profile, conversation, history, rules and enhancement in one plan."""

from string import Formatter

from pyspark.sql import DataFrame, functions as F, types as T

from caseflow.functions.instants import instant, iso_offset
from caseflow.operators.features import activity
from caseflow.operators.history import (
    FIND, PART_BITS, chat_log, join_parts, long_histories, render_history)
from caseflow.operators.limits import first_rows
from caseflow.operators.lookup import with_conversation, with_history
from caseflow.operators.quality import open_only
from caseflow.operators.rules import ACTIVITY_DEFAULTS, DEFAULT_RULES, decide, issue_status
from caseflow.operators.skew import SMALL_KEYS, is_small, join_unique
from caseflow.schemas import LOG_COLUMNS, PREDICTION_COLUMNS
from caseflow.storage import durable

NO_HISTORY = "No detailed conversation history available."

# Our own wording; callers pass theirs. The answer has to be JSON with message and reasoning.
PROMPT_TEMPLATE = (
    "Write a short reply to customer {customer_id} and explain the chosen next step.\n"
    "Summary: {summary}\nTopic: {topic}\nMessages:\n{history}\n"
    "Chosen step: {channel} - {reasoning}\n"
    'Answer with one JSON object with the keys "message" and "reasoning".')

_RESPONSE = T.StructType([
    T.StructField("message", T.StringType()),
    T.StructField("reasoning", T.StringType()),
    T.StructField("_corrupt_record", T.StringType())])


def customers(profiles: DataFrame) -> DataFrame:
    """Each customer once, with the creation time of the latest profile."""
    return profiles.groupBy("customer_id").agg(F.max("created_at").alias("created_at"))


def first_profiles(profiles: DataFrame, limit) -> DataFrame:
    """The first customers by id. The order is total, so the choice is the same in every run."""
    return first_rows(profiles, ["customer_id", "created_at"], limit)


def send_time(as_of):
    return iso_offset(instant(as_of) + F.expr("interval 1 hour"))


def history_of_few(interactions: DataFrame, chosen: DataFrame, count) -> DataFrame:
    """Filter the history before aggregating it when the chosen customers are few enough to broadcast."""
    if count > SMALL_KEYS:
        return interactions
    ids = chosen.select(F.col("customer_id").alias("participant_external_id"))
    return interactions.join(F.broadcast(ids), "participant_external_id", "left_semi")


def recommend(profiles, interactions, as_of, rules=DEFAULT_RULES, known=None) -> DataFrame:
    """Channel and reason for profiles that are unique by customer; no history is an empty one.

    ``known``: the activity of the customers, where it need not be found from the interactions.
    """
    return (
        with_history(profiles, activity(interactions, as_of) if known is None else known)
        .fillna(ACTIVITY_DEFAULTS)
        .transform(decide, rules))


def predict(
        profiles: DataFrame, conversations: DataFrame, interactions: DataFrame, as_of, limit=None,
        rules=DEFAULT_RULES, responses: DataFrame = None, skip_resolved=True, activity: DataFrame = None) -> DataFrame:
    """One prediction per customer whose conversation is not resolved.

    ``limit`` takes the first customers before anything else is read. ``responses`` (customer_id,
    response) carries enhancement answers; without one the rule reason is both message and reasoning, and
    so it is where a customer has several that differ (``error`` is conflicting_answers). Answers to prompts
    in parts are put together by ``answer_prompts``.
    ``activity``: what the rules read, where it need not be found from the interactions.
    """
    profiles = customers(profiles)
    if limit is not None:
        profiles = first_profiles(profiles, limit)
        interactions = history_of_few(interactions, profiles, limit)
    cases = with_conversation(profiles, conversations)
    if skip_resolved:
        cases = open_only(cases)
    decided = recommend(cases, interactions, as_of, rules, activity)
    return _answered(decided, as_of, responses)


def answer(cases: DataFrame, as_of, rules=DEFAULT_RULES) -> DataFrame:
    """Predictions for rows that hold their activity already."""
    return _answered(decide(cases, rules), as_of)


def _answered(decided, as_of, responses=None):
    if responses is None:
        answered = decided.withColumns({
            "response": F.lit(None).cast("string"), "conflict": F.lit(None).cast("boolean")})
    else:
        answered = decided.join(_one_answer(responses, "customer_id"), "customer_id", "left")
    return (
        answered.transform(apply_enhancement, "response")
        .transform(_name_conflict)
        .transform(issue_status)
        .withColumn("send_time", send_time(as_of))
        .select(
            "customer_id", "channel", "message", "send_time", "reasoning", "issue_status", "error"))


def _one_answer(answers, *key):
    """The answer of each key, however often it came; none where several differ."""
    least, most = F.min("response"), F.max("response")
    return answers.groupBy(*key).agg(
        F.when(least == most, least).alias("response"), (least != most).alias("conflict"))


def _name_conflict(df):
    return df.withColumn("error", F.when(F.col("conflict"), "conflicting_answers").otherwise(F.col("error")))


def with_chat_log(
        predictions: DataFrame, interactions: DataFrame, variant="prediction",
        part_bits=PART_BITS, long=FIND) -> DataFrame:
    """Predictions with their chat log, ``part`` of ``parts``. A log of several parts repeats the prediction,
    one row each; the row of part 0 stands for the prediction."""
    if long is FIND:
        long = long_histories(interactions, part_bits=part_bits)
    logs = chat_log(interactions, variant, part_bits=part_bits, long=long)
    return join_parts(predictions, logs, long).fillna({"chat_log": ""})


def build_prompt(
        decided: DataFrame, interactions: DataFrame, template=PROMPT_TEMPLATE,
        part_bits=PART_BITS) -> DataFrame:
    """One enhancement request per customer, or per part of a long history.

    ``decided`` needs customer_id, channel and reasoning; summary and conversation_topic are optional.
    """
    def optional(name, default):
        return F.coalesce(F.col(name), F.lit(default)) if name in decided.columns else F.lit(default)

    values = {
        "customer_id": F.col("customer_id"),
        "summary": optional("summary", ""),
        "topic": optional("conversation_topic", "N/A"),
        "history": F.coalesce(F.col("history"), F.lit(NO_HISTORY)),
        "channel": F.col("channel"),
        "reasoning": F.col("reasoning"),
    }
    pieces = []
    for literal, field, _, _ in Formatter().parse(template):
        pieces.append(F.lit(literal))
        if field:
            pieces.append(values[field])
    long = long_histories(interactions, part_bits=part_bits)
    histories = render_history(interactions, part_bits=part_bits, long=long)
    return join_parts(decided, histories, long).select(
        "customer_id", "part", "parts", F.concat(*pieces).alias("prompt"))


def prompt_hash(prompt):
    """What an answer names its prompt by."""
    return F.sha2(prompt, 256)


def answer_prompts(decided: DataFrame, prompts: DataFrame, answers: DataFrame, as_of) -> DataFrame:
    """Predictions from the answers to ``build_prompt``, ``part`` of ``parts``.

    ``answers``: customer_id, part, prompt_hash, response. An answer counts only for the prompt it was given to, so
    one to an earlier state of the history is none. Where every part of a customer has an answer, there is a row for each
    part; the whole message is its parts in order, and the row of part 0 stands for the prediction. Otherwise the customer
    has one row with the rule reason, and ``error`` says what the first such part lacks: missing_answer,
    invalid_response, or conflicting_answers (several that differ; equal ones are one). No customer's parts come
    together in one task.
    """
    key = ["customer_id", "part", "prompt_hash"]
    asked = prompts.select("customer_id", "part", "parts", prompt_hash("prompt").alias("prompt_hash"))
    parts = durable(
        asked.join(_one_answer(answers, *key), key, "left")
        .withColumn("reasoning", F.lit(None).cast("string"))
        .transform(apply_enhancement, "response")
        .withColumn("error", F.coalesce("error", F.when(F.col("response").isNull(), "missing_answer")))
        .transform(_name_conflict)
        .select("customer_id", "part", "parts", "message", "reasoning", "error"))
    first_lack = F.min(F.when(F.col("error").isNotNull(), F.struct("part", "error")))["error"]
    outcomes = parts.groupBy("customer_id").agg(F.coalesce(
        first_lack, F.when(F.count(F.lit(1)) < F.max("parts"), "missing_answer")).alias("lack"))
    cases = durable(
        decided.select("customer_id", "channel", F.col("reasoning").alias("rule"))
        .join(outcomes.withColumn("asked", F.lit(True)), "customer_id", "left"))
    whole = F.col("asked").isNotNull() & F.col("lack").isNull()
    answered = join_unique(
        parts.drop("error"), cases.filter(whole).select("customer_id", "channel", "asked"), "customer_id").filter("asked")
    fallen_back = cases.filter(~whole).select(
        "customer_id", "channel", F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("parts"),
        F.col("rule").alias("message"), F.col("rule").alias("reasoning"),
        F.coalesce("lack", F.lit("missing_answer")).alias("error"))
    return (
        answered.drop("asked").withColumn("error", F.lit(None).cast("string")).unionByName(fallen_back)
        .transform(issue_status)
        .withColumn("send_time", send_time(as_of))
        .select("customer_id", "channel", "message", "send_time", "reasoning", "issue_status", "error", *LOG_COLUMNS))


def apply_enhancement(df: DataFrame, response) -> DataFrame:
    """Read message and reasoning from the JSON answer in the named column.

    A missing answer, or one that is not a JSON object, falls back to the rule reason for both; a
    missing key is empty text. ``error`` names rows whose answer could not be used.
    """
    strict = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    parsed = F.from_json(response, _RESPONSE, strict)
    # The reader stops at the end of the first value. What follows it breaks one of the two wrappings.
    listed = F.from_json(F.concat(F.lit("["), response, F.lit("]")), "array<string>", strict)
    keyed = F.from_json(
        F.concat(F.lit('{"value":'), response, F.lit("}")),
        "struct<value:string,_corrupt_record:string>",
        {**strict, "columnNameOfCorruptRecord": "_corrupt_record"})
    usable = (
        F.col(response).isNotNull() & F.col("_parsed._corrupt_record").isNull()
        & F.ltrim(F.col(response), F.lit(" \t\r\n")).startswith("{")
        & F.coalesce(F.size(listed) == 1, F.lit(False)) & keyed["_corrupt_record"].isNull())

    def field(name):
        return F.when(usable, F.coalesce(f"_parsed.{name}", F.lit(""))).otherwise(F.col("reasoning"))

    return df.withColumn("_parsed", parsed).withColumns({
        "message": field("message"),
        "reasoning": field("reasoning"),
        "error": F.when(F.col(response).isNotNull() & ~usable, "invalid_response"),
    }).drop("_parsed")


def score_requests(
        requests: DataFrame, profiles: DataFrame, conversations: DataFrame, interactions: DataFrame,
        as_of, rules=DEFAULT_RULES, responses=None) -> DataFrame:
    """Answer each requested id with a prediction, or ``not_found`` when it has no profile.

    Ids may repeat and one may dominate: each is scored once. Resolved customers are answered too.
    """
    ids = requests.select("customer_id").filter("customer_id is not null").distinct()
    few = is_small(ids)
    if few:
        profiles = profiles.join(F.broadcast(ids), "customer_id", "left_semi")
        conversations = conversations.join(F.broadcast(ids), "customer_id", "left_semi")
        interactions = history_of_few(interactions, ids, SMALL_KEYS)
    scored = predict(
        profiles, conversations, interactions, as_of, rules=rules, responses=responses,
        skip_resolved=False).withColumn("status", F.lit("ok"))
    if few:
        answered = requests.join(F.broadcast(scored), "customer_id", "left")
    else:
        answered = join_unique(requests, durable(scored), "customer_id")
    return answered.withColumn("status", F.coalesce("status", F.lit("not_found")))


def log_columns(df: DataFrame):
    """Which part of how many the log of a row is, also for rows that have no log."""
    return [
        F.coalesce(F.col(name) if name in df.columns else F.lit(None), F.lit(default)).cast("long").alias(name)
        for name, default in zip(LOG_COLUMNS, (0, 1))]


def project_predictions(df: DataFrame) -> DataFrame:
    return df.select(*PREDICTION_COLUMNS, *log_columns(df))
