"""Activity, timing and keyword features per customer, all from one aggregation."""

from pyspark.sql import Column, DataFrame, functions as F

from caseflow.functions.instants import hours_ago
from caseflow.functions.text import ESCALATION, URGENT, contains_any

RECENT_HOURS = 24
SPREAD_MICROS = 3_600_000_000


def recent_count(ts: Column, as_of) -> Column:
    """Rows at most 24 hours old; rows without a time and future rows count as recent."""
    return F.count_if(hours_ago(ts, as_of) <= RECENT_HOURS)


def turn_count() -> Column:
    return F.count(F.lit(1))


def hours_since_last(ts: Column, as_of) -> Column:
    return hours_ago(F.max(ts), as_of)


def avg_length(text: Column) -> Column:
    """Mean length in characters; missing text counts as empty."""
    return F.sum(F.coalesce(F.length(text), F.lit(0))) / F.count(F.lit(1))


def has_urgent(text: Column, words=URGENT) -> Column:
    return F.bool_or(contains_any(text, words))


def has_escalation(text: Column, words=ESCALATION) -> Column:
    return F.bool_or(contains_any(text, words))


def response_pattern(ts: Column) -> Column:
    """``spread_out`` when more than one message covers more than an hour, else ``clustered``."""
    span = F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))
    return F.when((F.count(F.lit(1)) > 1) & (span > SPREAD_MICROS), "spread_out").otherwise("clustered")


def _by_customer(df, key):
    return df.filter(F.col(key).cast("string") != "").groupBy(F.col(key).alias("customer_id"))


def extract_features(df: DataFrame, as_of, key="participant_external_id") -> DataFrame:
    """The seven features of every customer."""
    ts, text = F.col("interaction_timestamp"), F.col("content_text")
    return _by_customer(df, key).agg(
        turn_count().alias("total_interactions"),
        turn_count().alias("conversation_length"),
        hours_since_last(ts, as_of).alias("hours_since_last_interaction"),
        avg_length(text).alias("avg_message_length"),
        has_urgent(text).alias("contains_urgent_keywords"),
        has_escalation(text).alias("has_escalation_words"),
        response_pattern(ts).alias("response_pattern"))


# The features of an empty history.
FEATURE_DEFAULTS = {
    "total_interactions": 0, "conversation_length": 0, "hours_since_last_interaction": 0.0,
    "avg_message_length": 0.0, "contains_urgent_keywords": False, "has_escalation_words": False,
    "response_pattern": "clustered"}


def customer_features(profiles: DataFrame, df: DataFrame, as_of) -> DataFrame:
    """The features of every customer with a profile; one without messages has those of an empty history."""
    ids = profiles.select("customer_id").distinct()
    return ids.join(extract_features(df, as_of), "customer_id", "left").fillna(FEATURE_DEFAULTS)


def activity(df: DataFrame, as_of, key="participant_external_id", author=None) -> DataFrame:
    """What the rules read, per customer: message count, age of the last own message, recent count.

    ``author`` names the column telling who wrote a message, for histories that also hold messages of
    others; without it every message is the customer's own. The text is not read.
    """
    ts = F.col("interaction_timestamp")
    own = ts if author is None else F.when(F.col(author) == F.col(key), ts)
    return _by_customer(df, key).agg(
        turn_count().alias("total_interactions"),
        hours_ago(F.max(own), as_of).alias("hours_since_own"),
        recent_count(ts, as_of).alias("recent_interactions"))
