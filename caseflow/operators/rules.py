"""The ordered rule list that recommends a channel and gives the reason."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Rule:
    """A predicate over the activity columns, the channel it leads to and its reason, as SQL text."""

    predicate: str
    channel: str
    reason: str


# Channels, thresholds and reason texts.
DEFAULT_RULES = (
    Rule(
        "total_interactions > 5",
        "scheduling_phone_call",
        "concat('Conversation has ', total_interactions, "
        "' interactions - phone call more efficient')"),
    Rule(
        "hours_since_own > 24",
        "email_reply",
        "concat('Issue dormant for ', format_string('%.1f', round(hours_since_own, 1)), "
        "' hours - email follow-up needed. Last interaction was from customer.')"),
    Rule(
        "recent_interactions >= 3",
        "twitter_dm_reply",
        "concat('Customer very active (', recent_interactions, "
        "' recent interactions) - respond on Twitter')"),
)
FALLBACK = Rule("true", "twitter_dm_reply", "'Standard response for active issue'")

ACTIVITY_DEFAULTS = {"total_interactions": 0, "hours_since_own": 0.0, "recent_interactions": 0}


def decide(df: DataFrame, rules=DEFAULT_RULES, fallback=FALLBACK) -> DataFrame:
    """Add ``channel`` and ``reasoning`` from the first rule whose predicate is true."""

    def chain(outcome):
        result = None
        for rule in rules:
            predicate = F.expr(rule.predicate)
            result = F.when(predicate, outcome(rule)) if result is None else result.when(
                predicate, outcome(rule))
        return outcome(fallback) if result is None else result.otherwise(outcome(fallback))

    return df.withColumns({
        "channel": chain(lambda rule: F.lit(rule.channel)),
        "reasoning": chain(lambda rule: F.expr(rule.reason)),
    })


def issue_status(df: DataFrame, variant="prediction") -> DataFrame:
    """The status expected after the action; evaluation output uses its own map."""
    channel = F.col("channel")
    escalated = F.when(channel == "scheduling_phone_call", "escalated")
    if variant == "prediction":
        status = escalated.otherwise("pending_customer_response")
    elif variant == "evaluation":
        status = escalated.when(channel == "email_reply", "pending_customer_reply").otherwise(
            "resolved")
    else:
        raise ValueError(f"unknown status variant: {variant}")
    return df.withColumn("issue_status", status)
