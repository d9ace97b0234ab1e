"""From interactions to one conversation and one profile per participant."""

from pyspark.sql import DataFrame, functions as F

from caseflow.functions import instants
from caseflow.schemas import CONVERSATION, PROFILE


def _conform(df, schema):
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def build_conversations(df: DataFrame, as_of, brand="brand", inbound_only=False) -> DataFrame:
    """One conversation per participant from one aggregation with map-side combine.

    Rows without a participant, stored as ``''``, belong to no conversation. Status, sentiment, topic and channel are fixed defaults. ``inbound_only`` keeps customer messages
    only and needs the raw ``inbound`` column.
    """
    rows = df.filter(F.col("participant_external_id") != "")
    if inbound_only:
        rows = rows.filter(F.lower("inbound") == "true")
    return as_conversations(
        rows.groupBy(F.col("participant_external_id").alias("customer_id")).agg(
            F.min("interaction_timestamp").alias("conversation_start_timestamp"),
            F.max("interaction_timestamp").alias("conversation_end_timestamp"),
            F.count(F.lit(1)).alias("total_interactions")), as_of, brand)


def as_conversations(spans: DataFrame, as_of, brand="brand") -> DataFrame:
    """Conversations from the count and the first and last time of each customer."""
    return (
        spans
        .withColumns({
            "conversation_id": F.md5(F.concat_ws("|", F.lit("conversation"), "customer_id")),
            "brand_account_id": F.lit(brand),
            "resolution_status": F.lit("open"),
            "customer_sentiment_score": F.lit(0.0),
            "conversation_topic": F.lit("general_inquiry"),
            "channel_mix": F.lit('{"twitter":true}'),
            "created_at": instants.instant(as_of),
        })
        .transform(_conform, CONVERSATION))


def build_profiles(conversations: DataFrame, as_of) -> DataFrame:
    """One profile per conversation; a projection, so it needs no second shuffle."""
    return (
        conversations
        .withColumns({
            "platform_accounts": F.to_json(F.struct(F.col("customer_id").alias("twitter_id"))),
            "interaction_history_summary": F.to_json(F.struct("total_interactions")),
            "behavioral_tags": F.lit('{"default":true}'),
            "preferred_channels": F.lit('{"twitter":true}'),
            "avg_response_time": F.lit(0.0),
            "total_conversations": F.lit(1),
            "resolution_rate": F.lit(0.0),
            "last_interaction_timestamp": F.col("conversation_end_timestamp"),
            "created_at": instants.instant(as_of),
        })
        .transform(_conform, PROFILE))


def batch_stats(df: DataFrame) -> DataFrame:
    """Rows, valid rows and the latest event time of a batch."""
    valid = F.col("is_valid") if "is_valid" in df.columns else F.lit(True)
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(valid).alias("valid_records"),
        F.max("interaction_timestamp").alias("max_timestamp"))
