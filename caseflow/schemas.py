"""Schemas of every table the package reads or writes.

Text that holds JSON stays ``string`` at rest. Table timestamps have millisecond precision.
"""

from pyspark.sql import types as T


def _struct(**fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_S, _L, _D, _B, _TS = (
    T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType())
_META = T.MapType(_S, _S)

RAW_TWEET = _struct(
    tweet_id=_S, author_id=_S, inbound=_S, created_at=_S, text=_S,
    response_tweet_id=_S, in_response_to_tweet_id=_S)

INTERACTION = _struct(
    interaction_id=_S, external_id=_S, platform_type=_S, participant_external_id=_S,
    content_text=_S, content_metadata=_S, interaction_timestamp=_TS, parent_interaction_id=_S,
    platform_metadata=_S, processing_metadata=_S, created_at=_TS)

# Quality columns are stored next to the canonical ones; batch_id and event_month are directories.
INTERACTION_STORED = T.StructType(
    INTERACTION.fields + _struct(is_valid=_B, quality_score=_D).fields)
INTERACTION_TABLE = T.StructType(
    INTERACTION_STORED.fields + _struct(batch_id=_S, event_month=T.DateType()).fields)

WATERMARK = _struct(
    id=_S, pipeline_name=_S, platform_type=_S, last_processed_timestamp=_TS,
    last_processed_external_id=_S, records_processed=_L, last_run_status=_S, updated_at=_TS)

RUN = _struct(
    run_id=_S, pipeline_name=_S, run_type=_S, database_target=_S, start_timestamp=_TS,
    end_timestamp=_TS, status=_S, records_processed=_L, error_message=_S, config_snapshot=_S,
    created_at=_TS)

CONVERSATION = _struct(
    conversation_id=_S, customer_id=_S, brand_account_id=_S, conversation_start_timestamp=_TS,
    conversation_end_timestamp=_TS, total_interactions=_L, resolution_status=_S,
    customer_sentiment_score=T.DecimalType(9, 4), conversation_topic=_S, channel_mix=_S,
    created_at=_TS)

PROFILE = _struct(
    customer_id=_S, platform_accounts=_S, interaction_history_summary=_S, behavioral_tags=_S,
    preferred_channels=_S, avg_response_time=T.DecimalType(9, 2), total_conversations=_L,
    resolution_rate=T.DecimalType(9, 2), last_interaction_timestamp=_TS, created_at=_TS)

FEATURES = _struct(
    customer_id=_S, total_interactions=_L, conversation_length=_L, hours_since_last_interaction=_D,
    avg_message_length=_D, contains_urgent_keywords=_B, has_escalation_words=_B, response_pattern=_S,
    created_at=_TS)

STREAM_BATCH = _struct(
    records=_L, without_time=_L, without_id=_L, left_out_late=_L, left_out_copy=_L, left_out_stored=_L,
    left_out_no_text=_L, stored=_L, max_timestamp=_TS, number=_L, stream=_S, batch=_L)

LEASE = _struct(batch_id=_S, run_id=_S, at=_TS, expires_at=_TS)

# Which identity a stream knows: its best copy so far and the batch of that copy. The bits of a month tell which
# identities may lie in it. A row that a better copy replaced is listed with its batch.
IDENTITY = _struct(
    identity=_S, external_id=_S, interaction_timestamp=_TS, content_text=_S, participant_external_id=_S, is_stored=_B,
    batch_id=_S, id_month=T.DateType())
IDENTITY_BITS = _struct(word=_L, bits=_L, id_month=T.DateType(), batch_id=_S)
SUPERSEDED = _struct(external_id=_S, batch_id=_S, by_batch=_S)

# The kept tables: one row per customer and hour, one per customer, one per message, one per merged load.
CUSTOMER_HOURS = _struct(
    customer_id=_S, hour=_TS, n=_L, first_time=_TS, last_time=_TS, characters=_L, urgent=_B, escalating=_B,
    event_month=T.DateType())
CUSTOMER_STATE = _struct(
    customer_id=_S, total_interactions=_L, without_time=_L, first_time=_TS, last_time=_TS, characters=_L, urgent=_B,
    escalating=_B)
HISTORY = _struct(
    participant_external_id=_S, interaction_timestamp=_TS, external_id=_S, content_text=_S)
KEPT_BATCHES = _struct(batch_id=_S)

# The row model an interaction has to satisfy before it is stored.
INTERACTION_MODEL = _struct(
    interaction_id=_S, external_id=_S, platform_type=_S, participant_external_id=_S,
    content_text=_S, content_metadata=_META, interaction_timestamp=_TS,
    parent_interaction_id=_S, interaction_type=_S, platform_metadata=_META,
    processing_metadata=_META)
MODEL_REQUIRED = (
    "external_id", "platform_type", "participant_external_id", "content_text",
    "interaction_timestamp", "interaction_type")

PREDICTION_COLUMNS = (
    "customer_id", "chat_log", "channel", "message", "send_time", "reasoning", "issue_status")
# Exports say which part of how many a chat log is; a log of one part is part 0 of 1.
LOG_COLUMNS = ("part", "parts")
EVALUATION_COLUMNS = (
    "customer_id", "channel", "send_time", "message", "reasoning", "chat_log", "issue_status")
FEATURE_COLUMNS = (
    "total_interactions", "conversation_length", "hours_since_last_interaction",
    "avg_message_length", "contains_urgent_keywords", "has_escalation_words", "response_pattern")
