"""Reading the current state of things: latest rows, histories, joins by customer."""

from pyspark.sql import DataFrame, Window, functions as F

from caseflow.operators.skew import join_unique, semi_join


def latest(df: DataFrame, keys, *order) -> DataFrame:
    """One row per key: the last one in ``order``.

    The rank filter is applied before the shuffle too, so old versions never leave their map task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(name).desc_nulls_last() for name in order])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def latest_profile(df: DataFrame) -> DataFrame:
    return latest(df, ["customer_id"], "created_at", "last_interaction_timestamp")


def latest_conversation(df: DataFrame) -> DataFrame:
    return latest(
        df, ["customer_id"], "created_at", "conversation_end_timestamp", "conversation_id")


def _of(df, ids, name):
    """Rows of the given ids: a Python list becomes a pushed-down filter, a frame a semi join."""
    if isinstance(ids, DataFrame):
        return semi_join(df, ids.select(F.col(ids.columns[0]).alias(name)), name)
    return df.filter(F.col(name).isin(list(ids)))


def profile_of(df: DataFrame, ids) -> DataFrame:
    return _of(df, ids, "customer_id").transform(latest_profile)


def conversation_of(df: DataFrame, ids) -> DataFrame:
    return _of(df, ids, "customer_id").transform(latest_conversation)


def history_of(df: DataFrame, ids) -> DataFrame:
    """Interactions of the given customers in time order."""
    return _of(df, ids, "participant_external_id").orderBy(
        "participant_external_id", "interaction_timestamp", "external_id")


def last_watermarks(df: DataFrame) -> DataFrame:
    """The current mark of every (pipeline, platform)."""
    return df.groupBy("pipeline_name", "platform_type").agg(
        F.max_by("last_processed_timestamp", F.struct("updated_at", "last_processed_timestamp"))
        .alias("last_processed_timestamp"))


def last_watermark(df: DataFrame, pipeline, platform) -> DataFrame:
    return last_watermarks(
        df.filter((F.col("pipeline_name") == pipeline) & (F.col("platform_type") == platform)))


def latest_run(df: DataFrame, run_id=None) -> DataFrame:
    """The current row of every run, or of one. A start row ends in 1970, so an end row wins."""
    if run_id is not None:
        df = df.filter(F.col("run_id") == run_id)
    return latest(df, ["run_id"], "end_timestamp", "created_at", "status")


def with_conversation(profiles: DataFrame, conversations: DataFrame) -> DataFrame:
    """Profiles with their conversation, if any."""
    columns = [
        name for name in ("resolution_status", "conversation_topic", "summary")
        if name in conversations.columns]
    return profiles.join(
        latest_conversation(conversations).select("customer_id", *columns), "customer_id", "left")


def with_history(profiles: DataFrame, activity: DataFrame) -> DataFrame:
    """Profiles with their aggregated history; both sides have one row per customer."""
    return profiles.join(activity, "customer_id", "left")


def resolve_requests(requests: DataFrame, profiles: DataFrame) -> DataFrame:
    """Mark each requested id ``ok`` or ``not_found``. Ids may repeat or be missing."""
    known = latest_profile(profiles).select("customer_id", F.lit("ok").alias("status"))
    return join_unique(requests, known, "customer_id").withColumn(
        "status", F.coalesce("status", F.lit("not_found")))
