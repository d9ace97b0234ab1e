"""From raw tweets to canonical interactions."""

from pyspark.sql import DataFrame, functions as F

from caseflow.functions import instants
from caseflow.operators.quality import identity
from caseflow.schemas import INTERACTION


def rename_canonical(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({
        "tweet_id": "external_id",
        "author_id": "participant_external_id",
        "text": "content_text",
    })


def add_platform(df: DataFrame, platform="twitter", interaction_type="tweet") -> DataFrame:
    return df.withColumns({
        "platform_type": F.lit(platform),
        "interaction_type": F.lit(interaction_type),
    })


def parse_created_at(df: DataFrame) -> DataFrame:
    """Replace the raw creation text by ``interaction_timestamp``."""
    return df.withColumn(
        "interaction_timestamp", instants.parse_created_at(F.col("created_at"))).drop("created_at")


def add_interaction_id(df: DataFrame, deterministic=True) -> DataFrame:
    """An id per row: the hash of its business key, or a random UUID.

    A random id changes when a lost task is run again, so stored rows use the hash.
    """
    key = F.md5(F.concat_ws("|", F.col("platform_type"), identity()))
    return df.withColumn("interaction_id", key if deterministic else F.expr("uuid()"))


def add_lineage(df: DataFrame, as_of) -> DataFrame:
    """Parent id, empty metadata and the load time."""
    return df.withColumns({
        "parent_interaction_id": F.col("in_response_to_tweet_id"),
        "content_metadata": F.lit("{}"),
        "platform_metadata": F.lit("{}"),
        "processing_metadata": F.lit("{}"),
        "created_at": instants.instant(as_of),
    })


def project_canonical(df: DataFrame, extra=()) -> DataFrame:
    return df.select(*INTERACTION.names, *extra)


def normalize(df: DataFrame, as_of, platform="twitter", extra=()) -> DataFrame:
    """All steps above over raw tweets whose creation time is parsed already."""
    return (
        df.transform(rename_canonical)
        .transform(add_platform, platform)
        .transform(add_interaction_id)
        .transform(add_lineage, as_of)
        .transform(project_canonical, extra))
