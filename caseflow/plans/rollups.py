"""Rebuilding conversations and profiles from the interaction table."""

from pyspark.sql import SparkSession

from caseflow.functions.instants import instant
from caseflow.operators.features import customer_features
from caseflow.operators.rollup import build_conversations, build_profiles
from caseflow.plans.session import job_settings, now_text
from caseflow.sources import sinks, tables


def build_rollups(spark: SparkSession, root, as_of=None, brand="brand") -> None:
    """One aggregation over all interactions; profiles are a projection of the stored result.

    Each table is a new version, so readers keep a whole one meanwhile.
    """
    with job_settings(spark):
        as_of = as_of or now_text()
        tables.ensure_tables(spark, root)
        sinks.write_conversations(
            build_conversations(tables.interactions(spark, root), as_of, brand), root)
        sinks.write_profiles(build_profiles(tables.conversations(spark, root), as_of), root)


def build_features(spark: SparkSession, root, as_of=None) -> None:
    """The features of every customer with a profile, silent ones included, as a stored table."""
    with job_settings(spark):
        as_of = as_of or now_text()
        features = customer_features(tables.profiles(spark, root), tables.interactions(spark, root), as_of)
        sinks.write_features(features.withColumn("created_at", instant(as_of)), root)
