"""The stored tables: where they are, how they are created and read.

All tables are Parquet folders under one root. Interactions lie in ``batch_id=/event_month=`` folders:
a batch owns its folder, so that loading it again replaces it, and a time filter skips whole months.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from caseflow import schemas
from caseflow.operators.conform import serialize_nested
from caseflow.operators.limits import first_rows

SCHEMAS = {
    "interactions": schemas.INTERACTION_TABLE,
    "ingestion_watermarks": schemas.WATERMARK,
    "pipeline_runs": schemas.RUN,
    "conversations": schemas.CONVERSATION,
    "customer_profiles": schemas.PROFILE,
    "customer_features": schemas.FEATURES,
    "watermarks_current": schemas.WATERMARK,
    "runs_current": schemas.RUN,
    "stream_batches": schemas.STREAM_BATCH,
    "load_leases": schemas.LEASE,
    "identities": schemas.IDENTITY,
    "identity_bits": schemas.IDENTITY_BITS,
    "superseded": schemas.SUPERSEDED,
}
# Tables that are replaced as a whole: a new version is written next to the others, then one row in the list of
# versions makes it the current one, so a reader never meets half a table.
VERSIONED = ("conversations", "customer_profiles", "customer_features", "watermarks_current", "runs_current")
PARTITIONS = {"interactions": ("batch_id", "event_month"), "stream_batches": ("stream", "batch"),
              "identities": ("batch_id", "id_month"), "identity_bits": ("batch_id",), "superseded": ("by_batch",)}
SORT_KEYS = {
    "interactions": ("platform_type", "interaction_timestamp", "external_id"),
    "ingestion_watermarks": ("pipeline_name", "platform_type", "updated_at"),
    "pipeline_runs": ("pipeline_name", "start_timestamp"),
    "conversations": ("customer_id", "conversation_start_timestamp"),
    "customer_profiles": ("customer_id", "created_at"),
    "customer_features": ("customer_id",),
    "watermarks_current": ("pipeline_name", "platform_type"),
    "runs_current": ("run_id",),
}


def path_of(root, name):
    return f"{root.rstrip('/')}/{name}"


def ensure_tables(spark: SparkSession, root) -> None:
    """Create the tables that do not exist yet, empty."""
    for name, schema in SCHEMAS.items():
        if name in VERSIONED:
            ensure_versions(spark, root, name)
            continue
        empty = spark.range(0, 0, 1, 1).select([
            F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields])
        writer = empty.write.mode("ignore")
        if name in PARTITIONS:
            writer = writer.partitionBy(*PARTITIONS[name])
        writer.parquet(path_of(root, name))


def ensure_versions(spark: SparkSession, root, name) -> None:
    spark.range(0, 0, 1, 1).select(F.col("id").alias("version")).write.mode("ignore").parquet(
        f"{path_of(root, name)}/versions")


def current_version(spark: SparkSession, root, name):
    """The number of the current version, or None: one value of a list with a row per version."""
    return spark.read.schema("version long").parquet(f"{path_of(root, name)}/versions").agg(
        F.max("version")).first()[0]


def table(spark: SparkSession, root, name) -> DataFrame:
    if name not in VERSIONED:
        return spark.read.schema(SCHEMAS[name]).parquet(path_of(root, name))
    version = current_version(spark, root, name)
    if version is None:
        return spark.createDataFrame([], SCHEMAS[name])
    return spark.read.schema(SCHEMAS[name]).parquet(f"{path_of(root, name)}/version={version}")


def _first(df, name, limit, order_by=None):
    if limit is None:
        return df
    return first_rows(df, order_by or SORT_KEYS[name], limit)


def interactions(spark: SparkSession, root, limit=None) -> DataFrame:
    """All stored rows but those that a better copy replaced; whether there are such is asked of their small table."""
    found, gone = table(spark, root, "interactions"), superseded(spark, root)
    if gone is not None:
        found = found.join(gone.select("batch_id", "external_id"), ["batch_id", "external_id"], "left_anti").select(
            SCHEMAS["interactions"].names)
    return _first(found, "interactions", limit)


def superseded(spark: SparkSession, root):
    """The rows that a better copy replaced, or None."""
    try:
        gone = table(spark, root, "superseded")
        return None if gone.isEmpty() else gone
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def profiles(
        spark: SparkSession, root, limit=None, order_by=("customer_id", "created_at"), as_text=False):
    """Profiles, with their timestamps as ISO text when asked for."""
    df = _first(table(spark, root, "customer_profiles"), "customer_profiles", limit, order_by)
    return serialize_nested(df) if as_text else df


def conversations(spark: SparkSession, root) -> DataFrame:
    return table(spark, root, "conversations")


def watermarks(spark: SparkSession, root) -> DataFrame:
    return table(spark, root, "ingestion_watermarks")


def runs(spark: SparkSession, root) -> DataFrame:
    return table(spark, root, "pipeline_runs")


def latest_version(spark: SparkSession, path, schema) -> DataFrame:
    """The newest version of a table that is kept as ``version=`` folders."""
    versioned = StructType(schema.fields + [StructField("version", LongType())])
    versions = spark.read.schema(versioned).parquet(path)
    newest = versions.agg(F.max("version").alias("version"))
    return versions.join(F.broadcast(newest), "version", "left_semi").drop("version")
