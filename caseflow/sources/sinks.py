"""Writing tables and exports. Every write is a distributed write of a DataFrame."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from caseflow import schemas
from caseflow.functions.instants import event_month, instant, to_millis
from caseflow.operators.conform import ids_to_text
from caseflow.operators.evaluate import project_evaluation
from caseflow.operators.lookup import latest_run
from caseflow.operators.predict import project_predictions
from caseflow.sources.tables import SCHEMAS, SORT_KEYS, current_version, ensure_versions, path_of, table

# The writer would cut blanks at both ends of a text by default.
CSV_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false"}


def _shape(df, schema, defaults=None):
    """The columns of the schema in order and type, timestamps in milliseconds, defaults filled in."""
    columns = []
    for field in schema.fields:
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        value = value.cast(field.dataType)
        if field.name in (defaults or {}):
            value = F.coalesce(value, defaults[field.name].cast(field.dataType))
        if field.dataType.typeName() == "timestamp":
            value = to_millis(value)
        columns.append(value.alias(field.name))
    return df.select(columns)


def shape_interactions(df: DataFrame, as_of) -> DataFrame:
    """Interactions as stored: fixed columns, missing ids and text as ``''``, metadata as ``{}``."""
    ids = [
        name for name in ("interaction_id", "external_id", "participant_external_id")
        if name in df.columns]
    defaults = {name: F.lit("{}") for name in (
        "content_metadata", "platform_metadata", "processing_metadata")}
    defaults |= {"content_text": F.lit(""), "created_at": instant(as_of)}
    return (
        _shape(ids_to_text(df, ids), schemas.INTERACTION_STORED, defaults)
        .withColumn("event_month", event_month(F.col("interaction_timestamp"))))


def write_interactions(df: DataFrame, root, batch_id, as_of, batch_size=None) -> str:
    """Store one batch in its own folder and return the folder. Writing the batch again replaces it.

    Rows are brought together by month, with large months split at run time, so a month gets few large
    files; inside a file they follow the table's sort key. ``batch_size`` caps the rows per file.
    """
    folder = f"{path_of(root, 'interactions')}/batch_id={batch_id}"
    writer = (
        shape_interactions(df, as_of)
        .hint("rebalance", "event_month")
        .sortWithinPartitions("event_month", *SORT_KEYS["interactions"])
        .write.mode("overwrite").partitionBy("event_month"))
    if batch_size:
        writer = writer.option("maxRecordsPerFile", batch_size)
    writer.parquet(folder)
    return folder


def publish(df: DataFrame, root, name) -> int:
    """Replace a versioned table: write a new version, then make it the current one.

    A version that failed on the way is never listed and its number is written over. Readers of the old version
    go on with it; old versions are kept until the caller removes their folders.
    """
    spark = df.sparkSession
    ensure_versions(spark, root, name)
    version = (current_version(spark, root, name) or 0) + 1
    _shape(df, SCHEMAS[name]).hint("rebalance").sortWithinPartitions(*SORT_KEYS[name]).write.mode(
        "overwrite").parquet(f"{path_of(root, name)}/version={version}")
    spark.range(version, version + 1, 1, 1).select(F.col("id").alias("version")).write.mode("append").parquet(
        f"{path_of(root, name)}/versions")
    return version


def write_conversations(df: DataFrame, root) -> None:
    publish(df, root, "conversations")


def write_profiles(df: DataFrame, root) -> None:
    publish(df, root, "customer_profiles")


def write_features(df: DataFrame, root) -> None:
    publish(df, root, "customer_features")


def store_upsert(new: DataFrame, root) -> None:
    """Upsert marks into the stored table of current marks."""
    ensure_versions(new.sparkSession, root, "watermarks_current")
    publish(upsert_watermark(table(new.sparkSession, root, "watermarks_current"), new), root, "watermarks_current")


def store_run_ends(ends: DataFrame, root, as_of) -> None:
    """Change the ended runs in the stored table of runs."""
    publish(run_ended(table(ends.sparkSession, root, "runs_current"), ends, as_of, mode="update"), root, "runs_current")


def one_row(spark, schema, values):
    """A frame of one row from text, numbers and ISO times; columns are typed by Spark, not Python."""
    columns = []
    for field in schema.fields:
        value = values.get(field.name)
        if field.dataType.typeName() == "timestamp" and value is not None:
            columns.append(instant(value).alias(field.name))
        else:
            columns.append(F.lit(value).cast(field.dataType).alias(field.name))
    return spark.range(1).select(columns)


def append_rows(df: DataFrame, root, name) -> None:
    df.coalesce(1).write.mode("append").parquet(path_of(root, name))


def watermark_row(
        spark: SparkSession, row_id, pipeline, platform, timestamp, records, status, updated_at,
        external_id="") -> DataFrame:
    return one_row(spark, schemas.WATERMARK, {
        "id": row_id, "pipeline_name": pipeline, "platform_type": platform,
        "last_processed_timestamp": timestamp, "last_processed_external_id": external_id,
        "records_processed": records, "last_run_status": status, "updated_at": updated_at})


def append_watermark(spark: SparkSession, root, **values) -> None:
    """A new mark is always a new row; the lookup takes the latest."""
    append_rows(watermark_row(spark, **values), root, "ingestion_watermarks")


def upsert_watermark(current: DataFrame, new: DataFrame) -> DataFrame:
    """Replace the mark of a key or add it. An existing row keeps its id and its last external id."""
    keys = ["pipeline_name", "platform_type"]
    kept = ("id", "last_processed_external_id")
    old = current.select(*keys, *[
        F.col(name).alias(f"_old_{name}") for name in schemas.WATERMARK.names if name not in keys])
    joined = new.join(old, keys, "full_outer")
    return joined.select([
        F.col(name) if name in keys
        else F.coalesce(f"_old_{name}", name).alias(name) if name in kept
        else F.coalesce(name, f"_old_{name}").alias(name)
        for name in schemas.WATERMARK.names])


def run_start_row(
        spark: SparkSession, run_id, pipeline, run_type, target, started, config_json) -> DataFrame:
    return one_row(spark, schemas.RUN, {
        "run_id": run_id, "pipeline_name": pipeline, "run_type": run_type,
        "database_target": target, "start_timestamp": started,
        "end_timestamp": "1970-01-01 00:00:00", "status": "running", "records_processed": 0,
        "error_message": "", "config_snapshot": config_json, "created_at": started})


def run_started(runs: DataFrame, as_of) -> DataFrame:
    """Start rows for a frame of runs (run_id, pipeline_name, run_type, database_target, config)."""
    return runs.select(
        "run_id", "pipeline_name", "run_type", "database_target",
        instant(as_of).alias("start_timestamp"),
        F.lit("1970-01-01 00:00:00").cast("timestamp").alias("end_timestamp"),
        F.lit("running").alias("status"), F.lit(0).cast("long").alias("records_processed"),
        F.lit("").alias("error_message"), F.to_json("config").alias("config_snapshot"),
        instant(as_of).alias("created_at"))


_END_COLUMNS = ("end_timestamp", "status", "records_processed", "error_message")


def run_ended(runs: DataFrame, ends: DataFrame, as_of, mode="append") -> DataFrame:
    """Merge end values (run_id, end_timestamp, status, records_processed, error_message) over runs.

    ``append`` gives one new row per end, built on the latest row of its run, or on ``unknown`` defaults
    when the run never started. ``update`` gives the whole table with the ended runs changed in place.
    """
    end = ends.select("run_id", *[F.col(name).alias(f"_end_{name}") for name in _END_COLUMNS])
    if mode == "update":
        joined = runs.join(end, "run_id", "left")
        return joined.select([
            F.coalesce(f"_end_{name}", name).alias(name) if name in _END_COLUMNS else F.col(name)
            for name in schemas.RUN.names])
    if mode != "append":
        raise ValueError(f"unknown run end mode: {mode}")
    unknown = {
        "pipeline_name": F.lit("unknown"), "run_type": F.lit("unknown"),
        "database_target": F.lit("unknown"),
        "start_timestamp": F.lit("1970-01-01 00:00:00").cast("timestamp"),
        "config_snapshot": F.lit("{}"), "created_at": instant(as_of)}
    joined = end.join(latest_run(runs).drop(*_END_COLUMNS), "run_id", "left")
    return joined.select([
        F.col(f"_end_{name}").alias(name) if name in _END_COLUMNS
        else F.col(name) if name == "run_id"
        else F.coalesce(F.col(name), unknown[name]).alias(name)
        for name in schemas.RUN.names])


def write_version(df: DataFrame, path, version) -> None:
    """Store a whole new version of a small table; the version being read stays untouched."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def write_csv(df: DataFrame, path) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def _arranged(df, in_order):
    """Rows sorted by customer within files, or over all files.

    Order over all files keeps the parts of one long chat log together without holding them in one
    task; it samples the rows first, so it is worth asking for only when there are such logs.
    """
    order = ["customer_id", "part"] if "part" in df.columns else ["customer_id"]
    if in_order:
        df = df.repartitionByRange(*order)
    return df.sortWithinPartitions(*order)


def export_predictions(df: DataFrame, path, in_order=True) -> None:
    write_csv(project_predictions(_arranged(df, in_order)), path)


def export_evaluation(df: DataFrame, path, in_order=True) -> None:
    write_csv(project_evaluation(_arranged(df, in_order)), path)
