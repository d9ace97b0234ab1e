"""The incremental load of raw tweets into the interaction table."""

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from caseflow import schemas
from caseflow.functions.instants import instant
from caseflow.operators.lookup import last_watermark, latest_run
from caseflow.operators.normalize import normalize, parse_created_at
from caseflow.operators.quality import PROFILES, apply_profile, identity, since
from caseflow.operators.rollup import batch_stats
from caseflow.operators.skew import join_unique
from caseflow.plans import lease as leases
from caseflow.plans.session import job_settings, now_text
from caseflow.sources import sinks, tables
from caseflow.sources.tweets import read_tweets
from caseflow.storage import durable

PIPELINE = "data_ingestion"
INSTANT_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


@dataclass
class IngestResult:
    run_id: str
    status: str = "running"
    records_read: int = 0
    records_processed: int = 0
    valid_records: int = 0
    max_timestamp: str = None
    error: str = None


def read_mark(spark: SparkSession, root, platform):
    """The stored watermark as ISO text with its offset, or None."""
    marks = last_watermark(tables.watermarks(spark, root), PIPELINE, platform).select(
        F.date_format("last_processed_timestamp", INSTANT_TEXT).alias("mark")).collect()
    return marks[0]["mark"] if marks else None


def batch_id_for(runs: DataFrame, run_id, platform, mark, leased: DataFrame = None):
    """A load has a batch of its own, unless an earlier load from the same mark did not complete: then it
    takes over that batch and replaces it. A completed load never loses its batch, and a load that is still running
    keeps it as long as its lease (``leased``: batch_id) is renewed."""
    def said(name):
        return F.get_json_object("config_snapshot", f"$.{name}")

    loads = latest_run(runs.filter(F.col("pipeline_name") == PIPELINE)).withColumn("batch", said("batch_id"))
    completed = loads.filter("status = 'completed'").select("batch")
    left = loads.filter(
        (F.col("status") != "completed") & (F.col("run_id") != run_id) & F.col("batch").isNotNull()
        & (said("platform") == platform) & said("mark").eqNullSafe(F.lit(mark)))
    left = left.join(completed, "batch", "left_anti")
    if leased is not None:
        left = left.join(leased.select(F.col("batch_id").alias("batch")), "batch", "left_anti")
    open_ = left.agg(F.max("batch").alias("batch")).first()
    return open_["batch"] or own_batch(run_id)


def own_batch(run_id):
    return hashlib.md5(f"{PIPELINE}|{run_id}".encode()).hexdigest()


def drop_stored(df: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows that are not stored yet. Ids are made unique first and may be frequent in the new rows."""
    known = stored.select(identity().alias("_identity")).distinct().withColumn(
        "_stored", F.lit(True))
    joined = join_unique(df.withColumn("_identity", identity()), known, "_identity")
    return joined.filter("_stored is null").drop("_identity", "_stored")


def ingest(
        spark: SparkSession, path, root, as_of=None, profile="flag", allowed_lateness=None,
        platform="twitter", encoding="UTF-8", split_files=False, run_type="manual", batch_size=None,
        run_id=None, lease=leases.SECONDS) -> IngestResult:
    """Load what is newer than the watermark, then move the watermark.

    ``lease``: seconds after which a load that no longer renews its lease may be taken over.

    Reading, normalizing, checking and writing are one plan and one write. What the commit depends on
    (row count and latest time) is read back from the written batch, so a task that ran twice cannot
    change it; only ``records_read``, which nothing depends on, is counted on the way. The mark moves only after the write; a load that failed in between is replaced as a
    whole by the next one.
    """
    if profile not in PROFILES:
        raise ValueError(f"unknown quality profile: {profile}; expected one of {PROFILES}")
    with job_settings(spark):
        as_of = as_of or now_text()
        result = IngestResult(run_id or str(uuid.uuid4()))
        tables.ensure_tables(spark, root)
        mark = read_mark(spark, root, platform)
        leased = leases.held(tables.table(spark, root, "load_leases"), now_text())
        batch_id = batch_id_for(tables.runs(spark, root), result.run_id, platform, mark, leased)
        if not leases.claimed(spark, root, batch_id, result.run_id, lease):
            batch_id = own_batch(result.run_id)
            leases.claimed(spark, root, batch_id, result.run_id, lease)
        config = json.dumps({
            "data_file": str(path), "root": str(root), "profile": profile, "platform": platform,
            "mark": mark, "batch_id": batch_id})
        sinks.append_rows(sinks.run_start_row(
            spark, result.run_id, PIPELINE, run_type, "parquet", as_of, config),
            root, "pipeline_runs")
        try:
            with leases.renewed(spark, root, batch_id, result.run_id, lease):
                _load(spark, path, root, as_of, profile, allowed_lateness, platform, encoding,
                      split_files, batch_size, mark, batch_id, result)
            result.status = "completed"
        except Exception as error:  # the run log has to show every failure
            result.status, result.error = "failed", str(error)
        end = sinks.one_row(spark, schemas.RUN, {
            "run_id": result.run_id, "end_timestamp": now_text(), "status": result.status,
            "records_processed": result.records_processed, "error_message": result.error})
        sinks.append_rows(
            sinks.run_ended(tables.runs(spark, root), end, as_of), root, "pipeline_runs")
        return result


def _load(spark, path, root, as_of, profile, allowed_lateness, platform, encoding, split_files,
          batch_size, mark, batch_id, result):
    read = Observation()
    raw = read_tweets(spark, path, encoding, split_files).transform(parse_created_at).transform(
        since, mark, allowed_lateness)
    rows = normalize(
        raw.observe(read, F.count(F.lit(1)).alias("records")), as_of, platform
    ).transform(apply_profile, profile)
    if mark and allowed_lateness:
        stored = tables.interactions(spark, root).filter(F.col("batch_id") != batch_id)
        # Stored times are cut to milliseconds, so the window starts one earlier.
        stored = since(stored, instant(mark) - F.expr("interval 1 millisecond"), allowed_lateness)
        rows = drop_stored(durable(rows), stored)
    folder = sinks.write_interactions(rows, root, batch_id, as_of, batch_size)
    result.records_read = read.get["records"]

    written = spark.read.schema(schemas.INTERACTION_STORED).parquet(folder)
    stats = batch_stats(written.withColumn("is_valid", F.coalesce("is_valid", F.lit(True)))).select(
        "records", "valid_records",
        F.date_format("max_timestamp", INSTANT_TEXT).alias("max_timestamp")).first()
    result.records_processed = stats["records"]
    result.valid_records = stats["valid_records"]
    result.max_timestamp = stats["max_timestamp"]
    if not leases.others(spark, root, batch_id, result.run_id).isEmpty():
        raise RuntimeError(f"the lease on batch {batch_id} was lost to another load")
    if stats["max_timestamp"]:
        # A load that overlapped may have moved the mark meanwhile; it never goes back.
        latest = max(filter(None, [stats["max_timestamp"], read_mark(spark, root, platform)]))
        sinks.append_watermark(
            spark, root, row_id=str(uuid.uuid4()), pipeline=PIPELINE, platform=platform,
            timestamp=latest, records=stats["records"], status="completed", updated_at=now_text())
