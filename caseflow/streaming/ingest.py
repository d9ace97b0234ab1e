"""The load as a stream: the checkpoint takes the place of the watermark table.

Each micro-batch is stored by the rules of the batch load. What it leaves out is stored aside with its reason, and
one row per micro-batch counts what was read, stored and left out, so nothing disappears unseen and the way the input
is cut into micro-batches does not decide what is stored.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from caseflow import schemas
from caseflow.functions.instants import event_month, instant
from caseflow.operators.normalize import normalize, parse_created_at
from caseflow.operators.quality import (
    PROFILES, clean_text, drop_missing_text, flag_length, flag_required, identity, score)
from caseflow.plans.session import job_settings, now_text
from caseflow.schemas import RAW_TWEET
from caseflow.sources import sinks, tables
from caseflow.sources.tweets import CSV_OPTIONS
from caseflow.storage import scratch

LEFT_OUT = "left_out"
# Words of 64 bits that the identities of a month are spread over.
WORD_BITS = 24
METRICS = "stream_batches"


def tweet_stream(spark: SparkSession, in_dir, encoding="UTF-8", max_files_per_trigger=None):
    """New CSV files in a folder as a stream of raw tweets."""
    reader = spark.readStream.schema(RAW_TWEET).options(**CSV_OPTIONS).option("encoding", encoding)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(in_dir)


def stream_rows(raw, as_of, platform="twitter"):
    """Canonical rows of a stream; rows without a readable time or an id stay."""
    return normalize(raw.transform(parse_created_at), as_of, platform)


def _months(rows):
    """The months of the rows: one value per month, read to prune the stored table."""
    return [r["m"] for r in rows.select(event_month(F.col("interaction_timestamp")).alias("m")).distinct().collect()]


def _order(prefix=""):
    """Of two copies the one with the smaller order is kept: the earlier, then by text and author, missing values last."""
    columns = []
    for name in ("interaction_timestamp", "content_text", "participant_external_id"):
        columns += [F.col(prefix + name).isNull().alias(f"no_{name}"), F.col(prefix + name).alias(name)]
    return F.struct(*columns)


def _bits(rows):
    """The word of each identity and its eight bits there."""
    second = F.xxhash64("identity", F.lit(1))
    mask = F.lit(0).cast("long")
    for i in range(8):
        mask = mask.bitwiseOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.shiftright(second, 6 * i).bitwiseAND(F.lit(63)).cast("int")))
    return rows.withColumns({"word": F.pmod(F.xxhash64("identity"), F.lit(1 << WORD_BITS)), "mask": mask})


def known_identities(ids: DataFrame, root, batch_id, keep) -> DataFrame:
    """(identity, known, known_stored, known_batch): the best copy seen before of each identity of a micro-batch.

    The bits of each month say which identities may lie in it; only the months that they name are asked exactly, and
    the copies themselves are read only of the identities that were found.
    """
    spark = ids.sparkSession
    bits = tables.table(spark, root, "identity_bits").filter(F.col("batch_id") != batch_id)
    named = bits.join(_bits(ids), "word").filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    months = [row["id_month"] for row in named.select("id_month").distinct().collect()]
    asked = F.col("id_month").isin([month for month in months if month is not None])
    if None in months:
        asked = asked | F.col("id_month").isNull()
    seen = tables.table(spark, root, "identities").filter((F.col("batch_id") != batch_id) & asked)
    found = keep(ids.join(seen.select("identity"), "identity", "left_semi"))
    return seen.join(found, "identity", "left_semi").groupBy("identity").agg(
        F.min(F.struct(_order().alias("order"), "is_stored", "batch_id")).alias("best")).select(
        "identity", F.col("best.order").alias("known"), F.col("best.is_stored").alias("known_stored"),
        F.col("best.batch_id").alias("known_batch"))


def mark_left_out(rows: DataFrame, root, batch_id, loaded: DataFrame, keep, profile="flag", late_before=None) -> DataFrame:
    """The rows with ``left_out``: null, or why a row is not stored; and what is known of their identity.

    ``late``: older than ``late_before``; ``copy``: a copy of another row, of this micro-batch or of one before, of
    which the earliest counts; ``stored``: its identity is stored by an earlier micro-batch or is in ``loaded``, of which
    the months of the rows are asked; ``no_text``: the profile ``clean`` wants a text, and the earliest copy has none.

    Texts are stored twice and shuffled once: the first rows are judged where the search for them brings them, and the
    others are told by their number.
    """
    late = F.lit(False)
    if late_before is not None:
        late = F.coalesce(F.col("interaction_timestamp") < instant(late_before), F.lit(False))
    numbered = keep(rows.withColumns({
        "identity": identity(), "_late": late, "_row": F.monotonically_increasing_id()}))
    months = _months(numbered)
    in_months = F.col("event_month").isin([m for m in months if m is not None])
    if None in months:
        in_months = in_months | F.col("event_month").isNull()
    in_loads = loaded.filter(in_months).select(identity().alias("identity")).distinct().withColumn("_loaded", F.lit(True))
    ids = numbered.filter("not _late").select("identity").distinct()
    # The first of each identity is found inside each task before the shuffle.
    order = Window.partitionBy("identity").orderBy(_order(), "_row")
    firsts = numbered.filter("not _late").withColumn("_rank", F.row_number().over(order)).filter("_rank = 1")
    no_text = F.col("content_text").isNull() if profile == "clean" else F.lit(False)
    judged = keep(
        firsts.join(known_identities(ids, root, batch_id, keep), "identity", "left").join(in_loads, "identity", "left")
        .withColumn("_better", F.col("known").isNull() | (_order() < F.col("known")))
        .withColumn("left_out", F.when(F.col("_loaded"), "stored").when(
            ~F.col("_better"), F.when(F.col("known_stored"), "stored").otherwise("copy")).when(no_text, "no_text"))
        .select(*numbered.columns, "_better", "known_stored", "known_batch", "left_out"))
    further = keep(numbered.select("_row").join(judged.select("_row"), "_row", "left_anti"))
    others = numbered.join(further, "_row", "left_semi").withColumn(
        "left_out", F.when(F.col("_late"), "late").otherwise("copy"))
    return judged.unionByName(others, allowMissingColumns=True).drop("_row", "_late")


def remember(marked: DataFrame, root, batch_id) -> None:
    """Write which identities have a new best copy, their bits by month, and which stored rows these copies replace."""
    new = marked.filter(F.coalesce("_better", F.lit(False)) & F.coalesce(
        F.col("left_out").isNull() | (F.col("left_out") == "no_text"), F.lit(False))).withColumn(
        "id_month", event_month(F.col("interaction_timestamp")))

    def path(name, by="batch_id"):
        return f"{tables.path_of(root, name)}/{by}={batch_id}"

    new.select("identity", "external_id", "interaction_timestamp", "content_text", "participant_external_id",
               F.col("left_out").isNull().alias("is_stored"), "id_month").write.mode("overwrite").partitionBy(
        "id_month").parquet(path("identities"))
    _bits(new).groupBy("id_month", "word").agg(F.bit_or("mask").alias("bits")).write.mode("overwrite").parquet(
        path("identity_bits"))
    new.filter("known_stored").select("external_id", F.col("known_batch").alias("batch_id")).write.mode(
        "overwrite").parquet(path("superseded", "by_batch"))


def mark_unfit(rows: DataFrame, profile, late_before=None) -> DataFrame:
    """``left_out`` where copies are kept: ``late`` and ``no_text`` only."""
    reason = F.when(F.col("content_text").isNull(), "no_text") if profile == "clean" else F.lit(None).cast("string")
    if late_before is not None:
        reason = F.when(F.col("interaction_timestamp") < instant(late_before), "late").otherwise(reason)
    return rows.withColumn("left_out", reason)


def _quality(rows, profile):
    if profile == "flag":
        return rows.transform(flag_required).transform(flag_length).transform(score)
    return rows.transform(drop_missing_text).transform(clean_text)


def store_micro_batch(
        batch: DataFrame, number, root, as_of, profile="flag", delay=None, name="stream", platform="twitter", copies="drop"):
    """Store one micro-batch of raw tweets in its own folders. A replayed one replaces itself."""
    spark = batch.sparkSession
    batch_id = f"{name}-{number:010d}"
    rows = stream_rows(batch, as_of, platform)
    # What this stream stored is known by its identities; rows of loads are looked for in the months of the rows.
    loaded = tables.table(spark, root, "interactions").filter(~F.col("batch_id").startswith(f"{name}-"))
    late_before = None
    if delay is not None:
        # The high mark of the micro-batches before this one: one small row each.
        late_before = stream_batches(spark, root, name).filter(F.col("number") < number).agg(
            (F.max("max_timestamp") - F.expr(f"interval {delay}")).cast("string").alias("mark")).first()["mark"]
    with scratch(spark) as keep:
        if copies == "keep":
            marked = keep(mark_unfit(rows, profile, late_before))
        else:
            marked = mark_left_out(rows, root, batch_id, loaded, keep, profile, late_before)
        folder = sinks.write_interactions(
            marked.filter("left_out is null").drop("left_out").transform(_quality, profile), root, batch_id, as_of)
        if copies != "keep":
            remember(marked, root, batch_id)
        marked.filter("left_out is not null").select(*rows.columns, "left_out").write.mode("overwrite").parquet(
            f"{tables.path_of(root, LEFT_OUT)}/batch_id={batch_id}")
        written = spark.read.schema(schemas.INTERACTION_STORED).parquet(folder).count()
        # A stored row that a better copy replaced is a copy left out.
        replaced = tables.table(spark, root, "superseded").filter(F.col("by_batch") == batch_id).count()
        reasons = [F.count_if(F.coalesce(F.col("left_out") == why, F.lit(False))).alias(f"left_out_{why}")
                   for why in ("late", "copy", "stored", "no_text")]
        read = marked.agg(
            F.count(F.lit(1)).alias("records"),
            # Of all rows read: a copy that is left out has been seen too.
            F.max("interaction_timestamp").alias("max_timestamp"),
            F.count_if(F.col("interaction_timestamp").isNull()).alias("without_time"),
            F.count_if(F.coalesce(F.col("external_id"), F.lit("")) == "").alias("without_id"), *reasons)
        read.withColumns({
            "stored": F.lit(written - replaced).cast("long"),
            "left_out_copy": F.col("left_out_copy") + F.lit(replaced),
            "number": F.lit(number).cast("long")}).coalesce(1).write.mode("overwrite").parquet(
            f"{tables.path_of(root, METRICS)}/stream={name}/batch={number}")


def stream_ingest(
        spark: SparkSession, in_dir, root, checkpoint, as_of=None, profile="flag", delay=None,
        max_files_per_trigger=None, name="stream", encoding="UTF-8", copies="drop"):
    """Load all files that are there, then stop; the next call goes on after them.

    Rows without a readable time or an id are stored like others, flagged by the profile ``flag``. Each identity is
    stored once, as its earliest copy: one that comes later replaces the stored row. ``copies="keep"`` stores all copies, as
    the batch load does with the profile ``flag``. With ``delay`` rows older than the latest time of earlier micro-batches minus the delay are left out.
    """
    if profile not in PROFILES:
        raise ValueError(f"unknown quality profile: {profile}; expected one of {PROFILES}")
    if copies not in ("drop", "keep"):
        raise ValueError(f"copies are dropped or kept, not: {copies}")
    as_of = as_of or now_text()

    def store(batch, number):
        store_micro_batch(batch, number, root, as_of, profile, delay, name, copies=copies)

    with job_settings(spark):
        tables.ensure_tables(spark, root)
        query = (
            tweet_stream(spark, in_dir, encoding, max_files_per_trigger).writeStream
            .foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
        query.awaitTermination()
    return query


def stream_batches(spark: SparkSession, root, name="stream") -> DataFrame:
    """One row per stored micro-batch, counted from what was written."""
    return tables.table(spark, root, METRICS).filter(F.col("stream") == name)


def stream_metrics(spark: SparkSession, root, name="stream") -> dict:
    """The counts of all micro-batches of a stream together."""
    counted = [c for c in stream_batches(spark, root, name).columns if c not in (
        "max_timestamp", "number", "stream", "batch")]
    return stream_batches(spark, root, name).agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counted)).first().asDict()


def left_out(spark: SparkSession, root) -> DataFrame:
    """The rows that micro-batches left out, with their reason and batch."""
    fields = schemas.INTERACTION.simpleString()[7:-1].replace(":", " ")
    return spark.read.schema(f"{fields}, left_out string, batch_id string").parquet(tables.path_of(root, LEFT_OUT))
