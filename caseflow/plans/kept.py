"""What is known of each customer, kept up load by load instead of rebuilt.

A version adds the loads that completed since the version before. It reads these loads and the old state only:

* ``hours``: one row per customer and hour of the new loads, with everything that can be merged (counts, first and last
  time, characters, keyword flags); each version adds its own part;
* ``state``: one row per customer, the old state merged with the new hours; bucketed by customer and written whole;
* ``history``: the messages of the new loads, bucketed by participant, a part for each version. What a participant with
  more than ``2 ** part_bits`` messages writes from then on goes to ``history_long``, in ranges of time, so that no bucket
  holds more than that of one participant.

A version counts from the moment its row is in ``versions``. Before that its loads are not merged, and the next run writes
the same version over.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from caseflow import schemas
from caseflow.functions.instants import event_month, hours_ago, instant
from caseflow.functions.text import ESCALATION, URGENT, contains_any
from caseflow.operators import predict as prediction
from caseflow.operators.features import FEATURE_DEFAULTS, SPREAD_MICROS
from caseflow.operators.history import PART_BITS, PART_BYTES, bucketed_long, bucketed_parts, bucketed_short, chat_log
from caseflow.operators.lookup import latest_run, with_conversation
from caseflow.operators.quality import resolution_counts
from caseflow.operators.rollup import as_conversations, build_profiles
from caseflow.operators.rules import ACTIVITY_DEFAULTS, DEFAULT_RULES
from caseflow.operators.skew import is_small, join_unique
from caseflow.plans.ingest import PIPELINE
from caseflow.plans.scoring import PredictionResult
from caseflow.plans.session import job_settings, now_text
from caseflow.sources import sinks, tables
from caseflow.sources.bucketed import read_parts, write_part
from caseflow.storage import scratch

BUCKETS = 64
STATE_KEY, HISTORY_KEY = "customer_id", "participant_external_id"
HISTORY_SORT = (HISTORY_KEY, "interaction_timestamp", "external_id")


@dataclass
class Kept:
    """The current version of the kept tables."""
    spark: SparkSession
    root: str
    version: int
    buckets: int
    part_bits: int
    first: int = 1

    def path(self, name):
        return kept_path(self.root, name)

    def state(self) -> DataFrame:
        """One row per customer: counts, first and last time, characters and keyword flags."""
        return read_parts(
            self.spark, self.path("state"), schemas.CUSTOMER_STATE, [self.version], STATE_KEY, self.buckets, [STATE_KEY])

    def hours(self) -> DataFrame:
        return self._added("hours", schemas.CUSTOMER_HOURS)

    def history(self) -> DataFrame:
        """The messages of participants up to the length of a part, and the first ones of longer ones; bucketed."""
        return read_parts(
            self.spark, self.path("history"), schemas.HISTORY, range(self.first, self.version + 1), HISTORY_KEY, self.buckets,
            HISTORY_SORT)

    def history_long(self) -> DataFrame:
        return self._added("history_long", schemas.HISTORY)

    def messages(self) -> DataFrame:
        """All messages. A filter on the participant reads one bucket, and of long histories their range only."""
        return self.history().unionByName(self.history_long())

    def long(self) -> DataFrame:
        """The customers with more messages than a part takes: all that ``history_long`` can hold messages of."""
        return self.state().filter(F.col("total_interactions") > 2 ** self.part_bits).select(STATE_KEY)

    def huge(self):
        """Those of ``long`` whose history a task must not hold, or None where these are all of them."""
        if self.part_bits >= PART_BITS:
            return None
        # A character takes four bytes at most.
        return self.state().filter(
            (F.col("total_interactions") > 2 ** self.part_bits)
            & ((F.col("total_interactions") > 2 ** PART_BITS) | (F.col("characters") > PART_BYTES // 4))).select(STATE_KEY)

    def batches(self) -> DataFrame:
        return self._added("batches", schemas.KEPT_BATCHES)

    def _added(self, name, schema):
        stored = self.spark.read.schema(f"{_ddl(schema)}, version long").parquet(self.path(name))
        return stored.filter(F.col("version").between(self.first, self.version)).drop("version")


def _ddl(schema):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def kept_path(root, name):
    return f"{tables.path_of(root, 'customer_kept')}/{name}"


def kept(spark: SparkSession, root):
    """The current version of the kept tables, or None."""
    spark.range(0, 0, 1, 1).selectExpr("id as version", "0 as buckets", "0 as part_bits", "id as first").write.mode("ignore").parquet(
        kept_path(root, "versions"))
    latest = spark.read.schema("version long, buckets int, part_bits int, first long").parquet(kept_path(root, "versions")).orderBy(
        F.desc("version")).first()
    return Kept(spark, root, latest["version"], latest["buckets"], latest["part_bits"], latest["first"]) if latest else None


def completed_batches(spark: SparkSession, root) -> DataFrame:
    """(batch_id) of every load and micro-batch that completed."""
    loads = latest_run(tables.runs(spark, root).filter(F.col("pipeline_name") == PIPELINE)).filter(
        "status = 'completed'").select(F.get_json_object("config_snapshot", "$.batch_id").alias("batch_id"))
    micro = tables.table(spark, root, "stream_batches").select(
        F.concat("stream", F.lit("-"), F.lpad(F.col("number").cast("string"), 10, "0")).alias("batch_id"))
    return loads.unionByName(micro).filter("batch_id is not null").distinct()


def hourly(rows: DataFrame) -> DataFrame:
    """One row per customer and hour, with all that can be merged; rows without a time have no hour."""
    text = F.col("content_text")
    return rows.filter(F.col(HISTORY_KEY) != "").groupBy(
        F.col(HISTORY_KEY).alias("customer_id"), F.date_trunc("hour", "interaction_timestamp").alias("hour")
    ).agg(
        F.count(F.lit(1)).alias("n"), F.min("interaction_timestamp").alias("first_time"),
        F.max("interaction_timestamp").alias("last_time"),
        F.sum(F.coalesce(F.length(text), F.lit(0))).alias("characters"),
        F.bool_or(contains_any(text, URGENT)).alias("urgent"),
        F.bool_or(contains_any(text, ESCALATION)).alias("escalating"))


def customer_state(hours: DataFrame) -> DataFrame:
    return hours.groupBy("customer_id").agg(
        F.sum("n").alias("total_interactions"),
        F.coalesce(F.sum(F.when(F.col("hour").isNull(), F.col("n"))), F.lit(0)).alias("without_time"),
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"),
        F.sum("characters").alias("characters"), F.bool_or("urgent").alias("urgent"),
        F.bool_or("escalating").alias("escalating"))


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two states as one. Sums, extremes and flags do not depend on the order of merging."""
    renamed = new.select("customer_id", *(F.col(c).alias(f"_{c}") for c in new.columns if c != "customer_id"))
    joined = old.join(renamed, "customer_id", "full_outer")

    def both(name, how):
        return F.coalesce(how(F.col(name), F.col(f"_{name}")), F.col(name), F.col(f"_{name}")).alias(name)

    def add(a, b):
        return a + b

    def either(a, b):
        return a | b

    return joined.select(
        "customer_id", both("total_interactions", add), both("without_time", add), both("first_time", F.least),
        both("last_time", F.greatest), both("characters", add), both("urgent", either), both("escalating", either))


def keep_up(spark: SparkSession, root, as_of=None, brand="brand", buckets=BUCKETS, part_bits=PART_BITS) -> int:
    """Merge the loads that completed since the last version, and publish conversations and profiles from the result.

    Returns the number of loads merged. ``buckets`` and ``part_bits`` count for the first version only.
    """
    with job_settings(spark):
        as_of = as_of or now_text()
        tables.ensure_tables(spark, root)
        old, first = kept(spark, root), 1
        version = old.version + 1 if old else 1
        done = completed_batches(spark, root)
        if old:
            buckets, part_bits = old.buckets, old.part_bits
            replaced = tables.superseded(spark, root)
            if replaced is not None and not replaced.join(old.batches(), "batch_id", "left_semi").join(
                    old.batches().withColumnRenamed("batch_id", "by_batch"), "by_batch", "left_anti").isEmpty():
                # A row that is merged was replaced since, and extremes cannot be taken back: start anew.
                first, old = old.version + 1, None
            else:
                first = old.first
                done = done.join(old.batches(), "batch_id", "left_anti")
        # Ids of loads since the last version: control values.
        batches = sorted(row["batch_id"] for row in done.collect())
        if not batches:
            return 0
        now = Kept(spark, root, version, buckets, part_bits, first)
        rows = tables.interactions(spark, root).filter(F.col("batch_id").isin(batches))
        _write_hours(rows, now)
        _write_state(old, now)
        _write_history(rows, now)
        spark.createDataFrame([(batch,) for batch in batches], "batch_id string").coalesce(1).write.mode(
            "overwrite").parquet(f"{now.path('batches')}/version={now.version}")
        spark.range(1).select(
            F.lit(now.version).cast("long").alias("version"), F.lit(buckets).alias("buckets"),
            F.lit(part_bits).alias("part_bits"), F.lit(first).cast("long").alias("first")).write.mode(
            "append").parquet(now.path("versions"))
        sinks.write_conversations(kept_conversations(now, as_of, brand), root)
        sinks.write_profiles(build_profiles(tables.conversations(spark, root), as_of), root)
        return len(batches)


def _write_hours(rows, now):
    hourly(rows).withColumn("event_month", event_month(F.col("hour"))).hint("rebalance", "event_month").write.mode(
        "overwrite").partitionBy("event_month").parquet(f"{now.path('hours')}/version={now.version}")


def _write_state(old, now):
    new = customer_state(now.spark.read.schema(_ddl(schemas.CUSTOMER_HOURS)).parquet(
        f"{now.path('hours')}/version={now.version}"))
    state = merged(old.state(), new) if old else new.repartition(now.buckets, STATE_KEY)
    write_part(state, now.path("state"), now.version, STATE_KEY, now.buckets, [STATE_KEY])


def _write_history(rows, now):
    rows = rows.filter(F.col(HISTORY_KEY) != "").select(schemas.HISTORY.names)
    long = now.long().select(F.col(STATE_KEY).alias(HISTORY_KEY), F.lit(True).alias("is_long"))
    with scratch(now.spark) as keep:
        if is_small(long):
            marked = rows.join(F.broadcast(long), HISTORY_KEY, "left")
        else:
            # Read three times: for the buckets, and for the ranges and their bounds.
            marked = keep(join_unique(rows, long, HISTORY_KEY))
        write_part(
            marked.filter("is_long is null").select(schemas.HISTORY.names).repartition(now.buckets, HISTORY_KEY),
            now.path("history"), now.version, HISTORY_KEY, now.buckets, HISTORY_SORT)
        marked.filter("is_long").select(schemas.HISTORY.names).repartitionByRange(*HISTORY_SORT).sortWithinPartitions(
            *HISTORY_SORT).write.mode("overwrite").parquet(f"{now.path('history_long')}/version={now.version}")


def kept_conversations(now: Kept, as_of, brand="brand") -> DataFrame:
    return as_conversations(now.state().select(
        "customer_id", F.col("first_time").alias("conversation_start_timestamp"),
        F.col("last_time").alias("conversation_end_timestamp"), "total_interactions"), as_of, brand)


def recent_messages(now: Kept, as_of) -> DataFrame:
    """(customer_id, recent): messages at most 24 hours old, those without a time left aside.

    Whole hours come from the hourly counts. Only for the hour that the limit falls into messages are read.
    """
    limit = instant(as_of) - F.expr("interval 24 hours")
    hour = F.date_trunc("hour", limit)
    whole = now.hours().filter(
        (F.col("hour") > hour) & (F.col("event_month") >= event_month(limit))).select("customer_id", "n")
    # Loads that are not merged yet do not count.
    cut = tables.interactions(now.spark, now.root).filter(
        (F.col("interaction_timestamp") >= limit) & (F.col("interaction_timestamp") < hour + F.expr("interval 1 hour"))
        & (F.col("event_month") >= event_month(limit)) & (F.col(HISTORY_KEY) != "")
    ).join(now.batches(), "batch_id", "left_semi").select(
        F.col(HISTORY_KEY).alias("customer_id"), F.lit(1).cast("long").alias("n"))
    return whole.unionByName(cut).groupBy("customer_id").agg(F.sum("n").alias("recent"))


def kept_activity(now: Kept, as_of) -> DataFrame:
    """What the rules read, per customer, as ``activity`` gives it, without reading the messages."""
    return now.state().join(recent_messages(now, as_of), "customer_id", "left").select(
        "customer_id", "total_interactions", hours_ago(F.col("last_time"), as_of).alias("hours_since_own"),
        (F.coalesce("recent", F.lit(0)) + F.col("without_time")).alias("recent_interactions"))


def kept_features(now: Kept, as_of) -> DataFrame:
    """The seven features of every customer, as ``extract_features`` gives them, without reading the messages."""
    span = F.unix_micros("last_time") - F.unix_micros("first_time")
    return now.state().select(
        "customer_id", "total_interactions", F.col("total_interactions").alias("conversation_length"),
        hours_ago(F.col("last_time"), as_of).alias("hours_since_last_interaction"),
        (F.col("characters") / F.col("total_interactions")).alias("avg_message_length"),
        F.col("urgent").alias("contains_urgent_keywords"), F.col("escalating").alias("has_escalation_words"),
        F.when((F.col("total_interactions") > 1) & (span > SPREAD_MICROS), "spread_out").otherwise("clustered")
        .alias("response_pattern"))


def write_kept_features(spark: SparkSession, root, as_of=None) -> None:
    """The feature table of ``build_features``, from the kept state."""
    with job_settings(spark):
        as_of = as_of or now_text()
        ids = tables.profiles(spark, root).select("customer_id").distinct()
        features = ids.join(kept_features(kept(spark, root), as_of), "customer_id", "left").fillna(FEATURE_DEFAULTS)
        sinks.write_features(features.withColumn("created_at", instant(as_of)), root)


def kept_chat_log(now: Kept, variant="prediction") -> DataFrame:
    """Chat logs of all participants; only long histories are shuffled."""
    return chat_log(
        None, variant, parts=lambda item: bucketed_parts(
            now.history(), now.history_long(), now.long(), item, HISTORY_KEY, now.part_bits, huge=now.huge()))


def _with_short_logs(predictions, now):
    """The predictions come to the logs: no text is shuffled."""
    logs = chat_log(None, parts=lambda item: bucketed_short(now.history(), now.long(), item, HISTORY_KEY))
    return predictions.join(logs, STATE_KEY, "left").fillna({"part": 0, "parts": 1})


def _with_logs(predictions, now, keep):
    """Short logs where they lie; the parts of long ones get the prediction of their customer, which is one row."""
    predictions, long = keep(predictions), now.long()
    short = _with_short_logs(predictions.join(long, STATE_KEY, "left_anti"), now)
    logs = chat_log(None, parts=lambda item: bucketed_long(
        now.history(), now.history_long(), long, item, HISTORY_KEY, now.part_bits, huge=now.huge(), keep=keep))
    wanted = predictions.join(long, STATE_KEY, "left_semi")
    if is_small(long):
        return short.unionByName(logs.join(F.broadcast(wanted), STATE_KEY))
    found = join_unique(logs, wanted.withColumn("_found", F.lit(True)), STATE_KEY)
    return short.unionByName(found.filter("_found").drop("_found"))


def predict_kept(
        spark: SparkSession, root, out, as_of=None, rules=DEFAULT_RULES,
        responses: DataFrame = None) -> PredictionResult:
    """The predictions of ``predict_batch`` from the kept tables: the history is joined where it lies."""
    with job_settings(spark), scratch(spark) as keep:
        as_of = as_of or now_text()
        now = kept(spark, root)
        chosen = prediction.customers(tables.profiles(spark, root))
        conversations = tables.conversations(spark, root)
        predictions = prediction.predict(
            chosen, conversations, None, as_of, rules=rules, responses=responses, activity=kept_activity(now, as_of))
        has_long = not now.long().isEmpty()
        rows = _with_logs(predictions, now, keep) if has_long else _with_short_logs(predictions, now)
        sinks.export_predictions(rows.fillna({"chat_log": ""}), out, in_order=has_long)
        counts = resolution_counts(with_conversation(chosen, conversations)).first()
        return PredictionResult(
            counts["open_customers"] + counts["skipped_customers"], counts["open_customers"], counts["skipped_customers"])


def score_kept(requests: DataFrame, root, as_of=None, rules=DEFAULT_RULES) -> DataFrame:
    """The answers of ``score_requests`` from the kept tables.

    The requests are read once and joined to one row per customer; no message is read. Very frequent ids are left to
    the skew handling of adaptive joins, which needs no count of them first.
    """
    spark = requests.sparkSession
    as_of = as_of or now_text()
    known = prediction.customers(tables.profiles(spark, root)).join(
        kept_activity(kept(spark, root), as_of), "customer_id", "left").fillna(ACTIVITY_DEFAULTS)
    scored = prediction.answer(known, as_of, rules).withColumn("status", F.lit("ok"))
    return requests.join(scored, "customer_id", "left").withColumn(
        "status", F.coalesce("status", F.lit("not_found")))
