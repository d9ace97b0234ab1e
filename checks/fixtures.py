"""Input views over the test tables, as SQL that Spark and DuckDB both read.

A participant is a user-day of ``events``, so that message counts fall on both sides of every rule.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from caseflow.functions.instants import instant
from caseflow.operators.rollup import build_conversations, build_profiles
from caseflow.storage import shared_dir

AS_OF = "2024-01-16 12:00:00"
MARK = "2024-01-20 06:00:00"

INTERACTIONS = """
SELECT CAST(event_id AS STRING) AS external_id,
       CAST(user_id AS STRING) || '-' || CAST(day(ts) AS STRING) AS participant_external_id,
       CAST(ts AS TIMESTAMP) AS interaction_timestamp,
       CASE event_id % 10
         WHEN 0 THEN 'URGENT: please Help https://t.co/' || CAST(event_id AS STRING) || ' @brand'
         WHEN 1 THEN 'I want a Manager, this is unacceptable #fail'
         WHEN 2 THEN 'I know it is down'
         WHEN 3 THEN 'ok'
         WHEN 4 THEN NULL
         WHEN 5 THEN ''
         ELSE event_type || ' ' || props END AS content_text,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id - 1 AS STRING) END
         AS parent_interaction_id
FROM {events}"""

# Rows of the raw shape with reposts, unreadable times, and document texts that span lines.
RAW_TWEETS = """
SELECT external_id AS tweet_id, participant_external_id AS author_id,
       CASE WHEN n % 2 = 0 THEN 'True' ELSE 'False' END AS inbound,
       CASE WHEN n % 97 = 0 THEN 'garbage' ELSE <render> END AS created_at,
       content_text AS text, CAST(NULL AS STRING) AS response_tweet_id,
       parent_interaction_id AS in_response_to_tweet_id
FROM (
  SELECT CAST(external_id AS BIGINT) AS n, external_id, participant_external_id,
         interaction_timestamp AS t, content_text, parent_interaction_id
  FROM {interactions}
  UNION ALL
  SELECT CAST(external_id AS BIGINT), external_id, participant_external_id,
         interaction_timestamp + INTERVAL '1' HOUR, 'repost of ' || external_id,
         parent_interaction_id
  FROM {interactions} WHERE CAST(external_id AS BIGINT) % 50 = 0
  UNION ALL
  SELECT doc_id, 'd' || CAST(doc_id AS STRING), 'src-' || source,
         CAST('2024-01-05 00:00:00' AS TIMESTAMP), text, CAST(NULL AS STRING)
  FROM {documents})"""
SPARK_RENDER = "date_format(t, 'EEE MMM dd HH:mm:ss') || ' +0000 ' || date_format(t, 'yyyy')"
DUCK_RENDER = "strftime(t, '%a %b %d %H:%M:%S +0000 %Y')"

# Several versions per customer, and run and watermark logs, out of the orders.
VERSIONS = """
SELECT 'c' || CAST(o_custkey AS STRING) AS customer_id, o_orderdate AS created_at,
       o_orderdate AS last_interaction_timestamp, o_orderdate AS conversation_end_timestamp,
       CAST(o_orderkey AS STRING) AS conversation_id, o_orderkey AS total_interactions,
       CASE o_orderstatus WHEN 'F' THEN 'resolved' WHEN 'P' THEN NULL ELSE 'open' END
         AS resolution_status
FROM {orders}"""
WATERMARKS = """
SELECT CAST(o_orderkey AS STRING) AS id, 'p' || CAST(o_custkey % 50 AS STRING) AS pipeline_name,
       lower(o_orderpriority) AS platform_type,
       CAST(o_orderdate AS TIMESTAMP) AS last_processed_timestamp,
       CAST('' AS STRING) AS last_processed_external_id, o_orderkey AS records_processed,
       'completed' AS last_run_status, CAST(o_orderdate AS TIMESTAMP) AS updated_at
FROM {orders}"""
RUNS = """
SELECT CAST(o_orderkey AS STRING) AS run_id, 'p' || CAST(o_custkey % 50 AS STRING) AS pipeline_name,
       'manual' AS run_type, 'parquet' AS database_target,
       CAST(o_orderdate AS TIMESTAMP) AS start_timestamp,
       CAST('1970-01-01 00:00:00' AS TIMESTAMP) AS end_timestamp, 'running' AS status,
       CAST(0 AS BIGINT) AS records_processed, '' AS error_message, '{{}}' AS config_snapshot,
       CAST(o_orderdate AS TIMESTAMP) AS created_at
FROM {orders}"""
# One end per order of another status; orders with an odd key never started.
RUN_ENDS = """
SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'lost-' ELSE '' END || CAST(o_orderkey AS STRING) AS run_id,
       CAST(o_orderdate AS TIMESTAMP) + INTERVAL '2' HOUR AS end_timestamp,
       CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'completed' END AS status,
       o_custkey AS records_processed,
       CASE o_orderstatus WHEN 'F' THEN 'disk full' END AS error_message
FROM {orders} WHERE o_orderstatus <> 'P'"""
# Requested ids: known, unknown, repeated and missing ones.
REQUESTS = """
SELECT o_orderkey AS request_id,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL
            WHEN o_orderkey % 3 = 0 THEN '7-7'
            ELSE CAST(o_custkey % 160 AS STRING) || '-' || CAST(1 + o_orderkey % 33 AS STRING) END
         AS customer_id
FROM {orders}"""


def load(spark: SparkSession, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark, sf_dir, sql, **frames):
    names = [n for n in ("events", "orders", "documents") if "{" + n + "}" in sql]
    return spark.sql(sql, **{name: load(spark, sf_dir, name) for name in names}, **frames)


def interactions(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, INTERACTIONS)


def raw_tweets(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, RAW_TWEETS.replace("<render>", SPARK_RENDER),
                 interactions=interactions(spark, sf_dir))


def versions(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, VERSIONS)


def watermarks(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, WATERMARKS)


def runs(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, RUNS)


def run_ends(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, RUN_ENDS)


def requests(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, REQUESTS)


def conversations(spark, sf_dir) -> DataFrame:
    """Rolled-up conversations; some are resolved, some have no status."""
    return build_conversations(interactions(spark, sf_dir), AS_OF).withColumn(
        "resolution_status", F.expr(
            "CASE total_interactions % 3 WHEN 0 THEN 'resolved' WHEN 1 THEN 'open' END"))


def profiles(spark, sf_dir) -> DataFrame:
    """Rolled-up profiles, and customers who never wrote and have no conversation."""
    silent = load(spark, sf_dir, "customer").select(
        F.concat(F.lit("silent-"), F.col("c_custkey").cast("string")).alias("customer_id"),
        instant(AS_OF).alias("created_at"))
    return build_profiles(
        build_conversations(interactions(spark, sf_dir), AS_OF), AS_OF
    ).unionByName(silent, allowMissingColumns=True)


def responses(spark, sf_dir) -> DataFrame:
    """Enhancement answers: whole, partial, not JSON, not an object, missing."""
    return (
        build_conversations(interactions(spark, sf_dir), AS_OF)
        .select("customer_id", F.expr(RESPONSE).alias("response")))


def part_answers(prompts, conversations) -> DataFrame:
    """An answer to each prompt, which repeats the prompt and came twice. By the customer's number of messages, part 0 has
    none, a broken one, one to another prompt, or two that differ."""
    n = conversations.select("customer_id", (F.col("total_interactions") % 6).alias("kind"))
    whole = F.to_json(F.struct(F.col("prompt").alias("message"), F.col("part").cast("string").alias("reasoning")))
    given = prompts.join(n, "customer_id", "left").fillna({"kind": 0}).select(
        "customer_id", "part", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"), "kind",
        F.sha2("prompt", 256).alias("prompt_hash"), whole.alias("response"))
    first = F.col("part") == 0
    return given.filter(~first | (F.col("kind") != 1)).select(
        "customer_id", "part",
        F.when(first & (F.col("kind") == 3), F.sha2("prompt_hash", 256)).otherwise(F.col("prompt_hash")).alias("prompt_hash"),
        F.when(first & (F.col("kind") == 2), F.lit("broken"))
        .when(first & (F.col("kind") == 4) & (F.col("copy") == 1), F.lit("{}")).otherwise(F.col("response")).alias("response"))


RESPONSE = """CASE total_interactions % 6
  WHEN 0 THEN CASE WHEN total_interactions % 12 = 0 THEN '{"message": "x"} junk' ELSE
    '{"message": "Hello ' || customer_id || '", "reasoning": "said so"}' END
  WHEN 1 THEN chr(10) || chr(9) || '{"message": "only"}'
  WHEN 2 THEN CASE WHEN total_interactions % 12 = 2 THEN '{''message'': ''x''}' ELSE 'not json' END
  WHEN 3 THEN '[1]'
  WHEN 4 THEN '{}' END"""


def new_folder(spark, name):
    """A folder of its own for each run, in the shared folder of the cluster."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without zone and decimals as doubles, so that both systems return the same types."""
    return df.select([
        F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp"
        else F.col(name).cast("double").alias(name) if kind.startswith("decimal")
        else F.col(name)
        for name, kind in df.dtypes])
