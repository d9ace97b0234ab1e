"""Every operator as a registered query, and its SQL twin where SQL can express it."""

import re

from pyspark.sql import functions as F

from caseflow.functions import instants
from caseflow.operators import (
    conform, evaluate, explore, features, history, lookup, normalize, predict, quality, rollup, rules)
from caseflow.plans import kept as keeping
from caseflow.plans.ingest import drop_stored, ingest
from caseflow.plans.rollups import build_rollups
from caseflow.plans.scoring import evaluate_batch, predict_batch
from caseflow.schemas import FEATURE_COLUMNS, INTERACTION, PREDICTION_COLUMNS
from caseflow.sources import sinks, tables
from caseflow.sources.tweets import read_tweets, scan_csv
from caseflow.storage import durable, remove
from caseflow.streaming.ingest import stream_batches, stream_ingest
from caseflow.streaming.scoring import score_stream
from checks import fixtures as fx
from checks.fixtures import AS_OF, MARK, naive

QUERIES = {}
ORACLES = {}

# --- shared SQL -------------------------------------------------------------------------------------

_NAMES = {name: name for name in ("events", "orders", "documents", "interactions")}


def _duck(sql):
    return sql.replace("<render>", fx.DUCK_RENDER).format(**_NAMES)


_CTES = {
    "interactions": _duck(fx.INTERACTIONS),
    "raw": _duck(fx.RAW_TWEETS),
    "tweets": """
SELECT tweet_id AS external_id, author_id AS participant_external_id, text AS content_text, inbound,
       try_strptime(created_at[5:], '%b %d %H:%M:%S +0000 %Y') AS interaction_timestamp,
       in_response_to_tweet_id
FROM raw""",
    # NULL and '' cannot be told apart in a CSV file.
    "csv_tweets": """
SELECT external_id, participant_external_id, nullif(content_text, '') AS content_text,
       interaction_timestamp, in_response_to_tweet_id
FROM tweets""",
    "deduped": """
SELECT * FROM csv_tweets QUALIFY row_number() OVER (
  PARTITION BY external_id ORDER BY interaction_timestamp ASC NULLS LAST,
  content_text ASC NULLS LAST, participant_external_id ASC NULLS LAST) = 1""",
    "conv": """
SELECT participant_external_id AS customer_id, count(*) AS n, min(interaction_timestamp) AS first_ts,
       max(interaction_timestamp) AS last_ts
FROM interactions GROUP BY 1""",
    "prof": f"""
SELECT customer_id, last_ts FROM conv
UNION ALL SELECT 'silent-' || CAST(c_custkey AS VARCHAR), NULL FROM customer""",
    "status": """
SELECT customer_id, CASE n % 3 WHEN 0 THEN 'resolved' WHEN 1 THEN 'open' END AS resolution_status
FROM conv""",
    "act": f"""
SELECT participant_external_id AS customer_id, count(*) AS n,
       coalesce((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(interaction_timestamp))) / 3.6e9, 0.0)
         AS h,
       count(*) FILTER (WHERE coalesce((epoch_us(TIMESTAMP '{AS_OF}')
         - epoch_us(interaction_timestamp)) / 3.6e9, 0.0) <= 24) AS recent
FROM interactions GROUP BY 1""",
    "decided": """
SELECT customer_id,
       CASE WHEN n > 5 THEN 'scheduling_phone_call' WHEN h > 24 THEN 'email_reply'
            ELSE 'twitter_dm_reply' END AS channel,
       CASE WHEN n > 5 THEN 'Conversation has ' || n || ' interactions - phone call more efficient'
            WHEN h > 24 THEN 'Issue dormant for ' || printf('%.1f', round(h, 1))
              || ' hours - email follow-up needed. Last interaction was from customer.'
            WHEN recent >= 3 THEN 'Customer very active (' || recent
              || ' recent interactions) - respond on Twitter'
            ELSE 'Standard response for active issue' END AS reasoning
FROM (SELECT prof.customer_id, coalesce(n, 0) AS n, coalesce(h, 0.0) AS h,
             coalesce(recent, 0) AS recent
      FROM prof LEFT JOIN act ON prof.customer_id = act.customer_id)""",
    "logs": """
SELECT participant_external_id AS customer_id,
       trim(string_agg(participant_external_id || ': ' || coalesce(content_text, ''), chr(10)
            ORDER BY interaction_timestamp NULLS FIRST, external_id),
            chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '||chr(160)) AS chat_log
FROM interactions GROUP BY 1""",
    "eval_logs": """
SELECT participant_external_id AS customer_id,
       string_agg('Customer: ' || coalesce(content_text, '') || chr(10), ''
                  ORDER BY interaction_timestamp NULLS FIRST, external_id) AS chat_log
FROM interactions GROUP BY 1""",
    "rendered": """
SELECT participant_external_id AS customer_id,
       string_agg('Interaction ' || i || ' (' ||
         coalesce(strftime(interaction_timestamp, '%Y-%m-%dT%H:%M:%SZ'), 'No timestamp') || ') by '
         || participant_external_id || ': ' || coalesce(content_text, 'No content'), '' ORDER BY i)
         AS history
FROM (SELECT *, row_number() OVER (PARTITION BY participant_external_id
        ORDER BY interaction_timestamp NULLS FIRST, external_id) AS i FROM interactions)
GROUP BY 1""",
    "requests": _duck(fx.REQUESTS),
    "versions": _duck(fx.VERSIONS),
    "marks": _duck(fx.WATERMARKS),
    "runs": _duck(fx.RUNS),
    "ends": _duck(fx.RUN_ENDS),
    "response": "SELECT customer_id, " + fx.RESPONSE.replace("total_interactions", "n")
                + " AS response FROM conv",
    "answered": """
SELECT decided.customer_id, channel, response,
       CASE WHEN ok THEN coalesce(json_extract_string(response, '$.message'), '') ELSE reasoning END
         AS message,
       CASE WHEN ok THEN coalesce(json_extract_string(response, '$.reasoning'), '') ELSE reasoning END
         AS reasoning,
       CASE WHEN response IS NOT NULL AND NOT ok THEN 'invalid_response' END AS error
FROM decided LEFT JOIN (
  SELECT *, coalesce(CASE WHEN json_valid(response) THEN json_type(response) = 'OBJECT' END, false)
    AS ok FROM response) r ON decided.customer_id = r.customer_id""",
}
# The same over rows that were loaded from CSV up to a mark, which leaves rows without a time out.
_LOADED = "FROM csv_tweets WHERE interaction_timestamp IS NOT NULL"
_CTES["kept_act"] = _CTES["act"].replace("FROM interactions", _LOADED)
_CTES["kept_logs"] = _CTES["logs"].replace("FROM interactions", _LOADED)
_CTES["kept_decided"] = _CTES["decided"].replace("prof", "kept_act").replace(
    "FROM kept_act LEFT JOIN act ON kept_act.customer_id = act.customer_id", "FROM kept_act")
# What each CTE reads, so that an oracle names only those it needs.
_ORDER = list(_CTES)


def _with(names, select):
    wanted = set(names.split())
    for name in reversed(_ORDER):
        if name in wanted:
            wanted |= {other for other in _ORDER if other != name and _mentions(_CTES[name], other)}
    return "WITH " + ",\n".join(
        f"{name} AS ({_CTES[name]})" for name in _ORDER if name in wanted) + "\n" + select


def _mentions(sql, name):
    return re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql) is not None


def query(sql=None, ctes=""):
    """Register a query under its function name, with its SQL twin if there is one."""
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = _with(ctes, sql) if ctes else sql
        return function
    return register


def _parsed(spark, sf):
    return fx.raw_tweets(spark, sf).transform(normalize.parse_created_at)


def _normalized(spark, sf):
    return normalize.normalize(_parsed(spark, sf), AS_OF, extra=("interaction_type",))


def csv_folder(spark, sf):
    """The raw tweets as CSV files."""
    folder = fx.new_folder(spark, "tweets")
    sinks.write_csv(fx.raw_tweets(spark, sf), folder)
    return folder


# --- reading and normalizing ------------------------------------------------------------------------

_RAW_COLUMNS = """tweet_id, author_id, inbound, created_at, nullif(text, '') AS text,
response_tweet_id, in_response_to_tweet_id"""


@query(f"SELECT {_RAW_COLUMNS} FROM raw", "raw")
def read_tweets_csv(spark, sf):
    return read_tweets(spark, csv_folder(spark, sf))


@query(f"SELECT {_RAW_COLUMNS} FROM raw", "raw")
def read_tweets_split(spark, sf):
    return read_tweets(spark, csv_folder(spark, sf), split_files=True)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_inferred(spark, sf):
    folder = fx.new_folder(spark, "customer")
    sinks.write_csv(fx.load(spark, sf, "customer"), folder)
    return scan_csv(spark, folder).withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("SELECT event_id, ts, event_type, value FROM events ORDER BY value DESC, event_id LIMIT 25")
def head_rows(spark, sf):
    return explore.head(
        fx.load(spark, sf, "events").select("event_id", "ts", "event_type", "value"), 25,
        [F.col("value").desc(), F.col("event_id")])


@query("""SELECT external_id, interaction_timestamp FROM tweets""", "tweets")
def parse_created_at(spark, sf):
    return naive(_parsed(spark, sf).select(
        F.col("tweet_id").alias("external_id"), "interaction_timestamp"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso_seconds,
CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
     ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00' AS iso_full FROM events""")
def iso_text(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return fx.load(spark, sf, "events").select(
        "event_id", instants.iso_utc(ts).alias("iso_seconds"),
        instants.iso_offset(ts).alias("iso_full"))


@query(f"""SELECT md5('twitter|' || external_id) AS interaction_id, external_id,
'twitter' AS platform_type, participant_external_id, content_text, '{{}}' AS content_metadata,
interaction_timestamp, in_response_to_tweet_id AS parent_interaction_id, '{{}}' AS platform_metadata,
'{{}}' AS processing_metadata, TIMESTAMP '{AS_OF}' AS created_at, 'tweet' AS interaction_type
FROM tweets""", "tweets")
def normalize_tweets(spark, sf):
    return naive(_normalized(spark, sf))


@query("""SELECT count(*) AS n, count(DISTINCT external_id) AS ids, true AS distinct_ids FROM tweets""",
       "tweets")
def random_interaction_ids(spark, sf):
    rows = normalize.add_interaction_id(
        fx.raw_tweets(spark, sf).transform(normalize.rename_canonical).transform(
            normalize.add_platform), deterministic=False)
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("external_id").alias("ids"),
        (F.countDistinct("interaction_id") == F.count(F.lit(1))).alias("distinct_ids"))


def _modelled(spark, sf):
    """Rows of which some have metadata that is no JSON, some a filled one, some none, and some no type."""
    first = F.substring(F.md5("external_id"), 1, 1)
    return _normalized(spark, sf).withColumns({
        "content_metadata": F.when(first == "0", "not json").when(first == "1", '{"a":"1"}')
        .when(first == "2", F.lit(None)).otherwise(F.col("content_metadata")),
        "interaction_type": F.when(F.length("external_id") == 3, F.lit(None)).otherwise("tweet")})


_MODEL_PROBLEMS = """concat_ws(',',
CASE WHEN external_id IS NULL THEN 'external_id' END,
CASE WHEN participant_external_id IS NULL THEN 'participant_external_id' END,
CASE WHEN content_text IS NULL THEN 'content_text' END,
CASE WHEN substr(md5(external_id), 1, 1) = '0' THEN 'content_metadata' END,
CASE WHEN interaction_timestamp IS NULL THEN 'interaction_timestamp' END,
CASE WHEN length(external_id) = 3 THEN 'interaction_type' END)"""


@query(f"""SELECT external_id, {_MODEL_PROBLEMS} AS rejected FROM tweets""", "tweets")
def conform_check(spark, sf):
    return conform.check_model(_modelled(spark, sf)).select(
        "external_id", F.array_join("rejected", ",").alias("rejected"))


@query(f"""SELECT external_id, content_text, CASE substr(md5(external_id), 1, 1) WHEN '1' THEN '1' END AS a
FROM tweets WHERE {_MODEL_PROBLEMS} = ''""", "tweets")
def conform_accepted(spark, sf):
    ok, _ = conform.conform(_modelled(spark, sf))
    return ok.select("external_id", "content_text", F.col("content_metadata")["a"].alias("a"))


@query(f"""SELECT external_id, {_MODEL_PROBLEMS} AS rejected FROM tweets
WHERE {_MODEL_PROBLEMS} <> ''""", "tweets")
def conform_rejected(spark, sf):
    _, rejected = conform.conform(_modelled(spark, sf))
    return rejected.select("external_id", F.array_join("rejected", ",").alias("rejected"))


@query("""SELECT event_id, event_type FROM events""")
def keep_columns(spark, sf):
    return conform.keep_columns(
        fx.load(spark, sf, "events"), ["event_id", "not_there", "event_type"])


@query("""SELECT event_id, '{"type":"' || event_type || '","user":' || user_id || '}' AS about,
'["' || event_type || '","' || user_id || '"]' AS words,
'{"' || event_type || '":' || user_id || '}' AS pairs,
strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts FROM events""")
def serialize_nested(spark, sf):
    return conform.serialize_nested(fx.load(spark, sf, "events").select(
        "event_id", F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"))
        .alias("about"), F.array("event_type", F.col("user_id").cast("string")).alias("words"),
        F.create_map("event_type", "user_id").alias("pairs"), "ts"))


@query("""SELECT coalesce(CAST(event_id AS VARCHAR), '') AS event_id,
CASE WHEN user_id % 4 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS user_id, event_type
FROM events""")
def ids_to_text(spark, sf):
    return conform.ids_to_text(
        fx.load(spark, sf, "events").select(
            "event_id", F.expr("CASE WHEN user_id % 4 <> 0 THEN user_id END").alias("user_id"),
            "event_type"), ["event_id", "user_id"])


@query("""SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
CAST(CAST(l_tax AS DECIMAL(9,4)) AS DOUBLE) AS tax, CAST(CAST(l_discount AS DECIMAL(9,4)) AS DOUBLE)
AS discount FROM lineitem""")
def decimals_to_double(spark, sf):
    price, tax, discount = (
        F.col(name).cast(kind) for name, kind in (
            ("l_extendedprice", "decimal(12,2)"), ("l_tax", "decimal(9,4)"),
            ("l_discount", "decimal(9,4)")))
    rows = fx.load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", price.alias("price"), F.struct(F.array(tax).alias("taxes"))
        .alias("nested"), F.create_map(F.lit("d"), discount).alias("rates"))
    return conform.decimals_to_double(rows).select(
        "l_orderkey", "l_linenumber", "price", F.col("nested.taxes")[0].alias("tax"),
        F.col("rates")["d"].alias("discount"))


# --- quality ----------------------------------------------------------------------------------------

# A dot matches neither line feed, carriage return, NEL nor the two separators.
_LINE_OF_FIVE = r"regexp_matches(content_text, '[^\n\r\x{85}\x{2028}\x{2029}]{5}')"
_PRESENT = "(external_id IS NOT NULL AND interaction_timestamp IS NOT NULL AND content_text IS NOT NULL)"


def _flagged(rule):
    return f"coalesce({_PRESENT} AND {rule}, false)"


@query(f"""SELECT external_id, {_flagged(_LINE_OF_FIVE)} AS is_valid,
CASE WHEN {_flagged(_LINE_OF_FIVE)} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS quality_score
FROM tweets""", "tweets")
def quality_flags(spark, sf):
    return quality.apply_profile(_normalized(spark, sf), "flag").select(
        "external_id", F.coalesce("is_valid", F.lit(False)).alias("is_valid"), "quality_score")


@query(f"""SELECT external_id, {_flagged('length(content_text) BETWEEN 5 AND 10000')} AS is_valid
FROM tweets""", "tweets")
def quality_bounds(spark, sf):
    rows = _normalized(spark, sf).transform(quality.flag_required).transform(
        quality.flag_length, "bounds")
    return rows.select("external_id", F.coalesce("is_valid", F.lit(False)).alias("is_valid"))


@query(f"SELECT external_id, content_text FROM tweets WHERE {_flagged(_LINE_OF_FIVE)}", "tweets")
def quarantine_valid(spark, sf):
    valid, _ = quality.quarantine(quality.apply_profile(_normalized(spark, sf), "flag"))
    return valid.select("external_id", "content_text")


@query(f"SELECT external_id, content_text FROM tweets WHERE NOT {_flagged(_LINE_OF_FIVE)}", "tweets")
def quarantine_rejected(spark, sf):
    _, rejected = quality.quarantine(quality.apply_profile(_normalized(spark, sf), "flag"))
    return rejected.select("external_id", "content_text")


@query("""SELECT external_id, participant_external_id, content_text, interaction_timestamp FROM tweets
QUALIFY row_number() OVER (PARTITION BY external_id ORDER BY interaction_timestamp ASC NULLS LAST,
content_text ASC NULLS LAST, participant_external_id ASC NULLS LAST) = 1""",
       "tweets")
def dedup_external(spark, sf):
    return naive(quality.dedup_external(_normalized(spark, sf)).select(
        "external_id", "participant_external_id", "content_text", "interaction_timestamp"))


@query("SELECT external_id, content_text FROM interactions WHERE content_text IS NOT NULL",
       "interactions")
def drop_missing_text(spark, sf):
    return quality.drop_missing_text(fx.interactions(spark, sf)).select("external_id", "content_text")


_NON_SPACE = (
    r"[^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")


def _cleaned(name):
    for lead in ("http", "@", "#"):
        name = f"regexp_replace({name}, '{lead}{_NON_SPACE}', '', 'gi')"
    return name


@query(f"SELECT external_id, {_cleaned('content_text')} AS content_text FROM tweets", "tweets")
def clean_text(spark, sf):
    return quality.clean_text(_normalized(spark, sf)).select("external_id", "content_text")


@query(f"SELECT page_id, {_cleaned('html')} AS html FROM pages")
def clean_pages(spark, sf):
    return quality.clean_text(fx.load(spark, sf, "pages"), "html").select("page_id", "html")


@query(f"""SELECT external_id, interaction_timestamp FROM tweets
WHERE interaction_timestamp > TIMESTAMP '{MARK}'""", "tweets")
def since_watermark(spark, sf):
    return naive(quality.since(_normalized(spark, sf), MARK).select(
        "external_id", "interaction_timestamp"))


@query(f"""SELECT external_id, interaction_timestamp FROM tweets
WHERE interaction_timestamp > TIMESTAMP '{MARK}' - INTERVAL '2' HOUR""", "tweets")
def since_with_lateness(spark, sf):
    return naive(quality.since(_normalized(spark, sf), MARK, "2 hours").select(
        "external_id", "interaction_timestamp"))


@query("""SELECT external_id, interaction_timestamp FROM tweets WHERE external_id NOT IN
(SELECT external_id FROM interactions WHERE interaction_timestamp <= TIMESTAMP '2024-01-16 12:00:00')""",
       "tweets")
def drop_stored_rows(spark, sf):
    stored = fx.interactions(spark, sf).filter(F.col("interaction_timestamp") <= AS_OF)
    return naive(drop_stored(_normalized(spark, sf), stored).select(
        "external_id", "interaction_timestamp"))


@query(r"""SELECT page_id, url FROM pages WHERE regexp_matches(html, '<(script|table)[ >]')""")
def contains_pattern(spark, sf):
    return quality.contains(
        fx.load(spark, sf, "pages"), "html", "<(script|table)[ >]").select("page_id", "url")


@query("""SELECT customer_id, resolution_status FROM status
WHERE coalesce(resolution_status, '') <> 'resolved'""", "status")
def open_only(spark, sf):
    return quality.open_only(fx.conversations(spark, sf)).select("customer_id", "resolution_status")


@query("""SELECT count(*) FILTER (WHERE coalesce(resolution_status, '') <> 'resolved') AS open_customers,
count(*) FILTER (WHERE resolution_status = 'resolved') AS skipped_customers FROM status""", "status")
def resolution_counts(spark, sf):
    return quality.resolution_counts(fx.conversations(spark, sf))


# --- state: watermarks, runs, lookups ---------------------------------------------------------------

@query("""SELECT pipeline_name, platform_type,
max(last_processed_timestamp) AS last_processed_timestamp
FROM (SELECT * FROM marks QUALIFY rank() OVER (PARTITION BY pipeline_name, platform_type
ORDER BY updated_at DESC) = 1) GROUP BY 1, 2""", "marks")
def last_watermarks(spark, sf):
    return naive(lookup.last_watermarks(fx.watermarks(spark, sf)))


@query("""SELECT pipeline_name, platform_type,
max(last_processed_timestamp) AS last_processed_timestamp
FROM marks WHERE pipeline_name = 'p7' AND platform_type = '1-urgent' GROUP BY 1, 2""", "marks")
def last_watermark(spark, sf):
    return naive(lookup.last_watermark(fx.watermarks(spark, sf), "p7", "1-urgent"))


_NEWEST = """QUALIFY row_number() OVER (PARTITION BY pipeline_name, platform_type
ORDER BY updated_at DESC, id DESC) = 1"""
_SWITCH = "1995-06-01"


def _marks(spark, sf, when):
    """The current row per key among the marks before or since the switch."""
    rows = fx.watermarks(spark, sf).filter(f"updated_at {when} timestamp'{_SWITCH}'")
    return lookup.latest(rows, ["pipeline_name", "platform_type"], "updated_at", "id")


_UPSERTED = f"""SELECT coalesce(o.pipeline_name, n.pipeline_name) AS pipeline_name,
coalesce(o.platform_type, n.platform_type) AS platform_type, coalesce(o.id, n.id) AS id,
coalesce(n.last_processed_timestamp, o.last_processed_timestamp) AS last_processed_timestamp,
coalesce(n.records_processed, o.records_processed) AS records_processed
FROM (SELECT * FROM marks WHERE updated_at < TIMESTAMP '{_SWITCH}' {_NEWEST}) o
FULL JOIN (SELECT * FROM marks WHERE updated_at >= TIMESTAMP '{_SWITCH}' {_NEWEST}) n
ON o.pipeline_name = n.pipeline_name AND o.platform_type = n.platform_type"""


@query(_UPSERTED, "marks")
def upsert_watermark(spark, sf):
    return naive(sinks.upsert_watermark(_marks(spark, sf, "<"), _marks(spark, sf, ">=")).select(
        "pipeline_name", "platform_type", "id", "last_processed_timestamp", "records_processed"))


@query(_UPSERTED, "marks")
def upsert_stored(spark, sf):
    """The upsert into the stored table: first the old marks, then the new ones."""
    root = fx.new_folder(spark, "tables")
    for when in ("<", ">="):
        sinks.store_upsert(_marks(spark, sf, when), root)
    return naive(tables.table(spark, root, "watermarks_current").select(
        "pipeline_name", "platform_type", "id", "last_processed_timestamp", "records_processed"))


@query(f"""SELECT customer_id, created_at, total_interactions FROM versions
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY created_at DESC, conversation_id DESC) = 1""",
       "versions")
def lookup_conversation(spark, sf):
    rows = fx.versions(spark, sf)
    return naive(lookup.conversation_of(rows, rows.select("customer_id")).select(
        "customer_id", "created_at", "total_interactions"))


@query("""SELECT customer_id, created_at FROM versions
WHERE customer_id IN (SELECT 'c' || c_custkey FROM customer)
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY created_at DESC) = 1""", "versions")
def lookup_profile(spark, sf):
    ids = fx.load(spark, sf, "customer").selectExpr("'c' || c_custkey AS id")
    return naive(lookup.profile_of(fx.versions(spark, sf), ids).select(
        "customer_id", "created_at"))


@query("""SELECT participant_external_id, interaction_timestamp, external_id, content_text
FROM interactions WHERE participant_external_id IN (SELECT customer_id FROM requests)""",
       "interactions requests")
def lookup_history(spark, sf):
    return naive(lookup.history_of(
        fx.interactions(spark, sf), fx.requests(spark, sf).select("customer_id")).select(
        "participant_external_id", "interaction_timestamp", "external_id", "content_text"))


@query("""SELECT customer_id, strftime(date_trunc('millisecond', last_ts), '%Y-%m-%dT%H:%M:%SZ')
AS last_interaction_timestamp, '2024-01-16T12:00:00Z' AS created_at FROM conv""", "conv")
def profiles_as_text(spark, sf):
    root = fx.new_folder(spark, "tables")
    sinks.write_profiles(rollup.build_profiles(
        rollup.build_conversations(fx.interactions(spark, sf), AS_OF), AS_OF), root)
    return tables.profiles(spark, root, as_text=True).select(
        "customer_id", "last_interaction_timestamp", "created_at")


@query("""SELECT customer_id, last_ts AS last_interaction_timestamp FROM prof
ORDER BY customer_id LIMIT 40""", "prof")
def profiles_limit(spark, sf):
    return naive(predict.first_profiles(fx.profiles(spark, sf), 40).select(
        "customer_id", "last_interaction_timestamp"))


_RUN_COLUMNS = ["run_id", "pipeline_name", "run_type", "start_timestamp", "end_timestamp", "status",
                "records_processed", "error_message"]


@query(f"""SELECT {', '.join(_RUN_COLUMNS)} FROM runs""", "runs")
def latest_run_started(spark, sf):
    return naive(lookup.latest_run(fx.runs(spark, sf)).select(_RUN_COLUMNS))


@query("""SELECT 'o' || o_orderkey AS run_id, 'running' AS status,
TIMESTAMP '2024-01-16 12:00:00' AS start_timestamp, TIMESTAMP '1970-01-01 00:00:00' AS end_timestamp,
CAST(0 AS BIGINT) AS records_processed, '' AS error_message,
'{"file":"f' || o_custkey || '"}' AS config_snapshot FROM orders""")
def run_started(spark, sf):
    runs = fx.load(spark, sf, "orders").selectExpr(
        "'o' || o_orderkey AS run_id", "'load' AS pipeline_name", "'manual' AS run_type",
        "'parquet' AS database_target", "named_struct('file', 'f' || o_custkey) AS config")
    return naive(sinks.run_started(runs, AS_OF).select(
        "run_id", "status", "start_timestamp", "end_timestamp", "records_processed",
        "error_message", "config_snapshot"))


_ENDED = """SELECT e.run_id, coalesce(r.pipeline_name, 'unknown') AS pipeline_name,
coalesce(r.run_type, 'unknown') AS run_type,
coalesce(r.start_timestamp, TIMESTAMP '1970-01-01 00:00:00') AS start_timestamp, e.end_timestamp,
e.status, e.records_processed, e.error_message FROM ends e LEFT JOIN runs r ON e.run_id = r.run_id"""


@query(_ENDED, "runs ends")
def run_end_append(spark, sf):
    return naive(sinks.run_ended(fx.runs(spark, sf), fx.run_ends(spark, sf), AS_OF).select(
        _RUN_COLUMNS))


_CHANGED = f"""SELECT r.run_id, r.pipeline_name, r.run_type, r.start_timestamp,
coalesce(e.end_timestamp, r.end_timestamp) AS end_timestamp, coalesce(e.status, r.status) AS status,
coalesce(e.records_processed, r.records_processed) AS records_processed,
coalesce(e.error_message, r.error_message) AS error_message
FROM runs r LEFT JOIN ends e ON r.run_id = e.run_id"""


@query(_CHANGED, "runs ends")
def run_end_update(spark, sf):
    return naive(sinks.run_ended(
        fx.runs(spark, sf), fx.run_ends(spark, sf), AS_OF, mode="update").select(_RUN_COLUMNS))


@query(_CHANGED, "runs ends")
def run_end_stored(spark, sf):
    root = fx.new_folder(spark, "tables")
    sinks.publish(fx.runs(spark, sf), root, "runs_current")
    sinks.store_run_ends(fx.run_ends(spark, sf), root, AS_OF)
    return naive(tables.table(spark, root, "runs_current").select(_RUN_COLUMNS))


@query(f"""SELECT {', '.join(_RUN_COLUMNS)} FROM ({_ENDED})
UNION ALL SELECT {', '.join(_RUN_COLUMNS)} FROM runs
WHERE run_id NOT IN (SELECT run_id FROM ends)""", "runs ends")
def latest_run_ended(spark, sf):
    runs = fx.runs(spark, sf)
    log = runs.unionByName(sinks.run_ended(runs, fx.run_ends(spark, sf), AS_OF))
    return naive(lookup.latest_run(log).select(_RUN_COLUMNS))


# --- rollups and histories --------------------------------------------------------------------------

_CONVERSATION = f"""SELECT md5('conversation|' || customer_id) AS conversation_id, customer_id,
'brand' AS brand_account_id, first_ts AS conversation_start_timestamp,
last_ts AS conversation_end_timestamp, n AS total_interactions, 'open' AS resolution_status,
CAST(0 AS DOUBLE) AS customer_sentiment_score, 'general_inquiry' AS conversation_topic,
'{{"twitter":true}}' AS channel_mix, TIMESTAMP '{AS_OF}' AS created_at FROM conv"""
_PROFILE = f"""SELECT customer_id, '{{"twitter_id":"' || customer_id || '"}}' AS platform_accounts,
'{{"total_interactions":' || n || '}}' AS interaction_history_summary,
'{{"default":true}}' AS behavioral_tags, '{{"twitter":true}}' AS preferred_channels,
CAST(0 AS DOUBLE) AS avg_response_time, CAST(1 AS BIGINT) AS total_conversations,
CAST(0 AS DOUBLE) AS resolution_rate, last_ts AS last_interaction_timestamp,
TIMESTAMP '{AS_OF}' AS created_at FROM conv"""


@query(_CONVERSATION, "conv")
def conversations(spark, sf):
    return naive(rollup.build_conversations(fx.interactions(spark, sf), AS_OF))


@query("""SELECT participant_external_id AS customer_id, count(*) AS total_interactions FROM tweets
WHERE inbound = 'True' GROUP BY 1""", "tweets")
def conversations_inbound(spark, sf):
    rows = normalize.normalize(_parsed(spark, sf), AS_OF, extra=("inbound",))
    return rollup.build_conversations(rows, AS_OF, inbound_only=True).select(
        "customer_id", "total_interactions")


@query(_PROFILE, "conv")
def profiles(spark, sf):
    return naive(rollup.build_profiles(
        rollup.build_conversations(fx.interactions(spark, sf), AS_OF), AS_OF))


@query(f"""SELECT count(*) AS records, count(*) FILTER (WHERE {_flagged(_LINE_OF_FIVE)}) AS valid_records,
max(interaction_timestamp) AS max_timestamp FROM tweets""", "tweets")
def batch_stats(spark, sf):
    return naive(rollup.batch_stats(quality.apply_profile(_normalized(spark, sf), "flag")))


_MESSAGES = """SELECT participant_external_id AS customer_id, string_agg(
strftime(interaction_timestamp, '%H:%M:%S') || ' ' || external_id || ' ' || coalesce(content_text, '-'),
chr(10) ORDER BY interaction_timestamp, external_id) AS messages FROM interactions GROUP BY 1"""


def _history_text(spark, sf, part_bits):
    """The messages of the parts in order, joined again."""
    parts = history.collect_history(fx.interactions(spark, sf), part_bits).select(
        "customer_id", "offset", F.array_join(F.transform("messages", lambda m: F.concat(
            F.date_format(m["interaction_timestamp"], "HH:mm:ss"), F.lit(" "), m["external_id"],
            F.lit(" "), F.coalesce(m["content_text"], F.lit("-")))), "\n").alias("text"))
    return parts.groupBy("customer_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("offset", "text"))), lambda p: p["text"]), "\n")
        .alias("messages"))


@query(_MESSAGES, "interactions")
def history_ordered(spark, sf):
    return _history_text(spark, sf, history.PART_BITS)


@query(_MESSAGES, "interactions")
def history_in_parts(spark, sf):
    return _history_text(spark, sf, 1)


@query("SELECT customer_id, 0::BIGINT AS part, 1::BIGINT AS parts, chat_log FROM logs", "logs")
def chat_log(spark, sf):
    return history.chat_log(fx.interactions(spark, sf))


@query("SELECT customer_id, 0::BIGINT AS part, 1::BIGINT AS parts, chat_log FROM eval_logs", "eval_logs")
def chat_log_evaluation(spark, sf):
    return history.chat_log(fx.interactions(spark, sf), "evaluation")


@query("""SELECT conv_id AS customer_id, trim(string_agg(role || ': ' || coalesce(text, ''), chr(10)
ORDER BY turn), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '||chr(160)) AS chat_log
FROM conversations GROUP BY 1""")
def chat_log_by_turn(spark, sf):
    return history.chat_log(
        fx.load(spark, sf, "conversations"), key="conv_id", order=("turn", "role"), speaker="role",
        text="text").select("customer_id", "chat_log")


@query("SELECT customer_id, 0::BIGINT AS part, 1::BIGINT AS parts, history FROM rendered", "rendered")
def render_history(spark, sf):
    return history.render_history(fx.interactions(spark, sf))


@query("SELECT customer_id, history FROM rendered", "rendered")
def render_history_in_parts(spark, sf):
    parts = history.render_history(fx.interactions(spark, sf), part_bits=1)
    return parts.groupBy("customer_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("part", "history"))), lambda p: p["history"]), "")
        .alias("history"))


# --- features, rules, predictions -------------------------------------------------------------------

def _any_word(words):
    return "bool_or(coalesce(" + " OR ".join(
        f"contains(lower(content_text), '{word}')" for word in words) + ", false))"


_FEATURES = f"""SELECT participant_external_id AS customer_id, count(*) AS total_interactions,
count(*) AS conversation_length,
coalesce((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(interaction_timestamp))) / 3.6e9, 0.0)
  AS hours_since_last_interaction,
CAST(sum(coalesce(length(content_text), 0)) AS DOUBLE) / count(*) AS avg_message_length,
{_any_word(('urgent', 'asap', 'immediately', 'now', 'help'))} AS contains_urgent_keywords,
{_any_word(('escalate', 'manager', 'complaint', 'unacceptable'))} AS has_escalation_words,
CASE WHEN count(*) > 1 AND epoch_us(max(interaction_timestamp)) - epoch_us(min(interaction_timestamp))
  > 3600000000 THEN 'spread_out' ELSE 'clustered' END AS response_pattern
FROM interactions GROUP BY 1"""


@query(_FEATURES, "interactions")
def extract_features(spark, sf):
    return features.extract_features(fx.interactions(spark, sf), AS_OF).select(
        "customer_id", *FEATURE_COLUMNS)


@query(f"""SELECT p.customer_id, coalesce(total_interactions, 0) AS total_interactions,
coalesce(conversation_length, 0) AS conversation_length,
coalesce(hours_since_last_interaction, 0) AS hours_since_last_interaction,
coalesce(avg_message_length, 0) AS avg_message_length,
coalesce(contains_urgent_keywords, false) AS contains_urgent_keywords,
coalesce(has_escalation_words, false) AS has_escalation_words,
coalesce(response_pattern, 'clustered') AS response_pattern
FROM (SELECT DISTINCT customer_id FROM prof) p LEFT JOIN ({_FEATURES}) f ON p.customer_id = f.customer_id""",
       "prof interactions")
def features_stored(spark, sf):
    """The stored features, with those of customers that have no messages."""
    root = fx.new_folder(spark, "tables")
    sinks.write_features(
        features.customer_features(fx.profiles(spark, sf), fx.interactions(spark, sf), AS_OF), root)
    return tables.table(spark, root, "customer_features").drop("created_at")


@query(f"""SELECT event_id, (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) / 3.6e9 AS hours FROM events""")
def hours_ago(spark, sf):
    return fx.load(spark, sf, "events").select(
        "event_id", instants.hours_ago(F.col("ts"), AS_OF).alias("hours"))


@query(f"""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 0.0::DOUBLE
WHEN 1 THEN (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(date_trunc('second', ts))) / 3.6e9
WHEN 2 THEN 0.0::DOUBLE WHEN 3 THEN (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) / 3.6e9
ELSE 0.0::DOUBLE END AS hours FROM events""")
def hours_ago_text(spark, sf):
    text = F.expr("""CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
        WHEN 2 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss')
        WHEN 3 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') END""")
    return fx.load(spark, sf, "events").select(
        "event_id", instants.hours_ago_text(text, AS_OF).alias("hours"))


@query(f"""SELECT doc_id, regexp_matches(lower(text), 'urgent|asap|immediately|now|help') AS urgent,
regexp_matches(lower(text), 'escalate|manager|complaint|unacceptable') AS escalation FROM documents""")
def keywords(spark, sf):
    text = F.col("text")
    return fx.load(spark, sf, "documents").groupBy("doc_id").agg(
        features.has_urgent(text).alias("urgent"), features.has_escalation(text).alias("escalation"))


@query("""SELECT decided.customer_id, channel, reasoning FROM decided
JOIN conv ON decided.customer_id = conv.customer_id""", "decided conv")
def decide(spark, sf):
    return rules.decide(features.activity(fx.interactions(spark, sf), AS_OF)).select(
        "customer_id", "channel", "reasoning")


@query(f"""SELECT conv_id, count(*) AS n, CASE WHEN count(*) > 3 THEN 'scheduling_phone_call'
WHEN count(*) FILTER (WHERE role = 'user') >= 1 THEN 'email_reply' ELSE 'twitter_dm_reply' END AS channel
FROM conversations GROUP BY 1""")
def decide_custom_rules(spark, sf):
    """A rule list of the caller's own, over the caller's own columns."""
    turns = fx.load(spark, sf, "conversations").groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("role") == "user").alias("asked"))
    own = (rules.Rule("n > 3", "scheduling_phone_call", "'long'"),
           rules.Rule("asked >= 1", "email_reply", "'asked'"))
    return rules.decide(turns, own).select("conv_id", "n", "channel")


@query("""SELECT role || '-' || conv_id AS customer_id, count(*) AS total_interactions,
coalesce((epoch_us(TIMESTAMP '2024-01-16 12:00:00') - epoch_us(max(CASE WHEN role = 'user' THEN
TIMESTAMP '2024-01-15 00:00:00' + to_minutes(CAST(turn AS INTEGER)) END))) / 3.6e9, 0.0)
AS hours_since_own FROM conversations GROUP BY role, conv_id""")
def own_messages_only(spark, sf):
    """Histories that also hold messages of others: only the customer's own set the age."""
    rows = fx.load(spark, sf, "conversations").select(
        F.expr("role || '-' || conv_id").alias("participant_external_id"),
        F.expr("CASE WHEN role = 'user' THEN role || '-' || conv_id ELSE 'agent' END").alias("who"),
        F.expr("timestamp'2024-01-15 00:00:00' + make_interval(0,0,0,0,0,cast(turn as int),0)")
        .alias("interaction_timestamp"))
    return features.activity(rows, AS_OF, author="who").select(
        "customer_id", "total_interactions", "hours_since_own")


_PREDICTION = """SELECT d.customer_id, channel, reasoning AS message,
'2024-01-16T13:00:00+00:00' AS send_time, reasoning,
CASE channel WHEN 'scheduling_phone_call' THEN 'escalated' ELSE 'pending_customer_response' END
  AS issue_status FROM decided d LEFT JOIN status s ON d.customer_id = s.customer_id"""
_OPEN = "WHERE coalesce(s.resolution_status, '') <> 'resolved'"


def _predict(spark, sf, **options):
    return predict.predict(
        fx.profiles(spark, sf), fx.conversations(spark, sf), fx.interactions(spark, sf), AS_OF,
        **options)


@query(f"{_PREDICTION} {_OPEN}", "decided status")
def predict_open(spark, sf):
    return _predict(spark, sf).drop("error")


@query(f"""{_PREDICTION} {_OPEN} AND d.customer_id IN
(SELECT customer_id FROM prof ORDER BY customer_id LIMIT 200)""", "decided status prof")
def predict_limit(spark, sf):
    return _predict(spark, sf, limit=200).drop("error")


@query(f"""SELECT p.*, coalesce(chat_log, '') AS chat_log, 0::BIGINT AS part, 1::BIGINT AS parts
FROM ({_PREDICTION} {_OPEN}) p LEFT JOIN logs ON p.customer_id = logs.customer_id""",
       "decided status logs")
def predict_with_chat_log(spark, sf):
    return predict.with_chat_log(_predict(spark, sf).drop("error"), fx.interactions(spark, sf))


@query(f"""SELECT p.customer_id, p.channel, trim(coalesce(chat_log, ''), chr(10) || ' ') AS chat_log
FROM ({_PREDICTION} {_OPEN}) p LEFT JOIN logs ON p.customer_id = logs.customer_id""",
       "decided status logs")
def predict_with_chat_log_in_parts(spark, sf):
    """Long logs take the way over several rows and are joined again here."""
    rows = predict.with_chat_log(_predict(spark, sf), fx.interactions(spark, sf), part_bits=1)
    return rows.groupBy("customer_id", "channel").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("part", "chat_log"))), lambda p: p["chat_log"]), "\n")
        .alias("chat_log")).withColumn("chat_log", F.expr("trim(BOTH '\n ' FROM chat_log)"))


@query("""SELECT a.customer_id, channel, message, reasoning, error FROM answered a
LEFT JOIN status s ON a.customer_id = s.customer_id
WHERE coalesce(s.resolution_status, '') <> 'resolved'""", "answered status")
def predict_enhanced(spark, sf):
    return _predict(spark, sf, responses=fx.responses(spark, sf)).select(
        "customer_id", "channel", "message", "reasoning", "error")


@query("""SELECT customer_id, message, reasoning, error FROM answered
WHERE customer_id NOT LIKE 'silent-%'""", "answered")
def apply_enhancement(spark, sf):
    decided = rules.decide(features.activity(fx.interactions(spark, sf), AS_OF))
    rows = decided.join(fx.responses(spark, sf), "customer_id")
    return predict.apply_enhancement(rows, "response").select(
        "customer_id", "message", "reasoning", "error")


@query("""SELECT d.customer_id, 0::BIGINT AS part, 1::BIGINT AS parts,
'id=' || d.customer_id || ' summary= topic=' || CASE WHEN c.customer_id IS NULL THEN 'N/A'
  ELSE 'general_inquiry' END || ' step=' || channel || '/' || reasoning || chr(10)
  || coalesce(history, 'No detailed conversation history available.') AS prompt
FROM decided d LEFT JOIN rendered r ON d.customer_id = r.customer_id
LEFT JOIN status c ON d.customer_id = c.customer_id""", "decided rendered status")
def build_prompt(spark, sf):
    template = "id={customer_id} summary={summary} topic={topic} step={channel}/{reasoning}\n{history}"
    inter = fx.interactions(spark, sf)
    cases = lookup.with_conversation(
        fx.profiles(spark, sf).select("customer_id", "created_at"), fx.conversations(spark, sf))
    return predict.build_prompt(predict.recommend(cases, inter, AS_OF), inter, template)


@query("""SELECT d.customer_id, channel,
CASE WHEN error IS NULL THEN coalesce(history, 'No detailed conversation history available.') ELSE reasoning END AS message,
error FROM (
  SELECT d.*, CASE c.n % 6 WHEN 1 THEN 'missing_answer' WHEN 2 THEN 'invalid_response' WHEN 3 THEN 'missing_answer'
    WHEN 4 THEN 'conflicting_answers' END AS error
  FROM decided d LEFT JOIN conv c ON d.customer_id = c.customer_id) d
LEFT JOIN rendered r ON d.customer_id = r.customer_id""", "decided rendered conv")
def prompt_answers(spark, sf):
    inter = fx.interactions(spark, sf)
    decided = predict.recommend(fx.profiles(spark, sf).select("customer_id", "created_at"), inter, AS_OF)
    # Prompts are sent out and their answers come back, so they are stored.
    prompts = durable(predict.build_prompt(decided, inter, "{history}", part_bits=2))
    answers = fx.part_answers(prompts, fx.conversations(spark, sf))
    rows = predict.answer_prompts(decided, prompts, answers, AS_OF)
    # The answers repeat their prompts, so the parts in order are the whole history.
    in_order = F.sort_array(F.collect_list(F.struct("part", "message")))
    return rows.groupBy("customer_id", "channel", "error").agg(
        F.array_join(F.transform(in_order, lambda part: part["message"]), "").alias("message"))


@query("""SELECT customer_id,
CASE channel WHEN 'scheduling_phone_call' THEN 'escalated' ELSE 'pending_customer_response' END
  AS prediction_status,
CASE channel WHEN 'scheduling_phone_call' THEN 'escalated' WHEN 'email_reply'
  THEN 'pending_customer_reply' ELSE 'resolved' END AS evaluation_status
FROM decided WHERE customer_id NOT LIKE 'silent-%'""", "decided")
def issue_status(spark, sf):
    decided = rules.decide(features.activity(fx.interactions(spark, sf), AS_OF))
    both = rules.issue_status(decided).withColumnRenamed("issue_status", "prediction_status")
    return rules.issue_status(both, "evaluation").select(
        "customer_id", "prediction_status", F.col("issue_status").alias("evaluation_status"))


_EVALUATION = """SELECT d.customer_id, channel, '2024-01-16T13:00:00+00:00' AS send_time,
reasoning AS message, reasoning, coalesce(chat_log, '') AS chat_log,
CASE channel WHEN 'scheduling_phone_call' THEN 'escalated' WHEN 'email_reply'
  THEN 'pending_customer_reply' ELSE 'resolved' END AS issue_status, 0::BIGINT AS part, 1::BIGINT AS parts
FROM decided d LEFT JOIN eval_logs l ON d.customer_id = l.customer_id"""
_FIRST = "d.customer_id IN (SELECT customer_id FROM prof ORDER BY customer_id LIMIT 1000)"


@query(f"{_EVALUATION} WHERE {_FIRST}", "decided eval_logs prof")
def evaluate_first(spark, sf):
    return evaluate.project_evaluation(evaluate.evaluate(
        fx.profiles(spark, sf), fx.interactions(spark, sf), AS_OF))


@query(_EVALUATION, "decided eval_logs")
def evaluate_all(spark, sf):
    return evaluate.project_evaluation(evaluate.evaluate(
        fx.profiles(spark, sf), fx.interactions(spark, sf), AS_OF, n=None))


@query("""SELECT request_id, q.customer_id, CASE WHEN c.customer_id IS NULL THEN 'not_found' ELSE 'ok'
END AS status FROM requests q LEFT JOIN conv c ON q.customer_id = c.customer_id""", "requests conv")
def resolve_requests(spark, sf):
    return lookup.resolve_requests(fx.requests(spark, sf), fx.profiles(spark, sf))


@query("""SELECT request_id, q.customer_id, CASE WHEN d.customer_id IS NULL THEN 'not_found' ELSE 'ok'
END AS status, channel, reasoning AS message,
CASE WHEN channel IS NOT NULL THEN '2024-01-16T13:00:00+00:00' END AS send_time
FROM requests q LEFT JOIN decided d ON q.customer_id = d.customer_id""", "requests decided")
def score_requests(spark, sf):
    return predict.score_requests(
        fx.requests(spark, sf), fx.profiles(spark, sf), fx.conversations(spark, sf),
        fx.interactions(spark, sf), AS_OF).select(
        "request_id", "customer_id", "status", "channel", "message", "send_time")


@query("""SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def semi_authors(spark, sf):
    return explore.semi_join(
        fx.load(spark, sf, "customer"),
        fx.load(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey"
    ).select("c_custkey", "c_name")


# --- stored tables and jobs -------------------------------------------------------------------------

_STORED = [name for name in INTERACTION.names if name != "created_at"]


@query("""SELECT md5('twitter|' || external_id) AS interaction_id, external_id,
'twitter' AS platform_type, participant_external_id, coalesce(content_text, '') AS content_text,
'{}' AS content_metadata, date_trunc('millisecond', interaction_timestamp) AS interaction_timestamp,
in_response_to_tweet_id AS parent_interaction_id, '{}' AS platform_metadata,
'{}' AS processing_metadata, strftime(interaction_timestamp, '%Y-%m') AS month FROM tweets""", "tweets")
def write_interactions(spark, sf):
    root = fx.new_folder(spark, "tables")
    tables.ensure_tables(spark, root)
    sinks.write_interactions(_normalized(spark, sf), root, "b1", AS_OF, batch_size=1000)
    return naive(tables.interactions(spark, root).select(
        *_STORED, F.date_format("event_month", "yyyy-MM").alias("month")))


@query(_CONVERSATION.replace("first_ts", "date_trunc('millisecond', first_ts)")
       .replace("last_ts", "date_trunc('millisecond', last_ts)"), "conv")
def write_conversations(spark, sf):
    root = fx.new_folder(spark, "tables")
    sinks.write_conversations(rollup.build_conversations(fx.interactions(spark, sf), AS_OF), root)
    return naive(tables.conversations(spark, root))


@query(_PROFILE.replace("last_ts", "date_trunc('millisecond', last_ts)"), "conv")
def write_profiles(spark, sf):
    root = fx.new_folder(spark, "tables")
    sinks.write_profiles(rollup.build_profiles(
        rollup.build_conversations(fx.interactions(spark, sf), AS_OF), AS_OF), root)
    return naive(tables.profiles(spark, root))


@query(f"""SELECT external_id, participant_external_id, coalesce(content_text, '') AS content_text,
interaction_timestamp, {_flagged(_LINE_OF_FIVE)} AS is_valid FROM csv_tweets""", "csv_tweets")
def ingest_flag(spark, sf):
    root = fx.new_folder(spark, "tables")
    _done(ingest(spark, csv_folder(spark, sf), root, AS_OF, "flag"))
    return naive(tables.interactions(spark, root).select(
        "external_id", "participant_external_id", "content_text", "interaction_timestamp",
        F.coalesce("is_valid", F.lit(False)).alias("is_valid")))


_CLEAN = f"""SELECT external_id, {_cleaned('content_text')} AS content_text, interaction_timestamp
FROM deduped WHERE content_text IS NOT NULL"""


@query(_CLEAN, "deduped")
def ingest_clean(spark, sf):
    root = fx.new_folder(spark, "tables")
    _done(ingest(spark, csv_folder(spark, sf), root, AS_OF, "clean"))
    return _ingested(spark, root)


def _done(result):
    if result.status != "completed":
        raise RuntimeError(result.error)
    return result


def _ingested(spark, root):
    return naive(tables.interactions(spark, root).select(
        "external_id", "content_text", "interaction_timestamp"))


@query("""SELECT external_id, coalesce(content_text, '') AS content_text, interaction_timestamp
FROM csv_tweets WHERE interaction_timestamp IS NOT NULL""", "csv_tweets")
def ingest_twice(spark, sf):
    """A first load up to a mark, then two loads of everything: the second adds, the third does not."""
    root = fx.new_folder(spark, "tables")
    old, both = fx.new_folder(spark, "tweets"), csv_folder(spark, sf)
    raw = fx.raw_tweets(spark, sf)
    sinks.write_csv(raw.filter(
        instants.parse_created_at(F.col("created_at")) <= instants.instant(MARK)), old)
    for folder in (old, both, both):
        _done(ingest(spark, folder, root, AS_OF, "flag"))
    return _ingested(spark, root)


@query(f"""SELECT coalesce(p.customer_id, '') AS customer_id, p.channel, p.issue_status, p.reasoning,
nullif(p.chat_log, '') AS chat_log FROM (
  SELECT q.*, chat_log FROM ({_PREDICTION}) q JOIN logs ON q.customer_id = logs.customer_id) p""",
       "decided status logs")
def predict_batch_export(spark, sf):
    """Tables written, rolled up, scored and exported as CSV, then read again."""
    root, out = fx.new_folder(spark, "tables"), fx.new_folder(spark, "predictions")
    sinks.write_interactions(
        fx.interactions(spark, sf).withColumn("platform_type", F.lit("twitter")), root, "b1", AS_OF)
    build_rollups(spark, root, AS_OF)
    predict_batch(spark, root, out, AS_OF)
    return _read_export(spark, out, PREDICTION_COLUMNS).select(
        "customer_id", "channel", "issue_status", "reasoning", "chat_log")


def _read_export(spark, out, columns):
    schema = ", ".join([*(f"{name} string" for name in columns), "part long", "parts long"])
    return spark.read.schema(schema).options(
        header=True, multiLine=True, quote='"', escape='"').csv(out)


def export_rows(spark, sf):
    return fx.load(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("customer_id"), F.lit(0).alias("part"),
        F.col("text").alias("chat_log"), F.lit("email_reply").alias("channel"),
        F.col("source").alias("message"), F.lit("t").alias("send_time"),
        F.col("lang").alias("reasoning"), F.lit("escalated").alias("issue_status"))


_EXPORTED = """SELECT CAST(doc_id AS VARCHAR) AS customer_id, nullif(text, '') AS chat_log,
'email_reply' AS channel, source AS message, 't' AS send_time, lang AS reasoning,
 'escalated' AS issue_status, 0::BIGINT AS part, 1::BIGINT AS parts FROM documents"""


@query(_EXPORTED)
def export_predictions(spark, sf):
    """Whole document texts, with their newlines, quotes and blanks, survive the CSV."""
    out = fx.new_folder(spark, "predictions")
    sinks.export_predictions(export_rows(spark, sf), out)
    return _read_export(spark, out, PREDICTION_COLUMNS)


@query(_EXPORTED)
def export_evaluation(spark, sf):
    out = fx.new_folder(spark, "evaluation")
    sinks.export_evaluation(export_rows(spark, sf), out)
    columns = ("customer_id", "channel", "send_time", "message", "reasoning", "chat_log", "issue_status")
    return _read_export(spark, out, columns)


@query(f"""SELECT customer_id, channel, send_time, issue_status, chat_log FROM (
{_EVALUATION} WHERE d.customer_id IN (SELECT customer_id FROM conv ORDER BY customer_id LIMIT 500))""",
       "decided eval_logs conv")
def evaluate_batch_export(spark, sf):
    root, out = fx.new_folder(spark, "tables"), fx.new_folder(spark, "evaluation")
    sinks.write_interactions(
        fx.interactions(spark, sf).withColumn("platform_type", F.lit("twitter")), root, "b1", AS_OF)
    build_rollups(spark, root, AS_OF)
    evaluate_batch(spark, root, out, AS_OF, n=500)
    columns = ("customer_id", "channel", "send_time", "message", "reasoning", "chat_log", "issue_status")
    return _read_export(spark, out, columns).select(
        "customer_id", "channel", "send_time", "issue_status", "chat_log")


# --- tables kept up load by load -------------------------------------------------------------------

_TIMED = _CTES["conv"].replace("FROM interactions", _LOADED)


_KEPT = {}


def _kept(spark, sf, **options):
    """Three loads up to three marks, each merged before the next; made once in a session."""
    key = (spark.sparkContext.applicationId, sf, *sorted(options.items()))
    if key not in _KEPT:
        inbox = fx.new_folder(spark, "tweets")
        _KEPT[key] = _keep(spark, sf, options, inbox)
        # No later step reads the files of the loads.
        remove(spark, inbox)
    return _KEPT[key]


def _keep(spark, sf, options, inbox=None):
    root, inbox, raw = fx.new_folder(spark, "tables"), inbox or fx.new_folder(spark, "tweets"), fx.raw_tweets(spark, sf)
    when, upto = instants.parse_created_at(F.col("created_at")), F.lit(None)
    for number, mark in enumerate(("2030-01-01 00:00:00", MARK, "2024-01-10 00:00:00")):
        upto = F.when(F.col("_when") <= instants.instant(mark), 3 - number).otherwise(upto)
    # Rows are written once, by the first mark they are not after; each load reads all that is up to its mark.
    raw.withColumn("_when", when).withColumn("upto", upto).drop("_when").filter("upto is not null").write.options(
        **sinks.CSV_OPTIONS).partitionBy("upto").csv(inbox)
    for marks in ("1", "1,2", "1,2,3"):
        _done(ingest(spark, f"{inbox}/upto={{{marks}}}", root, AS_OF, "flag"))
        keeping.keep_up(spark, root, AS_OF, buckets=8, **options)
    return root


@query(_CONVERSATION.replace("FROM conv", f"FROM ({_TIMED}) conv"), "csv_tweets")
def rollups_incremental(spark, sf):
    return naive(tables.conversations(spark, _kept(spark, sf)))


@query(_FEATURES.replace("FROM interactions", _LOADED), "csv_tweets")
def features_incremental(spark, sf):
    return keeping.kept_features(keeping.kept(spark, _kept(spark, sf)), AS_OF).select("customer_id", *FEATURE_COLUMNS)


_AT = "2024-01-16 12:34:56"


@query("SELECT customer_id, n AS total_interactions, h AS hours_since_own, recent AS recent_interactions FROM ("
       + _CTES["kept_act"].replace(AS_OF, _AT) + ")", "csv_tweets")
def activity_incremental(spark, sf):
    """At a time within an hour: whole hours are counted already, the hour that the limit cuts is read."""
    return keeping.kept_activity(keeping.kept(spark, _kept(spark, sf)), _AT)


@query("SELECT *, 0::BIGINT AS part, 1::BIGINT AS parts FROM kept_logs", "kept_logs")
def history_bucketed(spark, sf):
    """Chat logs from the history as it lies, without a shuffle."""
    return keeping.kept_chat_log(keeping.kept(spark, _kept(spark, sf)))


@query("SELECT * FROM kept_logs", "kept_logs")
def history_bucketed_long(spark, sf):
    """Almost all histories are long here, and most messages come after that is known."""
    rows = keeping.kept_chat_log(keeping.kept(spark, _kept(spark, sf, part_bits=0)))
    return rows.groupBy("customer_id").agg(F.expr(
        "trim(BOTH '\t\n\u000b\f\r \u00a0' FROM array_join(transform(sort_array(collect_list(struct(part, chat_log))), "
        "p -> p.chat_log), '\n'))").alias("chat_log"))


@query("""SELECT external_id, participant_external_id, interaction_timestamp,
coalesce(content_text, '') AS content_text FROM csv_tweets
WHERE participant_external_id IN ('7-7', '12-3', 'd5', 'nobody') AND interaction_timestamp IS NOT NULL""", "csv_tweets")
def lookup_bucketed(spark, sf):
    messages = keeping.kept(spark, _kept(spark, sf)).messages()
    return naive(lookup.history_of(messages, ["7-7", "12-3", "d5", "nobody"]))


@query("""SELECT d.customer_id, channel, reasoning, nullif(chat_log, '') AS chat_log,
CASE channel WHEN 'scheduling_phone_call' THEN 'escalated' ELSE 'pending_customer_response' END AS issue_status
FROM kept_decided d JOIN kept_logs l ON d.customer_id = l.customer_id""", "kept_decided kept_logs")
def predict_kept_export(spark, sf):
    """The prediction job over the kept tables, exported as CSV and read again."""
    root, out = _kept(spark, sf), fx.new_folder(spark, "predictions")
    keeping.predict_kept(spark, root, out, AS_OF)
    return _read_export(spark, out, PREDICTION_COLUMNS).select(
        "customer_id", "channel", "issue_status", "reasoning", "chat_log")


@query("""SELECT request_id, q.customer_id, CASE WHEN d.customer_id IS NULL THEN 'not_found' ELSE 'ok' END AS status,
channel, reasoning AS message FROM requests q LEFT JOIN kept_decided d ON q.customer_id = d.customer_id""",
       "requests kept_decided")
def stream_scores_kept(spark, sf):
    """A stream of requests answered from the kept state: no message is read."""
    root, state, out, inbox = (_kept(spark, sf), *(fx.new_folder(spark, n) for n in ("state", "answers", "requests")))
    fx.requests(spark, sf).write.parquet(inbox)
    stream = spark.readStream.schema("request_id bigint, customer_id string").parquet(inbox)
    score_stream(spark, stream, root, out, state, AS_OF, kept=True)
    return spark.read.parquet(out).select("request_id", "customer_id", "status", "channel", "message")


# --- streams ----------------------------------------------------------------------------------------

@query("""SELECT external_id, count(*) AS copies FROM (
SELECT DISTINCT external_id FROM tweets) GROUP BY 1""", "tweets")
def stream_ingest_once(spark, sf):
    """All files as a stream; which copy of an id stays depends on arrival, that one stays does not."""
    root, state = fx.new_folder(spark, "tables"), fx.new_folder(spark, "state")
    stream_ingest(spark, csv_folder(spark, sf), root, state, AS_OF)
    return tables.interactions(spark, root).groupBy("external_id").agg(
        F.count(F.lit(1)).alias("copies"))


@query("""SELECT count(*) AS records, count(DISTINCT external_id) AS stored,
count(*) - count(DISTINCT external_id) AS left_out,
count(*) FILTER (WHERE interaction_timestamp IS NULL) AS without_time FROM tweets""", "tweets")
def stream_left_out(spark, sf):
    """What micro-batches of a file each read, stored and left out; how they are cut does not matter."""
    root, state = fx.new_folder(spark, "tables"), fx.new_folder(spark, "state")
    stream_ingest(spark, csv_folder(spark, sf), root, state, AS_OF, max_files_per_trigger=1)
    counts = stream_batches(spark, root).agg(*(
        F.sum(c).alias(c) for c in ("records", "stored", "left_out_copy", "left_out_stored", "without_time")))
    return counts.select(
        "records", "stored", (F.col("left_out_copy") + F.col("left_out_stored")).alias("left_out"), "without_time")


@query("""SELECT md5('twitter|' || external_id) AS interaction_id, external_id, 'twitter' AS platform_type,
participant_external_id, """ + _cleaned("content_text") + """ AS content_text, '{}' AS content_metadata,
interaction_timestamp, in_response_to_tweet_id AS parent_interaction_id, '{}' AS platform_metadata,
'{}' AS processing_metadata, strftime(interaction_timestamp, '%Y-%m') AS month
FROM deduped WHERE content_text IS NOT NULL""", "deduped")
def stream_equals_batch(spark, sf):
    """The load of profile ``clean`` in two micro-batches that tear copies apart, the later copies coming first."""
    root, state, inbox = (fx.new_folder(spark, name) for name in ("tables", "state", "tweets"))
    raw = fx.raw_tweets(spark, sf)
    for later in (True, False):
        rows = raw.filter(F.coalesce(F.col("text").startswith("repost") | (F.length("tweet_id") == 2), F.lit(False)) == later)
        rows.write.mode("append").options(**sinks.CSV_OPTIONS).csv(inbox)
        stream_ingest(spark, inbox, root, state, AS_OF, profile="clean")
    return naive(tables.interactions(spark, root).select(
        *_STORED, F.date_format("event_month", "yyyy-MM").alias("month")))


@query("""SELECT external_id, count(*) AS copies FROM (
SELECT DISTINCT external_id FROM tweets CROSS JOIN (
  SELECT max(interaction_timestamp) - INTERVAL '10' DAY AS m FROM tweets WHERE length(external_id) % 2 = 0) mark
WHERE length(external_id) % 2 = 0 OR interaction_timestamp IS NULL OR interaction_timestamp >= m)
GROUP BY 1""", "tweets")
def stream_late(spark, sf):
    """The late rule: ids of odd length come after the others and are measured by the latest time of these."""
    root, state, inbox = (fx.new_folder(spark, name) for name in ("tables", "state", "tweets"))
    raw = fx.raw_tweets(spark, sf)
    for part in (0, 1):
        rows = raw.filter(F.length("tweet_id") % 2 == part)
        rows.write.mode("append").options(**sinks.CSV_OPTIONS).csv(inbox)
        stream_ingest(spark, inbox, root, state, AS_OF, delay="10 days")
    return tables.interactions(spark, root).groupBy("external_id").agg(F.count(F.lit(1)).alias("copies"))


@query("""SELECT external_id, participant_external_id FROM interactions
ORDER BY interaction_timestamp NULLS FIRST, external_id LIMIT 100""", "interactions")
def interactions_limit(spark, sf):
    root = fx.new_folder(spark, "tables")
    sinks.write_interactions(
        fx.interactions(spark, sf).withColumn("platform_type", F.lit("twitter")), root, "b1", AS_OF)
    return tables.interactions(spark, root, limit=100).select("external_id", "participant_external_id")


@query("SELECT customer_id FROM prof ORDER BY customer_id LIMIT 50", "prof")
def stored_profiles_limit(spark, sf):
    root = fx.new_folder(spark, "tables")
    sinks.write_profiles(fx.profiles(spark, sf), root)
    return tables.profiles(spark, root, limit=50).select("customer_id")


@query("SELECT count(*) AS profiles, count(*) AS predictions, 0::BIGINT AS skipped FROM conv", "conv")
def job_counts(spark, sf):
    """What the prediction job says it did over the tables it read."""
    root, out = fx.new_folder(spark, "tables"), fx.new_folder(spark, "predictions")
    sinks.write_interactions(
        fx.interactions(spark, sf).withColumn("platform_type", F.lit("twitter")), root, "b1", AS_OF)
    build_rollups(spark, root, AS_OF)
    done = predict_batch(spark, root, out, AS_OF)
    return spark.range(1).select(*(
        F.lit(getattr(done, name)).cast("long").alias(name) for name in ("profiles", "predictions", "skipped")))


@query("""SELECT request_id, q.customer_id, CASE WHEN c.customer_id IS NULL THEN 'not_found' ELSE 'ok'
END AS status FROM requests q LEFT JOIN conv c ON q.customer_id = c.customer_id""", "requests conv")
def stream_scores(spark, sf):
    root, state, out, inbox = (
        fx.new_folder(spark, name) for name in ("tables", "state", "answers", "requests"))
    sinks.write_interactions(
        fx.interactions(spark, sf).withColumn("platform_type", F.lit("twitter")), root, "b1", AS_OF)
    build_rollups(spark, root, AS_OF)
    fx.requests(spark, sf).write.parquet(inbox)
    stream = spark.readStream.schema("request_id bigint, customer_id string").parquet(inbox)
    score_stream(spark, stream, root, out, state, AS_OF)
    return spark.read.parquet(out).select("request_id", "customer_id", "status")
