"""Times the headline queries and jobs; prints one JSON line.

``$BENCH_SF_DIR`` names the test tables (default sf0.1), ``$BENCH_CPUS`` the local threads. Queries run
into the no-op sink, jobs write real tables. Preparing the CSV files is not timed. The ``ingest_2m`` job
loads two million records, the size of the one load the reference publishes a time for. ``value`` adds up
the headline jobs; the ``hard_*`` cases (cleaning two million rows, one large file, a participant with a third of
all rows, a late reload) are listed next to them.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from caseflow.plans.ingest import ingest  # noqa: E402
from caseflow.plans.rollups import build_rollups  # noqa: E402
from caseflow.plans.scoring import evaluate_batch, predict_batch, score_requests  # noqa: E402
from caseflow.sources import sinks  # noqa: E402
from caseflow.streaming.ingest import stream_ingest  # noqa: E402
from checks import fixtures as fx, registry  # noqa: E402
from checks.compare import session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
QUERIES = (
    "normalize_tweets", "quality_flags", "dedup_external", "clean_text", "conversations", "profiles",
    "extract_features", "decide", "predict_open", "predict_with_chat_log", "chat_log",
    "render_history", "build_prompt", "evaluate_first", "score_requests", "last_watermarks",
    "run_end_append", "upsert_watermark", "drop_stored_rows")
TWO_MILLION = 2_000_000


def timed(action):
    started = time.perf_counter()
    value = action()
    return time.perf_counter() - started, value


def run_query(spark, name):
    registry.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()


def completed(result):
    if result.status != "completed":
        raise RuntimeError(result.error)
    return result


def two_million_tweets(spark, files=32, hot=False):
    """CSV files of two million raw tweets, by repeating the event tweets under new ids; ``hot`` gives a third of
    them to one author."""
    tweets = fx.raw_tweets(spark, SF_DIR).filter("inbound is not null and author_id not like 'src%'")
    copies = -(-TWO_MILLION // tweets.count())
    folder = fx.new_folder(spark, "tweets")
    sinks.write_csv(
        tweets.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        .withColumn("tweet_id", F.concat_ws("-", "tweet_id", "copy"))
        .withColumn("author_id", F.concat_ws("-", "author_id", "copy"))
        .withColumn("author_id", F.when(
            F.lit(hot) & (F.crc32("tweet_id") % 3 == 0), "hot").otherwise(F.col("author_id")))
        .drop("copy").limit(TWO_MILLION).repartition(files), folder)
    return folder


def main():
    spark = session(CPUS)
    run_query(spark, "decide")  # start the executors and the code generator
    seconds, rates = {}, {}
    for name in QUERIES:
        seconds[name], _ = timed(lambda: run_query(spark, name))

    csv, root = registry.csv_folder(spark, SF_DIR), fx.new_folder(spark, "tables")
    for profile in ("clean", "flag"):
        target = root if profile == "flag" else fx.new_folder(spark, "tables")
        seconds[f"ingest_{profile}"], result = timed(
            lambda: completed(ingest(spark, csv, target, fx.AS_OF, profile)))
        rates[f"ingest_{profile}"] = result.records_read / seconds[f"ingest_{profile}"]
    seconds["stream_ingest"], _ = timed(lambda: stream_ingest(
        spark, csv, fx.new_folder(spark, "tables"), fx.new_folder(spark, "state"), fx.AS_OF))
    seconds["build_rollups"], _ = timed(lambda: build_rollups(spark, root, fx.AS_OF))
    seconds["predict_batch"], result = timed(
        lambda: predict_batch(spark, root, fx.new_folder(spark, "predictions"), fx.AS_OF))
    rates["predict_batch"] = result.predictions / seconds["predict_batch"]
    seconds["evaluate_batch"], _ = timed(
        lambda: evaluate_batch(spark, root, fx.new_folder(spark, "evaluation"), fx.AS_OF))
    seconds["score_requests_job"], _ = timed(lambda: score_requests(
        spark, fx.requests(spark, SF_DIR), root, fx.AS_OF).write.format("noop").mode(
        "overwrite").save())

    large, target = two_million_tweets(spark), fx.new_folder(spark, "tables")
    seconds["ingest_2m"], result = timed(
        lambda: completed(ingest(spark, large, target, fx.AS_OF, "flag")))
    rates["ingest_2m"] = result.records_read / seconds["ingest_2m"]
    seconds["rollups_2m"], _ = timed(lambda: build_rollups(spark, target, fx.AS_OF))
    seconds["predict_2m"], result = timed(
        lambda: predict_batch(spark, target, fx.new_folder(spark, "predictions"), fx.AS_OF))
    rates["predict_2m"] = result.predictions / seconds["predict_2m"]

    hard = fx.new_folder(spark, "tables")
    seconds["hard_ingest_clean_2m"], result = timed(
        lambda: completed(ingest(spark, large, hard, fx.AS_OF, "clean")))
    rates["hard_ingest_clean_2m"] = result.records_read / seconds["hard_ingest_clean_2m"]
    seconds["hard_late_reload_2m"], _ = timed(lambda: completed(ingest(
        spark, large, hard, fx.AS_OF, "clean", allowed_lateness="40 days")))
    one, hard = two_million_tweets(spark, files=1, hot=True), fx.new_folder(spark, "tables")
    seconds["hard_one_file_hot_2m"], result = timed(
        lambda: completed(ingest(spark, one, hard, fx.AS_OF, "flag", split_files=True)))
    rates["hard_one_file_hot_2m"] = result.records_read / seconds["hard_one_file_hot_2m"]
    seconds["hard_rollups_hot_2m"], _ = timed(lambda: build_rollups(spark, hard, fx.AS_OF))
    seconds["hard_predict_hot_2m"], _ = timed(
        lambda: predict_batch(spark, hard, fx.new_folder(spark, "predictions"), fx.AS_OF))

    print(json.dumps({
        "metric": "headline queries and jobs, total wall time",
        "value": round(sum(v for name, v in seconds.items() if not name.startswith("hard_")), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "per_second": {name: round(value) for name, value in rates.items()},
        "sf": float(Path(SF_DIR).name.removeprefix("sf")),
        "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
