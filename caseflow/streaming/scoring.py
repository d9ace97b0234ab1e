"""Answering a stream of requested customer ids."""

from pyspark.sql import SparkSession

from caseflow.plans.kept import score_kept
from caseflow.plans.scoring import score_requests
from caseflow.plans.session import job_settings, now_text


def score_stream(spark: SparkSession, requests, root, out, checkpoint, as_of=None, kept=False):
    """Answer each micro-batch of requests from the stored tables, one folder per micro-batch.

    ``kept``: from the tables that are kept up per customer, so that a micro-batch is read once and no message is.
    """
    def answer(batch, number):
        now = as_of or now_text()
        scored = score_kept(batch, root, now) if kept else score_requests(batch.sparkSession, batch, root, now)
        scored.write.mode("overwrite").parquet(f"{out}/batch={number}")

    with job_settings(spark):
        query = (
            requests.writeStream.foreachBatch(answer)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    return query
