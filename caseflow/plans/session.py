"""What a job needs from its session."""

from contextlib import contextmanager
from datetime import datetime, timezone

from caseflow.storage import CLEAN_SHUFFLES

ZONE = "spark.sql.session.timeZone"
EXCLUDED = "spark.sql.adaptive.optimizer.excludedRules"
EMPTY_RELATION = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
CODEC = "spark.sql.parquet.compression.codec"


@contextmanager
def job_settings(spark):
    """Session settings while a job runs.

    The zone is UTC, so that months, texts and marks mean the same everywhere. Stages that turn out
    empty stay in the plan, since row counts observed below them would be lost with them. A job is many queries over the
    same rows: the shuffle files of each go with its end instead of at the driver's next garbage collection, and tables
    are written with zstd, where the session does not say otherwise.
    """
    before = {name: spark.conf.get(name, None) for name in (ZONE, EXCLUDED, CLEAN_SHUFFLES, CODEC)}
    spark.conf.set(ZONE, "UTC")
    spark.conf.set(EXCLUDED, ",".join(filter(None, [before[EXCLUDED], EMPTY_RELATION])))
    spark.conf.set(CLEAN_SHUFFLES, before[CLEAN_SHUFFLES] or "true")
    spark.conf.set(CODEC, before[CODEC] or "zstd")
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def now_text():
    return datetime.now(timezone.utc).isoformat()
