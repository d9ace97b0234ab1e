"""Quality flags, cleaning, deduplication and row filters."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from caseflow.functions import instants, text

REQUIRED = ("external_id", "platform_type", "interaction_timestamp", "content_text")
PROFILES = ("flag", "clean")


def flag_required(df: DataFrame) -> DataFrame:
    present = F.lit(True)
    for name in REQUIRED:
        present = present & F.col(name).isNotNull()
    return df.withColumn("is_valid", present)


def flag_length(df: DataFrame, mode="line") -> DataFrame:
    """Narrow ``is_valid`` by text length.

    ``line`` wants one line of five or more characters and has no upper bound; ``bounds`` wants 5 to
    10,000 characters in all.
    """
    if mode == "line":
        long_enough = F.col("content_text").rlike(".{5}")
    elif mode == "bounds":
        long_enough = F.length("content_text").between(5, 10000)
    else:
        raise ValueError(f"unknown length mode: {mode}")
    return df.withColumn("is_valid", F.col("is_valid") & long_enough)


def score(df: DataFrame) -> DataFrame:
    return df.withColumn("quality_score", F.when(F.col("is_valid"), 1.0).otherwise(0.0))


def quarantine(df: DataFrame):
    """Split a flagged frame into valid and invalid rows; an undecided row is invalid."""
    valid = F.coalesce(F.col("is_valid"), F.lit(False))
    return df.filter(valid), df.filter(~valid)


def identity(key="external_id") -> Column:
    """What tells two interactions apart: the external id, or the content where there is none.

    Empty text is a missing value, as in the stored table, and times count to the millisecond.
    """
    content = F.concat_ws("|", *(F.coalesce(column, F.lit("")) for column in (
        F.col("participant_external_id"), F.unix_millis("interaction_timestamp").cast("string"),
        F.col("content_text"))))
    return F.coalesce(F.nullif(F.col(key), F.lit("")), F.concat(F.lit("content:"), F.md5(content)))


def dedup_external(df: DataFrame, key="external_id") -> DataFrame:
    """One row per identity: the earliest, ties by text and participant, missing values last.

    The rank filter runs before the shuffle too, so copies of one id collapse inside each map task
    and a very frequent id costs no more than any other.
    """
    order = Window.partitionBy(identity(key)).orderBy(
        F.col("interaction_timestamp").asc_nulls_last(),
        F.col("content_text").asc_nulls_last(),
        F.col("participant_external_id").asc_nulls_last())
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def drop_missing_text(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["content_text"])


def clean_text(df: DataFrame, name="content_text") -> DataFrame:
    return df.withColumn(name, text.strip_links_and_tags(F.col(name)))


def since(df: DataFrame, watermark, allowed_lateness=None) -> DataFrame:
    """Rows strictly after the watermark; all rows when there is none.

    ``allowed_lateness`` (an interval such as ``'2 hours'``) moves the mark back, for callers that
    deduplicate what they read twice. The month filter lets a stored table skip directories.
    """
    if watermark is None:
        return df
    mark = instants.instant(watermark)
    if allowed_lateness:
        mark = mark - F.expr(f"interval {allowed_lateness}")
    kept = F.col("interaction_timestamp") > mark
    if "event_month" in df.columns:
        kept = kept & (F.col("event_month") >= instants.event_month(mark))
    return df.filter(kept)


def contains(df: DataFrame, name, pattern) -> DataFrame:
    return df.filter(F.col(name).rlike(pattern))


def _is_resolved():
    return F.coalesce(F.col("resolution_status"), F.lit("")) == "resolved"


def open_only(df: DataFrame) -> DataFrame:
    return df.filter(~_is_resolved())


def resolution_counts(df: DataFrame) -> DataFrame:
    """How many customers are open and how many are skipped as resolved."""
    return df.agg(
        F.count_if(~_is_resolved()).alias("open_customers"),
        F.count_if(_is_resolved()).alias("skipped_customers"))


def apply_profile(df: DataFrame, profile) -> DataFrame:
    """``flag`` keeps every row and marks it; ``clean`` deduplicates, drops and rewrites."""
    if profile == "flag":
        return df.transform(flag_required).transform(flag_length).transform(score)
    if profile == "clean":
        return df.transform(dedup_external).transform(drop_missing_text).transform(clean_text)
    raise ValueError(f"unknown quality profile: {profile}; expected one of {PROFILES}")
