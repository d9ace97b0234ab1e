"""Joins that hold when one key owns a large share of the rows."""

from pyspark.sql import DataFrame, functions as F

# At most this many keys travel by broadcast. Any key outside the FREQUENT_KEYS most frequent ones
# owns at most 1/(FREQUENT_KEYS + 1) of the rows.
FREQUENT_KEYS = 1000
# Tasks over which the rows of a frequent key are spread.
SPREAD = 64
# A key list up to this length may be broadcast to filter a large table.
SMALL_KEYS = 100_000


def frequent_keys(df: DataFrame, key, limit=FREQUENT_KEYS) -> DataFrame:
    """The most frequent keys. Only the key column is read, and counts are combined before the shuffle."""
    return (
        df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        .orderBy(F.col("_rows").desc(), F.col(key)).limit(limit).select(key))


def join_unique(left: DataFrame, right: DataFrame, key) -> DataFrame:
    """Left join to a table with one row per key, for a left side with very frequent keys.

    The rows of a frequent key, and those without a key, are spread over SPREAD tasks; the one right row of a
    frequent key is repeated for each. The left side is read whole once, and its key column once more to count.
    """
    # Where a row goes follows from its values, so a task that runs again sends it to the same place.
    plain = [f.name for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    place = F.pmod(F.xxhash64(*(left[c] for c in plain)), F.lit(SPREAD))
    frequent = F.broadcast(frequent_keys(left, key).withColumn("_frequent", F.lit(True)))
    is_frequent = F.coalesce("_frequent", F.lit(False))
    spread = left.join(frequent, key, "left").withColumn("_salt", F.when(
        is_frequent | F.col(key).isNull(), place).otherwise(F.lit(0)).cast("long")).drop("_frequent")
    repeated = right.join(frequent, key, "left").withColumn("_salt", F.explode(F.sequence(
        F.lit(0).cast("long"), F.when(is_frequent, F.lit(SPREAD - 1)).otherwise(0).cast("long")))).drop("_frequent")
    return spread.join(repeated, [key, "_salt"], "left").drop("_salt")


def semi_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Left rows whose key occurs on the right; both sides may have very frequent keys."""
    keys = right.select(on).filter(F.col(on).isNotNull()).distinct()
    if is_small(keys):
        return left.join(F.broadcast(keys), on, "left_semi")
    marked = join_unique(left, keys.withColumn("_found", F.lit(True)), on)
    return marked.filter("_found").select(left.columns)


def is_small(df: DataFrame, limit=SMALL_KEYS) -> bool:
    """Whether the frame has at most ``limit`` rows. Runs a job; each task stops after that many rows."""
    return df.limit(limit + 1).count() <= limit
