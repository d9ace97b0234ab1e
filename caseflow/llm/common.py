"""What several operators share: stored intermediate tables, skewed joins, slices of Arrow batches."""

import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from caseflow.storage import shared_dir

# A broadcast list of the most frequent keys has at most this many rows, whatever the input.
HOT_KEYS = 1000
SPREAD = 64
# A key below this share of rows is never hot.
HOT_ROWS = 2000
# An id list up to this length may be broadcast; a longer one is joined by shuffle.
BROADCAST_IDS = 1_000_000
# Spark's setting that removes the shuffle files of a query at its end.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Spark's setting of how many bytes of rows go to a Python worker at once, besides 10,000 rows.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Text handled at once inside a task.
SLICE_BYTES = 8 << 20


@contextmanager
def settings(spark, values):
    """Settings of the session for a while."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def store(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and go on from there, whatever executors are lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    # The shuffles of the write are of no use once the rows are stored. A batch is cut into slices in any case, and both the
    # executor and its Python worker hold it whole.
    with settings(spark, {CLEAN_SHUFFLES: "true", BATCH_BYTES: spark.conf.get(BATCH_BYTES, str(SLICE_BYTES))}):
        df.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def used_up(*tables: DataFrame) -> None:
    """Remove stored tables that no later step reads: what was made from them must be stored itself."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def texts(docs: DataFrame, doc_id="doc_id", text="text", **more) -> DataFrame:
    """Only the columns needed, under fixed names, so that no other column of the input can clash."""
    return docs.select(
        docs[doc_id].alias("doc_id"), docs[text].alias("text"),
        *(column.alias(name) for name, column in more.items()))


def hot_keys(counts: DataFrame, key, rows) -> DataFrame:
    """The keys with most rows, at most HOT_KEYS of them."""
    return counts.filter(F.col(rows) >= HOT_ROWS).orderBy(F.desc(rows), key).limit(HOT_KEYS).select(key)


def spread_join(left: DataFrame, right: DataFrame, key, hot: DataFrame, how="inner") -> DataFrame:
    """Join to a table with one row per key. The rows of a hot key go to SPREAD tasks, and its one right
    row is repeated for each of them; any other key owns less than 1/HOT_KEYS of the rows. Where a row goes follows
    from its values, so a task that runs again sends it to the same place."""
    place = F.pmod(F.xxhash64(*(left[c] for c in left.columns)), F.lit(SPREAD))
    hot = F.broadcast(hot.select(key).withColumn("_hot", F.lit(True)))
    spread = F.coalesce("_hot", F.lit(False))
    left = (
        left.join(hot, key, "left")
        .withColumn("_salt", F.when(spread, place).otherwise(F.lit(0)))
        .drop("_hot"))
    right = (
        right.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(
            F.lit(0).cast("long"), F.when(spread, F.lit(SPREAD - 1)).otherwise(0).cast("long"))))
        .drop("_hot"))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def with_ids(docs: DataFrame, ids: DataFrame, n: int, key="doc_id") -> DataFrame:
    """The documents whose id is on a list of ``n`` distinct ids. A list of checked length is broadcast,
    a longer one is joined by shuffle; the rows are the same."""
    ids = ids.select(F.col(key).alias("_id"))
    if n <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs[key].eqNullSafe(ids["_id"]), "left_semi")


def slices(batch: pa.RecordBatch, column="text", limit=SLICE_BYTES):
    """Cut a batch into runs of rows whose texts take about ``limit`` bytes, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start, done = 0, 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield batch.slice(start, end - start)
        start, done = end, int(sizes[end - 1])


def words_of(column: pa.Array):
    """Words between ASCII white space: (distinct words, code of each word, row of each word)."""
    split = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    rows = pc.list_parent_indices(split).to_numpy().astype(np.int64)
    coded = pc.list_flatten(split).dictionary_encode()
    codes, distinct = coded.indices.to_numpy(), coded.dictionary
    # White space at the ends leaves empty words.
    empty = pc.index(distinct, "").as_py()
    if empty >= 0:
        keep = codes != empty
        codes, rows = codes[keep], rows[keep]
    return distinct, codes.astype(np.int64), rows
