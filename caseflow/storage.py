"""Where intermediate results live that must outlast an executor."""

import itertools
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Rows of a file in a scratch folder: what one task wrote is read again by several.
SCRATCH_ROWS = 100_000
# Spark's setting that removes the shuffle files of a query at its end.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where none is set, a local session gets a folder of its own; any other session is an error, since
    a machine-local folder cannot be read by the rest of the cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or _checkpoint_dir(spark)


def _checkpoint_dir(spark):
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.match(r"local(\[|$)", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Store the rows once in the shared folder and go on from there."""
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Store the rows once in the shared folder, as compressed columns, and go on from there. For wide rows this takes less
    than ``durable``, and who reads few columns reads only these."""
    spark = df.sparkSession
    return _stored(df, f"{shared_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}")


def _stored(df, path):
    spark = df.sparkSession
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").option("maxRecordsPerFile", SCRATCH_ROWS).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder) -> None:
    """Remove a folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession):
    """``keep(df)``: store rows as ``stored`` does. The folder goes with the end of the block, so what is made from it
    must be written by then."""
    folder = f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    numbers = itertools.count()

    def keep(df: DataFrame) -> DataFrame:
        return _stored(df, f"{folder}/{next(numbers)}")

    try:
        yield keep
    finally:
        remove(spark, folder)
