"""The first rows of a total order, for any number of rows."""

from pyspark.sql import DataFrame, Window, functions as F

from caseflow.operators.skew import SMALL_KEYS
from caseflow.storage import durable

ROW_BITS = 33


def first_rows(df: DataFrame, order_by, n) -> DataFrame:
    """The first ``n`` rows; the order should end in a unique column, so that the choice is fixed.

    A short list is one top-k. A longer one must not pass through one task: the rows are range
    partitioned and sorted, the partitions before a row are counted, and each task keeps its share.
    """
    if n <= SMALL_KEYS:
        return df.orderBy(*order_by).limit(n)
    # A row id is the number of the partition, then the number of the row within it.
    row = F.monotonically_increasing_id()
    placed = durable(
        df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        .withColumn("_partition", F.shiftright(row, ROW_BITS))
        .withColumn("_position", row.bitwiseAND(F.lit(2 ** ROW_BITS - 1))))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_partition").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    # One row per partition of the range shuffle.
    return (
        placed.join(F.broadcast(offsets), "_partition")
        .filter(F.col("_before") + F.col("_position") < n)
        .drop("_partition", "_position", "_before"))
