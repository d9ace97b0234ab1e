"""First looks at a table."""

from pyspark.sql import DataFrame

from caseflow.operators.limits import first_rows
from caseflow.operators.quality import contains
from caseflow.operators.skew import semi_join

__all__ = ["contains", "head", "semi_join"]


def head(df: DataFrame, n, order_by) -> DataFrame:
    """The first ``n`` rows in a stated order, which should end in a unique column."""
    return first_rows(df, order_by, n)
