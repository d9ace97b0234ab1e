"""The evaluation run: the first customers, scored whatever their status."""

from pyspark.sql import DataFrame, functions as F

from caseflow.operators.history import PART_BITS
from caseflow.operators.predict import (
    customers, first_profiles, history_of_few, log_columns, recommend, send_time, with_chat_log)
from caseflow.operators.rules import DEFAULT_RULES, issue_status
from caseflow.schemas import EVALUATION_COLUMNS


def evaluate(
        profiles: DataFrame, interactions: DataFrame, as_of, n=1000, rules=DEFAULT_RULES,
        part_bits=PART_BITS) -> DataFrame:
    """Score the first ``n`` profiles; a customer without messages keeps an empty history."""
    chosen = customers(profiles)
    if n:
        chosen = first_profiles(chosen, n)
        interactions = history_of_few(interactions, chosen, n)
    return (
        recommend(chosen, interactions, as_of, rules)
        .withColumns({"message": F.col("reasoning"), "send_time": send_time(as_of)})
        .transform(issue_status, "evaluation")
        .transform(with_chat_log, interactions, "evaluation", part_bits))


def project_evaluation(df: DataFrame) -> DataFrame:
    return df.select(*EVALUATION_COLUMNS, *log_columns(df))
