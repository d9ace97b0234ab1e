import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = session(4, **{
        "spark.sql.session.timeZone": "UTC",
        "spark.checkpoint.dir": folder,
        "spark.sql.warehouse.dir": folder + "/warehouse"})
    yield spark
    spark.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def interactions(spark):
    """Build an interaction frame from (id, participant, time, text) rows."""
    def build(rows):
        return spark.createDataFrame(
            [(str(i), who, when, text) for i, who, when, text in rows],
            "external_id string, participant_external_id string, t string, content_text string"
        ).selectExpr("external_id", "participant_external_id",
                     "cast(t as timestamp) as interaction_timestamp", "content_text")
    return build


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
