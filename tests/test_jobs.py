import json

import pytest
from pyspark.sql import functions as F

from caseflow import schemas
from caseflow.operators.lookup import latest_run
from caseflow.plans import ingest as ingest_module
from caseflow.plans.ingest import ingest, read_mark
from caseflow.plans.rollups import build_rollups
from caseflow.plans.scoring import evaluate_batch, predict_batch, score_requests
from caseflow.schemas import EVALUATION_COLUMNS, LOG_COLUMNS, PREDICTION_COLUMNS, RAW_TWEET, WATERMARK
from caseflow.sources import sinks, tables
from conftest import plan_of

AS_OF = "2024-01-16T12:00:00+00:00"


@pytest.fixture
def tweets(spark, tmp_path):
    """Write (id, author, raw time, text) tweets as CSV and return the folder."""
    def write(rows, name="in"):
        path = str(tmp_path / name)
        frame = spark.createDataFrame(
            [(str(i), who, "True", when, text, None, None) for i, who, when, text in rows], RAW_TWEET)
        sinks.write_csv(frame.coalesce(1), path)
        return path
    return write


def at(day, hour=0):
    return f"Mon Jan {day:02d} {hour:02d}:00:00 +0000 2024"


def stored(spark, root):
    return sorted(r["external_id"] for r in tables.interactions(spark, root).collect())


def runs(spark, root):
    return {r["run_id"]: r for r in latest_run(tables.runs(spark, root)).collect()}


def test_empty_tables(spark, folder):
    tables.ensure_tables(spark, folder)
    tables.ensure_tables(spark, folder)
    for name, schema in tables.SCHEMAS.items():
        frame = tables.table(spark, folder, name)
        assert frame.count() == 0 and frame.columns == schema.names


def test_load_is_incremental_and_idempotent(spark, folder, tweets):
    first = [(1, "a", at(1), "hello there"), (2, "b", at(2), "hi"), (3, "b", "garbage", "no time given")]
    result = ingest(spark, tweets(first), folder, AS_OF, run_id="r1")
    assert (result.status, result.records_read, result.records_processed, result.valid_records) == (
        "completed", 3, 3, 1)
    assert result.max_timestamp.startswith("2024-01-02T00:00:00")
    assert stored(spark, folder) == ["1", "2", "3"]

    result = ingest(spark, tweets(first, "again"), folder, AS_OF, run_id="r2")
    assert (result.status, result.records_read, result.records_processed) == ("completed", 0, 0)
    assert stored(spark, folder) == ["1", "2", "3"]
    assert tables.watermarks(spark, folder).count() == 1  # nothing loaded, mark not moved

    more = first + [(4, "a", at(2), "at the mark"), (5, "a", at(3), "after the mark")]
    assert ingest(spark, tweets(more, "more"), folder, AS_OF).records_processed == 1
    assert stored(spark, folder) == ["1", "2", "3", "5"]
    log = runs(spark, folder)
    assert log["r1"]["status"] == log["r2"]["status"] == "completed"
    assert log["r1"]["records_processed"] == 3 and log["r1"]["error_message"] is None
    assert json.loads(log["r1"]["config_snapshot"])["profile"] == "flag"


def test_invalid_rows_are_flagged_not_dropped(spark, folder, tweets):
    ingest(spark, tweets([(1, "a", at(1), "hello there"), (2, "a", at(1), "hi")]), folder, AS_OF)
    got = {r["external_id"]: (r["is_valid"], r["quality_score"])
           for r in tables.interactions(spark, folder).collect()}
    assert got == {"1": (True, 1.0), "2": (False, 0.0)}


def test_clean_profile(spark, folder, tweets):
    rows = [(1, "a", at(2), "repost"), (1, "a", at(1), "see http://x @me #now ok"), (2, "a", at(1), None)]
    result = ingest(spark, tweets(rows), folder, AS_OF, profile="clean")
    assert (result.records_read, result.records_processed, result.valid_records) == (3, 1, 1)
    assert tables.interactions(spark, folder).first()["content_text"] == "see    ok"


def test_everything_dropped(spark, folder, tweets):
    result = ingest(spark, tweets([(1, "a", at(1), None)]), folder, AS_OF, profile="clean")
    assert (result.status, result.records_read, result.records_processed) == ("completed", 1, 0)
    assert read_mark(spark, folder, "twitter") is None


def test_failure_between_write_and_mark(spark, folder, tweets, monkeypatch):
    rows = [(1, "a", at(1), "hello there"), (2, "b", at(2), "hello again")]
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "append_watermark", lambda *a, **k: 1 / 0)
        failed = ingest(spark, tweets(rows), folder, AS_OF, run_id="broken")
    assert failed.status == "failed" and "division" in failed.error
    assert runs(spark, folder)["broken"]["status"] == "failed"
    assert "division" in runs(spark, folder)["broken"]["error_message"]
    assert stored(spark, folder) == ["1", "2"] and read_mark(spark, folder, "twitter") is None

    rows.append((3, "c", at(3), "arrived since"))
    assert ingest(spark, tweets(rows, "later"), folder, AS_OF).status == "completed"
    assert stored(spark, folder) == ["1", "2", "3"]
    assert read_mark(spark, folder, "twitter").startswith("2024-01-03")


def test_missing_input_fails_the_run(spark, folder):
    result = ingest(spark, folder + "/nowhere", folder, AS_OF, run_id="r")
    assert result.status == "failed" and runs(spark, folder)["r"]["status"] == "failed"
    with pytest.raises(ValueError):
        ingest(spark, folder, folder, AS_OF, profile="strict")


@pytest.mark.parametrize("profile", ["flag", "clean"])
def test_late_rows(spark, folder, tweets, profile):
    first = [(1, "a", at(1), "hello there"), (2, "a", at(5, 6), "hello there")]
    ingest(spark, tweets(first), folder, AS_OF, profile=profile)
    late = first + [(3, "a", at(5, 1), "late but within"), (4, "a", at(4), "too late"),
                    (5, "a", at(5, 7), "new one")]
    result = ingest(
        spark, tweets(late, "late"), folder, AS_OF, profile=profile, allowed_lateness="12 hours")
    assert result.error is None and result.records_processed == 2
    assert stored(spark, folder) == ["1", "2", "3", "5"]
    ingest(spark, tweets(late, "again"), folder, AS_OF, profile=profile, allowed_lateness="12 hours")
    assert stored(spark, folder) == ["1", "2", "3", "5"]
    assert read_mark(spark, folder, "twitter").startswith("2024-01-05T07")


def test_session_settings_are_restored(spark, folder, tweets):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ingest(spark, tweets([(1, "a", at(1), "hello there")]), folder, AS_OF)
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
        month = tables.interactions(spark, folder).selectExpr("cast(event_month as string)").first()[0]
        assert month == "2024-01-01"  # by UTC, not 2023-12
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_months_are_skipped(spark, folder, tweets):
    from caseflow.operators.quality import since
    rows = [(i, "a", f"Mon {m} 05 00:00:00 +0000 2024", "hello there")
            for i, m in enumerate(("Jan", "Feb", "Mar"))]
    ingest(spark, tweets(rows), folder, AS_OF)
    recent = since(tables.interactions(spark, folder), "2024-02-10")
    assert recent.count() == 1 and len(recent.inputFiles()) == 3
    plan = plan_of(recent)
    assert "PartitionFilters: [isnotnull(event_month" in plan


def test_batch_size_caps_files(spark, folder, interactions):
    rows = [(i, "a", "2024-01-01", "x") for i in range(250)]
    sinks.write_interactions(interactions(rows), folder, "b", AS_OF, batch_size=100)
    stored_rows = tables.interactions(spark, folder)
    per_file = stored_rows.groupBy(F.input_file_name()).count().collect()
    assert sorted(r["count"] for r in per_file) == [50, 100, 100]


def test_rewriting_a_batch_replaces_it(spark, folder, interactions):
    for n in (5, 3):
        sinks.write_interactions(
            interactions([(i, "a", "2024-01-01", "x") for i in range(n)]), folder, "b", AS_OF)
    assert tables.interactions(spark, folder).count() == 3


def test_stored_defaults(spark, folder, interactions):
    df = interactions([(1, None, "2024-01-01 00:00:00.123456", None)])
    sinks.write_interactions(df, folder, "b", AS_OF)
    row = tables.interactions(spark, folder).first()
    assert row["participant_external_id"] == "" and row["content_text"] == ""
    assert row["content_metadata"] == row["platform_metadata"] == "{}"
    assert row["parent_interaction_id"] is None and row["interaction_timestamp"].microsecond == 123000


def test_watermark_upsert_in_versions(spark, folder):
    def mark(row_id, pipeline, ts, n):
        return sinks.watermark_row(spark, row_id, pipeline, "t", ts, n, "completed", ts)
    path = folder + "/marks"
    sinks.write_version(mark("1", "p", "2024-01-01", 1), path, 1)
    for version, new in ((2, mark("2", "p", "2024-01-02", 5)), (3, mark("3", "q", "2024-01-03", 7))):
        current = tables.latest_version(spark, path, WATERMARK)
        sinks.write_version(sinks.upsert_watermark(current, new), path, version)
    got = {r["pipeline_name"]: (r["id"], r["records_processed"])
           for r in tables.latest_version(spark, path, WATERMARK).collect()}
    assert got == {"p": ("1", 5), "q": ("3", 7)}


def test_run_end_forms(spark):
    start = sinks.run_start_row(spark, "r", "load", "manual", "parquet", "2024-01-01", "{}")
    ends = spark.createDataFrame(
        [("r", "completed", 5, None), ("lost", "failed", 0, "boom")],
        "run_id string, status string, records_processed long, error_message string").withColumn(
        "end_timestamp", F.lit("2024-01-02").cast("timestamp"))
    rows = {r["run_id"]: r for r in sinks.run_ended(start, ends, AS_OF).collect()}
    assert (rows["r"]["pipeline_name"], rows["r"]["status"], rows["r"]["error_message"]) == (
        "load", "completed", None)
    assert (rows["lost"]["pipeline_name"], rows["lost"]["start_timestamp"].year) == ("unknown", 1970)
    log = start.unionByName(sinks.run_ended(start, ends, AS_OF))
    assert latest_run(log, "r").first()["status"] == "completed"
    changed = sinks.run_ended(start, ends, AS_OF, mode="update").collect()
    assert [(r["run_id"], r["status"]) for r in changed] == [("r", "completed")]


def test_rebuilding_rollups_replaces_them(spark, folder, tweets):
    ingest(spark, tweets([(1, "a", at(1), "x" * 9), (2, "b", at(2), "y" * 9)]), folder, AS_OF)
    build_rollups(spark, folder, AS_OF)
    first = tables.conversations(spark, folder).collect()
    build_rollups(spark, folder, AS_OF)
    assert sorted(first) == sorted(tables.conversations(spark, folder).collect())
    assert [r["customer_id"] for r in tables.profiles(spark, folder, limit=1).collect()] == ["a"]
    assert tables.profiles(spark, folder).count() == 2
    assert tables.interactions(spark, folder, limit=1).first()["external_id"] == "1"


def read_export(spark, path):
    return spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path)


def test_predictions_end_to_end(spark, folder, tweets):
    rows = [(i, "long", at(1, i), 'with "quotes"\nand lines') for i in range(7)] + [(9, "short", at(2), "x")]
    ingest(spark, tweets(rows), folder, AS_OF)
    build_rollups(spark, folder, AS_OF)
    result = predict_batch(spark, folder, folder + "/out", AS_OF)
    assert (result.profiles, result.predictions, result.skipped) == (2, 2, 0)
    out = read_export(spark, folder + "/out")
    assert tuple(out.columns) == PREDICTION_COLUMNS + LOG_COLUMNS
    got = {r["customer_id"]: r for r in out.collect()}
    assert got["long"]["issue_status"] == "escalated"
    assert got["long"]["chat_log"] == "\n".join(['long: with "quotes"\nand lines'] * 7)
    assert got["short"]["channel"] == "email_reply"
    assert predict_batch(spark, folder, folder + "/one", AS_OF, limit=1).predictions == 1

    evaluate_batch(spark, folder, folder + "/eval", AS_OF)
    evaluated = read_export(spark, folder + "/eval")
    assert tuple(evaluated.columns) == EVALUATION_COLUMNS + LOG_COLUMNS and evaluated.count() == 2

    asked = spark.createDataFrame([("short",), ("who",)], "customer_id string")
    assert {r["customer_id"]: r["status"] for r in score_requests(
        spark, asked, folder, AS_OF).collect()} == {"short": "ok", "who": "not_found"}


def test_long_logs_are_exported_in_order(spark, folder, interactions):
    from caseflow.operators.predict import with_chat_log
    df = interactions([(f"{i:03d}", "hot", "2024-01-01", f"m{i:03d}") for i in range(50)])
    one = spark.createDataFrame([("hot", "c", "m", "s", "r", "i")], (
        "customer_id string, channel string, message string, send_time string, reasoning string, "
        "issue_status string"))
    sinks.export_predictions(with_chat_log(one, df, part_bits=2), folder + "/out")
    files = sorted(r["f"] for r in read_export(spark, folder + "/out").select(
        F.input_file_name().alias("f")).distinct().collect())
    parts = [(int(r["part"]), int(r["parts"])) for f in files for r in read_export(spark, f).collect()]
    assert parts == [(i, len(parts)) for i in range(len(parts))]
    logs = [r["chat_log"] for f in files for r in read_export(spark, f).collect()]
    assert "\n".join(logs) == "\n".join(f"hot: m{i:03d}" for i in range(50)) and len(logs) > 10


def test_batch_identity(spark, folder):
    tables.ensure_tables(spark, folder)

    def batch(run, mark="2024", platform="twitter"):
        return ingest_module.batch_id_for(tables.runs(spark, folder), run, platform, mark)

    def log(run, status, batch_id):
        config = json.dumps({"platform": "twitter", "mark": "2024", "batch_id": batch_id})
        sinks.append_rows(sinks.run_start_row(
            spark, run, ingest_module.PIPELINE, "manual", "parquet", AS_OF, config), folder, "pipeline_runs")
        end = sinks.one_row(spark, schemas.RUN, {
            "run_id": run, "end_timestamp": AS_OF, "status": status, "records_processed": 0, "error_message": ""})
        sinks.append_rows(sinks.run_ended(tables.runs(spark, folder), end, AS_OF), folder, "pipeline_runs")

    assert batch("r1") == batch("r1") != batch("r2")
    log("r1", "failed", "b1")
    assert batch("r2") == "b1" and batch("r2", mark="2025") != "b1" and batch("r2", platform="other") != "b1"
    log("r2", "completed", "b1")
    assert batch("r3") not in ("b1", batch("r4"))


def test_late_loads_keep_each_other(spark, folder, tweets):
    ingest(spark, tweets([(1, "a", at(9), "x" * 9)]), folder, AS_OF)
    for i in (2, 3, 4):
        late = ingest(spark, tweets([(i, "a", at(8, i), "late one")]), folder, AS_OF, allowed_lateness="40 days")
        assert late.status == "completed"
    assert sorted(r["external_id"] for r in tables.interactions(spark, folder).collect()) == ["1", "2", "3", "4"]


def test_rows_without_readable_times_keep_each_other(spark, folder, tweets):
    for i in (1, 2):
        ingest(spark, tweets([(i, "a", "never", "x" * 9)]), folder, AS_OF)
    assert sorted(r["external_id"] for r in tables.interactions(spark, folder).collect()) == ["1", "2"]


def test_rows_without_id_or_author(spark, folder, tweets):
    rows = [("", "a", at(9), "first text"), ("", "a", at(9), "other text"), ("", "", at(9), "nobody"), (1, "b", at(9), "hello")]
    ingest(spark, tweets(rows), folder, AS_OF)
    ingest(spark, tweets(rows + [("", "a", at(9, 2), "new text")]), folder, AS_OF, allowed_lateness="2 days")
    found = tables.interactions(spark, folder).collect()
    assert len(found) == 5 and len({r["interaction_id"] for r in found}) == 5
    build_rollups(spark, folder, AS_OF)
    assert {r["customer_id"] for r in tables.profiles(spark, folder).collect()} == {"a", "b"}


def test_overlapping_loads_keep_both(spark, folder, tweets, monkeypatch):
    """A second load starts from the same mark while the first has written and not yet committed."""
    first, second = tweets([(1, "a", at(9), "first"), (2, "a", at(9), "first")]), tweets(
        [(3, "b", at(8), "second"), (4, "b", at(7), "second")], "second")
    plain, inner = ingest_module.batch_stats, []

    def overlapped(rows):
        if not inner:
            inner.append(None)
            inner[0] = ingest(spark, second, folder, AS_OF, run_id="r2")
        return plain(rows)

    monkeypatch.setattr(ingest_module, "batch_stats", overlapped)
    outer = ingest(spark, first, folder, AS_OF, run_id="r1")
    assert (outer.status, inner[0].status) == ("completed", "completed")
    assert stored(spark, folder) == ["1", "2", "3", "4"]
    assert read_mark(spark, folder, "twitter").startswith("2024-01-09")


def test_the_mark_never_goes_back(spark, folder, tweets, monkeypatch):
    late, early = tweets([(1, "a", at(5), "x")]), tweets([(2, "a", at(9), "y")], "early")
    plain, inner = ingest_module.batch_stats, []

    def overlapped(rows):
        if not inner:
            inner.append(None)
            ingest(spark, early, folder, AS_OF)
        return plain(rows)

    monkeypatch.setattr(ingest_module, "batch_stats", overlapped)
    ingest(spark, late, folder, AS_OF)
    assert read_mark(spark, folder, "twitter").startswith("2024-01-09") and stored(spark, folder) == ["1", "2"]


def test_only_an_expired_lease_is_taken_over(spark, folder, tweets):
    tables.ensure_tables(spark, folder)
    config = json.dumps({"platform": "twitter", "mark": None, "batch_id": "b1"})
    sinks.append_rows(sinks.run_start_row(
        spark, "gone", ingest_module.PIPELINE, "manual", "parquet", AS_OF, config), folder, "pipeline_runs")
    leases = ingest_module.leases
    assert leases.claimed(spark, folder, "b1", "gone", 600)
    ingest(spark, tweets([("", "a", "never", "one")]), folder, AS_OF, run_id="r1")
    assert {r["batch_id"] for r in tables.interactions(spark, folder).collect()} == {ingest_module.own_batch("r1")}
    assert not leases.claimed(spark, folder, "b1", "r2", 600)
    leases._write(spark, folder, "b1", "gone", 0)
    ingest(spark, tweets([("", "a", "never", "two")], "two"), folder, AS_OF, run_id="r3")
    assert {r["batch_id"] for r in tables.interactions(spark, folder).collect()} == {ingest_module.own_batch("r1"), "b1"}


def test_a_load_that_lost_its_lease_does_not_commit(spark, folder, tweets, monkeypatch):
    plain = ingest_module.batch_stats

    def stalled(rows):
        batch = ingest_module.own_batch("r1")
        ingest_module.leases._write(spark, folder, batch, "other", 600)
        return plain(rows)

    monkeypatch.setattr(ingest_module, "batch_stats", stalled)
    result = ingest(spark, tweets([(1, "a", at(9), "first")]), folder, AS_OF, run_id="r1")
    assert result.status == "failed" and "lease" in result.error and read_mark(spark, folder, "twitter") is None


def test_leases_are_renewed_while_a_load_runs(spark, folder):
    import time
    tables.ensure_tables(spark, folder)
    leases = ingest_module.leases
    assert leases.claimed(spark, folder, "b", "r", 3)
    with leases.renewed(spark, folder, "b", "r", 3):
        time.sleep(5)
        assert not leases.others(spark, folder, "b", "someone").isEmpty()
    assert leases.others(spark, folder, "b", "someone").isEmpty()
