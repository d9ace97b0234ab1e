"""Tables kept up load by load: equal to a rebuild after every load, from the new loads and the old state alone."""

import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from caseflow.operators import history
from caseflow.operators.features import activity, extract_features
from caseflow.operators.rollup import build_conversations
from caseflow.plans import kept as keeping
from caseflow.plans.rollups import build_features, build_rollups
from caseflow.plans.scoring import predict_batch, score_requests
from caseflow.sources import sinks, tables
from caseflow.sources.tweets import read_tweets
from checks import fixtures, registry
from conftest import plan_of

AS_OF = "2024-03-02T10:20:30+00:00"
TEXTS = (None, "", "help me now", "I want a Manager", "fine", "two\nlines", "x" * 40)


def add_load(spark, root, number, rows, status="completed"):
    """A stored batch and its run, as a load leaves them."""
    batch = f"b{number}"
    frame = spark.createDataFrame(
        [(str(i), who, when, text) for i, who, when, text in rows],
        "external_id string, participant_external_id string, t string, content_text string").selectExpr(
        "external_id", "participant_external_id", "cast(t as timestamp) as interaction_timestamp", "content_text",
        "'twitter' as platform_type")
    tables.ensure_tables(spark, root)
    sinks.write_interactions(frame, root, batch, AS_OF)
    start = sinks.run_start_row(
        spark, f"r{number}", "data_ingestion", "manual", "parquet", AS_OF, f'{{"batch_id": "{batch}"}}')
    ended = start.withColumns({"status": F.lit(status), "end_timestamp": F.lit(AS_OF).cast("timestamp")})
    sinks.append_rows(ended, root, "pipeline_runs")


def make_rows(seed, n, start):
    """A third of the rows from one participant, some without time, some late and some in the future."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        who = "hot" if i % 3 == 0 else rng.choice(["", None, *(f"u{k}" for k in range(15))])
        when = None if i % 19 == 0 else (
            f"2024-{rng.choice(['01', '02', '02', '03'])}-{rng.choice([1, 1, 1, 2, 28]):02d} "
            f"{rng.choice([9, 10, 10, 11, 23]):02d}:{rng.choice([0, 20, 59]):02d}:{rng.choice([0, 30, 31]):02d}")
        out.append((start + i, who, when, rng.choice(TEXTS)))
    return out


def same(one, other):
    other = other.select(one.columns)
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Three merged loads, the state after each compared on the way."""
    root = str(tmp_path_factory.mktemp("kept"))
    for number in (1, 2, 3):
        add_load(spark, root, number, make_rows(number, 240, number * 1000))
        assert keeping.keep_up(spark, root, AS_OF, buckets=4, part_bits=5) == 1
        now, inter = keeping.kept(spark, root), tables.interactions(spark, root)
        assert now.version == number
        assert same(keeping.kept_conversations(now, AS_OF), build_conversations(inter, AS_OF))
        assert same(keeping.kept_features(now, AS_OF), extract_features(inter, AS_OF))
    return root


@pytest.mark.parametrize("as_of", [
    AS_OF, "2024-03-02T10:20:31+00:00", "2024-03-02T10:00:00+00:00", "2024-03-02T11:59:59.999+00:00",
    "2024-02-02T10:59:00+00:00", "2020-01-01T00:00:00+00:00", "2030-01-01T00:00:00+00:00", "2024-03-01T00:00:00+00:00"])
def test_recent_messages_at_any_time(spark, loaded, as_of):
    now = keeping.kept(spark, loaded)
    assert same(keeping.kept_activity(now, as_of), activity(tables.interactions(spark, loaded), as_of))


def test_nothing_new_changes_nothing(spark, loaded):
    assert keeping.keep_up(spark, loaded, AS_OF) == 0 and keeping.kept(spark, loaded).version == 3


def test_published_tables_and_features(spark, loaded, folder):
    add_load(spark, folder, 9, [row for n in (1, 2, 3) for row in make_rows(n, 240, n * 1000)])
    build_rollups(spark, folder, AS_OF)
    build_features(spark, folder, AS_OF)
    keeping.write_kept_features(spark, loaded, AS_OF)
    for name in ("conversations", "customer_profiles", "customer_features"):
        assert same(tables.table(spark, loaded, name), tables.table(spark, folder, name))


def test_logs_of_long_and_short_histories(spark, loaded):
    now = keeping.kept(spark, loaded)
    assert {r["customer_id"] for r in now.long().collect()} >= {"hot"}
    assert now.history_long().count() > 0
    in_buckets = now.history().groupBy("participant_external_id").count().agg(F.max("count")).first()[0]
    assert in_buckets <= 2 ** 5
    for variant in ("prediction", "evaluation"):
        joiner = "\n" if variant == "prediction" else ""

        def whole(logs):
            return {r["customer_id"]: (r["n"] == r["parts"], r["log"].strip()) for r in logs.groupBy("customer_id").agg(
                F.count(F.lit(1)).alias("n"), F.max("parts").alias("parts"), F.array_join(F.transform(F.sort_array(
                    F.collect_list(F.struct("part", "chat_log"))), lambda p: p["chat_log"]), joiner).alias("log")).collect()}

        inter = tables.interactions(spark, loaded)
        got = whole(keeping.kept_chat_log(now, variant))
        assert got == whole(history.chat_log(inter, variant)) and all(done for done, _ in got.values())


def test_exports_agree(spark, loaded, tmp_path):
    one, other = str(tmp_path / "one"), str(tmp_path / "other")
    assert keeping.predict_kept(spark, loaded, one, AS_OF) == predict_batch(spark, loaded, other, AS_OF)

    def read(path):
        rows = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path)
        return rows.filter("part = 0").drop("chat_log", "parts")

    assert same(read(one), read(other))


def test_requests_are_read_once_and_no_message_is(spark, loaded):
    requests = spark.createDataFrame(
        [(1, "hot"), (2, "hot"), (3, "u1"), (4, "nobody"), (5, None)], "n int, customer_id string")
    got = keeping.score_kept(requests, loaded, AS_OF)
    assert same(got, score_requests(spark, requests, loaded, AS_OF))
    plan = plan_of(got)
    assert plan.count("ExistingRDD") == 1 and "content_text" not in plan


def test_only_new_loads_and_the_old_state_are_read(spark, folder):
    add_load(spark, folder, 1, make_rows(1, 60, 0))
    keeping.keep_up(spark, folder, AS_OF, buckets=4)
    # A load that did not complete is left for later, and the messages of the first load are not needed again.
    add_load(spark, folder, 2, make_rows(2, 60, 1000), status="failed")
    add_load(spark, folder, 3, make_rows(3, 60, 2000))
    old = keeping.kept(spark, folder)
    before = old.state().collect()
    sinks.write_interactions(tables.interactions(spark, folder).limit(0), folder, "b1", AS_OF)
    assert keeping.keep_up(spark, folder, AS_OF) == 1
    now = keeping.kept(spark, folder)
    total = {r["customer_id"]: r["total_interactions"] for r in now.state().collect()}
    for row in before:
        new = sum(who == row["customer_id"] for _, who, _, _ in make_rows(3, 60, 2000))
        assert total[row["customer_id"]] == row["total_interactions"] + new
    # The old state is joined as it lies; only the new loads are shuffled.
    new = keeping.customer_state(now.hours())
    plan = plan_of(keeping.merged(old.state(), new))
    join = plan.index("SortMergeJoin")
    sides = plan[join:].split("\n")
    depth = min(line.index("+-") for line in sides if "+-" in line)
    left = [line for line in sides[1:] if not line[depth:].startswith("+-") and line[depth:depth + 1] == ":"]
    assert any("Bucketed: true" in line for line in left) and not any("Exchange" in line for line in left)


def test_logs_need_no_exchange_of_the_history(spark, folder):
    add_load(spark, folder, 1, make_rows(1, 60, 0))
    keeping.keep_up(spark, folder, AS_OF, buckets=4)
    now = keeping.kept(spark, folder)
    plan = plan_of(now.history().groupBy("participant_external_id").agg(F.collect_list("content_text")))
    assert "Exchange" not in plan and "Bucketed: true" in plan
    one = now.history().filter("participant_external_id = 'u1'")
    assert one.rdd.getNumPartitions() <= 1 < now.history().groupBy("participant_external_id").count().rdd.getNumPartitions()


def test_a_version_that_failed_is_written_over(spark, folder, monkeypatch):
    add_load(spark, folder, 1, make_rows(1, 60, 0))
    keeping.keep_up(spark, folder, AS_OF, buckets=4)
    add_load(spark, folder, 2, make_rows(2, 60, 1000))
    with monkeypatch.context() as broken:
        broken.setattr(keeping, "_write_history", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            keeping.keep_up(spark, folder, AS_OF)
    assert keeping.kept(spark, folder).version == 1
    assert same(keeping.kept_features(keeping.kept(spark, folder), AS_OF),
                extract_features(tables.interactions(spark, folder).filter("batch_id = 'b1'"), AS_OF))
    add_load(spark, folder, 3, make_rows(3, 60, 2000))
    assert keeping.keep_up(spark, folder, AS_OF) == 2
    assert same(keeping.kept_features(keeping.kept(spark, folder), AS_OF),
                extract_features(tables.interactions(spark, folder), AS_OF))


def test_files_of_three_loads_hold_each_row_once(spark, monkeypatch):
    """Each load reads all rows up to its mark; files that held the earlier ones again grew faster than the input."""
    folders, sf, new_folder = [], "/root/testdata/sf0.001", fixtures.new_folder
    monkeypatch.setattr(fixtures, "new_folder", lambda *args: folders.append(new_folder(*args)) or folders[-1])
    root = registry._keep(spark, sf, {})
    files = [f for f in folders if "/tweets-" in f]
    written = sum(read_tweets(spark, f).count() for f in files)
    timed = fixtures.raw_tweets(spark, sf).filter("created_at <> 'garbage'").count()
    assert written == timed == tables.interactions(spark, root).count()


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = (blocks.apply(i).name() for i in range(blocks.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_jobs_leave_no_shuffles_and_no_stored_rows(spark, folder):
    """Shuffle files stayed until the driver collected its garbage, and stored rows for good."""
    add_load(spark, folder, 1, make_rows(1, 240, 1000))
    before, shared = shuffle_files(spark), Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))

    def kept_files():
        return {f for f in shared.rglob("part-*") if "/tables-" not in str(f) and "/tweets-" not in str(f)}

    files = kept_files()
    keeping.keep_up(spark, folder, AS_OF, buckets=4, part_bits=5)
    keeping.predict_kept(spark, folder, f"{folder}/out", AS_OF)
    for _ in range(20):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.5)
    assert not left and kept_files() == files


def test_short_logs_are_joined_where_they_lie(spark, loaded):
    """With long histories about, all short logs were shuffled once more to meet their customers."""
    now = keeping.kept(spark, loaded)
    predictions = spark.range(20).select(F.concat(F.lit("u"), "id").alias("customer_id"), F.lit("x").alias("channel"))
    rows = keeping._with_short_logs(predictions, now)
    plan = plan_of(rows)
    history = plan[plan.index("ObjectHashAggregate" if "ObjectHashAggregate" in plan else "SortAggregate"):]
    assert "Bucketed: true" in history and "content_text" in history
    assert "Exchange hashpartitioning" not in history.split("BroadcastExchange")[0]
    got = {r["customer_id"]: r["chat_log"] for r in rows.collect()}
    short = {r["participant_external_id"] for r in now.history().join(
        now.long(), F.col("participant_external_id") == F.col("customer_id"), "left_anti").collect()}
    assert {who for who, log in got.items() if log} == short and got["u19"] is None


@pytest.mark.parametrize("small", [True, False])
def test_exported_logs_are_whole_and_in_order(spark, loaded, tmp_path, monkeypatch, small):
    monkeypatch.setattr(keeping, "is_small", lambda df: small)
    out = str(tmp_path / "out")
    keeping.predict_kept(spark, loaded, out, AS_OF)
    rows = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(out)
    got = {}
    for row in sorted(rows.collect(), key=lambda r: (r["customer_id"], int(r["part"]))):
        got.setdefault(row["customer_id"], []).append(row)
    want = {r["customer_id"]: r["chat_log"] for r in history.chat_log(tables.interactions(spark, loaded)).collect()}
    assert got.keys() == want.keys() and len(got["hot"]) > 1
    for who, parts in got.items():
        assert [(int(p["part"]), int(p["parts"])) for p in parts] == [(i, len(parts)) for i in range(len(parts))]
        assert len({(p["channel"], p["message"], p["send_time"]) for p in parts}) == 1
        assert "\n".join(p["chat_log"] or "" for p in parts).strip() == want[who].strip()


def test_files_of_the_loads_go_after_them(spark, monkeypatch):
    """They stayed beside the tables made from them."""
    folders, new_folder = [], fixtures.new_folder
    monkeypatch.setattr(fixtures, "new_folder", lambda *args: folders.append(new_folder(*args)) or folders[-1])
    monkeypatch.setattr(registry, "_KEPT", {})
    root = registry._kept(spark, "/root/testdata/sf0.001")
    assert tables.interactions(spark, root).count() > 0
    assert not [f for f in folders if "/tweets-" in f and Path(f.removeprefix("file:")).exists()]


# --- histories that one task can hold

def test_huge_histories_are_ranged_and_others_shuffled_by_customer(spark, loaded, monkeypatch):
    now, found = keeping.kept(spark, loaded), []
    split, held = history._split, history._split_by_customer
    monkeypatch.setattr(history, "_split", lambda rows, *a: found.append(
        {r[0] for r in rows.select("customer_id").distinct().collect()}) or split(rows, *a))
    monkeypatch.setattr(history, "_split_by_customer", lambda rows, *a: found.append(
        {r[0] for r in rows.select("customer_id").distinct().collect()}) or held(rows, *a))
    long = {r["customer_id"] for r in now.long().collect()}
    logs = {}
    for bits in (7, 13):
        monkeypatch.setattr(keeping, "PART_BITS", bits)
        logs[bits] = {r["customer_id"]: (r["n"], r["log"]) for r in keeping.kept_chat_log(now).groupBy("customer_id").agg(
            (F.count(F.lit(1)) == F.max("parts")).alias("n"), F.array_join(F.transform(F.sort_array(
                F.collect_list(F.struct("part", "chat_log"))), lambda p: p["chat_log"]), "\n").alias("log")).collect()}
    assert found == [long - {"hot"}, {"hot"}, long]
    assert logs[7] == logs[13] and all(whole for whole, _ in logs[7].values())
    # By bytes too: four for a character at most.
    monkeypatch.setattr(keeping, "PART_BYTES", 4)
    assert {r["customer_id"] for r in now.huge().collect()} == long
