import random

import pytest
from pyspark.sql import functions as F

from caseflow.operators import history
from conftest import plan_of


@pytest.fixture(scope="module")
def skewed(spark, interactions):
    """One participant owns a third of the rows, many of them at one instant."""
    rng = random.Random(5)
    rows = []
    for i in range(600):
        who = "hot" if i % 3 == 0 else f"u{i % 40}"
        when = None if i % 97 == 0 else "2024-01-01 00:00:00" if i % 2 else (
            f"2024-01-{rng.randint(1, 28):02d} 10:00:{rng.randint(0, 59):02d}")
        rows.append((f"{i:04d}", who, when, rng.choice([None, "", f"text {i}", "two\nlines"])))
    return rows, interactions(rows).cache()


def expected_log(rows, who):
    mine = sorted((when or "", i, text) for i, person, when, text in rows if person == who)
    return "\n".join(f"{who}: {text or ''}" for _, _, text in mine).strip()


@pytest.mark.parametrize("bits, few", [(2, True), (2, False), (4, True), (13, True)])
def test_parts_hold_everything_in_order(skewed, monkeypatch, bits, few):
    monkeypatch.setattr(history, "is_small", lambda keys: few)
    rows, df = skewed
    parts = history.chat_log(df, part_bits=bits).orderBy("customer_id", "part").collect()
    joined = {}
    for part in parts:
        joined.setdefault(part["customer_id"], []).append(part)
    assert len(joined) == len({who for _, who, _, _ in rows})
    for who, found in joined.items():
        assert [p["part"] for p in found] == list(range(len(found)))
        assert "\n".join(p["chat_log"] for p in found) == expected_log(rows, who)
    # 200 messages of the hot participant in parts of bounded size, the others whole
    assert (len(joined["hot"]) >= 200 // 2 ** bits) and (bits == 13) == (len(joined["hot"]) == 1)


@pytest.mark.parametrize("bits", [3, 13])
def test_offsets_number_the_messages(skewed, bits):
    rows, df = skewed
    texts = history.render_history(df, bits).orderBy("part").collect()
    whole = "".join(r["history"] for r in texts if r["customer_id"] == "hot")
    positions = [whole.index(f"Interaction {i} (") for i in range(1, 201)]
    assert positions == sorted(positions) and "Interaction 201 (" not in whole


def test_part_sizes_are_bounded(skewed):
    _, df = skewed
    parts = history.history_parts(df, F.col("content_text"), part_bits=4)
    sizes = parts.select(F.size("items").alias("n"), "offset", "parts").collect()
    assert max(r["n"] for r in sizes) <= 16 and sum(r["n"] for r in sizes) == 600


@pytest.mark.parametrize("bits", [3, 13])
def test_long_texts_are_cut_by_bytes(interactions, bits):
    """Few messages of much text, among them one above the bound, next to customers with short histories."""
    rows = [(f"{i:04d}", "wordy", f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", f"{i:03d}é" * (1000 if i == 70 else 20 + i % 50))
            for i in range(120)]
    rows += [(f"9{i:03d}", f"u{i % 5}", "2024-01-02", None if i % 3 else "short") for i in range(40)]
    df, bound = interactions(rows), 1500
    parts = history.chat_log(df, part_bits=bits, part_bytes=bound).orderBy("customer_id", "part").collect()
    for who in {row[1] for row in rows}:
        mine = [p for p in parts if p["customer_id"] == who]
        assert [(p["part"], p["parts"]) for p in mine] == [(i, len(mine)) for i in range(len(mine))]
        assert "\n".join(p["chat_log"] for p in mine) == expected_log(rows, who)
        for p in mine:
            sizes = [len(line.removeprefix(f"{who}: ").encode()) for line in p["chat_log"].split("\n")]
            assert sum(sizes[:-1]) < bound and len(sizes) <= 2 ** bits
    assert sum(p["customer_id"] == "wordy" for p in parts) > 15
    assert max(p["parts"] for p in parts if p["customer_id"] != "wordy") == 1
    texts = history.render_history(df, bits, part_bytes=bound).orderBy("part").collect()
    whole = "".join(r["history"] for r in texts if r["customer_id"] == "wordy")
    positions = [whole.index(f"Interaction {i} (") for i in range(1, 121)]
    assert positions == sorted(positions)


def test_short_histories_need_one_shuffle(skewed):
    _, df = skewed
    plan = plan_of(history.chat_log(df))
    assert plan.count("Exchange") == 1 and "Python" not in plan


def test_many_long_histories_are_marked_once(skewed, monkeypatch):
    """The join that marks them is stored, not repeated for the short ones, the long ones and the bounds of their ranges."""
    rows, df = skewed
    monkeypatch.setattr(history, "is_small", lambda frame: False)
    parts = history.collect_history(df, part_bits=3)
    assert "_salt" not in plan_of(parts)
    assert parts.selectExpr("sum(size(messages))").first()[0] == len(rows)


def test_join_parts_keeps_customers_without_messages(spark, skewed):
    _, df = skewed
    customers = spark.createDataFrame([("hot", 1), ("nobody", 2), ("u1", 3)], "customer_id string, n int")
    for bits in (2, 13):
        long = history.long_histories(df, part_bits=bits)
        logs = history.chat_log(df, part_bits=bits, long=long)
        got = history.join_parts(customers, logs, long).collect()
        assert {r["customer_id"] for r in got} == {"hot", "nobody", "u1"}
        assert [(r["part"], r["chat_log"]) for r in got if r["customer_id"] == "nobody"] == [(0, None)]
        hot = sorted((r["part"], r["n"]) for r in got if r["customer_id"] == "hot")
        assert hot == [(i, 1) for i in range(len(hot))] and (len(hot) > 1) == (bits == 2)


def test_variants(interactions):
    df = interactions([
        (2, "a", "2024-01-01 00:00:00", "  second "), (1, "a", "2024-01-01 00:00:00", None),
        (3, "a", "2023-01-01", "first\nline "), (4, None, "2024-01-01", "nobody")])
    assert history.chat_log(df).first()["chat_log"] == "a: first\nline \na: \na:   second"
    assert history.chat_log(df, "evaluation").first()["chat_log"] == (
        "Customer: first\nline \nCustomer: \nCustomer:   second \n")
    assert history.render_history(df).first()["history"] == (
        "Interaction 1 (2023-01-01T00:00:00Z) by a: first\nline "
        "Interaction 2 (2024-01-01T00:00:00Z) by a: No content"
        "Interaction 3 (2024-01-01T00:00:00Z) by a:   second ")
    assert history.chat_log(df).count() == 1
    with pytest.raises(ValueError):
        history.chat_log(df, "other")


def test_collect_history(interactions):
    df = interactions([(2, "a", "2024-01-02", "b"), (1, "a", "2024-01-01", None)])
    messages = history.collect_history(df).first()["messages"]
    assert [(m["external_id"], m["content_text"]) for m in messages] == [("1", None), ("2", "b")]


@pytest.mark.parametrize("bits, size", [(0, 1 << 20), (2, 1 << 20), (4, 30), (13, 25), (13, 1 << 20)])
def test_parts_by_customer_are_those_of_ranges(skewed, bits, size):
    """What a task can hold takes one shuffle by customer; the messages of a part and their order are as bounded as before."""
    data, df = skewed
    rows = df.select(
        F.col("participant_external_id").alias("customer_id"), F.struct(*history.BY_TIME).alias("order"),
        F.col("content_text").alias("item"), history._bytes("content_text").alias("size"))
    parts = history._split_by_customer(rows, bits, size)
    assert plan_of(parts).count("Exchange ") == 1
    by_customer = {}
    for part in parts.collect():
        by_customer.setdefault(part["customer_id"], []).append(part)
    ranged = {}
    for row in history._split(rows, bits, size).collect():
        ranged.setdefault(row["customer_id"], []).append(row)
    assert by_customer.keys() == ranged.keys() == {who for _, who, _, _ in data}
    for who, found in by_customer.items():
        found.sort(key=lambda p: p["part"])
        items = [item for part in found for item in part["items"]]
        assert items == [item for part in sorted(ranged[who], key=lambda p: p["part"]) for item in part["items"]]
        assert [p["part"] for p in found] == list(range(len(found))) and {p["parts"] for p in found} == {len(found)}
        sizes = [len(p["items"]) for p in found]
        assert [p["offset"] for p in found] == [sum(sizes[:i]) for i in range(len(sizes))] and max(sizes) <= 2 ** bits
        assert all(sum(len(i["item"] or "") for i in p["items"][:-1]) < size for p in found + ranged[who])
