"""Mixing: targets by hand, flows against all assignments, amounts near their targets."""

import itertools
import random
import re

import pyarrow as pa
import pytest

from caseflow.llm.mixing import _small, in_order, mix, mix_report, mixed_copies, route, weighted_targets

SCHEMA = "doc_id long, text string, source string, size string, taken string"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)


def test_targets():
    sizes = {"b": 100, "a": 300, None: 100, "é": 0}
    assert in_order(sizes) == ["a", "b", "é", None]
    targets = weighted_targets(sizes, (3, 1, 2), 1.5, 2)
    # 750 by 3:1:2:3; é is capped at 0, null at 200, then 550 by 3:1.
    assert targets == {"é": 0.0, None: 200.0, "a": 412.5, "b": 137.5}


@pytest.mark.parametrize("seed", range(6))
def test_flow_is_cheapest(seed):
    rng = random.Random(seed)
    members = {0: ("a",), 1: ("a", "b"), 2: ("b",)}
    capacity = {p: rng.randint(0, 4) for p in members}
    quota = {"a": rng.randint(0, 6), "b": rng.randint(0, 6)}
    best = None
    for given in itertools.product(*(range(2 * capacity[p] + 1) for p in members)):
        for x in range(given[1] + 1):
            a, b = given[0] + x, given[2] + given[1] - x
            if a <= quota["a"] and b <= quota["b"]:
                cost = sum(max(0, g - capacity[p]) for p, g in zip(members, given))
                best = min(best or (0, 0), (-(a + b), cost))
    given = route(capacity, members, quota, 2)
    assert (-sum(given.values()), sum(max(0, given[p] - capacity[p]) for p in members)) == (best or (0, 0))


def test_report(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(3000)]
    rows += [(None, None, "a"), (None, "x y", None), (5, "same", "a"), (5, "same", "a"), (6, "w " * 5, "zero\u0000")]
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    targets = weighted_targets(sizes, (3, 1, 2), 1.5, 2)
    got = mix_report(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)
    by_size = {(s, t): 0 for s, t in {(sizes[n], targets[n]) for n in sizes}}
    for r in got:
        by_size[r.source_size, r.target] += r.taken
    for (size, target), taken in by_size.items():
        assert abs(taken - target) <= max(60, 0.01 * target) * len([n for n in sizes if sizes[n] == size])
    again = mix_report(frame(spark, list(reversed(rows)))).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a"] if i < 40 else ["a", "b"] if i < 80 else ["b", None]) for i in range(120)]
    rows += [(200, "w", []), (201, "w", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    mixed = mix(docs, targets={"a": 300, "b": 500, None: 100})
    taken = {r.pattern: r.n for r in mixed.documents.groupBy("pattern").sum("taken").withColumnRenamed("sum(taken)", "n").collect()}
    assert abs(sum(taken.values()) - 900) <= 30


def test_copies_and_empty(spark):
    rows = [(i, "w " * 10, "a" if i % 2 else "b") for i in range(100)]
    docs = frame(spark, rows)
    copies = mixed_copies(docs)
    assert copies.columns == docs.columns
    assert abs(copies.count() - 150) <= 2
    assert mix_report(frame(spark, [])).collect() == []


def test_tables_of_patterns_need_no_python_worker(spark):
    types = {"members": pa.list_(pa.string()), "pattern": pa.int64()}
    rows = [(["a", None], 0), ([None], 1), (["zero\u0000"], 2)]
    for some in (rows, []):
        table = _small(spark, some, **types)
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "LocalTableScan" in plan and "ExistingRDD" not in plan
        assert [(r.members, r.pattern) for r in table.collect()] == some
