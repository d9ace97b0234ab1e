"""Sharding: even tables, few moves, one lookup per row."""

from collections import Counter

import pytest

from caseflow.llm.sharding import fill_table, place, write_shards


def test_table_is_even_and_stable():
    names = [f"s{i}" for i in range(10)]
    table = fill_table(names, 1009)
    counts = Counter(table)
    assert set(counts) == set(names) and max(counts.values()) - min(counts.values()) <= 1
    fewer = fill_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != "s9")
    assert moved < 0.25 * 1009
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            fill_table(bad, 1009)
    with pytest.raises(ValueError):
        fill_table(names, 1000)


def test_rows(spark, folder):
    docs = spark.createDataFrame(
        [(i % 50 if i else None, "x", "clash", 1) for i in range(300)], "doc_id long, text string, shard string, Slot2 int")
    placed = place(docs, ["doc_id"], ["a", "b", "c"], 101)
    assert placed.columns == ["doc_id", "text", "Slot2", "slot", "shard"]
    rows = placed.collect()
    table = fill_table(["a", "b", "c"], 101)
    assert len(rows) == 300 and all(table[r.slot] == r.shard for r in rows)
    assert len({(r.doc_id, r.slot) for r in rows}) == 51
    write_shards(docs, ["doc_id"], ["a", "b", "c"], folder + "/out", files_per_shard=2, size=101)
    assert spark.read.parquet(folder + "/out").count() == 300
    assert place(docs.limit(0), ["doc_id"], ["a"], 101).collect() == []


def test_frequent_key_fills_the_files_of_its_shard(spark, folder):
    docs = spark.createDataFrame([(7, f"text {i}") for i in range(400)], "doc_id long, text string")
    write_shards(docs, ["doc_id"], ["a", "b", "c"], folder + "/hot", files_per_shard=8, size=101)
    files = spark.read.parquet(folder + "/hot").groupBy("_metadata.file_path").count().collect()
    assert sum(r["count"] for r in files) == 400
    assert len(files) > 1 and max(r["count"] for r in files) < 400
