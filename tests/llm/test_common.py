"""Stored tables and what is left of them."""

import os

import pyarrow as pa

from caseflow.llm.common import BATCH_BYTES, CLEAN_SHUFFLES, SLICE_BYTES, settings, store, used_up


def test_stored_rows_outlast_their_source(spark):
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    first = store(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())
    second = store(first.filter("k < 3"))
    assert spark.conf.get(CLEAN_SHUFFLES, None) == before
    used_up(first)
    assert not os.path.exists(first.stored_at) and os.path.exists(second.stored_at)
    assert sorted(map(tuple, second.collect())) == [(0, 143), (1, 143), (2, 143)]
    empty = store(second.limit(0))
    assert empty.columns == ["k", "count"] and empty.collect() == []


def test_batches_of_stored_rows_are_bounded_in_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    before = spark.conf.get(BATCH_BYTES, None)
    long = spark.range(0, 9000, 1, 1).selectExpr("repeat('word ', 800 + id % 2) AS text")
    for limit, own in ((SLICE_BYTES, {}), (1 << 20, {BATCH_BYTES: str(1 << 20)})):
        with settings(spark, own):
            rows = store(long.mapInArrow(sizes, "n long, bytes long")).collect()
        assert spark.conf.get(BATCH_BYTES, None) == before
        assert sum(r.n for r in rows) == 9000 and sum(r.bytes for r in rows) > 4 * SLICE_BYTES
        assert max(r.bytes for r in rows) < 1.1 * limit
