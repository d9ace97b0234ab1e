"""Exact deduplication against grouping in memory, and the filter's one-sided answers."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseflow.llm.exact_dedup import build_fuse, exact_dedup, in_fuse, keep_one, sha256

SCHEMA = "doc_id long, text string, digest string, keep_id string"
ROWS = [
    (1, "a"), (2, "a"), (3, "b"), (None, "b"), (4, None), (5, ""), (6, " "), (7, "A"), (8, "long " * 5000), (9, "long " * 5000),
    (2, "a"), (2, "c"), (None, "only"), (None, "only"), (10, "é"), (11, "é")]


def brute(rows):
    classes = defaultdict(list)
    for doc_id, text in rows:
        classes[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = classes[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


# The weak digest puts different texts under one digest, so that only their bytes tell them apart.
@pytest.mark.parametrize("batches, digest", [
    (1, sha256), (3, sha256), (2, lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 3), 2, "0")))])
def test_edges(spark, batches, digest):
    got = exact_dedup(frame(spark, ROWS), batches=batches, digest=digest).collect()
    assert sorted(map(tuple, got), key=repr) == brute(ROWS)


def test_hot_group(spark):
    rows = [(i, "copy" if i % 3 else f"own {i}") for i in range(9000)]
    got = exact_dedup(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_keep_one_and_empty(spark):
    kept = keep_one(frame(spark, ROWS))
    assert kept.columns == ["doc_id", "text", "digest", "keep_id"]
    assert sorted((r.text or "" for r in kept.collect())) == sorted({t or "" for _, t in ROWS})
    assert exact_dedup(frame(spark, [])).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 50_000])
def test_filter(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2 ** 63, 2 * n, np.int64)).view(np.uint64)[: 2 * n]
    held, others = keys[::2], keys[1::2]
    fuse = build_fuse(held)
    assert in_fuse(held, *fuse).all()
    assert in_fuse(others, *fuse).sum() <= 3 + len(others) / 100
