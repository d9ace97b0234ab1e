"""Exact top-k search against full scans."""

import math
import random

import numpy as np
import pytest

from caseflow.llm.topk import threshold_search, top_k

SCHEMA = "vec_id long, embedding array<float>, v string, class string"


def brute(rows, k):
    vectors = {(i, tuple(math.floor(64 * float(np.float32(x))) for x in e)) for i, e in rows
               if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)}
    out = []
    for i, q in vectors:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in vectors if j != i and len(v) == len(q))
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def test_table(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, rows[20][1]) for i in range(60)]
    rows += [(500, None), (501, [None] * 6), (502, [float("nan")] * 6), (520, [float("inf")] * 6), (None, [1.0] * 6),
             (540, [0.0] * 6), (560, [1.0, 2.0]), (561, [2.0, 1.0]), (580, []), rows[40], rows[41]]
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    got = sorted(map(tuple, top_k(docs, "vec_id % 20 = 0", k=20).collect()))
    assert got == brute(rows, 20)
    assert top_k(docs.limit(0), "vec_id % 20 = 0").collect() == []


def test_ids_with_several_vectors(spark):
    """A queried id with more vectors than k, some of them shared with other ids, and candidates with several."""
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(1, 60)]
    rows += [(20, [9.0 + i, 9.0, 9.0, 9.0]) for i in range(30)]
    rows += [(7, rows[-1][1]), (40, rows[-1][1]), (40, [8.0] * 4), (8, [8.0] * 4), (9, [7.0] * 4), (9, [7.5] * 4)]
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    for k in (1, 2, 20):
        assert sorted(map(tuple, top_k(docs, "vec_id % 20 = 0", k=k).collect())) == brute(rows, k)
    few = spark.createDataFrame(
        [(20, [3.0], "", ""), (20, [2.0], "", ""), (20, [1.0], "", ""), (1, [1.0], "", ""), (2, [0.5], "", ""),
         (3, [0.25], "", "")], SCHEMA)
    got = top_k(few, "vec_id % 20 = 0", k=2)
    assert sorted(r["vec_id"] for r in got.collect()) == [1, 1, 1, 2, 2, 2]


@pytest.mark.parametrize("n, k, spread", [(1, 3, 1.0), (500, 5, 1.0), (3000, 3, 4.0), (3000, 21, 0.0)])
def test_threshold_search(n, k, spread):
    rng = np.random.default_rng(n + k)
    x = np.floor(64 * rng.normal(size=(n, 8)) * np.exp(spread * rng.normal(size=(n, 1))))
    ids = rng.permutation(n)
    order = np.argsort(-x, axis=0, kind="stable")
    descending = np.take_along_axis(x, order, axis=0)
    for query in np.floor(64 * rng.normal(size=(20, 8))):
        rows, scores = threshold_search(x, ids, query, k, order, descending)
        want = np.lexsort((ids, -(x @ query)))[:k]
        assert rows.tolist() == want.tolist() and (scores == (x @ query)[want]).all()
