"""Hard negatives against full scans."""

import math
import random

import numpy as np
import pytest

from caseflow.llm import hard_negatives as hn
from caseflow.llm.hard_negatives import Search, far_apart, grow, hard_negatives, split_rows

SCHEMA = "vec_id long, label int, embedding array<float>, dims string, rank string"


def brute(rows, positives=5, negatives=3):
    vectors = sorted({(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in e)) for i, label, e in rows
                      if i is not None and label is not None and e is not None
                      and all(x is not None and math.isfinite(x) for x in e)})
    out = []
    for i, label, q in vectors:
        if i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j, other == label)
                        for j, other, v in vectors if j != i and len(v) == len(q))
        for p, positive, _ in [s for s in scored if s[2]][:positives]:
            fits = [(-n, j) for n, j, same in scored if not same and 50 * -p <= 100 * -n <= 95 * -p]
            out += [(i, positive, rank + 1, j, -p, n) for rank, (n, j) in enumerate(fits[:negatives])]
    return sorted(out)


def rows_of(seed, n, dims, spread, ids=range(0, 10 ** 9, 5)):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    x = centres[rng.integers(0, 12, n)] * (1 - spread) + rng.normal(size=(n, dims)) * spread
    return [(int(i), int(rng.integers(0, 4)), [float(c) for c in v]) for i, v in zip(ids, x)]


EDGE = [(50_001, None, [1.0] * 6), (50_050, 1, None), (50_100, 1, [None] * 6), (50_150, 1, [float("nan")] * 6),
        (50_200, 1, [float("inf")] * 6), (None, 1, [1.0] * 6), (50_250, 1, [0.0] * 6), (50_300, 1, [1.0, 2.0]),
        (50_301, 1, [2.0, 1.0]), (50_302, 2, [1.0, 1.5]), (50_350, 1, []), (50_351, 2, []), (50_401, 3, [-1.0] * 6)]


@pytest.mark.parametrize("splits, block, spread", [(32, 8192, 0.5), (4, 50, 0.1), (1, 30, 1.0), (7, 100, 0.02)])
def test_table(spark, monkeypatch, splits, block, spread):
    monkeypatch.setattr(hn, "LEAF", 16)
    monkeypatch.setattr(hn, "ASK_BLOCK", 7)
    rows = rows_of(splits, 900, 6, spread)
    # One vector under many ids, an id with several vectors and labels, and repeated rows.
    rows += [(10_000 + i, i % 3, rows[10][2]) for i in range(120)]
    rows += [(rows[20][0], 1, rows[30][2]), (rows[20][0], 2, rows[31][2]), rows[40], rows[40], *EDGE]
    random.Random(1).shuffle(rows)
    table = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    got = sorted(map(tuple, hard_negatives(table, "vec_id % 50 = 0", splits=splits, block=block).collect()))
    assert got == brute(rows) and got


def test_without_rows_or_anchors(spark):
    table = spark.createDataFrame([(1, 1, [1.0], "", ""), (2, 2, [1.0], "", "")], SCHEMA)
    assert hard_negatives(table, "vec_id % 50 = 0").collect() == []
    assert hard_negatives(table.limit(0), "vec_id % 50 = 0").collect() == []
    assert hard_negatives(table.filter("vec_id = 1"), "vec_id = 1").collect() == []


def scan(x, ids, labels, q, q_id, q_label, low, high, n, same):
    s = x @ q
    fits = ((labels == q_label) == same) & (ids != q_id) & (s >= low) & (s <= high)
    rows = np.flatnonzero(fits)
    best = np.lexsort((ids[rows], -s[rows]))[:n]
    return [(int(ids[r]), int(s[r])) for r in rows[best]]


@pytest.mark.parametrize("n, dims, spread", [(1, 3, 1.0), (700, 2, 0.3), (3000, 3, 0.02), (3000, 12, 0.5), (2000, 4, 0.0)])
def test_search_in_a_block(monkeypatch, n, dims, spread):
    monkeypatch.setattr(hn, "LEAF", 32)
    rows = rows_of(n + dims, n, dims, spread)
    x = np.floor(256 * np.array([r[2] for r in rows]))
    ids, labels = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    q = x[::97][:20]
    scores = q @ x.T
    low = np.stack([np.full(len(q), -np.inf), np.quantile(scores, 0.6, 1), np.full(len(q), np.inf)], 1)
    high = np.stack([np.full(len(q), np.inf), np.quantile(scores, 0.9, 1), np.full(len(q), -np.inf)], 1)
    for same in (True, False):
        done = Search(x, ids, labels, q, ids[::97][:20], labels[::97][:20], low, high, 4, same).run()
        found = {}
        for query, window, row, score in zip(*(part.tolist() for part in done.results())):
            found.setdefault((query, window), []).append((int(ids[row]), score))
        for query in range(len(q)):
            for window in range(3):
                want = scan(x, ids, labels, q[query], ids[::97][query], labels[::97][query],
                            low[query, window], high[query, window], 4, same)
                assert sorted(found.get((query, window), [])) == sorted(want)
    if spread == 0.02:
        # Clustered vectors: whole subtrees are left out.
        assert done.scored < 0.8 * n * len(q)


def test_tree_holds_every_row_once(monkeypatch):
    monkeypatch.setattr(hn, "LEAF", 10)
    x = np.floor(10 * np.random.default_rng(3).normal(size=(2000, 3)))
    x[500:900] = x[500]

    def rows(node):
        return np.concatenate([rows(child) for child in node[1]]) if isinstance(node, tuple) else node

    assert sorted(rows(grow(x, np.arange(2000))).tolist()) == list(range(2000))
    points = x[far_apart(x, 9)]
    of, split = split_rows(x, points)
    to = np.sqrt(((x[:, None] - points[None]) ** 2).sum(2))
    for child in range(9):
        assert (split.low[:, child] <= to[of == child].min(0) + 1e-6).all()
        assert (split.high[:, child] >= to[of == child].max(0) - 1e-6).all()
