"""Near-deduplication against all pairs in memory."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from caseflow.llm import near_dedup as module
from caseflow.llm.components import components
from caseflow.llm.near_dedup import block_links, keep_first, may_link, near_dedup

SCHEMA = "doc_id long, text string, signature string, node string"


def brute(rows, width):
    sets, parent = [], {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [tuple(words[i:i + width]) for i in range(len(words) - width + 1)]
        sets.append(frozenset(runs if len(words) >= width else [tuple(words)] if words else []))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        shared = defaultdict(int)
        for s in own:
            for j in holders[s]:
                shared[j] += 1
            holders[s].append(i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[root(i)].append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [d for d in groups[root(i)] if d is not None] if sets[i] else [doc_id]
        least = min(ids, default=None)
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(4)


def words(rng, n):
    return [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 400)) for _ in range(n)]


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        text[rng.randrange(len(text))] = "edit" + str(rng.randint(0, 10 ** 9))
    return text


def test_edges_and_groups(spark):
    rng = random.Random(5)
    rows = [(0, None), (1, ""), (2, " \t"), (3, "one"), (4, "ONE"), (5, "one two three"), (6, "One Two three"),
            (None, "one"), (None, "null id"), (3, "a b c d e"), (7, "a b c d e"), (8, "Ä b c d e"), (9, "ä b c d e"),
            (10, "x " * 4000), (11, "x\n" * 5000)]
    at = 100
    shared = words(rng, 60)
    for group in range(30):
        base = words(rng, rng.randint(8, 150))
        for copy in range(rng.randint(1, 9)):
            rows.append((at, " ".join(edited(rng, base, rng.randint(0, 1 + len(base) // 40)))))
            at += 1
        # A passage that many documents share links nothing by itself.
        rows.append((at, " ".join(shared + words(rng, 200))))
        at += 1
    for width in (4, 5):
        got = near_dedup(frame(spark, rows), width=width).collect()
        assert sorted(map(tuple, got), key=repr) == brute(rows, width)


def test_chain_of_copies(spark):
    # Neighbours are near copies, the ends share nothing: the links must not depend on the pivots.
    rng = random.Random(6)
    text, rows = words(rng, 120), []
    for i in range(120):
        rows.append((i, " ".join(text)))
        text = text[2:] + words(rng, 2)
    got = near_dedup(frame(spark, rows), width=4).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 4)
    assert {r.component_id for r in got} == {0}


def test_keep_first_and_empty(spark):
    rows = [(1, "a b c d e f"), (2, "A B C D E F"), (3, "other text"), (4, None)]
    kept = keep_first(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "signature", "node"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]
    assert near_dedup(frame(spark, [])).collect() == []


@pytest.mark.parametrize("edges, want", [
    ([], {}),
    ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)}),
    ([(5, i) for i in range(6, 3000)] + [(1, 2)], {1: 1, 2: 1, **{i: 5 for i in range(5, 3000)}})])
def test_components(spark, edges, want):
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.label for r in got} == want and len(got) == len(want)


def test_large_group_of_edited_copies(spark):
    # Most pairs are near 0.65; some copies are linked only to other edited copies.
    rng = random.Random(7)
    base = words(rng, 120)
    rows = []
    for i in range(350):
        rows.append((i, " ".join(edited(rng, base, rng.randint(0, 6)))))
    for i in range(350, 380):
        far = edited(rng, base, 9)
        rows += [(2 * i, " ".join(far)), (2 * i + 1, " ".join(edited(rng, far, 1)))]
    got = near_dedup(frame(spark, rows), width=4).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 4)


def test_short_texts_that_share_a_shingle(spark, monkeypatch):
    # Five words that differ in the last: one shingle of two in common, so no links, but one group.
    blocks = []
    kept = module._remaining

    def seen(met, labels, sets, percent):
        blocks.append(may_link(sets.withColumn("label", sets["node"]), percent).count())
        return kept(met, labels, sets, percent)

    monkeypatch.setattr(module, "_remaining", seen)
    rows = [(i, f"all of these share w{i}") for i in range(3000)]
    # Longer ones with the same start, some of them linked.
    for i in range(40):
        same = [f"z{i}x{k}" for k in range(30)]
        rows.append((5000 + 2 * i, " ".join(["all of these share", *same])))
        rows.append((5001 + 2 * i, " ".join(["all of these share", *same[:-1], "end"])))
    got = near_dedup(frame(spark, rows), width=4).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 4)
    # The texts that cannot be linked meet nobody.
    assert blocks[0] <= 80


def test_block_of_many_rows_takes_bounded_memory():
    import tracemalloc

    def table(nodes):
        sets = [np.unique(np.array([7, 1000 + i], np.uint64)).tobytes() for i in nodes]
        return pa.table({"node": list(nodes), "label": list(nodes), "shingles": pa.array(sets, pa.binary())})

    tracemalloc.start()
    u, v = block_links(table(range(2000)), table(range(1990, 21990)), 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(u) == 0 and peak < 400 << 20


@pytest.mark.parametrize("cells", [1, 50, 1 << 22])
def test_links_of_a_block(monkeypatch, cells):
    monkeypatch.setattr(module, "CELLS", cells)
    rng = random.Random(8)
    sets = [np.array(sorted(rng.sample(range(12), rng.randint(1, 12))), np.uint64) for _ in range(60)]
    label = [i % 7 for i in range(60)]

    def table(nodes):
        return pa.table({"node": list(nodes), "label": [label[i] for i in nodes],
                         "shingles": pa.array([sets[i].tobytes() for i in nodes], pa.binary())})

    u, v = block_links(table(range(20)), table(range(60)), 80)
    want = {(i, label[j]) for i in range(20) for j in range(60) if label[i] != label[j]
            and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert sorted((int(i), label[j]) for i, j in zip(u, v)) == sorted(want)
