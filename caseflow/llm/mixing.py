"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). Token capacity flows from the
patterns to the quotas of their sources; each further copy of a pattern costs more than the one before, so nothing is
repeated while unused text can fill the quota. The flow gives each pattern an amount: whole copies of all its documents,
and for the rest documents in a seeded order up to the amount, where the last ones are chosen to come near it.

Only patterns and sources pass through the driver, never documents: one row per pattern.

Defined cases: size counts runs of characters other than ASCII white space, 0 for a null text; a null source is a source
of its own, the last one; a document without sources is taken as belonging to the null source; documents of size 0 take
nothing; rows equal in id and text are decided alike; a repeated id is decided per text; an empty table gives an empty
result; other columns are carried, never read.
"""

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from caseflow.llm.common import BROADCAST_IDS, store

WORD = r"[^\x20\x09-\x0D]+"
SEED = 42
# The seeded order is refined by this many bits at a time, until few documents are left to choose from.
LEVEL_BITS = 10
ORDER_BITS = 60
NEAR = 500
SWAPS = 4


@dataclass
class Mix:
    """``documents``: the rows with size, copies and taken; ``sources``: {source: (size, target)}."""
    documents: DataFrame
    sources: dict


def in_order(sources):
    """By code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def weighted_targets(sizes, weights, share, limit):
    """Targets of the sources: ``share`` of all sizes by weight; what is above ``limit`` times a size is shared again."""
    names = in_order(sizes)
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), list(names), {}
    while open_:
        total = sum(weight[n] for n in open_)
        over = [n for n in open_ if left * weight[n] > limit * sizes[n] * total]
        if not over:
            target.update({n: left * weight[n] / total for n in open_})
            break
        for n in over:
            target[n] = float(limit * sizes[n])
        left -= sum(limit * sizes[n] for n in over)
        open_ = [n for n in open_ if n not in target]
    return target


def route(capacity, members, quota, limit):
    """Words each pattern gives: the cheapest flow that fills the quotas as far as it can.

    ``capacity`` and ``members`` by pattern, ``quota`` by source; copy c of a pattern costs c a word, from 0.
    """
    graph, edges = {}, []

    def edge(a, b, room, cost):
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            graph.setdefault(x, []).append(len(edges))
            edges.append([y, r, c])

    for p, words in capacity.items():
        for copy in range(limit):
            edge("from", ("p", p), words, copy)
        for s in members[p]:
            edge(("p", p), ("s", s), limit * words, 0)
    for s, words in quota.items():
        edge(("s", s), "to", words, 0)
    height = dict.fromkeys([*graph, "from", "to"], 0)
    while True:
        far, came, heap, tie = {"from": 0}, {}, [(0, 0, "from")], 0
        while heap:
            d, _, node = heapq.heappop(heap)
            if d > far[node]:
                continue
            for e in graph.get(node, ()):
                to, room, cost = edges[e]
                if room > 0 and d + cost + height[node] - height[to] < far.get(to, float("inf")):
                    far[to] = d + cost + height[node] - height[to]
                    came[to] = e
                    tie += 1
                    heapq.heappush(heap, (far[to], tie, to))
        if "to" not in far:
            break
        for node, d in far.items():
            height[node] += d
        path, node = [], "to"
        while node != "from":
            path.append(came[node])
            node = edges[came[node] ^ 1][0]
        push = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= push
            edges[e ^ 1][1] += push
    given = dict.fromkeys(capacity, 0)
    for e in graph.get("from", ()):
        if e % 2 == 0:
            given[edges[e][0][1]] += edges[e ^ 1][1]
    return given


def _small(spark, rows, **types):
    """A table of one row per pattern. It goes as Arrow, since Python workers, which stay, would read a list of rows."""
    columns = zip(*rows) if rows else [()] * len(types)
    table = spark.createDataFrame(pa.table({name: pa.array(c, types[name]) for name, c in zip(types, columns)}))
    return F.broadcast(table) if len(rows) <= BROADCAST_IDS else table


def _edges(units, need):
    """Where each pattern's seeded order is cut: {pattern: (first value not taken, words still needed)}.

    One aggregation per level; each level looks only at the documents of the part in which the amount is reached.
    """
    spark, found = units.sparkSession, {}
    state = {p: (0, words) for p, words in need.items()}
    for bits in range(ORDER_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        if not state:
            break
        table = _small(spark, [(p, low, words) for p, (low, words) in state.items()],
                       pattern=pa.int64(), low=pa.int64(), need=pa.int64())
        inside = units.join(table, "pattern").filter(
            F.shiftright(F.col("place") - F.col("low"), bits + LEVEL_BITS) == 0).filter("place >= low")
        part = F.shiftright(F.col("place") - F.col("low"), bits)
        sums = inside.groupBy("pattern", "low", "need", part.alias("part")).agg(
            F.sum("words").alias("words"), F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy("pattern").orderBy("part")
        reached = sums.withColumn("upto", F.sum("words").over(upto)).filter("upto > need")
        first = reached.withColumn("first", F.row_number().over(upto)).filter("first = 1").collect()
        # A pattern that never gets beyond its amount is taken whole.
        for p in set(state) - {r["pattern"] for r in first}:
            found[p] = (state[p][0] + (1 << bits + LEVEL_BITS), 0)
        state = {
            r["pattern"]: (r["low"] + (r["part"] << bits), r["need"] - (r["upto"] - r["words"])) for r in first}
        for r in first:
            if r["n"] <= NEAR or bits == 0:
                found[r["pattern"]] = state.pop(r["pattern"])
    return found


def _near(rows: pd.DataFrame) -> pd.DataFrame:
    """Of a pattern's next documents in seeded order those that bring the amount nearest.

    In order as far as they fit, then at most SWAPS exchanges of a chosen document, or none, for one left over.
    """
    rows = rows.sort_values("place")
    words, left = rows["words"].to_numpy(), int(rows["need"].iloc[0])
    chosen = np.zeros(len(words), bool)
    for i, n in enumerate(words.tolist()):
        if n <= left:
            chosen[i] = True
            left -= n
    for _ in range(SWAPS):
        give, take = np.r_[-1, np.flatnonzero(chosen)], np.r_[-1, np.flatnonzero(~chosen)]
        change = np.where(take < 0, 0, words[take])[None, :] - np.where(give < 0, 0, words[give])[:, None]
        i, j = np.unravel_index(np.abs(left - change).argmin(), change.shape)
        if abs(left - change[i, j]) >= abs(left):
            break
        left -= change[i, j]
        chosen[give[i:i + 1][give[i:i + 1] >= 0]] = False
        chosen[take[j:j + 1][take[j:j + 1] >= 0]] = True
    places = rows["place"].to_numpy()[chosen]
    return pd.DataFrame({"pattern": [rows["pattern"].iloc[0]] * len(places), "place": places, "more": 1}).astype("int64")


def mix(docs: DataFrame, weights=(3, 1, 2), share=1.5, limit=2, targets=None, seed=SEED,
        doc_id="doc_id", text="text", source="source") -> Mix:
    """Mix documents to targets per source: those given in ``targets`` (words), else by weight.

    ``source`` is a column of one source or of an array of sources. The documents come as (doc, size, pattern, copies,
    taken), ``doc`` being the whole input row; a document is taken ``copies`` times, 0 to ``limit``.
    """
    spark = docs.sparkSession
    one = docs[source].cast("array<string>" if docs.schema[source].dataType.typeName() == "array" else "string")
    if docs.schema[source].dataType.typeName() == "array":
        none = F.array(F.lit(None).cast("string"))
        one = F.when(F.size(F.coalesce(one, none)) == 0, none).otherwise(F.coalesce(one, none))
        members = F.array_sort(F.array_distinct(one))
    else:
        members = F.array(one)
    base = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("doc"), members.alias("members"),
        F.coalesce(F.regexp_count(docs[text], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), docs[doc_id], docs[text]), 64 - ORDER_BITS).alias("place"))
    narrow = store(base.select("members", "size", "place"))
    # One row per pattern and per source.
    found = narrow.groupBy("members").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    found = sorted(
        ((tuple(r["members"]), r["size"], r["n"]) for r in found), key=lambda p: [(m is None, m or "") for m in p[0]])
    patterns = [(names, size) for names, size, _ in found]
    sizes = {}
    for names, size in patterns:
        for name in names:
            sizes[name] = sizes.get(name, 0) + size
    targets = targets or weighted_targets(sizes, weights, share, limit)
    given = route(
        {i: size for i, (_, size) in enumerate(patterns)}, {i: names for i, (names, _) in enumerate(patterns)},
        {name: round(targets.get(name, 0)) for name in sizes}, limit)
    whole = {i: given[i] // size if size else 0 for i, (_, size) in enumerate(patterns)}
    need = {i: given[i] - whole[i] * size for i, (_, size) in enumerate(patterns)}

    numbers = _small(spark, [(list(names), i) for i, (names, _) in enumerate(patterns)],
                     members=pa.list_(pa.string()), pattern=pa.int64())
    same = F.col("a.members").eqNullSafe(F.col("b.members"))

    def numbered(rows):
        return rows.alias("a").join(numbers.alias("b"), same).select("a.*", "b.pattern").drop("members")

    units = store(numbered(narrow).filter("size > 0").groupBy("pattern", "place").agg(F.sum("size").alias("words")))
    # Of few documents all are chosen from.
    edges = {i: (0, need[i]) for i, (_, _, n) in enumerate(found) if n <= NEAR}
    edges |= _edges(units, {i: words for i, words in need.items() if words > 0 and i not in edges})
    cuts = _small(spark, [
        (i, whole[i], *edges.get(i, (0, 0))) for i in range(len(patterns))],
        pattern=pa.int64(), whole=pa.int64(), edge=pa.int64(), need=pa.int64())
    next_ones = Window.partitionBy("pattern").orderBy("place")
    near = (
        units.join(cuts, "pattern").filter("need > 0 AND place >= edge")
        .withColumn("rank", F.row_number().over(next_ones)).filter(F.col("rank") <= 2 * NEAR)
        .select("pattern", "place", "words", "need")
        .groupBy("pattern").applyInPandas(_near, "pattern long, place long, more long"))
    near = store(near)
    more = F.broadcast(near) if near.count() <= BROADCAST_IDS else near
    copies = F.col("whole") + (F.col("place") < F.col("edge")).cast("long") + F.coalesce("more", F.lit(0))
    documents = (
        numbered(base).join(cuts, "pattern").join(more, ["pattern", "place"], "left")
        .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0))
        .select("doc", "size", "pattern", "copies", (F.col("size") * F.col("copies")).alias("taken")))
    return Mix(documents, {name: (sizes[name], float(targets.get(name, 0))) for name in sizes})


def mixed_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents, all columns, each as often as the mix takes it."""
    taken = mix(docs, **options).documents.filter("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")


def mix_report(docs: DataFrame, source="source", doc_id="doc_id", **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken; for documents of one source each."""
    mixed = mix(docs, source=source, doc_id=doc_id, **options)
    sources = _small(docs.sparkSession, [(name, *of) for name, of in mixed.sources.items()],
                     source=pa.string(), source_size=pa.int64(), target=pa.float64())
    rows = mixed.documents.select(
        F.col("doc")[doc_id].alias("doc_id"), F.col("doc")[source].cast("string").alias("of"), "size", "taken")
    return rows.join(sources, F.col("of").eqNullSafe(F.col("source"))).select(
        "doc_id", "size", "source_size", "target", "taken")
