"""Exact top-k search by Fagin's threshold algorithm.

Vectors become integers, equal vectors one class (of which the k + 1 smallest ids can ever be asked for), and classes go to
blocks of bounded size. Each block of queries meets each block of candidates once. There every dimension is a sorted
list, read from the end that the sign of the query's component favours; vectors met in any list are scored in full, and
the reading stops when even a vector with the last component read in every list would score less than the
kth result. Where the lists would be read so deep that depth times dimensions reaches twice the block, the block is
scanned in full instead, which is exact too. The blocks' results are merged.

Defined cases: a null vector, or one with null, NaN or infinite components, takes no part, nor does a null id; vectors of
different lengths are not compared; equal scores go to the smaller id; repeated rows of an id and a vector are one; an id
with several vectors asks with each of them, none of its own rows answers it, and it answers others once for each; fewer candidates than k give fewer results; an empty table gives an empty result; other columns are not read.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from caseflow.llm.common import hot_keys, spread_join, store

BLOCK = 8192
QUERY_BLOCK = 1024
FIRST_DEPTH = 16


def integer_vectors(table: DataFrame, scale=64, vec_id="vec_id", embedding="embedding") -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component x, as double; distinct rows that take part."""
    x = table[embedding].cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return table.filter(table[vec_id].isNotNull() & x.isNotNull() & ~bad).select(
        table[vec_id].alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v")).distinct()


def threshold_search(vectors, ids, query, k, order, descending, skip=None):
    """The k best rows of ``vectors`` for one query, ties to smaller ids: (rows, scores).

    ``order`` holds the rows of each dimension by falling component, ``descending`` these components. Rows marked in
    ``skip`` take no part.
    """
    n = len(vectors)
    up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    depth = FIRST_DEPTH
    while True:
        depth = min(depth, n)
        if depth * (len(up) + len(down)) >= 2 * n or depth == n:
            rows, bound = np.arange(n), None
        else:
            met = np.zeros(n, bool)
            met[order[:depth, up]] = True
            met[order[n - depth:, down]] = True
            rows = np.flatnonzero(met)
            # No vector that has not been met can score more than this.
            bound = descending[depth - 1, up] @ query[up] + descending[n - depth, down] @ query[down]
        if skip is not None:
            rows = rows[~skip[rows]]
        scores = vectors[rows] @ query
        if len(rows) > k:
            least = np.partition(scores, len(rows) - k)[len(rows) - k]
            near = scores >= least
            rows_k, scores_k = rows[near], scores[near]
        else:
            least, rows_k, scores_k = None, rows, scores
        if bound is None or (least is not None and bound < least):
            best = np.lexsort((ids[rows_k], -scores_k))[:k]
            return rows_k[best], scores_k[best]
        depth *= 4


def top_k(table: DataFrame, queries, k=20, scale=64, vec_id="vec_id", embedding="embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row of the table that ``queries`` (a condition on
    vec_id) selects, the query's own row left out."""
    vectors = store(integer_vectors(table, scale, vec_id, embedding))
    smallest = Window.partitionBy("v").orderBy("vec_id")
    classes = store(
        vectors.withColumn("rank", F.row_number().over(smallest)).filter(F.col("rank") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("class", F.monotonically_increasing_id()))
    asked = vectors.filter(queries)
    # An id with several vectors asks for itself, with its own rows left out of the search: they could fill every place.
    several = store(asked.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    asked = store(spread_join(
        asked, several.select("vec_id", F.col("vec_id").cast("long").alias("own")), "vec_id",
        hot_keys(several, "vec_id", "n"), "left"))
    per_class = asked.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    asking = store(spread_join(
        asked, classes.select("v", "class"), "v", hot_keys(per_class, "v", "n")).select(
        "vec_id", "class", "own", F.concat_ws(":", "class", "own").alias("query")))
    asks = store(asking.groupBy("query", "class", "own").agg(F.count(F.lit(1)).alias("n")))
    per_asked = asks.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    query_classes = store(spread_join(
        asks, classes.select("class", "v"), "class", hot_keys(per_asked, "class", "n")).select("query", "own", "v"))

    blocks = max(1, math.ceil(classes.count() / BLOCK))
    query_blocks = max(1, math.ceil(query_classes.count() / QUERY_BLOCK))

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def block(key, n):
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    left = query_classes.select(
        "query", "own", "v", F.size("v").alias("dims"), block("query", query_blocks).alias("qb")).withColumn(
        "cb", every(blocks))
    right = classes.select(
        "class", F.col("ids")[0].alias("first"), F.get("ids", F.lit(1)).alias("second"), "v", F.size("v").alias("dims"),
        block("class", blocks).alias("cb")).withColumn("qb", every(query_blocks))

    def matrix(table, dims):
        return table.column("v").combine_chunks().flatten().to_numpy().reshape(table.num_rows, dims)

    def search(asked: pa.Table, block: pa.Table) -> pa.Table:
        found = {"query": [], "class": [], "first": [], "score": []}
        if asked.num_rows and block.num_rows:
            dims = asked.column("dims")[0].as_py()
            x, q = matrix(block, dims), matrix(asked, dims)
            classes, first = (block.column(name).to_numpy() for name in ("class", "first"))
            # Sums stay exact in doubles where they are this small.
            most = max(1, dims) * float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0))
            if most < 2 ** 53:
                x, q = x.astype(np.float64), q.astype(np.float64)
            order = np.argsort(-x, axis=0, kind="stable")
            descending = np.take_along_axis(x, order, axis=0)
            alone = block.column("second").is_null().to_numpy()
            second = block.column("second").fill_null(0).to_numpy()
            for number, (own, query) in enumerate(zip(asked.column("own").to_pylist(), q)):
                ids, skip = first, None
                if own is not None:
                    # A class goes by its next id, or is left out if it has no other.
                    mine = first == own
                    ids, skip = np.where(mine, second, first), mine & alone
                rows, scores = threshold_search(x, ids, query, k + 1, order, descending, skip)
                found["query"].append(np.full(len(rows), number))
                found["class"].append(classes[rows])
                found["first"].append(ids[rows])
                found["score"].append(scores.astype(np.int64))
        columns = {
            name: pa.array(np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64))
            for name, parts in found.items()}
        numbers = columns.pop("query")
        return pa.table({
            "query": asked.column("query").take(numbers), "own": asked.column("own").take(numbers), **columns})

    keys = ["dims", "cb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        search, "query string, own long, class long, first long, score long")
    # The k + 1 best rows are among the k + 1 best classes.
    best_classes = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    kept = found.withColumn("rank", F.row_number().over(best_classes)).filter(F.col("rank") <= k + 1)
    often = store(kept.select("query", "own", "class", "score"))
    uses = often.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    rows = spread_join(often, classes.select("class", "ids"), "class", hot_keys(uses, "class", "n")).select(
        "query", "own", "score", F.explode("ids").alias("vec_id")).filter("own IS NULL OR vec_id <> own")
    best_rows = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    results = (
        rows.withColumn("rank", F.row_number().over(best_rows)).filter(F.col("rank") <= k + 1)
        .groupBy("query").agg(
            F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best")))
    others = F.slice(F.filter("best", lambda r: r["vec_id"] != F.col("query_id")), 1, k)
    return (
        spread_join(asking.select("query", "vec_id"), results, "query", hot_keys(asks, "query", "n"))
        .withColumnRenamed("vec_id", "query_id").select("query_id", F.posexplode(others).alias("at", "one"))
        .select("query_id", (F.col("at") + 1).alias("rank"), "one.vec_id", "one.score"))
