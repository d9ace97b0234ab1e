"""Hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

Vectors become integers. Split points, far apart within a bounded sample, divide all vectors: each goes to its nearest split
point. For every split point and every subtree the least and largest distance between them is kept, and the norms of each
subtree. A window of scores around an anchor is an annulus of distances, since the squared distance of x and q is
x.x + q.q - 2 x.q. By the triangle inequality what lies in the annulus has distances to a split point within a range; a
subtree whose range does not meet it is eliminated. Subtrees are dealt to blocks of bounded size, and each block is such
a tree again within its task, down to leaves that are scored in full. An anchor first visits the subtree it belongs to; what it
finds there narrows its window for the others.

Positives of an anchor are its best rows of the same label, negatives of a positive the best rows of other labels whose score
is between two shares of the positive's score.

Defined cases: rows with a null id, label or vector, or with null, NaN or infinite components, take no part; vectors of
different lengths are not compared; rows with the anchor's id are neither its positives nor its negatives; equal scores go to
the smaller id; rows equal in id, label and vector are one; an id with several vectors or labels has a row for each;
fewer rows than asked for give fewer results; a positive without negatives gives none; a positive's score of 0 wants
negatives of score 0 and one below 0 has none; an empty table gives an empty result; other columns are not read.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from caseflow.llm.common import store

# Rows that split points are chosen from.
SAMPLE = 2048
SPLITS = 32
BLOCK = 8192
ASK_BLOCK = 512
BLOCK_SPLITS = 16
LEAF = 256
# Distances come from exact integers; roots are off by less.
NEARLY = 1e-9
NONE = -(1 << 62)


def labelled_vectors(table: DataFrame, scale=256, vec_id="vec_id", label="label", embedding="embedding") -> DataFrame:
    """(vec_id, label, v, dims): floor(scale * x) of each component x, as double; distinct rows that take part."""
    x = table[embedding].cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return table.filter(table[vec_id].isNotNull() & table[label].isNotNull() & x.isNotNull() & ~bad).select(
        table[vec_id].alias("vec_id"), table[label].alias("label"),
        F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"), F.size(x).alias("dims")).distinct()


def matrix(column, rows, dims):
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows, dims).astype(np.float64)


def distances(x, points):
    squared = (x * x).sum(1)[:, None] + (points * points).sum(1)[None] - 2 * (x @ points.T)
    return np.sqrt(np.maximum(squared, 0))


def far_apart(x, count):
    """Rows of ``x``, each as far as can be from those before it; equal vectors once."""
    chosen = [0]
    least = distances(x, x[:1])[:, 0]
    while len(chosen) < min(count, len(x)):
        chosen.append(int(least.argmax()))
        if least[chosen[-1]] == 0:
            return chosen[:-1]
        least = np.minimum(least, distances(x, x[chosen[-1:]])[:, 0])
    return chosen


class Split:
    """Split points with the ranges of distances from each point (rows) to the members of each subtree (columns)."""

    def __init__(self, points, low, high, least, most):
        self.points, self.low, self.high, self.least, self.most = points, low, high, least, most

    def bounds(self, q):
        """Per query: its squared norm, and per subtree the largest lower and the least upper bound of distances into it."""
        to = distances(q, self.points)[:, :, None]
        return (q * q).sum(1), np.maximum((to - self.high).max(1), (self.low - to).max(1)), (to + self.high).min(1)

    def survivors(self, bounds, window_low, window_high, child=slice(None)):
        """(queries, subtrees): whether a subtree may hold scores in one of the query's windows (queries, windows)."""
        own, below, above = bounds[0][:, None, None], bounds[1][:, None, child], bounds[2][:, None, child]
        far = own + self.most[child] - 2 * window_low[:, :, None]
        near = own + self.least[child] - 2 * window_high[:, :, None]
        possible = (far >= -NEARLY * (own + self.most[child])) & (window_low <= window_high)[:, :, None]
        far = np.sqrt(np.maximum(far, 0)) * (1 + NEARLY) + NEARLY
        near = np.sqrt(np.maximum(near, 0)) * (1 - NEARLY) - NEARLY
        return (possible & (below <= far) & (above >= near)).any(1)


def split_rows(x, points):
    """(subtree of each row, Split)."""
    to = distances(x, points)
    of = to.argmin(1)
    k, norms = len(points), (x * x).sum(1)
    low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
    least, most = np.full(k, np.inf), np.full(k, -np.inf)
    for child in range(k):
        inside = of == child
        if inside.any():
            low[:, child], high[:, child] = to[inside].min(0), to[inside].max(0)
            least[child], most[child] = norms[inside].min(), norms[inside].max()
    return of, Split(points, low, high, least, most)


def grow(x, rows):
    """The tree of the given rows: an array of rows (a leaf), or (Split, subtrees)."""
    if len(rows) <= LEAF:
        return rows
    some = rows[np.linspace(0, len(rows) - 1, 8 * BLOCK_SPLITS).astype(np.int64)]
    points = x[some][far_apart(x[some], BLOCK_SPLITS)]
    of, split = split_rows(x[rows], points)
    if np.bincount(of).max() == len(rows):
        return rows
    return split, [grow(x, rows[of == child]) for child in range(len(points))]


class Search:
    """The best rows of a block in each window of each query.

    Rows of the block are in the order of their ids, so a score and a row make one number that orders by score, then id.
    """

    def __init__(self, x, ids, labels, q, q_ids, q_labels, low, high, n, same_label):
        self.x, self.ids, self.labels, self.n, self.same_label = x, ids, labels, n, same_label
        self.q, self.q_ids, self.q_labels, self.low, self.high = q, q_ids, q_labels, low, high
        self.bits = max(1, (len(x) - 1).bit_length())
        self.best = np.full((*low.shape, n), NONE, np.int64)
        self.scored = 0

    def run(self):
        self.visit(grow(self.x, np.arange(len(self.x))), np.arange(len(self.q)))
        return self

    def narrowed(self, some):
        last = self.best[some, :, 0]
        return np.where(last == NONE, self.low[some], np.maximum(self.low[some], last >> self.bits))

    def visit(self, node, some):
        if not len(some):
            return
        if isinstance(node, tuple):
            split, children = node
            bounds = split.bounds(self.q[some])
            # Subtrees that are near to most queries come first.
            for child in np.argsort(bounds[1].sum(0), kind="stable").tolist():
                if len(children[child]):
                    alive = split.survivors(bounds, self.narrowed(some), self.high[some], slice(child, child + 1))
                    self.visit(children[child], some[alive[:, 0]])
            return
        self.scored += len(node) * len(some)
        scores = (self.q[some] @ self.x[node].T).astype(np.int64)
        fits = (self.labels[node][None] == self.q_labels[some][:, None]) == self.same_label
        fits &= self.ids[node][None] != self.q_ids[some][:, None]
        keys = (scores << self.bits) + ((1 << self.bits) - 1 - node)
        for window in range(self.low.shape[1]):
            inside = fits & (scores >= self.low[some, window][:, None]) & (scores <= self.high[some, window][:, None])
            both = np.concatenate([self.best[some, window], np.where(inside, keys, NONE)], axis=1)
            at = both.shape[1] - self.n
            self.best[some, window] = np.sort(np.partition(both, range(at, both.shape[1]), axis=1)[:, at:], axis=1)

    def results(self):
        """(query, window, row, score) of what was found."""
        query, window, place = np.nonzero(self.best != NONE)
        keys = self.best[query, window, place]
        return query, window, (1 << self.bits) - 1 - (keys & ((1 << self.bits) - 1)), keys >> self.bits


class Index:
    """All vectors with their subtree and block, and the ranges at the top of the tree."""

    def __init__(self, vectors: DataFrame, splits=SPLITS, block=BLOCK):
        self.block = block
        # The tree divides the vectors of the most frequent length; others are one subtree, -1.
        common = vectors.groupBy("dims").count().orderBy(F.desc("count"), "dims").first()
        self.dims = common["dims"] if common else 0
        sample = vectors.filter(F.col("dims") == self.dims).select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toArrow()
        if self.dims:
            points = matrix(sample.column("v"), sample.num_rows, self.dims)
            points = points[far_apart(points, splits)]
        else:
            points = np.zeros((0, 0))
        dims, k = self.dims, len(points)

        def divide(batches):
            for batch in batches:
                leaf = np.full(batch.num_rows, -1, np.int32)
                mine = np.flatnonzero(batch.column("dims").to_numpy() == dims) if k else np.empty(0, np.int64)
                if len(mine):
                    x = matrix(pa.chunked_array([batch.column("v").take(pa.array(mine))]), len(mine), dims)
                    leaf[mine] = distances(x, points).argmin(1)
                yield batch.append_column("leaf", pa.array(leaf))

        def ranges(batches):
            kept = {}
            for batch in batches:
                leaf = batch.column("leaf").to_numpy()
                other = int((leaf < 0).sum())
                if other:
                    kept[-1, 0] = (0.0, 0.0, 0.0, 0.0, kept.get((-1, 0), (0,) * 5)[4] + other)
                mine = np.flatnonzero(leaf >= 0)
                if not len(mine):
                    continue
                x = matrix(pa.chunked_array([batch.column("v").take(pa.array(mine))]), len(mine), dims)
                of, split = split_rows(x, points)
                count = np.bincount(of, minlength=k)
                for child in np.flatnonzero(count).tolist():
                    for point in range(k):
                        new = (split.low[point, child], split.high[point, child], split.least[child], split.most[child])
                        old = kept.get((child, point), (*new, 0))
                        kept[child, point] = (
                            min(old[0], new[0]), max(old[1], new[1]), min(old[2], new[2]), max(old[3], new[3]),
                            old[4] + int(count[child]))
            names = ["leaf", "point", "low", "high", "least", "most", "n"]
            rows = [(*key, *value) for key, value in kept.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(
                    [pa.int32(), pa.int32(), *[pa.float64()] * 4, pa.int64()])], names)

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields)
        self.rows = store(vectors.mapInArrow(divide, f"{kinds}, leaf int"))
        # At most (splits + 1) * splits rows.
        found = self.rows.select("v", "leaf").mapInArrow(
            ranges, "leaf int, point int, low double, high double, least double, most double, n long"
        ).groupBy("leaf", "point").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.min("least").alias("least"),
            F.max("most").alias("most"), F.sum("n").alias("n")).collect()
        low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        least, most = np.full(k, np.inf), np.full(k, -np.inf)
        self.blocks = {}
        for row in found:
            self.blocks[row["leaf"]] = math.ceil(row["n"] / block)
            if row["leaf"] >= 0:
                low[row["point"], row["leaf"]], high[row["point"], row["leaf"]] = row["low"], row["high"]
                least[row["leaf"]], most[row["leaf"]] = row["least"], row["most"]
        self.split = Split(points, low, high, least, most)

    def blocks_of(self, leaf):
        counts = F.create_map(*(F.lit(x) for pair in sorted(self.blocks.items()) for x in pair)) if self.blocks else F.lit(None)
        return counts[leaf] if self.blocks else F.lit(1)

    def route(self, asks: DataFrame, home: bool) -> DataFrame:
        """A row for each subtree an ask has to visit: its own (``home``), or the others that survive."""
        split, dims, present = self.split, self.dims, np.array(sorted(b for b in self.blocks if b >= 0), np.int64)

        def visit(batches):
            for batch in batches:
                own = batch.column("leaf").to_numpy()
                if home:
                    row, leaf = np.arange(batch.num_rows), own
                else:
                    mine = np.flatnonzero(own >= 0)
                    row, leaf = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
                    for start in range(0, len(mine), 256):
                        some = mine[start:start + 256]
                        part = batch.take(pa.array(some))
                        q, low, high = (
                            matrix(pa.chunked_array([part.column(name)]), len(some), width)
                            for name, width in (("v", dims), ("low", -1), ("high", -1)))
                        alive = split.survivors(split.bounds(q), low, high)[:, present]
                        alive &= present[None] != own[some][:, None]
                        found, at = np.nonzero(alive)
                        row.append(some[found])
                        leaf.append(present[at])
                    row, leaf = np.concatenate(row), np.concatenate(leaf)
                yield batch.take(pa.array(row)).append_column("to", pa.array(leaf.astype(np.int32)))

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asks.schema.fields)
        routed = asks.mapInArrow(visit, f"{kinds}, to int").drop("leaf").withColumnRenamed("to", "leaf")
        return routed.withColumn("block", F.explode(F.sequence(F.lit(0), self.blocks_of(F.col("leaf")).cast("int") - 1)))

    def search(self, asks: DataFrame, home: bool, n, same_label) -> DataFrame:
        """(ask, window, vec_id, score): the best rows of each block that an ask visits."""
        routed = store(self.route(asks, home))
        keys = ["dims", "leaf", "block", "ask_block"]
        wanted = routed.select("dims", "leaf", "block", F.col("ask_block").alias("asked_by")).distinct()
        rows = self.rows.withColumn(
            "block", F.pmod(F.xxhash64("vec_id", "label", "v"), self.blocks_of(F.col("leaf"))).cast("int")
        ).join(wanted, keys[:3]).withColumnRenamed("asked_by", "ask_block")

        def look(asked: pa.Table, block: pa.Table) -> pa.Table:
            found = ([], [], [], [])
            if asked.num_rows and block.num_rows and asked.column("dims")[0].as_py():
                dims = asked.column("dims")[0].as_py()
                block = block.sort_by("vec_id")
                x, q = matrix(block.column("v"), block.num_rows, dims), matrix(asked.column("v"), asked.num_rows, dims)
                if dims * np.abs(x).max() * np.abs(q).max() * 2 * max(2, len(x)) >= 2 ** 62:
                    raise ValueError("components are too large for exact scores")
                low, high = (matrix(asked.column(name), asked.num_rows, -1) for name in ("low", "high"))
                ids = block.column("vec_id").to_numpy()
                label = block.column("label").combine_chunks()
                codes = pa.chunked_array([label, asked.column("label").combine_chunks()]).dictionary_encode()
                codes = np.concatenate([c.indices.to_numpy() for c in codes.chunks])
                done = Search(
                    x, ids, codes[:len(x)], q, asked.column("vec_id").to_numpy(), codes[len(x):], low, high, n, same_label).run()
                query, window, row, score = done.results()
                found = asked.column("ask").to_numpy()[query], window, ids[row], score
            return pa.table({name: pa.array(values, pa.int64()) for name, values in zip(
                ("ask", "window", "vec_id", "score"), found)})

        return routed.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(
            look, "ask long, window long, vec_id long, score long")

    def best(self, asks: DataFrame, n, same_label) -> DataFrame:
        """(ask, window, rank, vec_id, score): the ``n`` best rows in each window of each ask, over all subtrees.

        ``asks``: ask, vec_id, label, v, dims, leaf, ask_block and the ends ``low`` and ``high`` of the windows.
        """
        order = Window.partitionBy("ask", "window").orderBy(F.desc("score"), "vec_id")

        def ranked(found):
            return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)

        at_home = store(ranked(self.search(asks, True, n, same_label)))
        # A window that is full at home wants what scores no less than its last row there.
        last = at_home.filter(F.col("rank") == n).groupBy("ask").agg(
            F.map_from_entries(F.collect_list(F.struct("window", F.col("score").cast("double")))).alias("last"))
        narrowed = asks.join(last, "ask", "left").withColumn("low", F.transform("low", lambda low, i: F.greatest(
            low, F.coalesce(F.col("last")[i.cast("long")], low)))).drop("last")
        elsewhere = self.search(narrowed, False, n, same_label)
        return ranked(at_home.drop("rank").unionByName(elsewhere))


def hard_negatives(
        table: DataFrame, anchors, positives=5, negatives=3, at_least=50, at_most=95, scale=256, splits=SPLITS, block=BLOCK,
        vec_id="vec_id", label="label", embedding="embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors``: a condition on vec_id. A negative's score is at least ``at_least`` and at most ``at_most`` hundredths of
    the positive's.
    """
    index = Index(store(labelled_vectors(table, scale, vec_id, label, embedding)), splits, block)
    chosen = index.rows.filter(anchors)
    # At most splits + 1 rows. Anchors of a subtree ask together, since they visit the same ones, and small subtrees share.
    counts = {row["leaf"]: row["count"] for row in chosen.groupBy("leaf").count().collect()} or {-1: 1}
    first, many, before = [], [], 0
    for leaf, count in sorted(counts.items()):
        first += [F.lit(leaf), F.lit(before // ASK_BLOCK)]
        many += [F.lit(leaf), F.lit(math.ceil(count / ASK_BLOCK))]
        before += count
    place = F.pmod(F.xxhash64("vec_id", "label", "v"), F.create_map(*many)[F.col("leaf")])
    asks = store(chosen.select(
        F.monotonically_increasing_id().alias("ask"), "vec_id", "label", "v", "dims", "leaf",
        (F.create_map(*first)[F.col("leaf")] + place).alias("ask_block")))

    def windows(low, high):
        return asks.withColumns({"low": low, "high": high})

    endless = F.array(F.lit(float("-inf"))), F.array(F.lit(float("inf")))
    found = store(index.best(windows(*endless), positives, True).select(
        "ask", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    def share(part, more):
        part = F.lit(part).cast("long") * F.col("positive_score") + F.lit(more).cast("long")
        return ((part - F.pmod(part, F.lit(100).cast("long"))) / F.lit(100)).cast("double")

    shares = found.select("ask", "place", share(at_least, 99).alias("from"), share(at_most, 0).alias("to"))
    per_ask = shares.groupBy("ask").agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("place").cast("int"), F.struct("from", "to")))).alias("of"))
    # A place without a positive is a window that holds nothing.
    asked = asks.join(per_ask, "ask")
    places = F.sequence(F.lit(1), F.lit(positives))
    asked = asked.withColumns({
        "low": F.transform(places, lambda i: F.coalesce(F.col("of")[i]["from"], F.lit(float("inf")))),
        "high": F.transform(places, lambda i: F.coalesce(F.col("of")[i]["to"], F.lit(float("-inf"))))}).drop("of")
    worst = index.best(store(asked), negatives, False).select(
        "ask", (F.col("window") + 1).cast("int").alias("place"), F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (
        worst.join(found, ["ask", "place"]).join(asks.select("ask", F.col("vec_id").alias("anchor_id")), "ask")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
