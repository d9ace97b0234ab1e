"""MinHash near-deduplication by an inverted join over signature coordinates.

Documents become sets of word shingles, equal sets become one node, and each node posts its signature under
(coordinate, value). A pair that reaches the needed number of equal coordinates must meet in the rarest of either
node's postings, so only that prefix is posted, and a node that shares too few values with anyone posts nothing.

Within a posting list pairs are not all emitted. Each list has a pivot, the node with the most common values, which is
the nearest to what the list's documents are copies of. Every node meets the pivots of its lists; pairs that reach the
match threshold are confirmed on the full shingle sets, and confirmed links join components. Nodes that met one pivot
form a group, and two nodes that share a posting share a group. A group within one component is skipped. In the others
a node goes on only if one of its rarest shingles (so many that any link must share one) stands among those of a node of
another component. The nodes outside the largest component then meet the others that go on, block by block inside tasks,
and only links found leave them, so that no link between components is left out.
A pair of similarity 0.8 misses the match threshold with a probability below 1e-6.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing;
a text with fewer words than a shingle is one shingle; rows that repeat an id belong to the class of their text; the
least ``doc_id`` of a component names it, null ids never do unless there are no others; an empty table gives an empty
result; other columns are not read.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, Window

from caseflow.llm.common import BROADCAST_IDS, hot_keys, slices, spread_join, store, texts, with_ids, words_of
from caseflow.llm.components import components

COORDINATES = 40
# Shingles of the rows that meet in one task: on the side of all nodes, and of those outside the largest component.
BLOCK, STRAY_BLOCK = 200_000, 50_000
# The rows that meet in one task, on the same sides.
ROWS, STRAY_ROWS = 20_000, 5_000
# Pairs of equal shingles, and of rows, that are counted at once.
CELLS = 1 << 22
# Shingles known by how common they are, at most.
COMMON = 200_000
# Shingles whose coordinates are computed at once.
CHUNK = 1 << 15


def match_threshold(coordinates, percent):
    """Equal coordinates needed: 5.5 standard deviations below what the similarity makes likely."""
    t = percent / 100
    return max(1, int(coordinates * t - 5.5 * math.sqrt(coordinates * t * (1 - t))))


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(column: pa.Array, width):
    """The sorted distinct 64-bit shingles of each text, A-Z lower-cased."""
    import xxhash

    distinct, codes, rows = words_of(pc.ascii_lower(pc.fill_null(column, "")))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    words = hashes[codes]
    ends = np.searchsorted(rows, np.arange(len(column) + 1))
    odd = _mix(np.arange(1, width + 2, dtype=np.uint64)) | np.uint64(1)
    runs = max(0, len(words) - width + 1)
    total = np.zeros(runs, np.uint64)
    for i in range(width):
        total += words[i:i + runs] * odd[i]
    total = _mix(total)
    for start, end in zip(ends[:-1], ends[1:]):
        n = int(end - start)
        if n >= width:
            yield np.unique(total[start:end - width + 1])
        elif n:
            short = words[start:end] * odd[:n]
            yield _mix(np.array([np.add.reduce(short) + np.uint64(n) * odd[width]], np.uint64))
        else:
            yield np.empty(0, np.uint64)


def _signature(shingles, flips, factors):
    least = None
    for start in range(0, len(shingles), CHUNK):
        values = ((shingles[start:start + CHUNK, None] ^ flips) * factors) >> np.uint64(32)
        low = values.min(axis=0)
        least = low if least is None else np.minimum(least, low)
    return least.astype(np.uint32)


def signatures(docs: DataFrame, width, coordinates=COORDINATES) -> DataFrame:
    """Per document: doc_id, n_shingles, a 128-bit digest of its set, and its signature (null for empty sets)."""
    def sign(batches):
        import xxhash

        # Overflow is meant: arithmetic modulo 2**64.
        np.seterr(over="ignore")
        flips = _mix(np.arange(1, coordinates + 1, dtype=np.uint64) << np.uint64(20))
        factors = _mix(np.arange(1, coordinates + 1, dtype=np.uint64) << np.uint64(40)) | np.uint64(1)
        for batch in batches:
            for part in slices(batch):
                n, digests, signed = [], [], []
                for shingles in shingle_sets(part.column("text"), width):
                    n.append(len(shingles))
                    some = len(shingles) > 0
                    digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if some else None)
                    signed.append(_signature(shingles, flips, factors).tobytes() if some else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(signed, pa.binary())], ["doc_id", "n_shingles", "digest", "signature"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(sign, f"doc_id {kind}, n_shingles long, digest binary, signature binary")


def postings(nodes: DataFrame, coordinates=COORDINATES) -> DataFrame:
    """(token, node): every node under each of its (coordinate, value) pairs, packed into one number."""
    def post(batches):
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).astype(np.int64)
            tokens = (np.tile(np.arange(coordinates), n) << 32) | values
            node = np.repeat(batch.column("node").to_numpy(), coordinates)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(node)], ["token", "node"])

    return nodes.select("node", "signature").mapInArrow(post, "token long, node long")


def prefix_postings(posted: DataFrame, matches) -> DataFrame:
    """(token, node, score): of each node's postings the rarest that any pair with ``matches`` equal coordinates must
    meet in; the score says how common all its values are."""
    counts = store(posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    shared = spread_join(posted, counts, "token", hot_keys(counts, "token", "n"))
    of_node = Window.partitionBy("node")
    # Values that nobody shares are the rarest, so a node may leave out its ``matches`` - 1 most common shared ones.
    ranked = (
        shared.withColumn("shared", F.count(F.lit(1)).over(of_node))
        .withColumn("score", F.sum("n").over(of_node))
        .withColumn("rank", F.row_number().over(of_node.orderBy("n", "token"))))
    return ranked.filter(F.col("rank") <= F.col("shared") - (matches - 1)).select("token", "node", "score")


def _attach(pairs, table, key):
    """Join one side of the pairs; a node in very many pairs is spread over tasks."""
    degrees = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return spread_join(pairs, table, key, hot_keys(degrees, key, "n"))


def _matching(pairs, nodes, matches):
    """Pairs whose signatures agree in enough coordinates."""
    signed = nodes.select("node", "signature")
    u = signed.select(F.col("node").alias("u"), F.col("signature").alias("su"))
    v = signed.select(F.col("node").alias("v"), F.col("signature").alias("sv"))

    def count(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
                    for name in ("su", "sv"))
            enough = np.count_nonzero(a == b, axis=1) >= matches
            yield batch.select(["u", "v"]).filter(pa.array(enough))

    joined = _attach(_attach(pairs, u, "u"), v, "v")
    return joined.select("u", "v", "su", "sv").mapInArrow(count, "u long, v long")


def _confirmed(pairs, sets, percent):
    """Pairs whose full sets reach the similarity."""
    u = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    v = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))

    def compare(batches):
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("a"), batch.column("b")):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                    linked.append(False)
                    continue
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))

    joined = _attach(_attach(pairs, u, "u"), v, "v")
    return joined.select("u", "v", "a", "b").mapInArrow(compare, "u long, v long")


def _node_sets(docs, owners, width):
    """(node, shingles) of the nodes in ``owners`` (node, doc_id, digest), from the whole texts."""
    def collect(batches):
        import xxhash

        np.seterr(over="ignore")
        for batch in batches:
            for part in slices(batch):
                sets = [s.tobytes() for s in shingle_sets(part.column("text"), width)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()), pa.array(sets, pa.binary())],
                    ["digest", "shingles"])

    ids = owners.select("doc_id").distinct()
    wanted = with_ids(docs, ids, ids.count()).select("text")
    found = wanted.mapInArrow(collect, "digest binary, shingles binary")
    return found.join(owners.select("node", "digest"), "digest").dropDuplicates(["node"]).select("node", "shingles")


def _met(lists):
    """(pivot, node): every node with the pivots of its lists, pivots themselves included."""
    pivots = store(lists.groupBy("token").agg(
        F.max_by("node", F.struct("score", -F.col("node"))).alias("pivot"), F.count(F.lit(1)).alias("n")))
    hot = hot_keys(pivots, "token", "n")
    return spread_join(lists.select("token", "node"), pivots.select("token", "pivot"), "token", hot).select(
        "pivot", "node").distinct()


def block_links(strays: pa.Table, others: pa.Table, percent):
    """Links between two blocks of (node, label, shingles): one for each stray and other component."""
    def read(table):
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        return table.column("node").to_numpy(), table.column("label").to_numpy(), sets, np.array([len(x) for x in sets])

    (u, lu, a, na), (v, lv, b, nb) = read(strays), read(others)
    every_a, every_b = np.concatenate(a), np.concatenate(b)
    row_b = np.repeat(np.arange(len(b)), nb)
    order = np.argsort(every_b)
    every_b, row_b = every_b[order], row_b[order]
    low = np.searchsorted(every_b, every_a)
    many = np.searchsorted(every_b, every_a, "right") - low
    ends = np.cumsum(na)
    work = np.concatenate([[0], np.cumsum(many)])[ends]
    start, done, found = 0, 0, []
    while start < len(a):
        end = max(start + 1, min(int(np.searchsorted(work, done + CELLS, "right")), start + CELLS // len(b)))
        some = slice(ends[start] - na[start], ends[end - 1])
        n = many[some]
        row = np.repeat(np.repeat(np.arange(end - start), na[start:end]), n)
        at = np.repeat(low[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.bincount(row * len(b) + row_b[at], minlength=(end - start) * len(b))
        cell = np.flatnonzero(both)
        i, j = cell // len(b) + start, cell % len(b)
        linked = (100 * both[cell] >= percent * (na[i] + nb[j] - both[cell])) & (lu[i] != lv[j])
        i, j = i[linked], j[linked]
        first = np.unique(np.stack([i, lv[j]]), axis=1, return_index=True)[1]
        found.append((i[first], j[first]))
        start, done = end, int(work[end - 1])
    i, j = (np.concatenate(x) for x in zip(*found))
    return u[i], v[j]


def common_shingles(sets: DataFrame):
    """(shingles, how many nodes hold them) of the most common ones, in order of the shingles."""
    def count(batches):
        for batch in batches:
            if batch.num_rows:
                unique, n = np.unique(np.frombuffer(b"".join(batch.column("shingles").to_pylist()), np.int64),
                                      return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(unique), pa.array(n)], ["s", "n"])

    counted = sets.select("shingles").mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    top = counted.filter("n > 1").orderBy(F.desc("n"), "s").limit(COMMON).toArrow()
    s, n = top["s"].to_numpy(), top["n"].to_numpy()
    order = np.argsort(s)
    return s[order], n[order]


def may_link(sets: DataFrame, percent) -> DataFrame:
    """The nodes of (node, label, shingles) that may be linked to one of another label. A link shares percent of either
    set, so it shares one of the first shingles of both in any order; here the rarest come first."""
    known = sets.sparkSession.sparkContext.broadcast(common_shingles(sets))

    def post(batches):
        common, times = known.value
        for batch in batches:
            node, label, tokens = [], [], []
            for i, x in enumerate(batch.column("shingles")):
                own = np.frombuffer(x.as_buffer(), np.int64)
                n = np.zeros(len(own), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                    n = np.where(common[at] == own, times[at], 0)
                first = np.lexsort((own, n))[:len(own) - -(-percent * len(own) // 100) + 1]
                tokens.append(own[first])
                node.append(np.full(len(first), batch.column("node")[i].as_py()))
                label.append(np.full(len(first), batch.column("label")[i].as_py()))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in (tokens, node, label)], ["token", "node", "label"])

    posted = store(sets.mapInArrow(post, "token long, node long, label long"))
    lists = store(
        posted.groupBy("token").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count(F.lit(1)).alias("n"))
        .filter("a <> b").select("token", "n"))
    return spread_join(posted, lists, "token", hot_keys(lists, "token", "n")).select("node").distinct()


def _remaining(met, labels, sets, percent):
    """Links between the components of a group that its pivot has not joined."""
    sized = sets.select("node", (F.octet_length("shingles") / 8).cast("long").alias("size"))
    rows = store(met.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).join(sized, "node"))
    several = rows.groupBy("pivot").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b")
    inside = rows.join(several.select("pivot"), "pivot", "left_semi").select("node", "label").distinct()
    able = store(may_link(store(inside.join(sets, "node")), percent))
    rows = rows.join(able, "node", "left_semi")
    parts = rows.groupBy("pivot", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    groups = store(
        parts.groupBy("pivot").agg(
            F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("n"),
            F.sum("size").alias("size"), F.max_by("size", F.struct("n", "label")).alias("main_size"))
        .withColumn("strays", F.col("n") - F.col("most"))
        .filter("n > most")
        .select("pivot", "main", "n",
                F.ceil(F.greatest(F.col("size") / BLOCK, F.col("n") / ROWS)).cast("int").alias("blocks"),
                F.ceil(F.greatest((F.col("size") - F.col("main_size")) / STRAY_BLOCK, F.col("strays") / STRAY_ROWS))
                .cast("int").alias("stray_blocks")))
    mixed = store(spread_join(rows.drop("size"), groups, "pivot", hot_keys(groups, "pivot", "n")))

    def dealt(rows, own, n, other, m):
        return rows.select(
            "pivot", F.pmod(F.xxhash64("node"), n).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(m) - 1)).alias(other), "node", "label").join(sets, "node")

    keys = ["pivot", "block", "stray_block"]
    strays = dealt(mixed.filter("label <> main"), "stray_block", F.col("stray_blocks"), "block", "blocks")
    # Other names, since both sides come from one table.
    others = dealt(mixed, "block", F.col("blocks"), "stray_block", "stray_blocks").select(
        *(F.col(key).alias(f"of_{key}") for key in keys),
        *(F.col(name).alias(f"other_{name}") for name in ("node", "label", "shingles")))

    def compare(strays: pa.Table, others: pa.Table) -> pa.Table:
        others = others.select([f"other_{name}" for name in ("node", "label", "shingles")]).rename_columns(
            ["node", "label", "shingles"])
        u, v = block_links(strays, others, percent) if strays.num_rows and others.num_rows else ([], [])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return strays.groupBy(*keys).cogroup(others.groupBy(*(f"of_{key}" for key in keys))).applyInArrow(
        compare, "u long, v long").distinct()


def near_dedup(docs: DataFrame, width=5, percent=80, coordinates=COORDINATES, doc_id="doc_id", text="text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    docs = texts(docs, doc_id, text)
    matches = match_threshold(coordinates, percent)
    signed = store(signatures(docs, width, coordinates))
    nodes = store(
        signed.filter("n_shingles > 0").groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"),
             F.count(F.lit(1)).alias("rows"))
        .withColumn("node", F.monotonically_increasing_id()))
    lists = store(prefix_postings(postings(nodes, coordinates), matches))
    lists = store(lists.join(lists.groupBy("token").count().filter("count > 1").select("token"), "token", "left_semi"))
    owners = nodes.join(lists.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "digest")
    sets = store(_node_sets(docs, store(owners), width))

    met = store(_met(lists))
    pairs = met.filter("pivot <> node").select(F.col("pivot").alias("u"), F.col("node").alias("v"))
    links = store(_confirmed(store(_matching(pairs, nodes, matches)), sets, percent))
    labels = store(components(links))
    further = store(_remaining(met, labels, sets, percent))
    if further.count():
        labels = store(components(links.unionByName(further)))
    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    classes = store(
        spread_join(named, least.drop("n"), "label", hot_keys(least, "label", "n")).select("digest", "component_id", "rows"))
    rows = spread_join(signed.drop("signature"), classes.drop("rows"), "digest", hot_keys(classes, "digest", "rows"), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_first(docs: DataFrame, doc_id="doc_id", **options) -> DataFrame:
    """One document of each group of near copies, all columns."""
    result = near_dedup(docs, doc_id=doc_id, **options)
    gone = store(result.groupBy("doc_id").agg(F.every(~F.col("kept")).alias("gone")).filter("gone").select(
        F.col("doc_id").alias("_id")))
    side = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(side, docs[doc_id].eqNullSafe(side["_id"]), "left_anti")
