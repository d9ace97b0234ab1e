"""Exact deduplication: static binary-fuse filters over immutable snapshots screen each new batch.

Texts are reduced to digests and digests to classes (one row per digest). The first batch becomes an immutable
snapshot: its digests, in buckets, and one binary-fuse filter per bucket. A later batch groups its own
duplicates, asks the filters, and only digests that pass go to the exact buckets. Classes with more than one row
are checked byte by byte, so that a digest shared by different texts does no harm.

Defined cases: a null text is the empty text; empty texts are equal to each other; of equal texts the
largest ``doc_id`` stays, a null id only if all ids of the class are null; rows that repeat an id and a text count
as rows of the group and share their ``kept``; an empty table gives an empty result; other columns are not read.
"""

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from caseflow.llm.common import BROADCAST_IDS, hot_keys, spread_join, store, texts, with_ids

BUCKET_KEYS = 40_000


def sha256(text):
    return F.unhex(F.sha2(text, 256))


@dataclass
class Snapshot:
    """Immutable: ``digests`` (digest, key, bucket) and ``filters`` (bucket, seed, segment, segments, slots)."""
    digests: DataFrame
    filters: DataFrame
    buckets: int


def _mix(keys, seed):
    with np.errstate(over="ignore"):
        x = keys + np.uint64(seed)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def _places(keys, seed, segment, segments):
    """Three slots in neighbouring segments, and the fingerprint, of each key."""
    h = _mix(keys, seed)
    first = ((h >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
    low = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & low)
    third = (first + np.uint64(2 * segment)) ^ (h & low)
    return (np.stack([first, second, third], 1).astype(np.int64),
            ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8))


def build_fuse(keys):
    """(seed, segment, segments, slots) of a three-wise binary-fuse filter; ``keys`` are distinct uint64."""
    n = max(len(keys), 2)
    segment = min(1 << 18, 1 << int(math.floor(math.log(n) / math.log(3.33) + 2.25)))
    slots = int(n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n)))
    segments = max(1, -(-slots // segment) - 2)
    for seed in range(1, 1000):
        places, prints = _places(keys, seed, segment, segments)
        count = np.bincount(places.ravel(), minlength=(segments + 2) * segment)
        total = np.zeros(len(count), np.int64)
        np.add.at(total, places.ravel(), np.repeat(np.arange(len(keys)), 3))
        peeled, single = [], np.flatnonzero(count == 1)
        while len(single):
            # All slots with one key left give up their key at once.
            rows, at = np.unique(total[single], return_index=True)
            peeled.append((rows, single[at]))
            touched = places[rows].ravel()
            np.subtract.at(count, touched, 1)
            np.subtract.at(total, touched, np.repeat(rows, 3))
            touched = np.unique(touched)
            single = touched[count[touched] == 1]
        if sum(len(rows) for rows, _ in peeled) == len(keys):
            filled = np.zeros(len(count), np.uint8)
            for rows, at in reversed(peeled):
                filled[at] = prints[rows] ^ np.bitwise_xor.reduce(filled[places[rows]], axis=1)
            return seed, segment, segments, filled
        segments += 1 + segments // 20
    raise ValueError("keys are not distinct")


def in_fuse(keys, seed, segment, segments, slots):
    """Whether the filter may hold each key: never false for a key it was built from."""
    places, prints = _places(keys, seed, segment, segments)
    return np.bitwise_xor.reduce(slots[places], axis=1) == prints


def build_snapshot(digests: DataFrame) -> Snapshot:
    """Freeze a table of distinct digests. A bucket holds about BUCKET_KEYS of them, whatever their number."""
    keyed = store(digests.select("digest", F.xxhash64("digest").alias("key")))
    buckets = max(1, math.ceil(keyed.count() / BUCKET_KEYS))
    keyed = keyed.withColumn("bucket", F.pmod("key", F.lit(buckets)))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        seed, segment, segments, slots = build_fuse(
            np.unique(rows["key"].to_numpy(np.int64)).view(np.uint64))
        return pd.DataFrame({
            "bucket": [rows["bucket"].iloc[0]], "seed": [seed], "segment": [segment],
            "segments": [segments], "slots": [slots.tobytes()]})

    filters = store(keyed.select("bucket", "key").groupBy("bucket").applyInPandas(
        build, "bucket long, seed long, segment long, segments long, slots binary"))
    return Snapshot(keyed, filters, buckets)


def screen(digests: DataFrame, snapshot: Snapshot, n: int) -> DataFrame:
    """Of ``n`` distinct digests those that the snapshot may hold; buckets are cut into bounded pieces."""
    pieces = max(1, math.ceil(n / (snapshot.buckets * BUCKET_KEYS)))
    key = F.xxhash64("digest")
    asked = digests.select(
        "digest", key.alias("key"), F.pmod(key, F.lit(snapshot.buckets)).alias("bucket"),
        F.pmod(F.shiftrightunsigned(key, 32), F.lit(pieces)).alias("piece"))
    filters = snapshot.filters.withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pieces - 1).cast("long"))))

    def probe(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        if keys.empty or filters.empty:
            return pd.DataFrame({"digest": pd.Series([], dtype=object)})
        f = filters.iloc[0]
        found = in_fuse(
            keys["key"].to_numpy(np.int64).view(np.uint64), int(f["seed"]), int(f["segment"]),
            int(f["segments"]), np.frombuffer(f["slots"], np.uint8))
        return keys.loc[found, ["digest"]]

    return asked.groupBy("bucket", "piece").cogroup(filters.groupBy("bucket", "piece")).applyInPandas(
        probe, "digest binary")


def _classes(rows):
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_dedup(docs: DataFrame, batches=2, digest=sha256, doc_id="doc_id", text="text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The documents come as ``batches`` batches; each is screened by the snapshots of those before it.
    """
    source = texts(docs, doc_id, text).withColumn("text", F.coalesce("text", F.lit("")))
    sha = F.sha2("text", 256)
    rows = store(source.select(
        "doc_id", digest(F.col("text")).alias("digest"), F.unhex(sha).alias("sha"),
        F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("batch"), F.lit(1).cast("long").alias("n")))

    classes, repeats, snapshots = [], [], []
    for batch in range(batches):
        new = store(_classes(rows.filter(F.col("batch") == batch)))
        fresh, n = new, new.count()
        for snapshot in snapshots:
            known = store(screen(new, snapshot, n).join(snapshot.digests, "digest", "left_semi"))
            fresh = fresh.join(known, "digest", "left_anti")
            repeats.append(known)
        classes.append(new)
        if batch + 1 < batches:
            snapshots.append(build_snapshot(fresh))
    merged = reduce(DataFrame.unionByName, classes)
    if repeats:
        # Only classes found in an exact bucket are put together; the others are whole already.
        known = reduce(DataFrame.unionByName, repeats).distinct()
        again = merged.join(known, "digest", "left_semi").withColumnRenamed("keep_id", "doc_id")
        merged = merged.join(known, "digest", "left_anti").unionByName(
            _classes(again.withColumnRenamed("group_size", "n")))
    return _checked(source, rows, store(merged), digest)


def _checked(source, rows, classes, digest):
    """Attach the classes to the rows. Texts of larger classes are grouped by their bytes; where one digest
    stands for several texts, each text is a class of its own."""
    hot = store(hot_keys(classes, "digest", "group_size"))
    ids = store(spread_join(
        rows.select("doc_id", "digest"), classes.filter("group_size > 1").select("digest"), "digest", hot)
        .select("doc_id").distinct())
    by_bytes = (
        with_ids(source, ids, ids.count()).withColumn("digest", digest(F.col("text")))
        .groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    clashes = store(
        by_bytes.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest"))
    clean = rows
    if clashes.count():
        clean = rows.join(clashes, "digest", "left_anti")
    found = spread_join(clean, classes, "digest", hot).select("doc_id", "keep_id", "group_size", "sha")
    if clean is not rows:
        texts_of = source.withColumn("digest", digest(F.col("text"))).join(clashes, "digest", "left_semi")
        own = texts_of.groupBy("digest", "text").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        found = found.unionByName(
            texts_of.join(own, ["digest", "text"])
            .select("doc_id", "keep_id", "group_size", F.unhex(F.sha2("text", 256)).alias("sha")))
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def keep_one(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """The documents without their exact copies, all columns; of rows that repeat id and text one stays."""
    result = store(exact_dedup(docs, doc_id=doc_id, text=text).select("doc_id", "kept", "text_sha256"))
    ids = result.groupBy("doc_id").agg(F.bool_or("kept").alias("some"), F.count(F.lit(1)).alias("n"))
    # Ids that go altogether, and ids of several rows, which are told apart by their texts.
    gone = store(ids.filter("n = 1 AND NOT some OR n > 1").select(F.col("doc_id").alias("_id"), "n"))
    side = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    kept = docs.join(side, docs[doc_id].eqNullSafe(side["_id"]), "left_anti")
    several = gone.filter("n > 1")
    if several.count() == 0:
        return kept
    stay = result.filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    same = docs[doc_id].eqNullSafe(stay["_id"]) & (
        F.sha2(F.coalesce(docs[text], F.lit("")), 256) == stay["_sha"])
    rows = docs.join(several, docs[doc_id].eqNullSafe(several["_id"]), "left_semi").join(stay, same, "left_semi")
    # A null text is the empty text.
    return kept.unionByName(
        rows.withColumn("_same", F.coalesce(rows[text], F.lit(""))).dropDuplicates([doc_id, "_same"]).drop("_same"))
