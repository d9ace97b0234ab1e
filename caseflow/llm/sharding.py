"""Sharding by a permutation-filled lookup table.

Every shard walks the slots of a table of prime size in an order of its own and the shards take turns claiming the
next free slot, so each owns nearly the same number of slots, and a shard that comes or goes moves few others.
The table has a fixed size whatever the data, so it is broadcast, and a row finds its shard by one lookup.

Defined cases: a null key is one key of its own; equal keys share a shard, whose rows are dealt over its files by their
values, so that a frequent key fills all of them; a key's rows go to several shards by passing several key columns; an
empty table gives an empty result; an input column named slot or shard is not read.
"""

import hashlib

from pyspark.sql import DataFrame, functions as F

TABLE_SIZE = 65_537
SHARDS = 64


def _number(text, salt):
    return int.from_bytes(hashlib.sha256(f"{salt}:{text}".encode()).digest()[:8], "big")


def fill_table(shards, size=TABLE_SIZE):
    """The shard of each slot; ``size`` is a prime larger than the number of shards."""
    if size < 2 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table size must be a prime")
    names = list(shards)
    if not 0 < len(names) <= size or len(set(names)) < len(names):
        raise ValueError("shards must be distinct, one at least, and not more than slots")
    at = [_number(name, "offset") % size for name in names]
    step = [_number(name, "skip") % (size - 1) + 1 for name in names]
    table, free = [None] * size, size
    while free:
        for i, name in enumerate(names):
            if not free:
                break
            # The next free slot in the shard's own order.
            while table[at[i]] is not None:
                at[i] = (at[i] + step[i]) % size
            table[at[i]] = name
            free -= 1
    return table


def place(rows: DataFrame, keys, shards, size=TABLE_SIZE) -> DataFrame:
    """All rows with ``slot`` and ``shard`` (text) after their own columns, without a shuffle."""
    own = [rows[c] for c in rows.columns if c not in ("slot", "shard")]
    table = rows.sparkSession.createDataFrame(
        list(enumerate(fill_table(shards, size))), "_slot int, _shard string")
    slot = F.pmod(F.xxhash64(*(rows[k] for k in keys)), F.lit(size)).cast("int")
    placed = rows.select(*own, slot.alias("slot"))
    # One row per slot: the table's size is fixed.
    return placed.join(F.broadcast(table), placed["slot"] == F.col("_slot")).select(
        *(placed[c] for c in placed.columns), F.col("_shard").alias("shard"))


def write_shards(rows: DataFrame, keys, shards, path, files_per_shard=1, size=TABLE_SIZE):
    """Write one folder per shard; a shard's rows are dealt over ``files_per_shard`` tasks."""
    placed = place(rows, keys, shards, size)
    # Maps cannot be hashed.
    values = [F.col(f"`{f.name}`") for f in placed.schema if "map<" not in f.dataType.simpleString()]
    # A shard's rows are dealt over its tasks by their values, which a task that runs again finds unchanged.
    dealt = placed.repartition(
        max(1, len(list(shards)) * files_per_shard), "shard", F.pmod(F.xxhash64(*values), F.lit(files_per_shard)))
    dealt.write.partitionBy("shard").parquet(path)
