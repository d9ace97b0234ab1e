"""Whole, ordered message histories as text, without ever holding one customer in one task.

A history of up to ``2 ** part_bits`` messages and ``part_bytes`` bytes of text is one row. A longer one becomes several
rows, numbered by ``part``, whose texts follow each other; nothing is dropped. A part has at most as many messages, and
its texts less than ``part_bytes`` besides its last one.
"""

from pyspark.sql import DataFrame, Window, functions as F

from caseflow.functions.instants import iso_utc
from caseflow.functions.text import WHITESPACE, strip
from caseflow.operators.skew import is_small, join_unique
from caseflow.storage import durable, stored

PART_BITS = 13
PART_BYTES = 64 << 20
# A row id is the number of the partition, then the number of the row within it.
ROW_BITS = 33
FIND = object()
BY_TIME = ("interaction_timestamp", "external_id")
PART_COLUMNS = ["customer_id", "part", "parts", "offset", "items"]


def _collect(rows, *keys):
    """Ordered lists by key. Rows are brought together first: lists gain nothing from being built twice."""
    return rows.repartition(*keys).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("order", "item"))).alias("items"))


def _whole(collected):
    return collected.withColumns({
        "part": F.lit(0).cast("long"), "parts": F.lit(1).cast("long"),
        "offset": F.lit(0).cast("long")})


def _single(rows):
    return _whole(_collect(rows, "customer_id"))


def _split(rows, part_bits, part_bytes, keep=stored):
    """Histories that need several parts.

    A range shuffle on (customer, order) spreads one customer over many tasks in order. Row ids count
    up within a task, so a block of consecutive ids is a run of consecutive messages; the bytes up to a message, summed
    within its task, cut the blocks where texts are long. The placement is
    stored once, because the parts are numbered from it and it differs between two range shuffles.
    """
    task, row = F.shiftright("row", ROW_BITS), F.col("row")
    in_task = Window.partitionBy("task").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = keep(
        rows.repartitionByRange("customer_id", "order")
        .sortWithinPartitions("customer_id", "order", "item")
        .withColumn("row", F.monotonically_increasing_id()))
    # Where the bytes cut, by task: one row id for each ``part_bytes`` of text. Only sizes are shuffled for them.
    cuts = keep(
        placed.select("row", "size", task.alias("task"))
        .select("row", "task", F.floor((F.sum("size").over(in_task) - F.col("size")) / part_bytes).alias("bytes"))
        .filter("bytes > 0").groupBy("task", "bytes").agg(F.min("row").alias("row"))
        .groupBy("task").agg(F.collect_list("row").alias("cuts")))
    if is_small(cuts):
        cuts = F.broadcast(cuts)
    placed = placed.withColumn("task", task).join(cuts, "task", "left").select(
        "customer_id", "order", "item", F.struct(
            F.shiftright(row, part_bits).alias("rows"),
            F.when(F.col("cuts").isNull(), 0).otherwise(F.size(F.filter("cuts", lambda cut: cut <= row))).alias("bytes"))
        .alias("block"))
    in_order = Window.partitionBy("customer_id").orderBy("block")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    numbered = (
        placed.groupBy("customer_id", "block").agg(F.count(F.lit(1)).alias("n"))
        .select(
            "customer_id", "block",
            (F.row_number().over(in_order) - 1).cast("long").alias("part"),
            F.count(F.lit(1)).over(Window.partitionBy("customer_id")).alias("parts"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    return _collect(placed, "customer_id", "block").join(
        numbered, ["customer_id", "block"]).drop("block")


def _split_by_customer(rows, part_bits, part_bytes):
    """The parts of histories that a task can hold: one shuffle by customer, and no placement over all rows."""
    in_order = Window.partitionBy("customer_id").orderBy("order", "item")
    upto = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    before = F.row_number().over(in_order) - 1
    block = F.struct(F.shiftright(before, part_bits).alias("rows"), F.floor(upto / part_bytes).alias("bytes"))
    numbered = (
        rows.repartition("customer_id").select("customer_id", "order", "item", before.alias("before"), block.alias("block"))
        .withColumn("cut", F.coalesce(F.col("block") != F.lag("block").over(in_order), F.lit(False)).cast("long"))
        .withColumn("part", F.sum("cut").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("parts", F.max("part").over(Window.partitionBy("customer_id")) + 1))
    return numbered.groupBy("customer_id", "part", "parts").agg(
        F.min("before").cast("long").alias("offset"),
        F.sort_array(F.collect_list(F.struct("order", "item"))).alias("items"))


def _bytes(text):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def long_histories(
        df: DataFrame, key="participant_external_id", part_bits=PART_BITS, text="content_text", part_bytes=PART_BYTES):
    """The customers whose history needs several parts, or None. Runs a job over the key and the lengths of the texts."""
    long = (
        df.filter(F.col(key).cast("string") != "").groupBy(F.col(key).alias("customer_id"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(_bytes(text)).alias("bytes"))
        .filter((F.col("n") > 2 ** part_bits) | (F.col("bytes") > part_bytes))
        .select("customer_id", F.lit(True).alias("is_long")))
    return None if long.isEmpty() else durable(long)


def history_parts(
        df: DataFrame, item, key="participant_external_id", order=BY_TIME,
        part_bits=PART_BITS, long=FIND, text="content_text", part_bytes=PART_BYTES) -> DataFrame:
    """``customer_id, part, parts, offset, items``: each history in order, in parts of bounded length.

    ``item`` is the Column kept per message, ``text`` the column whose bytes are bounded, ``offset`` the number of messages before
    the part. The range shuffle is planned only for the customers in ``long``, which is found out when not given.
    """
    if long is FIND:
        long = long_histories(df, key, part_bits, text, part_bytes)
    rows = df.filter(F.col(key).cast("string") != "").select(
        F.col(key).alias("customer_id"), F.struct(*order).alias("order"), item.alias("item"), _bytes(text).alias("size"))
    columns = ["customer_id", "part", "parts", "offset", "items"]
    if long is None:
        return _single(rows).select(columns)
    if is_small(long):
        marked = rows.join(F.broadcast(long), "customer_id", "left")
    else:
        # Read three times: for the short histories, and for the ranges of the long ones and their bounds.
        marked = durable(join_unique(rows, long, "customer_id"))
    single = _single(marked.filter("is_long is null").drop("is_long"))
    split = _split(marked.filter("is_long").drop("is_long"), part_bits, part_bytes)
    return single.select(columns).unionByName(split.select(columns))


def _bucketed(history, long, item, key, text):
    """The messages of the buckets in the shape of parts, ``is_long`` for the customers in ``long``; nothing is shuffled."""
    long = long.select(F.col(long.columns[0]).alias(key), F.lit(True).alias("is_long"))
    if is_small(long):
        long = F.broadcast(long)
    return _shaped(history.join(long, key, "left"), item, key, text)


def _shaped(rows, item, key, text):
    return rows.select(key, F.struct(*BY_TIME).alias("order"), item.alias("item"), _bytes(text).alias("size"), "is_long")


def bucketed_short(history: DataFrame, long: DataFrame, item, key, text="content_text") -> DataFrame:
    """The histories of the customers that are not in ``long``; they lie where the history lies."""
    single = _whole(_bucketed(history, long, item, key, text).filter("is_long is null").groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("order", "item"))).alias("items")))
    return single.withColumnRenamed(key, "customer_id").select(PART_COLUMNS)


def bucketed_long(
        history: DataFrame, long_part: DataFrame, long: DataFrame, item, key, part_bits=PART_BITS,
        text="content_text", part_bytes=PART_BYTES, huge: DataFrame = None, keep=stored) -> DataFrame:
    """The parts of the customers in ``long``.

    Those that a task can hold are shuffled by customer, those in ``huge`` by ranges. ``keep`` stores what is read several
    times.
    """
    further = _shaped(long_part.withColumn("is_long", F.lit(True)), item, key, text)
    rows = _bucketed(history, long, item, key, text).filter("is_long").unionByName(further).select(
        F.col(key).alias("customer_id"), "order", "item", "size")
    if huge is None:
        return _split(rows, part_bits, part_bytes, keep).select(PART_COLUMNS)
    if huge.isEmpty():
        return _split_by_customer(rows, part_bits, part_bytes).select(PART_COLUMNS)
    huge = huge.select(F.col(huge.columns[0]).alias("customer_id"), F.lit(True).alias("is_huge"))
    if is_small(huge):
        rows = rows.join(F.broadcast(huge), "customer_id", "left")
    else:
        # Read three times: for the histories that a task can hold, and for the ranges of the others and their bounds.
        rows = keep(join_unique(rows, huge, "customer_id"))
    held = _split_by_customer(rows.filter("is_huge is null").drop("is_huge"), part_bits, part_bytes)
    split = _split(rows.filter("is_huge").drop("is_huge"), part_bits, part_bytes, keep)
    return held.select(PART_COLUMNS).unionByName(split.select(PART_COLUMNS))


def bucketed_parts(
        history: DataFrame, long_part: DataFrame, long: DataFrame, item, key, part_bits=PART_BITS,
        text="content_text", part_bytes=PART_BYTES, huge: DataFrame = None) -> DataFrame:
    """The parts of ``history_parts`` from a history bucketed by ``key``: only customers in ``long`` are shuffled.

    ``long_part`` holds further messages of the customers in ``long``. ``huge`` are those of them whose history a task must
    not hold, all of them where it is not given.
    """
    return bucketed_short(history, long, item, key, text).unionByName(
        bucketed_long(history, long_part, long, item, key, part_bits, text, part_bytes, huge))


def join_parts(customers: DataFrame, parts: DataFrame, long) -> DataFrame:
    """Left join of unique customers to their history parts.

    First parts are unique too. The further parts of a customer are many, so that side must not be
    shuffled by customer.
    """
    if long is None:
        return customers.join(parts, "customer_id", "left").fillna({"part": 0, "parts": 1})
    customers = durable(customers)
    first = customers.join(parts.filter("part = 0"), "customer_id", "left").fillna({"part": 0, "parts": 1})
    found = customers.withColumn("_found", F.lit(True))
    further = join_unique(parts.filter("part > 0"), found, "customer_id").filter("_found")
    return first.unionByName(further.drop("_found"))


def collect_history(df: DataFrame, part_bits=PART_BITS, long=FIND) -> DataFrame:
    """Each customer's messages as an ordered list of (time, id, text)."""
    parts = history_parts(df, F.struct("content_text"), part_bits=part_bits, long=long)
    return parts.select(
        "customer_id", "part", "offset",
        F.transform("items", lambda row: F.struct(
            row["order"]["interaction_timestamp"].alias("interaction_timestamp"),
            row["order"]["external_id"].alias("external_id"),
            row["item"]["content_text"].alias("content_text"))).alias("messages"))


def chat_log(
        df: DataFrame, variant="prediction", key="participant_external_id", order=BY_TIME,
        speaker=None, text="content_text", part_bits=PART_BITS, long=FIND, parts=None,
        part_bytes=PART_BYTES) -> DataFrame:
    """The history as lines of ``speaker: text``. ``parts`` makes the parts of the lines where they are not made from ``df``.

    ``prediction`` names the speaker and strips the whole log; ``evaluation`` calls everyone
    ``Customer`` and ends every line with a newline. The whole log is its parts in order, with a newline between
    them for ``prediction`` and nothing for ``evaluation``.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    if variant == "evaluation":
        line = F.concat(F.lit("Customer: "), body, F.lit("\n"))
        joined = F.array_join(F.transform("items", lambda row: row["item"]), "")
    elif variant == "prediction":
        line = F.concat(F.coalesce(F.col(speaker or key).cast("string"), F.lit("Unknown")),
                        F.lit(": "), body)
        joined = F.array_join(F.transform("items", lambda row: row["item"]), "\n")
        blanks = F.lit(WHITESPACE)
        joined = (
            F.when(F.col("parts") == 1, strip(joined))
            .when(F.col("part") == 0, F.ltrim(joined, blanks))
            .when(F.col("part") == F.col("parts") - 1, F.rtrim(joined, blanks))
            .otherwise(joined))
    else:
        raise ValueError(f"unknown chat log variant: {variant}")
    found = parts(line) if parts else history_parts(df, line, key, order, part_bits, long, text, part_bytes)
    return found.select("customer_id", "part", "parts", joined.alias("chat_log"))


def render_history(df: DataFrame, part_bits=PART_BITS, long=FIND, part_bytes=PART_BYTES) -> DataFrame:
    """The history as numbered ``Interaction i (time) by who: text`` pieces without separator."""
    item = F.concat(
        F.lit(" ("), F.coalesce(iso_utc(F.col("interaction_timestamp")), F.lit("No timestamp")),
        F.lit(") by "), F.col("participant_external_id"), F.lit(": "),
        F.coalesce("content_text", F.lit("No content")))
    numbered = F.transform("items", lambda row, i: F.concat(
        F.lit("Interaction "), (F.col("offset") + i + 1).cast("string"), row["item"]))
    return history_parts(df, item, part_bits=part_bits, long=long, part_bytes=part_bytes).select(
        "customer_id", "part", "parts", F.array_join(numbered, "").alias("history"))
