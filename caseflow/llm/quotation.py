"""Quotation linking: conversations in reply order, without their quotes. DataFrame functions only.

Lines that begin with ``>`` marks are quotes, as deep as they have marks. Runs of lines of one depth are passages. A
quoted passage, and each of its lines, is hashed after normalisation and joined to the first earlier message of the same
conversation that holds it as text of its own. The message of the shallowest linked quotes is replied to (the latest of
them, if they are several); a message that quotes nothing known starts a thread of its own. Threads come in the order of
their first messages, replies within a thread in the order of turns.

Defined cases: null and empty texts hold nothing and are kept as empty messages; blank lines belong to no passage; a
quote of text that no earlier message holds is dropped like any quote and counted as unlinked; messages that
repeat a conversation and turn are all kept, a quote of either goes to that turn; null turns come last, are never
replied to and start threads of their own; a null conversation is one conversation; an empty table gives an empty result;
other columns are not read.
"""

from pyspark.sql import DataFrame, functions as F, Window

from caseflow.llm.common import hot_keys, spread_join, store

ROW_BITS = 33


def messages_of(table: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """(message, conv_id, turn, role, text): the messages with a number each."""
    return table.select(
        table[conv_id].alias("conv_id"), table[turn].alias("turn"), table[role].alias("role"),
        F.coalesce(table[text], F.lit("")).alias("text")).withColumn("message", F.monotonically_increasing_id())


def quote_lines(messages: DataFrame) -> DataFrame:
    """(message, conv_id, turn, line, level, content): the lines of each message and the depth of their quote marks."""
    lines = messages.select("message", "conv_id", "turn", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("line", "raw"))
    marks = F.regexp_extract("raw", r"^((?:[ \t]*>)*)", 1)
    return lines.select(
        "message", "conv_id", "turn", "line",
        F.length(F.regexp_replace(marks, r"[^>]", "")).alias("level"),
        F.regexp_replace("raw", r"^(?:[ \t]*>)+[ \t]?", "").alias("content"))


def normalised(column):
    """Lower case, with single blanks."""
    return F.trim(F.regexp_replace(F.lower(column), r"\s+", " "))


def passages(lines: DataFrame) -> DataFrame:
    """(message, conv_id, turn, level, hash): each passage and each line of it; passages end at blank lines."""
    lines = lines.withColumn("plain", normalised(F.col("content")))
    of_message = Window.partitionBy("message").orderBy("line")
    before = F.lag(F.struct("level", (F.col("plain") == "").alias("blank"))).over(of_message)
    new = before.isNull() | before["blank"] | (before["level"] != F.col("level"))
    runs = lines.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(of_message)).filter("plain <> ''")
    keys = ["message", "conv_id", "turn", "level"]
    whole = runs.groupBy(*keys, "run").agg(F.sort_array(F.collect_list(F.struct("line", "plain"))).alias("parts")).select(
        *keys, F.concat_ws(" ", F.transform("parts", lambda p: p["plain"])).alias("plain"), F.size("parts").alias("lines"))
    single = runs.select(*keys, "plain")
    return whole.filter("lines > 1").select(*keys, "plain").unionByName(single).select(
        *keys, F.sha2("plain", 256).alias("hash"))


def links(found: DataFrame) -> DataFrame:
    """(message, level, original): the earliest earlier turn that holds a quoted passage as its own; null if none does."""
    own = found.filter("level = 0 AND turn IS NOT NULL")
    quoted = found.filter("level > 0 AND turn IS NOT NULL")
    # One row for each passage of a conversation: where it was said first.
    key = F.struct("conv_id", "hash")
    first = own.select(key.alias("key"), "turn").groupBy("key").agg(F.min("turn").alias("original"))
    quoted = store(quoted.select("message", "turn", "level", key.alias("key")))
    counts = quoted.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    joined = spread_join(quoted, first, "key", hot_keys(counts, "key", "n"), "left")
    return joined.select(
        "message", "level", F.when(F.col("original") < F.col("turn"), F.col("original")).alias("original"))


def threads(parents: DataFrame) -> DataFrame:
    """(key, thread): the first turn of the thread of every replying turn; ``parents`` has key (conv_id, turn), parent."""
    state = store(parents.select("key", F.col("parent").alias("thread")))
    while True:
        above = state.select(F.struct(F.col("key.conv_id").alias("conv_id"), F.col("key.turn").alias("turn")).alias("up"),
                             F.col("thread").alias("higher"))
        asked = state.withColumn("up", F.struct(F.col("key.conv_id").alias("conv_id"), F.col("thread").alias("turn")))
        counts = asked.groupBy("up").agg(F.count(F.lit(1)).alias("n"))
        # Each round doubles the way that is behind.
        joined = store(spread_join(asked, above, "up", hot_keys(counts, "up", "n"), "left"))
        state = joined.select("key", F.coalesce("higher", "thread").alias("thread"))
        if joined.filter("higher IS NOT NULL").limit(1).count() == 0:
            return state


def positions(rows: DataFrame, order, group) -> DataFrame:
    """The rows with ``position``, from 1 within ``group``, in ``order`` (which begins with the group). No group is ever
    in one task: rows are range partitioned and each partition adds the number of rows before it."""
    row = F.monotonically_increasing_id()
    placed = store(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.shiftright(row, ROW_BITS))
        .withColumn("_at", row.bitwiseAND(F.lit((1 << ROW_BITS) - 1))))
    # One row for each partition.
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(parts), "_part").withColumn("_number", F.col("_before") + F.col("_at"))
    first = numbered.groupBy(F.struct(group).alias("_group")).agg(
        F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    joined = spread_join(
        numbered.withColumn("_group", F.struct(group)), first.select("_group", "_first"), "_group",
        hot_keys(first, "_group", "_rows"))
    return joined.withColumn("position", F.col("_number") - F.col("_first") + 1).drop(
        "_part", "_at", "_before", "_number", "_group", "_first")


def reply_order(table: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """One row per message: conv_id, turn, role, parent_turn, thread_turn, position, n_linked, n_unlinked, text.

    ``parent_turn`` is the turn replied to, ``thread_turn`` the first turn of the thread, ``position`` the place in the
    conversation in reply order, ``text`` the message without quotes; the counts are of quoted passages and lines.
    """
    messages = store(messages_of(table, conv_id, turn, role, text))
    quoting = messages.filter(F.col("text").rlike(r"(?m)^[ \t]*>"))
    # Passages of conversations without any quote cannot be linked.
    conversations = quoting.select(F.struct("conv_id").alias("conv")).distinct()
    concerned = messages.withColumn("conv", F.struct("conv_id")).join(conversations, "conv", "left_semi")
    lines = store(quote_lines(concerned.drop("conv")))
    linked = store(links(passages(lines)))
    nearest = linked.groupBy("message").agg(
        F.max_by("original", F.when(F.col("original").isNotNull(), F.struct(-F.col("level"), F.col("original")))).alias("parent"),
        F.count("original").alias("n_linked"),
        (F.count(F.lit(1)) - F.count("original")).alias("n_unlinked"))
    own = lines.filter("level = 0").groupBy("message").agg(
        F.sort_array(F.collect_list(F.struct("line", "content"))).alias("parts")).select(
        "message", F.trim(F.concat_ws("\n", F.transform("parts", lambda p: p["content"])), F.lit("\n")).alias("own"))
    has_quote = lines.groupBy("message").agg(F.max("level").alias("deepest"))
    replies = store(
        messages.join(nearest, "message", "left").join(own, "message", "left").join(has_quote, "message", "left")
        .select(
            "message", "conv_id", "turn", "role", F.col("parent").alias("parent_turn"),
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.coalesce("n_unlinked", F.lit(0)).alias("n_unlinked"),
            F.when(F.col("deepest") > 0, F.coalesce("own", F.lit(""))).otherwise(F.col("text")).alias("text")))
    key = F.struct("conv_id", "turn")
    parents = replies.filter("parent_turn IS NOT NULL").groupBy(key.alias("key")).agg(F.min("parent_turn").alias("parent"))
    found = threads(parents)
    counts = replies.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    threaded = spread_join(replies.withColumn("key", key), found, "key", hot_keys(counts, "key", "n"), "left")
    threaded = threaded.withColumn("thread_turn", F.coalesce("thread", "turn")).drop("key", "thread")
    order = [F.col("conv_id"), F.col("thread_turn").asc_nulls_last(), F.col("turn").asc_nulls_last(),
             F.col("role"), F.col("text"), F.col("message")]
    return positions(threaded, order, "conv_id").select(
        "conv_id", "turn", "role", "parent_turn", "thread_turn", "position", "n_linked", "n_unlinked", "text")
