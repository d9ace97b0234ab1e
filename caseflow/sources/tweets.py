"""Reading raw tweet files."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from caseflow.operators.skew import is_small
from caseflow.schemas import RAW_TWEET
from caseflow.storage import durable

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def read_tweets(spark: SparkSession, path, encoding="UTF-8", split_files=False) -> DataFrame:
    """Raw tweets as seven text columns. Texts may hold newlines; a blank field is NULL.

    A file whose records may hold newlines is read by one task, which suits many files of moderate
    size. ``split_files`` reads pieces of large UTF-8 files in parallel instead, for one shuffle.
    """
    if split_files:
        if encoding.upper() != "UTF-8":
            raise ValueError("split_files reads UTF-8 only")
        return _read_split(spark, path)
    return (
        spark.read.schema(RAW_TWEET).options(**CSV_OPTIONS).option("encoding", encoding).csv(path))


def scan_csv(spark: SparkSession, path) -> DataFrame:
    """Any CSV with a header, column types inferred."""
    return spark.read.options(**CSV_OPTIONS).option("inferSchema", "true").csv(path)


# A quoted field from its start, with doubled quotes inside, and the rest of one that began on an earlier line.
_QUOTED = r'(^|,)"(?:[^"]|"")*+"(?!")'
_CLOSING = r'^(?:[^"]|"")*+"(?!")'


def _ends_inside(text):
    """Whether a line that starts outside of quotes ends inside. A quote opens at the start of a field only."""
    return F.regexp_replace(text, _QUOTED, "$1").rlike('(^|,)"')


def _states(rows, before):
    """Columns for rows in order, each of which either sets the state (``sets`` 0 or 1) or keeps or flips it.

    ``flips``: flips so far; ``set_to``: the state after the last row that set it, less the flips up to it.
    """
    total = F.coalesce(F.sum("flip").over(before), F.lit(0))
    at = F.when(F.col("sets").isNotNull(), F.pmod(F.col("sets") + total, F.lit(2)))
    return rows.withColumn("flips", total).withColumn("_at", at).withColumn(
        "set_to", F.last("_at", ignorenulls=True).over(before)).drop("_at")


def _read_split(spark, path):
    """Records of CSV files that are read in pieces.

    The lines are stored with their piece once, so that all further steps see the same pieces. A line is told by
    what it does to the quotes: one that starts outside and one that starts inside each end outside or inside. Each
    piece sums that up, so every piece knows how it starts. Most records are one line; only the lines of the others
    are put together, within their piece and, for the few that cross, over pieces.
    """
    earlier = Window.unboundedPreceding
    out = _ends_inside(F.col("value"))
    # After the closing quote the rest of the line is within a record: a quote at its start opens nothing.
    closes = F.col("value").rlike(_CLOSING)
    inside = ~closes | _ends_inside(F.concat(F.lit("x"), F.regexp_replace("value", _CLOSING, "")))
    lines = durable(
        spark.read.option("lineSep", "\n").text(path).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("piece"),
            F.monotonically_increasing_id().alias("line"), "value",
            F.when(out == inside, out.cast("int")).alias("sets"), (out & ~inside).cast("int").alias("flip")))
    in_piece = Window.partitionBy("file", "piece").orderBy("line")
    placed = _states(lines, in_piece.rowsBetween(earlier, -1)).withColumn(
        "first", F.lag("line").over(in_piece).isNull())
    ends = placed.groupBy("file", "piece").agg(
        F.max_by(F.struct("sets", "flip", "flips", "set_to"), "line").alias("end"))
    after = F.coalesce("end.sets", F.pmod(F.col("end.set_to") + F.col("end.flips") + F.col("end.flip"), F.lit(2)))
    by_piece = Window.partitionBy("file").orderBy("piece").rowsBetween(earlier, -1)
    pieces = _states(ends.select(
        "file", "piece", after.alias("sets"),
        F.when(after.isNull(), F.pmod(F.col("end.flips") + F.col("end.flip"), F.lit(2))).otherwise(0).alias("flip")),
        by_piece).select(
            "file", "piece", F.pmod(F.coalesce("set_to", F.lit(0)) + F.col("flips"), F.lit(2)).alias("start"))
    pieces = durable(pieces)
    if is_small(pieces):
        pieces = F.broadcast(pieces)
    starts = F.pmod(F.coalesce("set_to", "start") + F.col("flips"), F.lit(2))
    ends_at = F.coalesce("sets", F.pmod(F.col("starts") + F.col("flip"), F.lit(2)))
    placed = placed.join(pieces, ["file", "piece"]).withColumn("starts", starts).select(
        "file", "piece", "line", "value", (F.col("starts") == 1).alias("inside"),
        (ends_at != F.col("starts")).alias("turns"),
        ((F.col("piece") == 0) & F.col("first")).alias("header"))
    whole = placed.filter("not inside and not turns").select(F.col("value").alias("text"), "header")

    def joined(columns):
        in_order = F.sort_array(F.collect_list(F.struct(*columns)))
        return F.array_join(F.transform(in_order, lambda row: row[columns[-1]]), "\n")

    opens = (F.col("turns") & ~F.col("inside")).cast("int")
    fragments = (
        placed.filter("inside or turns")
        .withColumn("record", F.sum(opens).over(in_piece.rowsBetween(earlier, 0)))
        .groupBy("file", "piece", "record")
        .agg(
            F.bool_or("header").alias("header"),
            F.bool_or(F.col("inside") & F.col("turns")).alias("closed"),
            joined(["line", "value"]).alias("text")))
    inner = fragments.filter("record > 0 and closed").select("text", "header")
    # Record 0 of a piece goes on with the record the pieces before left open.
    in_file = Window.partitionBy("file").orderBy("piece", "record").rowsBetween(earlier, 0)
    crossing = (
        fragments.filter("record = 0 or not closed")
        .withColumn("owner", F.sum((F.col("record") > 0).cast("int")).over(in_file))
        .groupBy("file", "owner")
        .agg(joined(["piece", "record", "text"]).alias("text"), F.bool_or("header").alias("header"))
        .select("text", "header"))
    records = whole.unionByName(inner).unionByName(crossing)

    tweet = F.from_csv(
        F.regexp_replace("text", r"\r\z", ""), RAW_TWEET.simpleString()[7:-1].replace(":", " "),
        {name: value for name, value in CSV_OPTIONS.items() if name in ("quote", "escape")})
    return records.filter("not header and text <> ''").select(tweet.alias("tweet")).select("tweet.*")
