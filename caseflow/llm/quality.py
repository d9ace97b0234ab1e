"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

The model runs over the characters of each word (four at a time, with marks for the start and end of a word; a word equal to
the one before it is written as one mark for "again"). Counts of all trusted text, discounts, continuation
counts and the probability of every n-gram that any document holds are tables that grow with the corpus and are
joined by n-gram. A document's perplexity is the sum over its n-grams: those of the most frequent n-grams (a list of bounded
length) are known in place, the rarer ones are joined by shuffle.

What crosses word borders is scored next to it. Every pair of neighbouring words (the first word with a mark before it) of
trusted text is counted, and a pair's gain is what the word before it makes a word likelier: the log of its interpolated
probability over its frequency. A text whose words are shuffled gains less. A word is fresh unless it and the two before it stand
earlier in the text in the same order; a phrase without end leaves few fresh words, whatever its length.

A document is rejected when its perplexity leaves the fence of its language, its mean gain falls below its fence, or the
log of its words over its fresh words rises above its fence. The fence of the perplexity is the median plus or minus ``width`` times the
distance of the 95th and 5th percentile from it, over trusted documents kept out of the counts; a fence from ``n`` documents
is wider by 1/sqrt(n) nats per character. A text of few characters says little, so perplexity is drawn to the
median by ``weight`` characters of average surprise, the gain by FEW_WORDS words of average gain, and the fresh words are
taken as FEW_WORDS more. The other two fences are made alike, on their one side.

Defined cases: a null or empty text has no perplexity and is not rejected; a language without calibration
documents, or a null one, takes the fence of all languages; without any trusted text nothing is rejected; rows that
repeat an id are scored each; an id with conflicting labels is not trusted; characters beyond 16 bits count as one
character; an empty table gives an empty result; other columns are not read.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from caseflow.llm.common import (
    BATCH_BYTES, BROADCAST_IDS, hot_keys, settings, slices, spread_join, store, texts, used_up, words_of)
from caseflow.llm.token_counts import ROW_BITS

ORDER = 4
FREQUENT_GRAMS = 500_000
# Text handled at once inside a task: its n-grams take many times its bytes.
GRAM_BYTES = 1 << 20
START, END, AGAIN = "\x02", "\x03", "\x04"
MASKS = [(1 << 16 * order) - 1 for order in range(5)]
# Words that stand before a word for it and them to be a phrase.
BEFORE = 2
FEW_WORDS = 30
# Share of a word's probability that its pair has, the rest has its frequency.
PAIRED = 0.5
UNPAIRED = float(np.log(1 - PAIRED))
# Bits of the filter of known pairs. A full one lets pairs pass that no trusted text holds, and the join leaves them out.
FILTER_BITS = 27
# Least half widths of the fences, in nats: of the gain per word, of words over fresh words.
GAIN_SLACK, AGAIN_SLACK = 0.15, 0.5
# Every 5th trusted document calibrates the fences and is not counted.
FOLDS = 5
# Pairs are counted and joined in so many ranges of their numbers, and documents judged in so many parts, one after the
# other: what a round shuffles and stores goes with its end.
PAIR_RANGES = 3
JUDGED_PARTS = 2


def word_grams(words):
    """(4-gram, word number) for each character and the end of each word; a 4-gram is 16 bits a character."""
    words = pa.array(words, pa.large_string()) if isinstance(words, list) else words.cast(pa.large_string())
    n = len(words)
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + n + 1] if n else np.zeros(1, np.int64)
    data = (words.buffers()[2] or b"")[ends[0]:ends[-1]] if n else b""
    chars = np.frombuffer(bytes(data).decode().encode("utf-32-le"), np.uint32)
    size = pc.utf8_length(words).to_numpy().astype(np.int64) if n else np.zeros(0, np.int64)
    # Each word has its marks around it: ORDER - 1 before, one after.
    marked = np.full(len(chars) + ORDER * n, ord(START), np.uint64)
    grams = size + 1
    number = np.arange(n)
    marked[np.arange(len(chars)) + np.repeat(number * ORDER + ORDER - 1, size)] = np.minimum(chars, 0xFFFF)
    marked[np.cumsum(size) + number * ORDER + ORDER - 1] = ord(END)
    word = np.repeat(number, grams)
    last = np.arange(len(word)) + (word + 1) * (ORDER - 1)
    packed = marked[last]
    for back in range(1, ORDER):
        packed |= marked[last - back] << np.uint64(16 * back)
    return packed.view(np.int64), word


def part_grams(split):
    """4-grams of the words of a slice of documents: (distinct 4-grams, their number per gram of a word, the word of that gram,
    number of words, word code of each occurrence, row of each occurrence)."""
    distinct, codes, rows = split
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (rows[1:] == rows[:-1])
    codes = np.where(again, len(distinct), codes)
    words = pa.concat_arrays([distinct, pa.array([AGAIN], distinct.type)])
    grams, word = word_grams(words)
    coded = pa.array(grams).dictionary_encode()
    unique, number = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    return unique, number, word, len(words), codes, rows


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_number(before, words):
    return _mix(_mix(before + np.uint64(1)) + words).view(np.int64)


def word_hashes(distinct):
    """A 64-bit hash of each word: the mixed sum of its mixed bytes and their places."""
    np.seterr(over="ignore")
    large = distinct.cast(pa.large_string())
    if not len(large):
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(large.buffers()[1], np.int64)[large.offset:large.offset + len(large) + 1]
    length, start = np.diff(ends), ends - ends[0]
    data = np.frombuffer(large.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]].astype(np.uint64)
    place = (np.arange(len(data)) - np.repeat(start[:-1], length)).astype(np.uint64)
    mixed = _mix((data + (place << np.uint64(8)) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed)])
    return _mix(sums[start[1:]] - sums[start[:-1]] + length.astype(np.uint64))


def part_pairs(distinct, codes, rows):
    """(64-bit pair, hash of the word before or 0, hash of the word) of each word of a slice."""
    words = word_hashes(distinct)[codes]
    before = np.zeros(len(words), np.uint64)
    inside = rows[1:] == rows[:-1]
    before[1:][inside] = words[:-1][inside]
    return pair_number(before, words), before.view(np.int64), words.view(np.int64)


def pair_range(pair, ranges):
    """The range that a pair is counted and joined in."""
    return (pair.view(np.uint64) >> np.uint64(32)) % np.uint64(ranges)


def fresh_words(words, rows, n):
    """Per row the words that do not stand earlier in it after the same BEFORE words."""
    runs = words.view(np.uint64)
    for back in range(1, BEFORE + 1):
        runs = _mix(runs + np.uint64(back))
        runs[back:] += words.view(np.uint64)[:-back]
    # The first words of a row have no run of this length, and are fresh.
    whole = np.flatnonzero(np.arange(len(rows)) - np.searchsorted(rows, rows) >= BEFORE)
    of_row, run = rows[whole], runs[whole]
    run = _mix(run + _mix(of_row.astype(np.uint64)))
    order = np.argsort(run)
    again = run[order[1:]] == run[order[:-1]]
    return np.bincount(rows, minlength=n) - np.bincount(of_row[order[1:]][again], minlength=n)


def count_pairs(docs: DataFrame, at=0, ranges=1) -> DataFrame:
    """(a, b, c): how often word b stands after a in trusted text, for the pairs of range ``at``; in range 0 also rows without
    b, how often a stands there at all."""
    def count(batches):
        for batch in batches:
            for part in slices(batch, limit=GRAM_BYTES):
                pair, a, b = part_pairs(*words_of(part.column("text")))
                here = np.flatnonzero(pair_range(pair, ranges) == at)
                _, first, c = np.unique(pair[here], return_index=True, return_counts=True)
                first = here[first]
                order = np.argsort(a[first])
                first, c = first[order], c[order]
                yield pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(c)], ["a", "b", "c"])
                if at == 0:
                    # The mark before the first word stands once a text.
                    word, n = np.unique(np.concatenate([a[a == 0], b]), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(word), pa.nulls(len(word), pa.int64()), pa.array(n)], ["a", "b", "c"])

    return docs.filter("trusted").select("text").mapInArrow(count, "a long, b long, c long").groupBy("a", "b").agg(
        F.sum("c").alias("c"))


def count_words(counts: DataFrame, frequent=FREQUENT_GRAMS):
    """(stored table of w and n, number of words in trusted text, broadcast list of the most frequent ones, whether it has all)."""
    words = store(counts.filter("b IS NULL").select(F.col("a").alias("w"), F.col("c").alias("n")))
    total = words.filter("w <> 0").agg(F.sum("n")).first()[0] or 1
    listed = _listed(words.select("w", F.col("n").alias("value"), "n"), frequent)
    return words, total, words.sparkSession.sparkContext.broadcast(listed), words.count() <= frequent


def pair_gains(counts: DataFrame, frequent=FREQUENT_GRAMS, words=None) -> DataFrame:
    """(k, gain, c) of every pair of trusted text under its 64-bit number; any other pair gains ln(1 - PAIRED)."""
    words, total, listed, whole = words or count_words(counts, frequent)

    def number(batches, listed_only):
        np.seterr(over="ignore")
        keys, values = listed.value
        for batch in batches:
            a, b, c = (column.to_numpy() for column in batch.columns)
            (at_a, found_a), (at_b, found_b) = look_up(keys, a), look_up(keys, b)
            rows = np.flatnonzero((found_a & found_b) == listed_only)
            k = pair_number(a[rows].view(np.uint64), b[rows].view(np.uint64))
            sides = [values[at_a[rows]], values[at_b[rows]]] if listed_only and len(keys) else [a[rows], b[rows]]
            names = ["k", "ca", "cb", "c"] if listed_only else ["k", "a", "b", "c"]
            yield pa.RecordBatch.from_arrays([pa.array(k), *map(pa.array, sides), pa.array(c[rows])], names)

    pairs = counts.filter("b IS NOT NULL").select("a", "b", "c")
    joined = pairs.mapInArrow(lambda batches: number(batches, True), "k long, ca long, cb long, c long")
    if not whole:
        # The pairs of a word that is not listed are few.
        rarer = pairs.mapInArrow(lambda batches: number(batches, False), "k long, a long, b long, c long")
        for side in ("a", "b"):
            every = words.select(F.col("w").alias(side), F.col("n").alias(f"c{side}"))
            rarer = spread_join(rarer, every, side, hot_keys(every, side, f"c{side}"))
        joined = joined.unionByName(rarer.drop("a", "b"))
    ratio = F.col("c") * F.lit(float(total)) / (F.col("ca").cast("double") * F.col("cb"))
    return joined.select("k", F.log(PAIRED * ratio + (1 - PAIRED)).alias("gain"), "c")


def count_grams(docs: DataFrame) -> DataFrame:
    """(g, trusted, n): how often each 4-gram stands in trusted text, and in all text."""
    def count(batches):
        for batch in batches:
            for part in slices(batch, limit=GRAM_BYTES):
                unique, number, word, words, codes, rows = part_grams(words_of(part.column("text")))
                trusted = part.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
                columns = []
                for weights in (trusted[rows], None):
                    per_word = np.bincount(codes, weights, words)
                    columns.append(np.bincount(number, per_word[word], len(unique)).astype(np.int64))
                seen = columns[1] > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unique[seen]), *(pa.array(c[seen]) for c in columns)], ["g", "trusted", "n"])

    return docs.select("text", "trusted").mapInArrow(count, "g long, trusted long, n long").groupBy("g").agg(
        F.sum("trusted").alias("trusted"), F.sum("n").alias("n"))


def _listed(table, frequent):
    """The most frequent keys and their values, in order of the keys: at most ``frequent``, of equally frequent ones all or none.
    Nothing but the numbers of rows by frequency is shuffled for it."""
    key, value, n = table.columns
    least, rows = None, 0
    for size, count in table.groupBy(n).count().orderBy(F.desc(n)).collect():
        rows += count
        if rows > frequent:
            break
        least = size
    listed = table.filter(F.lit(False) if least is None else F.col(n) >= least).select(key, value).toArrow()
    keys, values = (listed[c].to_numpy() for c in (key, value))
    order = np.argsort(keys)
    return keys[order], values[order]


def look_up(keys, wanted):
    """(place in the sorted keys, whether it is there) of each value; places are right where it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    # Values in order are looked up several times faster.
    order = np.argsort(wanted)
    at = np.empty(len(wanted), np.int64)
    at[order] = np.minimum(np.searchsorted(keys, wanted[order]), len(keys) - 1)
    return at, keys[at] == wanted


def pair_filter(gains: DataFrame):
    """Bits set at the known pairs, in 64-bit words: what is not set is not known."""
    bit = F.col("k").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    # Stored, so that the shuffle goes before documents are judged.
    stored = store(gains.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(k & 63 as int))")).alias("bits")))
    set_bits = stored.toArrow()
    used_up(stored)
    bits = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    bits[set_bits["word"].to_numpy()] = set_bits["bits"].to_numpy().view(np.uint64)
    return bits


def _lists(of_row, n, **values):
    """One list of structs per row, from values in order of the rows."""
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(of_row, np.arange(n + 1)).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(v.astype(np.int64)) for v in values.values()], list(values)))


def part_gains(part, split, known, bits, ranges=1):
    """Per document of a slice: (words, fresh words, gain by the known list, for each range a list of pairs that may be known
    besides)."""
    n = part.num_rows
    keys, values = known
    distinct, codes, rows = split
    pair, _, words = part_pairs(distinct, codes, rows)
    place = pair & ((1 << FILTER_BITS) - 1)
    maybe = bits[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1) == 1
    # Trusted text holds its own pairs, which says nothing about it.
    judged = ~part.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
    left = np.flatnonzero(maybe & judged[rows])
    at, found = look_up(keys, pair[left])
    gain = np.full(len(pair), UNPAIRED)
    gain[left[found]] = values[at[found]]
    left = left[~found]
    left = left[np.lexsort((pair[left], rows[left]))]
    some, own = pair[left], rows[left]
    start = np.flatnonzero(np.r_[len(left) > 0, (some[1:] != some[:-1]) | (own[1:] != own[:-1])][:len(left)])
    f = np.diff(np.r_[start, len(left)])
    some, own = some[start], own[start]
    of = pair_range(some, ranges)
    sums = np.bincount(rows, gain, n)
    return (np.bincount(rows, minlength=n), fresh_words(words, rows, n), pa.array(sums, mask=~judged),
            [_lists(own[of == r], n, g=some[of == r], f=f[of == r]) for r in range(ranges)])


def discounts(tables):
    """Modified Kneser-Ney discounts per order from the counts of counts: {order: [D1, D2, D3+]}."""
    counted = reduce(DataFrame.unionByName, (
        table.select(F.lit(order).alias("order"), *(
            F.sum((F.col("c") == k).cast("long")).alias(f"n{k}") for k in range(1, 5)))
        for order, table in tables.items()))
    found = {}
    for row in counted.collect():
        n = [row[f"n{k}"] or 0 for k in range(1, 5)]
        y = n[0] / max(1, n[0] + 2 * n[1])
        found[row["order"]] = [
            min(k - 0.1, max(0.1, k - (k + 1) * y * n[k] / n[k - 1])) if n[k - 1] else k / 2 for k in (1, 2, 3)]
    return found


def gram_surprise(grams: DataFrame) -> DataFrame:
    """(g, surprise, n): -ln P(last character | three before it) of every 4-gram, interpolated over all orders."""
    tables = {ORDER: grams.filter("trusted > 0").select(F.col("g").alias("k"), F.col("trusted").alias("c"))}
    for order in range(ORDER - 1, 0, -1):
        # Lower orders count the different characters before an n-gram, not its occurrences.
        tables[order] = store(
            tables[order + 1].groupBy(F.col("k").bitwiseAND(F.lit(MASKS[order])).alias("k"))
            .agg(F.count(F.lit(1)).alias("c")))
    off = discounts(tables)
    p = None
    for order in range(1, ORDER + 1):
        d1, d2, d3 = off[order]
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        context = F.shiftrightunsigned("k", 16)
        table = tables[order].withColumn("d", cut)
        contexts = table.groupBy(context.alias("context")).agg(
            F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("back"))
        wanted = grams.select(
            F.col("g").bitwiseAND(F.lit(MASKS[order])).alias("k") if order < ORDER else F.col("g").alias("k"))
        wanted = wanted.distinct() if order < ORDER else wanted
        # A context, and the end of an n-gram, stand in at most 2**16 of these rows.
        joined = (
            wanted.join(table, "k", "left").withColumn("context", context)
            .join(contexts, "context", "left")
            .withColumn("own", F.coalesce((F.col("c") - F.col("d")) / F.col("total"), F.lit(0.0)))
            .withColumn("back", F.coalesce("back", F.lit(1.0))).select("k", "own", "back"))
        if p is None:
            p = joined.select("k", (F.col("own") + F.col("back") / 65536).alias("p"))
        else:
            lower = p.select(F.col("k").alias("low"), F.col("p").alias("lower"))
            p = (
                joined.withColumn("low", F.col("k").bitwiseAND(F.lit(MASKS[order - 1])))
                .join(lower, "low").select("k", (F.col("own") + F.col("back") * F.col("lower")).alias("p")))
        if order < ORDER:
            p = store(p)
    return grams.join(p.withColumnRenamed("k", "g"), "g").select("g", (-F.log("p")).alias("surprise"), "n")


def _sum_known(docs, known, known_pairs, at=0, parts=1, ranges=1):
    def add(batches):
        keys, values = known.value
        pairs_listed, bits = known_pairs.value
        row = TaskContext.get().partitionId() * parts + at << ROW_BITS
        for batch in batches:
            for part in slices(batch, limit=GRAM_BYTES):
                n = part.num_rows
                split = words_of(part.column("text"))
                unique, number, word, words, codes, rows = part_grams(split)
                listed, found = look_up(keys, unique)
                value = np.zeros(len(unique))
                value[found] = values[listed[found]]
                per_word = np.bincount(word, value[number], words)
                nll = np.bincount(rows, per_word[codes], n)
                chars = np.bincount(rows, np.bincount(word, minlength=words)[codes], n).astype(np.int64)
                # The rarer n-grams go with their row, once per word that holds them.
                strange = np.flatnonzero(~found[number])
                holds = np.zeros(words, bool)
                holds[word[strange]] = True
                where = np.flatnonzero(holds[codes])
                first = np.searchsorted(word[strange], codes[where])
                many = np.searchsorted(word[strange], codes[where], "right") - first
                each = strange[np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())]
                key = np.repeat(rows[where], many) * max(1, len(unique)) + number[each]
                pairs, f = np.unique(key, return_counts=True)
                of_row, code = np.divmod(pairs, max(1, len(unique)))
                lists = _lists(of_row, n, g=unique[code], f=f)
                said, fresh, gain, pair_lists = part_gains(part, split, pairs_listed, bits, ranges)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), part.column("doc_id"), part.column("lang"),
                     pa.array(chars), pa.array(nll), lists, pa.array(said), pa.array(fresh), gain, *pair_lists],
                    ["row", "doc_id", "lang", "chars", "known", "rest", "words", "fresh", "gained", *of_ranges])
                row += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    of_ranges = [f"pairs{r}" for r in range(ranges)]
    return docs.select("doc_id", "text", "lang", "trusted").mapInArrow(
        add, f"row long, doc_id {kind}, lang string, chars long, known double, rest array<struct<g:long,f:long>>, "
             "words long, fresh long, gained double" + "".join(f", {c} array<struct<g:long,f:long>>" for c in of_ranges))


def score(docs: DataFrame, trusted_ids: DataFrame, frequent=FREQUENT_GRAMS) -> DataFrame:
    """(row, doc_id, lang, chars, nll, words, fresh, gain, calibrates) per document; trusted text has no gain; ``docs`` has doc_id, text and lang."""
    marks = store(trusted_ids.select(
        F.col("doc_id").alias("_id"),
        (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == 0).alias("calibrates")))
    # A checked list is broadcast; a longer one is joined by shuffle.
    side = F.broadcast(marks) if marks.count() <= BROADCAST_IDS else marks
    flagged = docs.join(side, docs["doc_id"] == side["_id"], "left").select(
        "doc_id", "text", "lang", F.coalesce(~F.col("calibrates"), F.lit(False)).alias("trusted"))
    grams = store(count_grams(flagged))
    surprise = store(gram_surprise(grams))
    used_up(grams)
    gains, words = [], None
    for r in range(PAIR_RANGES):
        counts = store(count_pairs(flagged, r, PAIR_RANGES))
        words = words or count_words(counts, frequent)
        gains.append(store(pair_gains(counts, frequent, words)))
        used_up(counts)
    used_up(words[0])
    every = reduce(DataFrame.unionByName, gains)
    context = docs.sparkSession.sparkContext
    known = context.broadcast(_listed(surprise, frequent))
    known_pairs = context.broadcast((_listed(every, frequent), pair_filter(every)))

    def rarer(rows, lists, table, value, name):
        return (
            rows.select("row", F.explode(lists).alias("one")).select("row", "one.g", "one.f")
            .join(table, "g").groupBy("row").agg(F.sum(F.col("f") * value).alias(name)))

    scored = []
    for at in range(JUDGED_PARTS):
        part = flagged.filter(F.pmod(F.xxhash64("doc_id"), F.lit(JUDGED_PARTS)) == at)
        rows = store(_sum_known(part, known, known_pairs, at, JUDGED_PARTS, PAIR_RANGES))
        others = rarer(rows, "rest", surprise.select("g", "surprise"), F.col("surprise"), "others")
        summed = [store(rarer(
            rows, f"pairs{r}", gains[r].select(F.col("k").alias("g"), "gain"), F.col("gain") - UNPAIRED, "paired"))
            for r in range(PAIR_RANGES)]
        paired = reduce(DataFrame.unionByName, summed).groupBy("row").agg(F.sum("paired").alias("paired"))
        scored.append(store(
            rows.drop("rest", *(f"pairs{r}" for r in range(PAIR_RANGES)))
            .join(others, "row", "left").join(paired, "row", "left")
            .join(marks, F.col("doc_id") == F.col("_id"), "left")
            .select("row", "doc_id", "lang", "chars", (F.col("known") + F.coalesce("others", F.lit(0.0))).alias("nll"),
                    "words", "fresh", (F.col("gained") + F.coalesce("paired", F.lit(0.0))).alias("gain"),
                    F.coalesce("calibrates", F.lit(False)).alias("calibrates"))))
        used_up(rows, *summed)
    used_up(surprise, *gains, marks)
    return reduce(DataFrame.unionByName, scored)


def classify(docs: DataFrame, labels: DataFrame, width=4.0, slack=0.15, weight=200, frequent=FREQUENT_GRAMS,
             doc_id="doc_id", text="text", lang="lang") -> DataFrame:
    """One row per document: doc_id, lang, perplexity, low, high, rejected.

    ``labels`` has doc_id and quality; texts with quality 1 are trusted. ``slack`` is the least half
    width of a fence, in nats per character.
    """
    docs = texts(docs, doc_id, text, lang=docs[lang].cast("string"))
    trusted = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1")
    with settings(docs.sparkSession, {BATCH_BYTES: str(GRAM_BYTES)}):
        scored = score(docs, trusted, frequent)
    scored = scored.withColumn(
        "x", F.when(F.col("chars") > 0, F.col("nll") / F.col("chars"))).withColumn(
        "again", F.log((F.col("words") + FEW_WORDS) / (F.col("fresh") + FEW_WORDS)))
    calibration = scored.filter("calibrates AND x IS NOT NULL")
    at = [0.05, 0.5, 0.95]

    def per_language(table):
        # Half of the rows may have one language: a checked list is broadcast, only a longer one is joined by shuffle.
        table = store(table)
        return F.broadcast(table) if table.count() <= BROADCAST_IDS else table

    def fences(*by):
        centre = calibration.groupBy(*by).agg(
            F.percentile_approx("x", 0.5, 10_000).alias("median"),
            F.percentile_approx(F.col("gain") / F.col("words"), 0.5, 10_000).alias("usual"))
        if by:
            drawn = calibration.join(per_language(centre), list(by))
        else:
            drawn = calibration.withColumns({
                name: F.lit(value).cast("double") for name, value in centre.first().asDict().items()})
        drawn = drawn.withColumns({
            "y": (F.col("nll") + weight * F.col("median")) / (F.col("chars") + weight),
            "z": (F.col("gain") + FEW_WORDS * F.col("usual")) / (F.col("words") + FEW_WORDS)})
        return drawn.groupBy(*by).agg(F.struct(
            F.first("median").alias("median"), F.percentile_approx("y", at, 10_000).alias("q"),
            F.first("usual").alias("usual"), F.percentile_approx("z", at, 10_000).alias("gain"),
            F.percentile_approx("again", at, 10_000).alias("again"),
            F.try_divide(F.lit(1.0), F.sqrt(F.count(F.lit(1)))).alias("doubt")).alias("own"))

    # One row per language; the fence of all languages is four numbers.
    own = per_language(fences("lang").filter("lang IS NOT NULL"))
    every = fences().first()["own"]
    fenced = scored.join(own, "lang", "left").withColumn("fence", F.coalesce("own", F.struct(
        F.lit(every["median"]).cast("double").alias("median"),
        F.lit(every["q"]).cast("array<double>").alias("q"), F.lit(every["usual"]).cast("double").alias("usual"),
        F.lit(every["gain"]).cast("array<double>").alias("gain"),
        F.lit(every["again"]).cast("array<double>").alias("again"),
        F.lit(every["doubt"]).cast("double").alias("doubt"))))
    centre, low, high, doubt = *(F.col("fence.q")[i] for i in (1, 0, 2)), F.col("fence.doubt")
    fenced = fenced.withColumn(
        "y", (F.col("nll") + weight * F.col("fence.median")) / (F.col("chars") + weight)).withColumns({
            "low": centre - F.greatest(F.lit(slack), width * (centre - low)) - doubt,
            "high": centre + F.greatest(F.lit(slack), width * (high - centre)) + doubt})
    usual, least, most = F.col("fence.gain")[1], F.col("fence.gain")[0], F.col("fence.again")
    mean_gain = (F.col("gain") + FEW_WORDS * F.col("fence.usual")) / (F.col("words") + FEW_WORDS)
    shuffled = mean_gain < usual - F.greatest(F.lit(GAIN_SLACK), width * (usual - least)) - doubt
    repeats = F.col("again") > most[1] + F.greatest(F.lit(AGAIN_SLACK), width * (most[2] - most[1])) + doubt
    return fenced.select(
        "doc_id", "lang", F.exp("x").alias("perplexity"), F.exp("low").alias("low"), F.exp("high").alias("high"),
        (F.col("x").isNotNull() & (
            F.coalesce((F.col("y") < F.col("low")) | (F.col("y") > F.col("high")), F.lit(False))
            | F.coalesce(shuffled, F.lit(False)) | F.coalesce(repeats, F.lit(False)))).alias("rejected"))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id="doc_id", **options) -> DataFrame:
    """The documents not rejected, all columns. Rows that share an id go only if all of them are rejected."""
    result = classify(docs, labels, doc_id=doc_id, **options)
    gone = store(
        result.groupBy("doc_id").agg(F.every("rejected").alias("gone")).filter("gone").select(
            F.col("doc_id").alias("_id")))
    side = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(side, docs[doc_id].eqNullSafe(side["_id"]), "left_anti")
