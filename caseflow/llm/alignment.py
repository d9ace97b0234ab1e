"""Alignment of two tokenizers by merge-path partitioning of their token ends.

Each text is encoded by A (byte-level BPE, with a space in front) and B (pieces, which put that space themselves). Both give
the ends of their tokens in bytes. The texts of a slice stand one after the other, so both lists of ends are sorted, and merging
them finds where tokens of both end. The merge is divided along diagonals: for each multiple of ``PIECE`` a binary search
finds how many of the first so many merged ends come from A and from B. The pieces between are equal work, whatever texts they
hold, and each emits the ends it finds in both lists. An end whose two copies lie in two pieces shows at their boundary, where it
is added; so the groups that boundaries cut come together again. Neither tokenizer can begin within a text, so a text
is encoded whole by one task, and merging, a small part of the work, is done where its tokens are.

Within a group each A token is linked to each B token. How many documents link two ids is counted over all documents. The counts
of the most frequent pairs (at most ``FREQUENT``) travel to the documents by broadcast, the others are joined by shuffle; the
list changes the plan, never a result. Pairs are kept as the distinct ones of a document with their frequency, and those of a
large group are counted by distinct ids, so memory follows the distinct pairs of the documents in a slice.

Defined cases: a text that is null, empty, or not restored exactly by both tokenizers' bytes has no tokens: zeros and an empty
digest; special strings inside texts are plain text; rows that repeat an id are documents each; a text of any length is read
whole; an empty table gives an empty result; other columns are not read.
"""

import hashlib
import json
import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from caseflow.llm.common import slices, store, texts
from caseflow.llm.token_counts import ROW_BITS, load_tokenizer

A_VOCABULARY = "byte_bpe_50k.json"
B_VOCABULARY = "piece_bpe_32k.model"
PIECE = 1 << 16
FREQUENT = 500_000
SLICE = 1 << 20
# An A id takes 16 bits of a pair, a B id 15.
B_BITS = 15
PAIR_BITS = 31
# Groups with more links than this are counted by distinct ids.
LARGE = 4096


def byte_letters():
    """The character that stands for each byte in byte-level vocabularies: printable bytes stand for themselves, the
    others follow from code point 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


class Vocabulary:
    """The bytes of each id, one after the other, and where they begin. Ids have to fit into their bits of a pair."""

    def __init__(self, pieces, bits):
        if len(pieces) > 1 << bits:
            raise ValueError(f"the vocabulary has {len(pieces)} ids, more than {1 << bits}")
        self.sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)])
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def spell(self, ids):
        """The joined bytes of the ids."""
        sizes = self.sizes[ids]
        before = np.cumsum(sizes) - sizes
        return self.bytes[np.repeat(self.begin[ids] - before, sizes) + np.arange(int(sizes.sum()))]


class ByteEncoder:
    """A's ids of texts. Where the vocabulary is a plain byte-level BPE whose ids follow its merges, texts of Latin letters are
    encoded by its ranks, which is four times as fast and gives the same ids; all others by the tokenizer itself."""

    # Letters whose class no version of Unicode changes, and no run of white space that a pattern goes back over at length.
    SAFE = re.compile("[^\0-\u024f]|\\s{500}")

    def __init__(self, vocabulary):
        self.tokenizer = load_tokenizer(vocabulary)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        self.pieces = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            self.pieces[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.ranks = None
        said = json.loads(self.tokenizer.to_str())
        model, cut = said["model"], said["pre_tokenizer"] or {}
        plain = (
            said["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
            and not cut["add_prefix_space"] and model["type"] == "BPE" and not model["dropout"]
            and not model.get("ignore_merges"))
        if plain:
            merged = ["".join(merge) if isinstance(merge, list) else merge.replace(" ", "") for merge in model["merges"]]
            if all(model["vocab"].get(token) == 256 + i for i, token in enumerate(merged)):
                self.ranks = tiktoken.Encoding(
                    "ranks", pat_str=public_tokenizers.PATTERN, special_tokens={},
                    mergeable_ranks={self.pieces[i]: i for i in range(256 + len(merged))})

    def encode(self, texts_):
        ids = [None if self.ranks is None or self.SAFE.search(text) else self.ranks.encode_ordinary(text) for text in texts_]
        others = [i for i, found in enumerate(ids) if found is None]
        coded = self.tokenizer.encode_batch_fast([texts_[i] for i in others], add_special_tokens=False)
        for i, one in zip(others, coded):
            ids[i] = one.ids
        return ids


def load_a(vocabulary=A_VOCABULARY):
    encoder = ByteEncoder(vocabulary)
    return encoder, Vocabulary(encoder.pieces, PAIR_BITS - B_BITS)


def load_b(vocabulary=B_VOCABULARY):
    from sentencepiece import SentencePieceProcessor

    path = vocabulary if os.path.sep in vocabulary else public_tokenizers.path(vocabulary)
    model = SentencePieceProcessor(model_file=str(path))
    pieces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
        pieces.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
    return model, Vocabulary(pieces, B_BITS)


def diagonal(a, b, n):
    """How many of the first ``n`` ends of the merge of ``a`` and ``b`` come from ``a``; of equal ends that of ``a`` is first."""
    low, high = max(0, n - len(b)), min(n, len(a))
    while low < high:
        middle = (low + high) // 2
        if a[middle] <= b[n - middle - 1]:
            low = middle + 1
        else:
            high = middle
    return low


def common_ends(a, b, piece=PIECE):
    """The ends that both sorted lists hold, found in pieces of equal work."""
    total = len(a) + len(b)
    cuts = [(n_a, n - n_a) for n in range(piece, total, piece) for n_a in (diagonal(a, b, n),)]
    cuts = [(0, 0), *cuts, (len(a), len(b))]
    found = []
    for (a_from, b_from), (a_to, b_to) in zip(cuts, cuts[1:]):
        # Both copies of an end may lie on the two sides of this piece's first diagonal.
        if a_from and b_from < len(b) and a[a_from - 1] == b[b_from]:
            found.append(b[b_from:b_from + 1])
        mine, others = a[a_from:a_to], b[b_from:b_to]
        if len(mine) and len(others):
            at = np.minimum(np.searchsorted(others, mine), len(others) - 1)
            found.append(mine[others[at] == mine])
    return np.concatenate(found) if found else np.empty(0, np.int64)


# Decimal digits of each possible id, and how many there are.
_IDS = np.arange(1 << 16)
_WIDTH = 1 + sum((_IDS >= 10 ** n).astype(np.int64) for n in range(1, 5))
_DIGITS = np.zeros((1 << 16, 6), np.uint8)
for _place in range(5):
    _inside = _place < _WIDTH
    _DIGITS[_inside, _place] = 48 + _IDS[_inside] // 10 ** (_WIDTH[_inside] - 1 - _place) % 10


def spelled_groups(ids, marks):
    """(text of the ids, each followed by its mark; where each begins). A mark of 0 is none."""
    cells = _DIGITS[ids]
    width = _WIDTH[ids]
    cells[np.arange(len(ids)), width] = marks
    size = width + (marks != 0)
    return cells[np.arange(6) < size[:, None]].tobytes(), np.concatenate([[0], np.cumsum(size)])


def linked_pairs(a_ids, b_ids, a_count, b_count, doc_of_group):
    """(document << PAIR_BITS | pair, frequency): the links of all groups, each distinct pair of a document once."""
    links = a_count * b_count
    a_from, b_from = np.cumsum(a_count) - a_count, np.cumsum(b_count) - b_count
    small = np.flatnonzero(links <= LARGE)
    n = links[small]
    group = np.repeat(small, n)
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    of_a, of_b = np.divmod(place, b_count[group])
    keys = [(doc_of_group[group] << PAIR_BITS) + (a_ids[a_from[group] + of_a] << B_BITS) + b_ids[b_from[group] + of_b]]
    pairs, times = np.unique(keys[0], return_counts=True)
    if len(small) == len(links):
        return pairs, times
    keys, counts = [pairs], [times]
    for g in np.flatnonzero(links > LARGE).tolist():
        a, many_a = np.unique(a_ids[a_from[g]:a_from[g] + a_count[g]], return_counts=True)
        b, many_b = np.unique(b_ids[b_from[g]:b_from[g] + b_count[g]], return_counts=True)
        keys.append(((doc_of_group[g] << PAIR_BITS) + (a[:, None] << B_BITS) + b).ravel())
        counts.append((many_a[:, None] * many_b).ravel())
    pairs, at = np.unique(np.concatenate(keys), return_inverse=True)
    return pairs, np.bincount(at, np.concatenate(counts)).astype(np.int64)


def align(texts_, a, b, piece=PIECE):
    """Per text: (n_a, n_b, n_groups, n_links, digest), and the distinct pairs: (begins, pairs, frequencies)."""
    n = len(texts_)
    encoder, a_bytes = a
    model, b_bytes = b
    full = [i for i, text in enumerate(texts_) if text]
    coded_a = encoder.encode([" " + texts_[i] for i in full])
    coded_b = model.encode([texts_[i] for i in full], num_threads=1)
    docs, a_lists, b_lists = [], [], []
    for i, a_ids, b_ids in zip(full, coded_a, coded_b):
        a_ids, b_ids = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        text = (" " + texts_[i]).encode()
        if a_bytes.spell(a_ids).tobytes() == text and b_bytes.spell(b_ids).tobytes() == text:
            docs.append(i)
            a_lists.append(a_ids)
            b_lists.append(b_ids)
    counts = np.zeros((4, n), np.int64)
    digests = [""] * n
    if not docs:
        return counts, digests, np.zeros(n + 1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    docs = np.array(docs)
    a_ids, b_ids = np.concatenate(a_lists), np.concatenate(b_lists)
    counts[0, docs], counts[1, docs] = list(map(len, a_lists)), list(map(len, b_lists))
    a_ends, b_ends = np.cumsum(a_bytes.sizes[a_ids]), np.cumsum(b_bytes.sizes[b_ids])
    ends = common_ends(a_ends, b_ends, piece)
    a_group, b_group = np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends)
    a_count, b_count = np.bincount(a_group, minlength=len(ends)), np.bincount(b_group, minlength=len(ends))
    # A text ends where both its last tokens end.
    last = np.searchsorted(ends, a_ends[np.cumsum(counts[0, docs]) - 1])
    groups = np.diff(last, prepend=-1)
    counts[2, docs] = groups
    doc_of_group = np.repeat(docs, groups)
    counts[3] = np.bincount(doc_of_group, a_count * b_count, n).astype(np.int64)
    # Ids in the order of their groups, A before B, each with the mark after it.
    total = len(a_ids) + len(b_ids)
    ids, marks = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
    a_before, b_before = np.cumsum(a_count), np.cumsum(b_count)
    ids[np.arange(len(a_ids)) + (b_before - b_count)[a_group]] = a_ids
    ids[np.arange(len(b_ids)) + a_before[b_group]] = b_ids
    marks[a_before + b_before - b_count - 1] = ord("|")
    group_ends = a_before + b_before - 1
    marks[group_ends] = ord(";")
    marks[group_ends[last]] = 0
    spelled, begin = spelled_groups(ids, marks)
    doc_ends = begin[group_ends[last] + 1].tolist()
    for doc, start, end in zip(docs.tolist(), [0, *doc_ends], doc_ends):
        digests[doc] = hashlib.sha256(memoryview(spelled)[start:end]).hexdigest()
    keys, times = linked_pairs(a_ids, b_ids, a_count, b_count, doc_of_group)
    begins = np.searchsorted(keys, np.arange(n + 1) << PAIR_BITS)
    return counts, digests, begins, keys & ((1 << PAIR_BITS) - 1), times


def aligned_documents(docs: DataFrame, a_vocabulary=A_VOCABULARY, b_vocabulary=B_VOCABULARY, piece=PIECE) -> DataFrame:
    """Per document: row (unique), doc_id, its counts and digest, and its distinct pairs with their frequencies."""
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def read(batches):
        a, b = load_a(a_vocabulary), load_b(b_vocabulary)
        row = TaskContext.get().partitionId() << ROW_BITS
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                n = part.num_rows
                counts, digests, begins, pairs, times = align(part.column("text").to_pylist(), a, b, piece)
                begins = pa.array(begins.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + n)), part.column("doc_id"), *map(pa.array, counts), pa.array(digests),
                    pa.ListArray.from_arrays(begins, pa.array(pairs.astype(np.int32))),
                    pa.ListArray.from_arrays(begins, pa.array(times))], names)
                row += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(read, (
        f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<int>, times array<long>"))


def align_tokens(docs: DataFrame, a_vocabulary=A_VOCABULARY, b_vocabulary=B_VOCABULARY, frequent=FREQUENT, piece=PIECE,
                 doc_id="doc_id", text="text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = store(aligned_documents(texts(docs, doc_id, text), a_vocabulary, b_vocabulary, piece))
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = store(counts)
    # One row per A id: its highest count.
    of_a = F.shiftright("pair", B_BITS)
    highest = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("most"))
    counts = store(counts.withColumn("a", of_a).join(F.broadcast(highest), "a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")))
    # At most ``frequent`` rows of two integers and a truth value.
    listed = counts.orderBy(F.desc("n"), "pair").limit(frequent).toArrow().sort_by("pair")
    known = docs.sparkSession.sparkContext.broadcast(tuple(
        listed[name].to_numpy() for name in ("pair", "n", "best")))

    def sums(batches):
        pair, n, best = known.value
        for batch in batches:
            pairs, times = (batch.column(name).flatten().to_numpy() for name in ("pairs", "times"))
            size = np.diff(batch.column("pairs").offsets.to_numpy())
            of = np.repeat(np.arange(batch.num_rows), size)
            at = np.minimum(np.searchsorted(pair, pairs), len(pair) - 1) if len(pair) else np.zeros(len(pairs), np.int64)
            hit = pair[at] == pairs if len(pair) else np.zeros(len(pairs), bool)
            at = at[hit]
            best_here = np.zeros(len(pairs), np.int64)
            sum_here = np.zeros(len(pairs), np.int64)
            best_here[hit], sum_here[hit] = times[hit] * best[at], times[hit] * n[at]
            total = [np.concatenate([[0], np.cumsum(x)]) for x in (best_here, sum_here)]
            ends = np.concatenate([[0], np.cumsum(size)])
            rest = np.bincount(of[~hit], minlength=batch.num_rows)
            begins = pa.array(np.concatenate([[0], np.cumsum(rest)]).astype(np.int32))
            others = pa.StructArray.from_arrays(
                [pa.array(pairs[~hit]), pa.array(times[~hit])], names=["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(np.diff(x[ends])) for x in total),
                 pa.ListArray.from_arrays(begins, others)], ["row", "n_best", "count_sum", "rest"])

    summed = store(rows.select("row", "pairs", "times").mapInArrow(
        sums, "row long, n_best long, count_sum long, rest array<struct<pair:int,times:long>>"))
    rest = summed.select("row", F.explode("rest").alias("one")).select("row", "one.pair", "one.times").join(counts, "pair")
    both = summed.select("row", "n_best", "count_sum").unionByName(rest.select(
        "row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
        (F.col("times") * F.col("n")).alias("count_sum")))
    totals = both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(totals, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
