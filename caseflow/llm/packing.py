"""Packing by Karmarkar-Karp multiway differencing.

Every document becomes token ids with an end id, cut at multiples of the window length. Pieces are dealt at random
into groups of bounded size. Within a group a full piece is a window by itself; the others start as partial partitions
with one filled window each, and the two partitions with the largest imbalance are merged again and again, fullest
windows upon emptiest, until one partition is left. Where a window of it holds more than fits, the window count rises
and the group is packed anew.

Pieces are numbered in the order in which their task reads them, so the input should come in the same order when a task
runs again, as files do; store the result of a shuffle first.

Defined cases: a null or empty text is the end id alone; rows that repeat an id are packed each; a text of any length
is cut into windows; an empty table gives an empty result; other columns are not read.
"""

import heapq
import math
import zlib
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from caseflow.llm.common import BATCH_BYTES, settings, slices, store, texts
from caseflow.llm.token_counts import (
    ENCODE_AT_ONCE, FREQUENT_BYTES, ROW_BITS, VOCABULARY, load_tokenizer, pre_tokens)

WINDOW = 4096
END_ID = 2
GROUP_PIECES = 1500
WINDOW_BITS = 24
# Pre-tokens whose ids a Python worker remembers.
REMEMBERED = 500_000
# Text handled at once inside a task: its words and ids take many times its bytes.
PACK_BYTES = 1 << 20
# Pieces handed over at once.
BATCH_PIECES = 2048


def encode_flat(words, tokenizer):
    """(ids of all words one after the other, where each word's ids begin and the last ones end)."""
    flat, begin = [np.empty(0, "<u4")], [np.zeros(1, np.int64)]
    for start in range(0, len(words), ENCODE_AT_ONCE):
        coded = [c.ids for c in tokenizer.encode_batch_fast(words[start:start + ENCODE_AT_ONCE], add_special_tokens=False)]
        begin.append(np.fromiter(map(len, coded), np.int64, len(coded)))
        flat.append(np.fromiter(chain.from_iterable(coded), "<u4", int(begin[-1].sum())))
    return np.concatenate(flat), np.cumsum(np.concatenate(begin))


class Encoder:
    """The ids of pre-tokens. The first ones met, of bounded number and bytes, are remembered for as long as the worker
    lives, so it encodes frequent ones once; which are remembered changes the work, never an id."""

    def __init__(self, vocabulary, remembered):
        self.tokenizer, self.remembered = load_tokenizer(vocabulary), remembered
        self.number, self.flat, self.begin = {}, np.empty(0, "<u4"), np.zeros(1, np.int64)

    def encode(self, words):
        """(ids one after the other, where each word's begin there, how many each word has)."""
        at = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        short = np.fromiter((len(words[i].encode()) <= FREQUENT_BYTES for i in new.tolist()), bool, len(new))
        new = np.concatenate([new[short], new[~short]])
        ids, begin = encode_flat([words[i] for i in new.tolist()], self.tokenizer)
        known = len(self.number)
        at[new] = known + np.arange(len(new))
        flat = np.concatenate([self.flat, ids])
        begin = np.concatenate([self.begin, begin[1:] + len(self.flat)])
        kept = min(int(short.sum()), self.remembered - known)
        if kept > 0:
            self.number.update(zip((words[i] for i in new[:kept].tolist()), range(known, known + kept)))
            self.begin, self.flat = begin[:known + kept + 1], flat[:begin[known + kept]]
        return flat, begin[at], begin[at + 1] - begin[at]


@lru_cache(maxsize=1)
def encoder_of(vocabulary, remembered):
    """The encoder of this worker, which its tasks share one after the other."""
    return Encoder(vocabulary, remembered)


def id_type(tokenizer, end_id):
    """The narrowest type of ids on their way between tasks."""
    return "<u2" if max(tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def token_pieces(docs: DataFrame, window=WINDOW, end_id=END_ID, vocabulary=VOCABULARY, remembered=REMEMBERED,
                 ids=True) -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, ids_crc32, a unique number and, if asked for, the narrow ids."""
    def cut(batches):
        encoder = encoder_of(vocabulary, remembered)
        narrow = id_type(encoder.tokenizer, end_id)
        number = TaskContext.get().partitionId() << ROW_BITS
        for batch in batches:
            for part in slices(batch, limit=PACK_BYTES):
                distinct, codes, rows = pre_tokens(part.column("text"))
                flat, first, many = encoder.encode(distinct.to_pylist())
                size = many[codes]
                total = np.bincount(rows, size, part.num_rows).astype(np.int64) + 1
                ends = np.cumsum(total)
                # All documents one after the other, an end id behind each.
                own = np.full(int(total.sum()), end_id, "<u4")
                inside = np.ones(len(own), bool)
                inside[ends - 1] = False
                own[inside] = flat[np.repeat(first[codes] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
                pieces = -(-total // window)
                doc = np.repeat(np.arange(part.num_rows), pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
                length = np.minimum(window, total[doc] - start)
                # Pieces follow each other as their ids do.
                at = np.concatenate([[0], np.cumsum(length)])
                for low in range(0, len(doc), BATCH_PIECES):
                    some = slice(low, low + BATCH_PIECES)
                    n = len(doc[some])
                    bounds = at[low:low + n + 1]
                    crc = [zlib.crc32(own[i:j]) for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                    columns = {
                        "doc_id": part.column("doc_id").take(pa.array(doc[some])),
                        "start": pa.array(start[some]), "length": pa.array(length[some]),
                        "doc_tokens": pa.array(total[doc[some]]), "ids_crc32": pa.array(crc, pa.int64()),
                        "piece": pa.array(np.arange(number, number + n))}
                    if ids:
                        columns["ids"] = binaries(own[bounds[0]:bounds[-1]].astype(narrow), length[some])
                    yield pa.RecordBatch.from_pydict(columns)
                    number += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        cut, f"doc_id {kind}, start long, length long, doc_tokens long, ids_crc32 long, piece long"
        + (", ids binary" if ids else ""))


def binaries(ids, lengths):
    """An Arrow array of the bytes of ids that follow each other, so many for each row."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]) * ids.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))])


def difference(lengths, windows):
    """Karmarkar-Karp: the window (0 to ``windows`` - 1) of each length, with nearly equal sums."""
    # A partition is its window sums, in descending order, and the tree of pieces in each window.
    heap = [(-int(n), i, (int(n),), (i,)) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    tag, merged = len(heap), {}
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        # Windows that neither partition has filled yet stay implicit zeros at the end.
        size = min(windows, len(a) + len(b))
        sums = np.zeros(size, np.int64)
        sums[:len(a)] = a
        at = np.arange(size - 1, size - 1 - len(b), -1)
        sums[at] += b
        nodes = [None] * size
        nodes[:len(x)] = x
        for place, node in zip(at.tolist(), y):
            if nodes[place] is None:
                nodes[place] = node
            else:
                merged[tag] = (nodes[place], node)
                nodes[place] = tag
                tag += 1
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        nodes = [nodes[i] for i in order.tolist()]
        low = int(sums[-1]) if size == windows else 0
        heapq.heappush(heap, (low - int(sums[0]), tag, sums, nodes))
        tag += 1
    of = np.zeros(len(lengths), np.int64)
    for window, node in enumerate(heap[0][3] if heap else ()):
        waiting = [node]
        while waiting:
            node = waiting.pop()
            if node in merged:
                waiting.extend(merged[node])
            else:
                of[node] = window
    return of


def least_windows(lengths, window):
    """No fewer windows can hold the pieces: by their sum, and since at most k pieces longer than window / (k + 1) fit."""
    return max(
        -(-int(lengths.sum()) // window),
        *(-(-int((lengths * (k + 1) > window).sum()) // k) for k in range(1, 5)))


def fewest_windows(lengths, window):
    """The window of each piece. The count rises by doubled steps until no window holds more than fits, then the last
    step is halved down to half a percent."""
    fails = least_windows(lengths, window) - 1
    least = step = max(1, fails // 200)
    count = fails + 1
    while True:
        dealt = difference(lengths, count)
        if np.bincount(dealt, lengths).max() <= window:
            break
        fails, count, step = count, count + step, 2 * step
    while count - fails > least:
        middle = (fails + count) // 2
        other = difference(lengths, middle)
        if np.bincount(other, lengths).max() <= window:
            dealt, count = other, middle
        else:
            fails = middle
    return dealt


def pack_lengths(lengths, window=WINDOW):
    """(window number, offset) of each piece. The window count rises until no window holds more than fits."""
    lengths = np.asarray(lengths, np.int64)
    of, full = np.zeros(len(lengths), np.int64), lengths >= window
    rest = np.flatnonzero(~full)
    if len(rest):
        of[rest] = fewest_windows(lengths[rest], window)
        first_full = int(of[rest].max()) + 1
    else:
        first_full = 0
    of[full] = first_full + np.arange(int(full.sum()))
    order = np.argsort(of, kind="stable")
    ends = np.cumsum(lengths[order])
    starts = ends - lengths[order]
    new = np.r_[True, of[order][1:] != of[order][:-1]] if len(order) else np.zeros(0, bool)
    base = np.maximum.accumulate(np.where(new, starts, 0))
    offset = np.empty(len(lengths), np.int64)
    offset[order] = starts - base
    return of, offset


def pack(docs: DataFrame, window=WINDOW, end_id=END_ID, vocabulary=VOCABULARY, group=GROUP_PIECES,
         remembered=REMEMBERED, ids=True, doc_id="doc_id", text="text") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids_crc32, ids (little-endian
    unsigned 32-bit). Without ``ids`` that column is left out, and only numbers are shuffled."""
    docs = texts(docs, doc_id, text)
    # A token takes a byte at least, so this bounds the number of pieces before any text is tokenised.
    most = docs.agg(F.sum(
        1 + F.floor(F.coalesce(F.octet_length("text"), F.lit(0)) / F.lit(window)))).first()[0] or 0
    groups = max(1, math.ceil(most / group))
    narrow = id_type(load_tokenizer(vocabulary), end_id)
    with settings(docs.sparkSession, {BATCH_BYTES: str(PACK_BYTES)}):
        pieces = store(token_pieces(docs, window, end_id, vocabulary, remembered, ids))
    pieces = pieces.withColumn("group", F.pmod(F.xxhash64("piece"), F.lit(groups)))

    def place(table: pa.Table) -> pa.Table:
        # In order of their numbers, whatever order the shuffle brings.
        table = table.sort_by("piece").combine_chunks()
        length = table.column("length").to_numpy()
        of, offset = pack_lengths(length, window)
        number = pc.shift_left(table.column("group"), pa.scalar(WINDOW_BITS, pa.int64()))
        placed = table.select(["doc_id", "start", "length", "doc_tokens"]).append_column(
            "sequence_id", pc.add(number, pa.array(of))).append_column("offset", pa.array(offset)).append_column(
            "ids_crc32", table.column("ids_crc32"))
        if not ids:
            return placed
        wide = np.frombuffer(b"".join(table.column("ids").to_pylist()), narrow).astype("<u4")
        return placed.append_column("ids", binaries(wide, length))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return pieces.groupBy("group").applyInArrow(
        place, f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids_crc32 long"
        + (", ids binary" if ids else ""))
