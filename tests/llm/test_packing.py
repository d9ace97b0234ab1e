"""Packing: every id in exactly one piece, windows that fit, little padding."""

import random
import zlib
from collections import defaultdict
from unittest import mock

import numpy as np
import pyarrow as pa
import pytest

from caseflow.llm import packing
from caseflow.llm.packing import difference, pack, pack_lengths
from caseflow.llm.token_counts import load_tokenizer

SCHEMA = "doc_id long, text string, ids string, piece long"


def whole(text):
    return [*load_tokenizer().encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, got, window):
    pieces = defaultdict(list)
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length <= window
        pieces[r.doc_id].append((r.start, ids, r.doc_tokens))
    for doc_id, text in rows:
        ids = sorted(pieces[doc_id])
        assert [i for _, part, _ in ids for i in part] == whole(text)
        assert all(n == len(whole(text)) for _, _, n in ids)
        assert [s for s, _, _ in ids] == [sum(len(p) for _, p, _ in ids[:i]) for i in range(len(ids))]
    windows = defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return windows


def test_edges(spark):
    rows = [(0, None), (1, ""), (2, "the end"), (3, "word " * 700), (4, "a<|endoftext|>b"), (5, "x" * 3000)]
    rows += [(i, "some more words " * (i % 13)) for i in range(6, 60)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    for group in (7, 1500):
        check(rows, pack(docs, window=64, group=group).collect(), 64)
    assert pack(docs.limit(0)).collect() == []


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert sorted((repr(r.doc_id), r.length) for r in pack(docs).collect()) == [("1", 3), ("1", 3), ("None", 3)]


def test_whole_table_is_well_filled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    windows = check([(r.doc_id, r.text) for r in docs.collect()], pack(docs).collect(), 4096)
    used = sum(n for parts in windows.values() for _, n in parts)
    assert used > 0.95 * 4096 * len(windows)


@pytest.mark.parametrize("seed", range(4))
def test_differencing(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 4096) for _ in range(rng.randint(1, 400))]
    of, offset = pack_lengths(lengths)
    sums = np.bincount(of, lengths)
    assert sums.max() <= 4096 and sums.min() > 0
    assert len(sums) <= 1.2 * sum(lengths) / 4096 + 2
    even = np.bincount(difference([rng.randint(1, 100) for _ in range(600)], 20), minlength=20)
    assert even.sum() == 600


def test_differencing_is_even():
    # The textbook case: 8, 7, 6, 5, 4 in two parts differ by 2.
    of = difference([8, 7, 6, 5, 4], 2)
    assert sorted(np.bincount(of, [8, 7, 6, 5, 4])) == [14, 16]


@pytest.mark.parametrize("low, high, windows", [(2049, 2300, 1500), (1366, 1500, 750)])
def test_pieces_just_over_a_part_of_a_window(low, high, windows):
    rng = random.Random(low)
    of, _ = pack_lengths([rng.randint(low, high) for _ in range(1500)])
    assert of.max() + 1 == windows


def test_what_is_remembered_changes_no_id(spark):
    rows = [(i, f"{'word' * (i % 7)} {i} some, more: Words.") for i in range(40)] + [(40, "x" * 300 + " y " * 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    some = pack(docs, remembered=3).collect()
    check(rows, some, 4096)
    everything = pack(docs).collect()
    assert sorted(some) == sorted(everything)
    assert sorted(tuple(r)[:-1] for r in everything) == sorted(map(tuple, pack(docs, ids=False).collect()))
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in everything)


def test_tasks_handle_little_text_at_once(monkeypatch):
    """The words and ids of a slice take many times its bytes, and several workers share an executor's memory."""
    handled, pre_tokens = [], packing.pre_tokens
    monkeypatch.setattr(packing, "pre_tokens", lambda column: handled.append(column.nbytes) or pre_tokens(column))
    monkeypatch.setattr(packing, "TaskContext", mock.Mock(**{"get.return_value.partitionId.return_value": 0}))
    docs = mock.MagicMock()
    packing.token_pieces(docs)
    cut = docs.mapInArrow.call_args.args[0]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "text": ["word " * 40_000] * 40})
    assert sum(out.num_rows for out in cut([batch])) == 40 * 10
    assert max(handled) <= 3 << 20
