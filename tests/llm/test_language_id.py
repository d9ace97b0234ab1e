"""Language identification: the passes against all segmentations, accuracy on documents never learnt from."""

import itertools
import math
import random

import numpy as np
import pytest

from caseflow.llm.language_id import (
    START, UNKNOWN, expected_pieces, forward, forward_many, identify, load_pieces, piece_index)

SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string"


def segmentations(text):
    for marks in itertools.product((0, 1), repeat=len(text) - 1):
        cut = [0, *(i + 1 for i, m in enumerate(marks) if m), len(text)]
        yield [text[a:b] for a, b in zip(cut, cut[1:])]


def test_passes_sum_over_all_segmentations():
    rng = random.Random(1)
    pieces = sorted({START, "a", "b", START + "a", "ab", "ba", "bab", START + "ab", "aab"})
    p = {piece: rng.random() for piece in pieces}
    index = piece_index(pieces)
    table = np.array([[p[x], p[x] / 2] for x in pieces] + [[UNKNOWN, UNKNOWN]])
    for word in ("a", "ab", "babab", "aabab", "axb", "xyz"):
        weights = {}
        for cut in segmentations(START + word):
            if all(x in p or len(x) == 1 for x in cut):
                weights[tuple(cut)] = math.prod(p.get(x, UNKNOWN) for x in cut)
        total = sum(weights.values())
        assert math.isclose(forward(word, index, table)[0], math.log(total), rel_tol=1e-9)
        got = expected_pieces(word, index, [p[x] for x in pieces])
        for number, piece in enumerate(pieces):
            want = sum(w * cut.count(piece) for cut, w in weights.items()) / total
            assert math.isclose(got.get(number, 0.0), want, rel_tol=1e-9, abs_tol=1e-12)
    words = ["a", "babab", "aabab" * 20, "xyz", "ab"]
    assert np.allclose(forward_many(words, index, table), [forward(w, index, table) for w in words])


def test_long_words_do_not_underflow():
    pieces = load_pieces()
    table = np.full((len(pieces) + 1, 2), 1 / len(pieces))
    assert np.isfinite(forward("abc" * 5000 + "жщ", piece_index(pieces), table)).all()


def test_whole_table_and_edges(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    rows = [tuple(r) for r in base] + [
        (900, None, "en"), (901, "", "en"), (902, "123 !?", None), (903, "the " * 3000, None), (None, base[0].text, "xx"), base[0]]
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    results = {}
    for frequent in (50, 500_000):
        got = identify(docs, sample=40, rounds=2, frequent=frequent).collect()
        assert len(got) == len(rows)
        results[frequent] = sorted((r.doc_id is None, r.doc_id, r.lang_pred, round(r.score, 6)) for r in got)
        langs = {r.doc_id: r.lang for r in base}
        held = [r for r in got if r.held_out and r.doc_id in langs]
        assert len(held) > 20 and sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)
        assert {r.lang_pred for r in got if r.doc_id in (900, 901, 902)} == {"und"}
        assert all(0 <= r.score <= 1 for r in got) and "xx" not in {r.lang_pred for r in got}
    assert results[50] == results[500_000]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "the end", None, "", "")], SCHEMA)
    assert [(r.doc_id, r.lang_pred, r.score) for r in identify(docs).collect()] == [(1, "und", 0.0)]
    assert identify(docs.limit(0)).collect() == []


@pytest.mark.parametrize("doc_id, out", [(0, None), (1, None), (2, None), (7, None)])
def test_held_out_is_the_remainder(spark, doc_id, out):
    import zlib
    docs = spark.createDataFrame([(doc_id, "x", None, "", "")], SCHEMA)
    assert identify(docs).first().held_out == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
