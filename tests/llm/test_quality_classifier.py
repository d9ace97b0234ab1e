"""The n-gram model against a plain one, and what the classifier rejects."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caseflow.llm import quality
from caseflow.llm.quality import (
    AGAIN, END, START, classify, count_grams, count_pairs, fresh_words, gram_surprise, keep_good, pair_gains, word_grams)

SCHEMA = "doc_id long, text string, lang string, perplexity string, trusted string"


def plain_counts(texts):
    counts = Counter()
    for text in texts:
        last = None
        for word in text.split():
            mark = START * 3 + (AGAIN if word == last else word) + END
            counts.update(mark[i - 3:i + 1] for i in range(3, len(mark)))
            last = word
    return counts


def plain_model(counts):
    """-ln p by the textbook: modified Kneser-Ney, interpolated, continuation counts in lower orders."""
    tables, off = {4: counts}, {}
    for order in (3, 2, 1):
        tables[order] = Counter(gram[1:] for gram in tables[order + 1])
    for order, table in tables.items():
        n = [sum(c == k for c in table.values()) for k in range(1, 5)]
        y = n[0] / max(1, n[0] + 2 * n[1])
        off[order] = [min(k - 0.1, max(0.1, k - (k + 1) * y * n[k] / n[k - 1])) if n[k - 1] else k / 2 for k in (1, 2, 3)]
    sums = {o: defaultdict(lambda: [0, 0.0]) for o in tables}
    for order, table in tables.items():
        for gram, c in table.items():
            entry = sums[order][gram[:-1]]
            entry[0] += c
            entry[1] += off[order][min(c, 3) - 1]

    def p(gram):
        lower = p(gram[1:]) if len(gram) > 1 else 1 / 65536
        total, back = sums[len(gram)].get(gram[:-1], (0, 0.0))
        if not total:
            return lower
        c = tables[len(gram)].get(gram, 0)
        own = (c - off[len(gram)][min(c, 3) - 1]) / total if c else 0.0
        return own + back / total * lower

    return p


def packed(gram):
    value = 0
    for c in gram:
        value = value << 16 | min(ord(c), 0xFFFF)
    return value - (1 << 64) if value >= 1 << 63 else value


def test_model(spark):
    trusted = ["the cat sat on the the mat", "a cat and a dog and the end", "élan vital 😀 the", "the theme then"]
    other = ["zebra xylophone", "the the the", ""]
    docs = spark.createDataFrame([(t, True) for t in trusted] + [(t, False) for t in other], "text string, trusted boolean")
    counts = plain_counts(trusted)
    every = plain_counts(trusted + other)
    got = {r.g: r for r in count_grams(docs).collect()}
    assert {g: r.trusted for g, r in got.items() if r.trusted} == {packed(g): n for g, n in counts.items()}
    assert {g: r.n for g, r in got.items()} == {packed(g): n for g, n in every.items()}
    p = plain_model(counts)
    found = {r.g: r.surprise for r in gram_surprise(count_grams(docs)).collect()}
    for gram in every:
        assert math.isclose(found[packed(gram)], -math.log(p(gram)), rel_tol=1e-9)


def test_word_grams_of_nothing():
    grams, word = word_grams([])
    assert len(grams) == len(word) == 0


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]

    def text(n):
        return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(2, 3))) for _ in range(n))

    rows = [(i, text(rng.randint(20, 80)), rng.choice(["en", "xx", None])) for i in range(160)]
    rows += [(200 + i, text(40).upper().replace(" ", "!! "), "en") for i in range(10)]
    rows += [(220 + i, " ".join([text(1)] * 60), "en") for i in range(10)]
    rows += [(300, None, "en"), (301, "", "en"), (302, "the", "zz"), (None, text(30), "en"), (5, text(30), "en")]
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(100)] + [(200, 0, 1), (50, 0, 0), (None, 1, 0), (60, None, 0), (7, 1, 0)],
        "doc_id long, quality int, toxic int")
    return docs, labels


@pytest.mark.parametrize("frequent", [5, 500_000])
def test_rejects(corpus, frequent):
    docs, labels = corpus
    got = classify(docs, labels, frequent=frequent).collect()
    assert len(got) == docs.count()
    rejected = {r.doc_id for r in got if r.rejected}
    assert set(range(200, 210)) | set(range(220, 230)) <= rejected
    assert len(rejected - set(range(200, 230))) <= 3
    assert not rejected & {300, 301, None}
    assert {r.perplexity for r in got if r.doc_id in (300, 301)} == {None}


def test_same_rows_without_the_list(corpus):
    docs, labels = corpus
    key = lambda r: (r.doc_id is None, r.doc_id, r.perplexity or 0)
    a, b = (sorted(classify(docs, labels, frequent=n).collect(), key=key) for n in (5, 500_000))
    for x, y in zip(a, b):
        assert x.rejected == y.rejected and math.isclose(x.perplexity or 0, y.perplexity or 0, rel_tol=1e-9)


def test_keep_good_and_nothing_trusted(spark, corpus):
    docs, labels = corpus
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.filter("doc_id >= 200 and doc_id < 230").count() == 0
    assert kept.filter("doc_id < 200").count() >= 158
    assert classify(docs, labels.limit(0)).filter("rejected").count() == 0
    assert classify(docs.limit(0), labels).collect() == []
    assert classify(docs, labels.withColumn("quality", F.lit(0))).filter("rejected").count() == 0


@pytest.fixture(scope="module")
def prose(spark):
    """Text in which each word allows few next ones; documents 300 on are shuffled, 400 on repeat a phrase."""
    rng = random.Random(9)
    words = ["".join(rng.choice("aeioubdfgklmnprst") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    after = {w: rng.sample(words, 4) for w in words}

    def text(n):
        out = [rng.choice(words)]
        while len(out) < n:
            out.append(rng.choice(after[out[-1]]))
        return out

    rows = [(i, " ".join(text(rng.randint(80, 200)))) for i in range(260)]
    for i in range(20):
        shuffled = text(150)
        rng.shuffle(shuffled)
        rows.append((300 + i, " ".join(shuffled)))
        rows.append((400 + i, " ".join((text(2 + i // 2) * 150)[:150 + 10 * i])))
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string").repartition(3)
    return docs, spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")


@pytest.mark.parametrize("frequent", [3, 500_000])
def test_shuffled_words_and_repeated_phrases(prose, frequent):
    docs, labels = prose
    rejected = {r.doc_id for r in classify(docs, labels, frequent=frequent).collect() if r.rejected}
    assert set(range(300, 320)) <= rejected
    assert set(range(400, 420)) <= rejected
    assert len(rejected - set(range(300, 420))) <= 3


def test_gains_of_pairs(spark):
    texts = ["a b a b", "b c", "a b"]
    docs = spark.createDataFrame([(t, True) for t in texts] + [("c a", False)], "text string, trusted boolean")
    pairs = count_pairs(docs)
    assert sorted(r.c for r in pairs.filter("b IS NOT NULL").collect()) == [1, 1, 1, 2, 3]
    # (a, b) thrice; 3 of 8 words are a, 4 of them b.
    for frequent in (0, 1, 500_000):
        got = [r.gain for r in pair_gains(pairs, frequent).collect() if r.c == 3]
        assert len(got) == 1 and math.isclose(got[0], math.log(0.5 * 3 * 8 / (3 * 4) + 0.5))


def test_fresh_words_by_hand():
    rows = ["a b c a b c a b c", "c a b c", "x", "y y y y"]
    distinct = {}
    codes = np.array([distinct.setdefault(w, len(distinct)) + 1 for r in rows for w in r.split()], np.int64)
    of_row = np.repeat(np.arange(len(rows)), [len(r.split()) for r in rows])
    assert fresh_words(codes, of_row, 5).tolist() == [5, 4, 1, 3, 0]


def test_no_step_stores_or_lists_all_pairs_at_once(spark, prose, monkeypatch):
    docs, labels = prose
    flagged = docs.join(labels, "doc_id", "left").select(
        "text", ((F.col("quality") == 1) & (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0))
        .alias("trusted")).na.fill(False)
    whole = {(r.a, r.b): r.c for r in count_pairs(flagged).collect() if r.b is not None}
    held = []

    def stored(df, plain=quality.store):
        table = plain(df)
        if {"a", "b", "c"} <= set(df.columns) or "gain" in df.columns and "k" in df.columns:
            held.append(table.count())
        return table

    monkeypatch.setattr(quality, "store", stored)
    classify(docs, labels, frequent=20).collect()
    assert held and max(held) < 0.7 * len(whole)


@pytest.mark.parametrize("ranges", [1, 3])
def test_ranges_of_pairs_hold_each_pair_once(spark, ranges):
    docs = spark.createDataFrame([("a b a b", True), ("b c é", True), ("a b", True), ("", True)], "text string, trusted boolean")
    parts = [count_pairs(docs, r, ranges).collect() for r in range(ranges)]
    assert sorted(r.c for p in parts for r in p if r.b is not None) == [1, 1, 1, 1, 2, 3]
    assert sorted(r.c for p in parts for r in p if r.b is None) == [1, 1, 3, 3, 4]


def test_word_hashes_differ():
    words = ["", "a", "b", "ab", "ba", "aa", "aaa", "é", "\x00", "\x00\x00", *(f"w{i}" for i in range(100_000))]
    column = pa.array(["out", *words])
    got = quality.word_hashes(column[1:])
    assert len(set(got.tolist())) == len(words) and (got == quality.word_hashes(pa.array(words))).all()
    assert len(quality.word_hashes(pa.array([], pa.string()))) == 0


def test_listed_are_the_most_frequent_without_a_sort(spark):
    table = spark.createDataFrame([(k, k / 2, n) for k, n in ((7, 9), (3, 5), (4, 5), (1, 1))], "k long, v double, n long")
    for frequent, wanted in ((0, []), (1, [7]), (2, [7]), (3, [3, 4, 7]), (9, [1, 3, 4, 7])):
        keys, values = quality._listed(table, frequent)
        assert keys.tolist() == wanted and values.tolist() == [k / 2 for k in wanted]


def test_grams_of_words_from_arrow():
    words = ["", "ab", "é😀x", "", AGAIN, "the"]
    wanted = [(packed(mark[i - 3:i + 1]), n) for n, mark in enumerate(START * 3 + w + END for w in words) for i in range(3, len(mark))]
    for column in (words, pa.array(["out", *words])[1:]):
        grams, word = word_grams(column)
        assert list(zip(grams.tolist(), word.tolist())) == wanted
