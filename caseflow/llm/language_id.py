"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary have a probability per language. A text's probability in a language is the sum
over all ways to cut its words into pieces, computed by a forward pass over each word. The piece probabilities are
learnt by expectation maximisation (forward and backward passes over word counts) from a bounded sample of documents per
language. Scores of the most frequent words (a list of bounded bytes) are computed once and broadcast; other words are
scored where they stand.

Words are runs of letters, lower-cased. Defined cases: a null text, or one without a letter, is ``und`` with score 0; a
null ``lang`` or ``doc_id`` is not learnt from; without anything to learn from every text is ``und``; of equally likely
languages the first by name is taken; rows that repeat an id are predicted each; an empty table gives an empty result;
other columns are not read.
"""

import os
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, Window

from caseflow.llm.common import slices, store, texts, with_ids, words_of

VOCABULARY = "piece_bpe_32k.model"
# Documents learnt from, at most, per language: those with the least hash of their id.
SAMPLE = 300
ROUNDS = 3
SMOOTHING = 0.01
# Bytes of the broadcast list of word scores, counting 8 a language and this for the word itself.
FREQUENT_BYTES, WORD_BYTES = 64 << 20, 64
FREQUENT = 500_000
START = "▁"
UNKNOWN = 1e-8
TINY, HUGE = 1e-150, 1e150
# Words up to this many characters cannot underflow and are scored many at once.
SHORT, AT_ONCE = 30, 20_000


def load_pieces(vocabulary=VOCABULARY):
    """The ordinary pieces of a sentencepiece model, by file name of the public set or by path."""
    import sentencepiece

    path = vocabulary if os.path.sep in vocabulary else public_tokenizers.path(vocabulary)
    model = sentencepiece.SentencePieceProcessor(model_file=str(path))
    pieces = (
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    # Only pieces of letters, with or without the mark of a word's start, can be part of a word.
    return sorted({p for p in pieces if p == START or p.removeprefix(START).isalpha()})


def piece_index(pieces):
    """{piece: its number}, and -1 for beginnings of pieces."""
    index = {piece[:n]: -1 for piece in pieces for n in range(1, len(piece))}
    index.update({piece: i for i, piece in enumerate(pieces)})
    return index


def cuts(text, index):
    """(start, end, piece number) of every piece in ``text``; a character outside the vocabulary is a piece of its
    own, with the number after the last."""
    n, get, unknown = len(text), index.get, len(index)
    for start in range(n):
        if get(text[start], -1) < 0:
            yield start, start + 1, unknown
        for end in range(start + 1, n + 1):
            number = get(text[start:end])
            if number is None:
                break
            if number >= 0:
                yield start, end, number


def letter_words(column: pa.Array):
    """As ``words_of``, each word lower-cased with blanks for what is no letter; words without letters left out."""
    distinct, codes, rows = words_of(column)
    letters = pc.utf8_trim_whitespace(pc.replace_substring_regex(pc.utf8_lower(distinct), r"[^\p{L}]+", " "))
    coded = letters.dictionary_encode()
    codes, distinct = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[codes], coded.dictionary
    empty = pc.index(distinct, "").as_py()
    if empty >= 0:
        keep = codes != empty
        codes, rows = codes[keep], rows[keep]
    return distinct, codes, rows


def forward(word, index, table):
    """ln of the sum over all segmentations of ``word``, per language; ``table`` has a row per piece and a last one
    for unknown characters."""
    text = START + word
    sums, log = np.zeros((len(text) + 1, table.shape[1])), 0.0
    sums[0] = 1.0
    scaled = 0
    # Cuts come by start, so the sum at a start is whole when it is used.
    for start, end, number in cuts(text, index):
        if start > scaled:
            scaled = start
            if sums[start].max() < TINY:
                sums[start:] *= HUGE
                log -= np.log(HUGE)
        sums[end] += sums[start] * table[min(number, len(table) - 1)]
    return np.log(np.maximum(sums[-1], 1e-300)) + log


def forward_many(words, index, table):
    """``forward`` of many words, a row each."""
    found = np.empty((len(words), table.shape[1]))
    short = [i for i, w in enumerate(words) if len(w) <= SHORT]
    for i, w in enumerate(words):
        if len(w) > SHORT:
            found[i] = forward(w, index, table)
    for at in range(0, len(short), AT_ONCE):
        some = short[at:at + AT_ONCE]
        every = [(end, i, start, number) for i, w in enumerate(some)
                 for start, end, number in cuts(START + words[w], index)]
        end, word, start, number = np.array(every, np.int64).reshape(-1, 4).T
        order = np.lexsort((word, end))
        end, word, start, number = (x[order] for x in (end, word, start, np.minimum(number, len(table) - 1)))
        sums = np.zeros((len(some), SHORT + 2, table.shape[1]))
        sums[:, 0] = 1.0
        bounds = np.searchsorted(end, np.arange(SHORT + 3))
        for e in range(1, SHORT + 2):
            here = slice(bounds[e], bounds[e + 1])
            w = word[here]
            if len(w):
                first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
                sums[w[first], e] = np.add.reduceat(sums[w, start[here]] * table[number[here]], first, axis=0)
        last = np.array([len(words[w]) + 1 for w in some])
        found[some] = np.log(np.maximum(sums[np.arange(len(some)), last], 1e-300))
    return found


def expected_pieces(word, index, p):
    """{piece number: expected number in the segmentations of ``word``}; ``p``: probability by number."""
    text = START + word
    n = len(text)
    ahead, found = [1.0] + [0.0] * n, []
    for start, end, number in cuts(text, index):
        if ahead[start]:
            q = p[number] if number < len(p) else UNKNOWN
            ahead[end] += ahead[start] * q
            found.append((start, end, number, q))
    behind = [0.0] * n + [1.0]
    for start, end, _, q in reversed(found):
        behind[start] += q * behind[end]
    counts = {}
    if ahead[n] > 0:
        for start, end, number, q in found:
            if number < len(p):
                counts[number] = counts.get(number, 0.0) + ahead[start] * q * behind[end] / ahead[n]
    return counts


def sample_words(docs: DataFrame, sample=SAMPLE) -> DataFrame:
    """(lang, word, n) over at most ``sample`` documents of each language that may be learnt from."""
    learn = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = store(
        learn.select("doc_id", "lang").withColumn("rank", F.row_number().over(first))
        .filter(F.col("rank") <= sample).select("doc_id").distinct())

    def count(batches):
        for batch in batches:
            for part in slices(batch):
                distinct, codes, rows = letter_words(part.column("text"))
                langs = part.column("lang").dictionary_encode()
                key = langs.indices.to_numpy()[rows] * max(1, len(distinct)) + codes
                pairs, n = np.unique(key, return_counts=True)
                lang, code = np.divmod(pairs, max(1, len(distinct)))
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(lang)), distinct.take(pa.array(code)), pa.array(n.astype(np.int64))],
                    ["lang", "word", "n"])

    counted = with_ids(learn, chosen, chosen.count()).select("text", "lang").mapInArrow(
        count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, vocabulary=VOCABULARY, sample=SAMPLE, rounds=ROUNDS):
    """(languages, pieces, probabilities with a row per piece) by expectation maximisation."""
    words = store(sample_words(docs, sample))
    languages = [r["lang"] for r in words.select("lang").distinct().orderBy("lang").collect()]
    pieces = load_pieces(vocabulary)
    context = docs.sparkSession.sparkContext
    p = np.full((len(pieces), len(languages)), 1 / len(pieces))
    # The model is one number per piece and language, whatever the number of documents.
    for _ in range(rounds if languages else 0):
        given = context.broadcast((pieces, languages, p))

        def expect(batches):
            pieces, languages, p = given.value
            index, columns, totals = piece_index(pieces), {}, {}
            for batch in batches:
                for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                    if lang not in columns:
                        columns[lang] = p[:, languages.index(lang)].tolist()
                        totals[lang] = {}
                    total = totals[lang]
                    for one in word.split():
                        # Longer runs of letters are no words of a language; their pieces add nothing to learn.
                        if len(one) <= 100:
                            for number, e in expected_pieces(one, index, columns[lang]).items():
                                total[number] = total.get(number, 0.0) + e * n
            for lang, total in totals.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(total), pa.string()), pa.array(list(total), pa.int64()),
                     pa.array(list(total.values()), pa.float64())], ["lang", "number", "e"])

        sums = words.repartition("word").mapInArrow(expect, "lang string, number long, e double").groupBy(
            "lang", "number").agg(F.sum("e").alias("e")).toArrow()
        p = np.full((len(pieces), len(languages)), SMOOTHING)
        at = {lang: i for i, lang in enumerate(languages)}
        for lang, number, e in zip(*(sums.column(c).to_pylist() for c in ("lang", "number", "e"))):
            p[number, at[lang]] += e
        p /= p.sum(axis=0)
    return languages, pieces, p


def held_out(doc_id):
    """Documents that are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _score_units(units, index, table):
    """ln probability of each unit (words with blanks between), per language."""
    words = sorted({w for unit in units for w in unit.split()})
    number = {w: i for i, w in enumerate(words)}
    scores = forward_many(words, index, table)
    return np.array([scores[[number[w] for w in unit.split()]].sum(axis=0) for unit in units]).reshape(
        len(units), table.shape[1])


def predict(docs: DataFrame, languages, pieces, probabilities, frequent=FREQUENT) -> DataFrame:
    """Per document: doc_id, lang_pred, score."""
    context = docs.sparkSession.sparkContext
    n_languages = len(languages)
    most = min(frequent, FREQUENT_BYTES // (8 * n_languages + WORD_BYTES))
    learnt = context.broadcast((pieces, np.vstack([probabilities, np.full(n_languages, UNKNOWN)])))

    def offer(batches):
        for batch in batches:
            for part in slices(batch):
                distinct, codes, _ = letter_words(part.column("text"))
                count = np.bincount(codes, minlength=len(distinct))
                size = pc.binary_length(distinct).to_numpy(zero_copy_only=False)
                chosen = np.flatnonzero((count > 1) & (size <= WORD_BYTES))
                yield pa.RecordBatch.from_arrays(
                    [distinct.take(pa.array(chosen)), pa.array(count[chosen])], ["word", "n"])

    def score_words(batches):
        pieces, table = learnt.value
        index = piece_index(pieces)
        for batch in batches:
            words = batch.column("word")
            found = _score_units(words.to_pylist(), index, table)
            yield pa.RecordBatch.from_arrays(
                [words, pa.array(found.tolist(), pa.list_(pa.float64()))], ["word", "scores"])

    common = docs.select("text").mapInArrow(offer, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    listed = common.orderBy(F.desc("n"), "word").limit(most).select("word").repartition(
        max(1, context.defaultParallelism), "word").mapInArrow(score_words, "word string, scores array<double>").toArrow()
    values = listed["scores"].combine_chunks().flatten().to_numpy().reshape(listed.num_rows, n_languages)
    known = context.broadcast((listed["word"].to_pylist(), values))

    def guess(batches):
        words, values = known.value
        number = dict(zip(words, range(len(words))))
        pieces, probabilities = learnt.value
        index = piece_index(pieces)
        for batch in batches:
            for part in slices(batch):
                n = part.num_rows
                distinct, codes, rows = letter_words(part.column("text"))
                units = distinct.to_pylist()
                at = np.fromiter(map(number.get, units, repeat(-1)), np.int64, len(units))
                table = values[at] if len(values) else np.zeros((len(units), n_languages))
                used = np.zeros(len(units), bool)
                used[codes] = True
                rare = np.flatnonzero((at < 0) & used)
                if len(rare):
                    table[rare] = _score_units([units[i] for i in rare.tolist()], index, probabilities)
                totals = np.stack([np.bincount(rows, table[codes, i], n) for i in range(n_languages)], 1)
                letters = np.bincount(rows, minlength=n) > 0
                best = totals.argmax(axis=1)
                share = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"),
                     pa.array([languages[b] if some else "und" for b, some in zip(best.tolist(), letters.tolist())],
                              pa.string()),
                     pa.array(np.where(letters, share, 0.0))], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(guess, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame, vocabulary=VOCABULARY, sample=SAMPLE, rounds=ROUNDS, frequent=FREQUENT,
             doc_id="doc_id", text="text", lang="lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score. Learns from ``lang`` of documents not held out."""
    rows = texts(docs, doc_id, text, lang=docs[lang].cast("string"))
    languages, pieces, probabilities = learn(rows, vocabulary, sample, rounds)
    asked = rows.select("doc_id", "text")
    if languages:
        found = predict(asked, languages, pieces, probabilities, frequent)
    else:
        found = asked.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
