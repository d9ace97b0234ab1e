"""Token counts: pieces are counted once per distinct pre-token and summed per document; no ids are kept.

A pre-token is a run of characters other than ASCII white space, without the stops and commas at its end, which are
one of their own, and with A-Z lower-cased. The vocabulary lower-cases all text and never joins across white space
or from letters to punctuation, so a document has as many tokens as its pre-tokens together. The most frequent pre-tokens (a list of
bounded length and bytes) travel to the documents by broadcast, as in a skewed join; the others are
joined by shuffle. Which pre-tokens are on the list changes the plan, never a count.

Defined cases: a null text is empty; an empty text has 0 tokens; special strings inside a text count as the
tokenizer treats them by default; rows that repeat an id are counted each; an empty table gives an empty
result; other columns are not read.
"""

import os
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from caseflow.llm.common import hot_keys, slices, spread_join, store, texts, words_of

VOCABULARY = "word_bpe_49k.json"
FREQUENT = 500_000
FREQUENT_BYTES = 128
ENCODE_AT_ONCE = 20_000
ROW_BITS = 33
# Special strings of the vocabulary begin so.
SPECIAL = "<|"
STOPS = r"([a-zà-öø-ÿÀ-ÖØ-Þ])([.,]+)(\s|$)"


def load_tokenizer(vocabulary=VOCABULARY):
    """A tokenizer by file name of the public set, or by path."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = vocabulary if os.path.sep in vocabulary else public_tokenizers.path(vocabulary)
    return Tokenizer.from_file(str(path))


def pre_tokens(column: pa.Array):
    """(distinct pre-tokens, code of each, row of each). Texts near one that may hold a special string, which is told
    by its case, are cut at white space only; their tokens are the same."""
    column = pc.fill_null(column, "")
    if not pc.any(pc.match_substring(column, SPECIAL)).as_py():
        column = pc.replace_substring_regex(pc.ascii_lower(column), STOPS, r"\1 \2\3")
    return words_of(column)


def frequent_words(docs: DataFrame, n=FREQUENT) -> DataFrame:
    """At most ``n`` frequent pre-tokens of ``docs.text``: each slice of text offers those it has at least twice."""
    def offer(batches):
        for batch in batches:
            for part in slices(batch):
                distinct, codes, _ = pre_tokens(part.column("text"))
                count = np.bincount(codes, minlength=len(distinct))
                size = pc.binary_length(distinct).to_numpy(zero_copy_only=False)
                chosen = np.flatnonzero((count > 1) & (size <= FREQUENT_BYTES))
                yield pa.RecordBatch.from_arrays(
                    [distinct.take(pa.array(chosen)), pa.array(count[chosen])], ["word", "n"])

    found = docs.select("text").mapInArrow(offer, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.orderBy(F.desc("n"), "word").limit(n).select("word")


def count_pieces(words: DataFrame, vocabulary=VOCABULARY) -> DataFrame:
    """(word, n): the tokens of each distinct pre-token."""
    def count(batches):
        tokenizer = load_tokenizer(vocabulary)
        for batch in batches:
            for part in slices(batch, "word"):
                for start in range(0, part.num_rows, ENCODE_AT_ONCE):
                    some = part.column("word").slice(start, ENCODE_AT_ONCE)
                    coded = tokenizer.encode_batch_fast(some.to_pylist(), add_special_tokens=False)
                    yield pa.RecordBatch.from_arrays(
                        [some, pa.array([len(c.ids) for c in coded], pa.int64())], ["word", "n"])

    return words.select("word").mapInArrow(count, "word string, n long")


def sum_known(docs: DataFrame, known) -> DataFrame:
    """Per document: row (unique), doc_id, n_bytes, the tokens of its known pre-tokens, and the frequencies of the rest."""
    rest = pa.list_(pa.struct([("word", pa.string()), ("f", pa.int64())]))

    def split(batches):
        counts = dict(zip(known.value[0], known.value[1].tolist()))
        row = TaskContext.get().partitionId() << ROW_BITS
        for batch in batches:
            for part in slices(batch):
                n = part.num_rows
                distinct, codes, rows = pre_tokens(part.column("text"))
                pieces = np.fromiter(
                    map(counts.get, distinct.to_pylist(), repeat(-1)), np.int64, len(distinct))
                found = pieces[codes]
                sums = np.bincount(rows, np.maximum(found, 0), n).astype(np.int64)
                missing = found < 0
                pairs, f = np.unique(rows[missing] * max(1, len(distinct)) + codes[missing], return_counts=True)
                of_row, code = np.divmod(pairs, max(1, len(distinct)))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(of_row, np.arange(n + 1)).astype(np.int32)),
                    pa.StructArray.from_arrays(
                        [distinct.take(pa.array(code)), pa.array(f.astype(np.int64))], fields=list(rest.value_type)))
                size = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), part.column("doc_id"), size, pa.array(sums), lists],
                    ["row", "doc_id", "n_bytes", "known", "rest"])
                row += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        split, f"row long, doc_id {kind}, n_bytes long, known long, rest array<struct<word:string,f:long>>")


def count_tokens(docs: DataFrame, limit=2048, vocabulary=VOCABULARY, frequent=FREQUENT,
                 doc_id="doc_id", text="text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    docs = texts(docs, doc_id, text)
    context = docs.sparkSession.sparkContext
    # At most ``frequent`` rows of at most FREQUENT_BYTES bytes.
    listed = count_pieces(frequent_words(docs, frequent), vocabulary).toArrow()
    known = context.broadcast((listed["word"].to_pylist(), listed["n"].to_numpy()))
    rows = store(sum_known(docs, known))
    rest = rows.select("row", F.explode("rest").alias("one")).select("row", "one.word", "one.f")
    words = store(rest.groupBy("word").agg(F.count(F.lit(1)).alias("rows")))
    pieces = count_pieces(words, vocabulary)
    joined = spread_join(rest, pieces, "word", hot_keys(words, "word", "rows"))
    sums = joined.groupBy("row").agg(F.sum(F.col("f") * F.col("n")).alias("others"))
    n_tokens = F.col("known") + F.coalesce("others", F.lit(0))
    return rows.drop("rest").join(sums, "row", "left").select(
        "doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"))
