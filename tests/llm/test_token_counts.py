"""Token counts against the tokenizer itself."""

import pytest

from caseflow.llm.token_counts import count_tokens, load_tokenizer

SCHEMA = "doc_id long, text string, n_tokens string, word string"
EDGES = [
    None, "", " ", "\n\t ", "the", "The THE the", "don't we'll", "a<|endoftext|>b <|startoftext|>", "<|endoftext |>",
    "ΑΣ ΑΣΑ Σ", "é é ́x", "a\x0bb\x0cc\x1cd\x85e f g", "日本語 テキスト", "123 4,5.6!!", "x" * 5000,
    "word " * 3000, "😀 👩‍👩‍👧 ok", "End. x... y,, Élan, café. a.,b 5. '. don't. ñ,", "<|ENDOFTEXT|> A<|EndOfText|>, <|endoftext|>.",
    "İstanbul, K. ẞ. ﬁ, ß. e\u0301, Å. Ω,", "\x00 nul", "tab\tsep\r\nline"]


def brute(texts):
    tokenizer = load_tokenizer()
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("frequent", [3, 500_000])
def test_edges(spark, frequent):
    rows = [(i % 15, text, "clash", "clash") for i, text in enumerate(EDGES + EDGES[-3:])]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    got = sorted(map(tuple, count_tokens(docs, frequent=frequent).collect()))
    want = sorted(
        (i, len((t or "").encode()), n, n > 2048) for (i, t, *_), n in zip(rows, brute([r[1] for r in rows])))
    assert got == want


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: n for r, n in zip(docs.collect(), brute([r.text for r in docs.collect()]))}
    got = count_tokens(docs, frequent=2000).collect()
    assert len(got) == docs.count() and {r.doc_id: r.n_tokens for r in got} == want


def test_empty_table_and_null_id(spark):
    assert count_tokens(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(None, "the end", "", "")], SCHEMA)
    assert [tuple(r) for r in count_tokens(one).collect()] == [(None, 7, 2, False)]
