"""Alignment of two tokenizers against plain loops over bytes."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from caseflow.llm import alignment
from caseflow.llm.alignment import align_tokens, common_ends, diagonal, linked_pairs


def brute(rows):
    """The contract read word by word."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    letters = alignment.byte_letters()

    def b_bytes(i):
        piece = b.id_to_piece(i)
        byte = re.fullmatch("<0x(..)>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    done = []
    for doc_id, text in rows:
        groups = []
        if text:
            want = (" " + text).encode()
            a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            a_parts = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
            b_parts = [b_bytes(i) for i in b_ids]
            if b"".join(a_parts) == want == b"".join(b_parts):
                mine, other = [], []
                a_at = b_at = a_end = b_end = 0
                while a_at < len(a_ids) or b_at < len(b_ids):
                    if a_end <= b_end and a_at < len(a_ids):
                        a_end += len(a_parts[a_at])
                        mine.append(a_ids[a_at])
                        a_at += 1
                    else:
                        b_end += len(b_parts[b_at])
                        other.append(b_ids[b_at])
                        b_at += 1
                    if a_end == b_end:
                        groups.append((mine, other))
                        mine, other = [], []
        done.append((doc_id, groups))
    counts = Counter(pair for _, groups in done for pair in {(x, y) for m, o in groups for x in m for y in o})
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, groups in done:
        links = [(x, y) for m, o in groups for x in m for y in o]
        text = ";".join(",".join(map(str, m)) + "|" + ",".join(map(str, o)) for m, o in groups)
        out.append((
            doc_id, sum(len(m) for m, _ in groups), sum(len(o) for _, o in groups), len(groups), len(links),
            sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def texts():
    rng = random.Random(4)
    letters = "abcdefgh  \n\t.,!?éßñ漢字😀0123456789<>|▁ﬁ'\"-_  \x00"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    words = "the quick brown fox jumps over the lazy dog <|endoftext|> <s> </s> <unk> naïve Straße 12345 https://x.y/z".split()
    rows += [(1000 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))) for i in range(100)]
    rows += [(2000, None), (2001, ""), (2002, " "), (2003, "  lead"), (2004, "trail  "), (2005, "▁"), (2006, "<0x41>"),
             (2007, "a" * 20000), (2008, "ab" * 9000 + "x "), (2009, "漢" * 3000), (1000, rows[151][1]), (1001, rows[151][1]),
             (None, "no id"), (2010, "word " * 30000), (2011, "=" * 5000 + "-" * 5000)]
    return rows


@pytest.mark.parametrize("frequent, piece", [(500_000, 1 << 16), (20, 64), (0, 7)])
def test_table(spark, frequent, piece):
    rows = texts()
    docs = spark.createDataFrame(
        [(*r, 1, "clash") for r in rows], "doc_id long, text string, n_a int, pair string").repartition(3)
    got = sorted(map(tuple, align_tokens(docs, frequent=frequent, piece=piece).collect()), key=repr)
    assert got == brute(rows)
    assert align_tokens(docs.limit(0)).collect() == []
    nothing = align_tokens(docs.filter("text is null")).collect()
    assert [tuple(r) for r in nothing] == [(2000, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("piece", [1, 2, 3, 5, 64, 1000])
def test_pieces_of_a_merge(piece):
    rng = np.random.default_rng(piece)
    for n in (0, 1, 2, 30, 400):
        for m in (0, 1, 5, 300):
            a = np.unique(rng.integers(0, 500, n))
            b = np.unique(rng.integers(0, 500, m))
            assert common_ends(a, b, piece).tolist() == np.intersect1d(a, b).tolist()
            merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
            for at in range(0, len(merged) + 1, 7):
                assert diagonal(a, b, at) == sum(side == 0 for _, side in merged[:at])


def test_large_groups_count_like_small_ones(monkeypatch):
    rng = np.random.default_rng(1)
    a_count, b_count = rng.integers(1, 30, 40), rng.integers(1, 30, 40)
    args = (rng.integers(0, 50, a_count.sum()), rng.integers(0, 50, b_count.sum()), a_count, b_count, np.repeat([0, 2], 20))
    want = [x.tolist() for x in linked_pairs(*args)]
    monkeypatch.setattr(alignment, "LARGE", 100)
    assert [x.tolist() for x in linked_pairs(*args)] == want


def test_ranks_give_the_ids_of_the_tokenizer():
    encoder = alignment.ByteEncoder(alignment.A_VOCABULARY)
    assert encoder.ranks is not None
    texts_ = [" " + shape.replace("*", chr(c)) for c in range(0x250)
              for shape in ("*", "a*b 1*2", " **  *x", "*\n*", "it*s 's*", "\t* *.*9 *", "don't'*LL")]
    texts_ += [" " + text for _, text in texts() if text] + [" " * 400 + "x", " \n" * 200, "a" * 100_000, " " * 2000 + "x"]
    whole = [c.ids for c in encoder.tokenizer.encode_batch_fast(texts_, add_special_tokens=False)]
    assert encoder.encode(texts_) == whole
    assert sum(not encoder.SAFE.search(text) for text in texts_) > 0x250 * 7
