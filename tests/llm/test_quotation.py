"""Quotation linking against a plain reading of the rules."""

import random
import re

import pytest

from caseflow.llm.quotation import reply_order

SCHEMA = "conv_id long, turn long, role string, text string, message string, level int"


def norm(text):
    return re.sub(r"\s+", " ", text.lower()).strip()


def split(text):
    lines = []
    for raw in re.split(r"\r\n|\r|\n", text or ""):
        marks = re.match(r"^((?:[ \t]*>)*)", raw)[1]
        lines.append((marks.count(">"), re.sub(r"^(?:[ \t]*>)+[ \t]?", "", raw)))
    return lines


def found(text):
    """(level, normalised passage) of passages and lines."""
    out, run, last = [], [], None
    for level, content in [*split(text), (None, "")]:
        plain = norm(content)
        if plain == "" or level != last:
            if len(run) > 1:
                out.append((last, " ".join(run)))
            run = []
        if plain:
            run.append(plain)
            out.append((level, plain))
        last = level
    return out


def brute(rows):
    first, result = {}, []
    for conv, turn, _, text in rows:
        if turn is not None:
            for level, plain in found(text):
                if level == 0:
                    first[conv, plain] = min(turn, first.get((conv, plain), turn))
    parents = {}
    for conv, turn, role, text in rows:
        quotes = [(lv, first.get((conv, p))) for lv, p in found(text) if lv > 0] if turn is not None else []
        quotes = [(lv, o if o is not None and o < turn else None) for lv, o in quotes]
        linked = [(-lv, o) for lv, o in quotes if o is not None]
        parent = max(linked)[1] if linked else None
        if parent is not None:
            parents[conv, turn] = min(parent, parents.get((conv, turn), parent))
        lines = split(text)
        clean = text or ""
        if any(lv for lv, _ in lines):
            clean = "\n".join(c for lv, c in lines if lv == 0).strip("\n")
        result.append([conv, turn, role, parent, None, len(linked), len(quotes) - len(linked), clean])
    for row in result:
        at = row[1]
        while (row[0], at) in parents:
            at = parents[row[0], at]
        row[4] = at
    null_last = lambda x: (x is None, x or 0)
    result.sort(key=lambda r: ((r[0] is not None, r[0] or 0), null_last(r[4]), null_last(r[1]), r[2] or "", r[7]))
    out, number = [], {}
    for c, t, r, p, th, nl, nu, text in result:
        number[c] = number.get(c, 0) + 1
        out.append((c, t, r, p, th, number[c], nl, nu, text))
    return out


def check(spark, rows):
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in reply_order(table).collect()]
    key = lambda r: tuple((x is not None, x if x is not None else 0) if not isinstance(x, str) else (True, x) for x in r)
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    return sorted(got, key=key)


def test_nested_quotes(spark):
    rows = [
        (1, 0, "user", "How do I reset it?\nThanks"),
        (1, 1, "assistant", "Hold the button."),
        (1, 2, "user", "> HOLD  the button.\nFor how long?"),
        (1, 3, "assistant", "> > Hold the button.\n> For how long?\n\nTen seconds."),
        (1, 4, "user", "> How do I reset it?\n> Thanks\nAnyone else?"),
        (1, 5, "user", "> never said\nHello"),
        (2, 0, "user", "> Hold the button.\nwrong place"),
        (2, 1, "user", "> > > deep\r\n>\r\n> wrong place"),
        (None, None, None, None), (None, 0, "user", ""), (None, 1, "user", ">"), (3, None, "user", "> x"), (3, 0, "a", "x"),
        (3, 0, "a", "x"), (3, 1, "b", "> x"),
    ]
    got = check(spark, rows)
    order = [r[1] for r in sorted((r for r in got if r[0] == 1), key=lambda r: r[5])]
    assert order == [0, 4, 1, 2, 3, 5]


def test_random_threads(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(12):
        said = []
        for turn in range(rng.randint(1, 14)):
            quotes = [f"{'> ' * rng.randint(1, 3)}{line}" for text in rng.sample(said, min(len(said), rng.randint(0, 2)))
                      for line in text.split("\n")]
            own = "\n".join(" ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 3)))
            said.append(own)
            rows.append((conv, turn, rng.choice(["user", "assistant"]), "\n".join([*quotes, own])))
    check(spark, rows)


def test_one_conversation_with_many_replies(spark):
    rows = [(0, 0, "user", "start")] + [(0, i, "user", f"> start\nanswer {i}") for i in range(1, 3000)]
    got = check(spark, rows + [(i, 0, "user", "alone") for i in range(1, 50)])
    assert {r[4] for r in got} == {0}


def test_empty_table(spark):
    assert reply_order(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("size", ["sf0.001"])
def test_whole_table(spark, size):
    table = spark.read.parquet(f"/root/testdata/{size}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, reply_order(table).collect()), key=repr) == sorted(brute(rows), key=repr)
