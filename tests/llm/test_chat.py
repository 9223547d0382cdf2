from __future__ import annotations

import random

from farewind.llm import chat

FIELDS = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs.setdefault(conv_id, []).append((turn, role, text))
    none_first = lambda x: tuple((v is not None, v if v is not None else 0) for v in x[:2])
    said = {c: tuple((r, t) for _, r, t in sorted(turns, key=none_first)) for c, turns in convs.items()}
    out = []
    for own in set(said.values()):
        if any(len(o) > len(own) and o[: len(own)] == own for o in said.values()):
            continue
        ids = [c for c, s in said.items() if s == own]
        text = "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in own)
        out.append((min(ids), len(own), len(ids), text))
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame(rows, FIELDS).selectExpr("*", "1 as pos", "2 as h1", "3 as is_last")
    assert sorted(tuple(r) for r in chat.format_conversations(df).collect()) == brute(rows)


def test_snapshots_collapse(spark):
    a, b, c = ("user", "hi"), ("assistant", "hello"), ("user", "bye")
    convs = {1: [a], 2: [a, b], 3: [a, b, c], 4: [a, b], 5: [a, c], 6: [b], 7: [a, b, c], 8: [("user", None)], 9: [(None, "")], 10: [("user", "")]}
    check(spark, [(i, k, r, t) for i, turns in convs.items() for k, (r, t) in enumerate(turns)])


def test_shifted_turns_and_nulls(spark):
    rows = [(1, 5, "user", "x"), (1, 9, "assistant", "y"), (2, 0, "user", "x"), (3, None, "user", "x"), (3, 1, "assistant", "y"), (3, 2, "user", "z"), (None, 0, "user", "lost")]
    check(spark, rows)


def test_repeated_turns(spark):
    check(spark, [(1, 0, "user", "x"), (1, 0, "user", "x"), (2, 0, "user", "x"), (3, 0, "user", "long " * 9000)])


def test_random_conversations(spark):
    rng = random.Random(3)
    rows = [(i, k, "user" if k % 2 == 0 else "assistant", rng.choice("ab")) for i in range(150) for k in range(rng.randint(1, 6))]
    check(spark, rows)


def test_order_matters(spark):
    check(spark, [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "b"), (2, 1, "user", "a"), (2, 2, "user", "c")])


def test_empty(spark):
    check(spark, [])
