from __future__ import annotations

import hashlib
import math
import random
import zlib

import pytest

from farewind.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows) -> dict[int, tuple]:
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [said[1:] for said in sorted(turns, key=lambda s: s[:2])] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - int(math.fmod(c, 5)), [])
        out[c] = tuple(base[:h] + turns[h:])
    return out


def brute_force(convs: dict[int, tuple]) -> list[tuple]:
    members: dict[tuple, list[int]] = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    rows = []
    for node, ids in members.items():
        below = [other for other in members if other[: len(node)] == node]
        children = [other for other in below if len(other) == len(node) + 1]
        leaves = [o for o in below if not any(len(p) == len(o) + 1 and p[: len(o)] == o for p in members)]
        saved = sum((len(members[o]) - 1) * len(o[-1][1].encode()) for o in below if o)
        ends = ",".join(map(str, sorted(c for c in ids if convs[c] == node)))
        rows.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children),
            len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return rows


def in_order(rows) -> list[tuple]:
    return sorted(map(tuple, rows), key=lambda r: (r[0], r[1]))


def talk(seed: int, n: int, kinds: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, 12)):
            rows.append((c, turn, rng.choice(["user", "bot"]), f"t{rng.randint(1, kinds)}é"))
    rng.shuffle(rows)
    return rows


AWKWARD = [
    (0, 0, "user", "a"), (1, 0, "user", "a"), (6, 0, "user", "gone"), (2, None, None, None), (2, 1, "user", "a"), (3, 0, "user", "b"),
    (None, 0, "user", "lost"), (7, 0, "", ""), (9, 0, "user", "a"), (9, 1, "user", ""), (15, 0, "user", "x" * 5000),
    (16, 0, "bot", "own"), (12, 3, "user", None), (-3, 0, "user", "minus"),
]


@pytest.mark.parametrize(
    ("rows", "shard"), [(AWKWARD, 20_000), (talk(1, 60, 2), 25), (talk(2, 40, 1), 1)], ids=["awkward", "mixed", "alike"]
)
def test_nodes_as_by_brute_force(spark, rows, shard):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 as pos", "2 as depth", "3 as k1", "4 as shard", "5 as base", "6 as h"
    )
    convs = rebuilt(rows)
    assert rows is not AWKWARD or not all(convs.values())
    found = prefix_trie.rebuilt_trie(df, shard).select(COLUMNS).collect()
    assert in_order(found) == in_order(brute_force(convs))


def test_conversations_as_they_are(spark):
    rows = [(1, 1, "u", "a"), (1, 2, "b", "c"), (2, 1, "u", "a"), (2, 2, "b", "d"), (3, 1, "u", "a"), (4, 1, "u", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = {1: (("u", "a"), ("b", "c")), 2: (("u", "a"), ("b", "d")), 3: (("u", "a"),), 4: (("u", ""),)}
    found = prefix_trie.conversation_trie(df).select(COLUMNS).collect()
    assert in_order(found) == in_order(brute_force(convs))


def test_no_conversation_no_node(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.rebuilt_trie(empty).count() == 0
