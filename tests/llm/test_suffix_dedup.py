from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from farewind.llm import suffix_dedup
from tests.llm.tables import docs_df, documents


def brute_force(texts: list[str | None], length: int) -> list[tuple]:
    data = [(text or "").encode() for text in texts]
    places = defaultdict(int)
    for b in data:
        for i in range(len(b) - length + 1):
            places[b[i : i + length]] += 1
    rows = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if places[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = int((gone[:-1] & ~np.append(False, gone[:-2])[: len(b)]).sum()) if len(b) else 0
        rows.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return rows


def check(spark, texts, length, anchor, max_classes=suffix_dedup.MAX_CLASSES):
    df = docs_df(spark, [(i, text, "en", "s", 0) for i, text in enumerate(texts)]).withColumnRenamed("row", "key")
    removed = suffix_dedup.remove_repeats(df, length, anchor, max_classes)
    found = sorted(map(tuple, suffix_dedup.digest(removed).collect()))
    assert found == [(i, *row) for i, row in enumerate(brute_force(texts, length))]


def few_letters(seed: int, n: int, size: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("ab é") for _ in range(rng.randint(0, size))) for _ in range(n)]


def passages(seed: int) -> list[str]:
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choice("abcdefghij ü") for _ in range(n))
    shared = [prose(60), prose(25), prose(200)]
    texts = [prose(rng.randint(0, 80)) + rng.choice(shared) + prose(rng.randint(0, 80)) for _ in range(60)]
    # One passage in very many texts, with other words around it.
    texts += [prose(30) + shared[0] + prose(30) for _ in range(120)]
    return [*texts, shared[2], shared[2], shared[2] * 2, None, "", "x" * 500, "xy" * 100, *texts[:3]]


@pytest.mark.parametrize(
    ("texts", "length", "anchor", "max_classes"),
    [(few_letters(1, 40, 120), 8, 3, 8192), (passages(2), 20, 6, 8192), (passages(3), 40, 8, 10)],
    ids=["few letters", "passages", "crowded anchors"],
)
def test_bytes_removed_as_by_brute_force(spark, texts, length, anchor, max_classes):
    check(spark, texts, length, anchor, max_classes)


def test_contract_length_on_awkward_rows(spark):
    base = documents()[0][1] * 4
    texts = [row[1] for row in documents()]
    check(spark, [*texts, base, base[50:900], "é" * 199 + "a", "é" * 200, "é" * 200, "b" * 400, "c" * 401, base + base], 400, 32)


def test_transform_is_in_suffix_order():
    rng = random.Random(5)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(50)]
    width = 12
    first = np.array([rng.randint(0, width - len(w)) for w in words])
    symbols = np.zeros((width, len(words)), np.uint8)
    for i, w in enumerate(words):
        symbols[first[i] : first[i] + len(w), i] = np.frombuffer(w.encode(), np.uint8)
    last = first + np.array([len(w) for w in words]) - 1
    for column, order, put, common in suffix_dedup.transform_columns(symbols, last):
        suffixes = [words[i][column - first[i] :] if column >= first[i] else None for i in order]
        live = [s for s in suffixes if s is not None]
        assert live == sorted(live) and sorted(order) == [i for i in range(len(words)) if last[i] >= column]
        for k in range(1, len(suffixes)):
            a, b = suffixes[k - 1], suffixes[k]
            if a is None:
                continue
            same = 0
            while same < min(len(a), len(b)) and a[same] == b[same]:
                same += 1
            assert common[k] == same and put[k] == ord(b[0])


def test_long_text_has_the_same_anchors_in_stretches(monkeypatch):
    data = np.frombuffer(("abracadabra " * 50 + "x" * 300).encode(), np.uint8)
    whole = suffix_dedup.segments(data, np.array([0, 100, len(data)]), 40, 8)
    monkeypatch.setattr(suffix_dedup, "_STRETCH", 64)
    for a, b in zip(whole, suffix_dedup.segments(data, np.array([0, 100, len(data)]), 40, 8)):
        assert (a == b).all()


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.digest(suffix_dedup.remove_repeats(empty)).count() == 0
