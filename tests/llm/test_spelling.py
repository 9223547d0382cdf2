from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from farewind.llm import spelling
from tests.llm.tables import docs_df, documents


def one_apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(words: dict[str, int]) -> dict[str, tuple]:
    forms, near = {}, {}
    for word, n in words.items():
        found = sorted((other for other in words if one_apart(word, other)), key=lambda o: (-words[o], o))
        near[word] = len(found)
        forms[word] = found[0] if found and words[found[0]] >= 10 * n else None
    out = {}
    for word, n in words.items():
        root = word
        while forms[root]:
            root = forms[root]
        form = forms[word]
        out[word] = (form, root, n, near[word], words[form] if form else None)
    return out


def counted(rows) -> dict[str, int]:
    words: Counter[str] = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            words[run] += 1
    return {word: n for word, n in words.items() if len(word) >= 7 and n >= 2}


def variants(seed: int, n: int) -> dict[str, int]:
    """Words made of few letters, many of them one apart, with counts of all sizes."""
    rng = random.Random(seed)
    words = {}
    for _ in range(n):
        word = "".join(rng.choice("abÿ") for _ in range(rng.randint(7, 10)))
        words[word] = rng.choice([2, 3, 20, 30, 200, 400, 5000])
    return words


EDGE = {
    "aaaaaaa": 2, "aaaaaaaa": 20, "aaaaaaaaa": 200, "aaaaaaab": 20, "baaaaaa": 20, "abcdefg": 2, "abcdefgh": 2,
    "xabcdefg": 2, "abcxdefg": 2, "bcdefgh": 2, "zzzzzzz": 9, "÷×àÿzzzz": 2, "÷×àþzzzz": 30, "q" * 4000: 2, "q" * 3999 + "r": 40,
}


def check(spark, words, **options):
    df = spark.createDataFrame(list(words.items()), "word string, n long").selectExpr("*", "1 as m", "2 as key", "3 as root")
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(df, **options).collect()}
    assert found == brute_force(words)


def test_groups_as_by_brute_force(spark):
    check(spark, EDGE)
    check(spark, variants(1, 700))


def test_crowded_keys_are_halved(spark):
    words = spark.createDataFrame(list(variants(2, 500).items()), "word string, n long")
    assert len(spelling.windows(words, 5)) > 1
    check(spark, variants(2, 500), max_key_words=5, bin_words=16)


@pytest.mark.parametrize("seed", range(3))
def test_bin_gives_each_pair_in_one_window(seed):
    words = sorted(variants(seed, 300))
    as_bytes = [w.encode("latin-1") for w in words]
    for m in (7, 8, 9):
        pairs = Counter()
        for lo, hi in ((0, 2), (2, 3), (3, m)):
            pairs.update(zip(*map(list, spelling.near_in_bin(as_bytes, m, lo, hi))))
        wanted = {
            (i, j) for i, a in enumerate(words) for j, b in enumerate(words)
            if len(a) == m and len(b) in (m, m + 1) and one_apart(a, b)
        }
        assert set(pairs) == wanted and set(pairs.values()) <= {1}


def test_vocabulary_of_awkward_texts(spark):
    texts = [(row[0], row[1]) for row in documents()]
    texts += [(None, "Étrange étrange ÉTRANGE Überall überall"), (77, "seven_letters ABCDEFG abcdefg xabcdefg1abcdefg")]
    found = spelling.vocabulary(docs_df(spark, [(*t, "en", "s", 0) for t in texts])).collect()
    assert {r.word: r.n for r in found} == counted(texts)


def test_damage_takes_one_letter():
    runs = [f"{'abcdefgh' * 2}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    changed = [r for r in runs if spelling.damaged(r, "5") != r]
    assert changed and all(len(spelling.damaged(r, "5")) == len(r) - 1 for r in changed)
    assert all(zlib.crc32(f"5:{r}".encode()) % 31 == 0 for r in changed)


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.document_variants(empty).count() == 0
