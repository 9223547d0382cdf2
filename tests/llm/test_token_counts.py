from __future__ import annotations

import random
import re

import pytest

from farewind.llm.token_counts import MARK, Vocabulary, count_tokens, read_vocabulary
from tests.llm.tables import docs_df, documents

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(MODEL)


def test_every_text_matches_the_plain_recursion(spark, vocabulary):
    expected = []
    for doc_id, text, *_ in documents():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = sum(vocabulary.count_one((MARK + w).encode()) for w in words)
        expected.append((doc_id, len(words), n, len((text or "").encode())))
    found = [tuple(r) for r in count_tokens(docs_df(spark), vocabulary).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def exhaustive(vocabulary, word):
    """Best (score, -tokens) over all segmentations, by plain enumeration."""
    if not word:
        return (0, 0)
    options = []
    for end in range(1, len(word) + 1):
        score = vocabulary.scores.get(word[:end])
        rest = exhaustive(vocabulary, word[end:])
        if score is not None:
            options.append((score + rest[0], rest[1] - 1))
        if end == 1:
            options.append((vocabulary.fallback + rest[0], rest[1] - 1))
    return max(options)


def test_trie_matches_enumeration_with_ties():
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 4))) for _ in range(25)]
    vocabulary = Vocabulary(pieces)
    for word in pieces:
        vocabulary.scores[word] = vocabulary.scores[word] // 30000 * 30000  # make ties
    vocabulary.keys, vocabulary.values = vocabulary._table()
    words = sorted({bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 9))) for _ in range(150)})
    found = vocabulary.count_distinct(words)
    assert [-exhaustive(vocabulary, w)[1] for w in words] == found.tolist()


def test_order_of_distinct_words_does_not_matter(vocabulary):
    words = [b"banana", b"ban", b"bandana", b"b", b"bananas", "é".encode(), b"a\x00", b"a", b"z" * 80]
    straight = dict(zip(words, vocabulary.count_distinct(words).tolist()))
    assert straight == {w: vocabulary.count_one(w) for w in words}


def test_empty(spark, vocabulary):
    assert count_tokens(docs_df(spark, []), vocabulary).collect() == []
