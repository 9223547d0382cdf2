from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from farewind.llm import continuations as ct
from farewind.llm import mixing_model as mm
from farewind.llm.arrow_text import Words, hash_word, mix
from tests.llm.tables import docs_df, documents, prose
from tests.llm.test_mixing_model import held, tokens

M = 2**64


def mixed(h):
    return int(mix(np.array([h % M], np.uint64))[0])


def plain_anchors(text):
    """(context, words of the segment, whether the text ends with it), word by word."""
    words = [t.encode() for t in tokens(text)[:-1]]
    hashes = [hash_word(w) for w in words]
    found = []
    for i in range(len(words)):
        key = hashes[i]
        for back in range(1, ct.CONTEXT_WORDS):
            key = mixed(key * int(ct._ODD) + (hashes[i - back] if i >= back else 0))
        if key % ct.EVERY == 0:
            found.append((i, key))
    stops = [i for i, _ in found[1:]] + [len(words) - 1]
    return [
        (key, tuple(words[i + 1 : stop + 1]), n == len(found) - 1)
        for n, ((i, key), stop) in enumerate(zip(found, stops))
    ]


def level(n):
    return min(int(math.log2(n)), ct._LEVELS - 1)


def plain_gains(rows, costs):
    """What the bits of each row add, from counts in dictionaries; ``costs``: per row, of each anchor."""
    segments = defaultdict(Counter)
    for doc_id, text in rows:
        if not held(doc_id):
            for key, words, end in plain_anchors(text):
                segments[key][words, end] += 1
    order = {}  # ties go to the largest hash, which only the operator knows
    for doc_id, text in rows:
        a = ct.Anchors(Words(pa.array([text], pa.string())))
        order.update(zip([s[1:] for s in plain_anchors(text)], a.segment.tolist()))
    bits = []
    for doc_id, text in rows:
        mine = []
        for at, (key, words, end) in enumerate(plain_anchors(text)):
            total = sum(segments[key].values())
            if not total:
                continue
            n, _, best = max((n, order[s], s) for s, n in segments[key].items())
            hit = best == (words, end)
            if not held(doc_id):
                total -= 1
                if hit and n > 1:
                    n -= 1
                elif hit:
                    hit = False
            if total > 0:
                mine.append((at, level(n) * ct._LEVELS + level(total - n + 1), hit))
        bits.append(mine)
    seen = defaultdict(lambda: [0, 0])
    for (doc_id, _), mine in zip(rows, bits):
        for _, gate, hit in mine if not held(doc_id) else []:
            seen[gate][not hit] += 1
    gains = []
    for mine, cost in zip(bits, costs):
        gain, weight, bias = 0.0, 1.0, 0.0
        for at, gate, hit in mine:
            x = math.log((seen[gate][0] + 0.5) / (seen[gate][1] + 0.5))
            one = 1 / (1 + math.exp(-max(-16, min(16, weight * x + bias))))
            gain += math.log(one) - cost[at] if hit else math.log1p(-one)
            weight += ct.RATE * (hit - one) * x
            bias += ct.RATE * (hit - one)
        gains.append(gain)
    return gains


def test_segments_are_the_words_between_anchors():
    texts = [prose(1, 300), "", None, "a", prose(2, 90) + " " + prose(1, 300), prose(1, 3)]
    words = Words(pa.array(texts))
    found = ct.Anchors(words)
    expected = [(i, *anchor) for i, text in enumerate(texts) for anchor in plain_anchors(text)]
    assert [(t, int(np.int64(k).view(np.uint64)), e) for t, k, e in zip(found.text, found.key, found.ends)] == [
        (i, key, end) for i, key, _, end in expected
    ]
    hashes = {}
    for word, last, segment, (_, _, run, end) in zip(found.word, found.last, found.segment.tolist(), expected):
        assert tuple(words.word(j) for j in range(word + 1, last + 1)) == run
        assert hashes.setdefault((run, end), segment) == segment
    assert len(set(hashes.values())) == len(hashes)


def test_scores_match_plain_counts(spark):
    rows = [(r[0], r[1]) for r in documents()]
    rows += [(1000 + i, prose(i % 12, 150) + " " + prose(50 + i % 5, 120)) for i in range(60)]
    df = docs_df(spark, [(i, text, "en", "s", 0) for i, text in rows])
    _, _, model, *_ = mm.fit(df.filter(~mm.is_held_out(df["doc_id"])))
    expected, costs = [], []
    for _, text in rows:
        words = Words(pa.array([text], pa.string()))
        stream, anchors = mm.Stream(words), ct.Anchors(words)
        logs = model.logs(stream)
        stops = [len(logs) if end else stream.after[last] for end, last in zip(anchors.ends, anchors.last)]
        costs.append([logs[stream.after[w] : stop].sum() for w, stop in zip(anchors.word, stops)])
        expected.append(logs.sum())
    gains = plain_gains(rows, costs)
    assert sum(g > 0 for g in gains) > 40
    found = sorted(((repr(r["doc_id"]), r["score"]) for r in mm.score_documents(df).collect()))
    wanted = sorted((repr(i), (s + g) / math.log(10)) for (i, _), s, g in zip(rows, expected, gains))
    assert [i for i, _ in found] == [i for i, _ in wanted]
    assert [s for _, s in found] == pytest.approx([s for _, s in wanted], rel=1e-3)


def test_chances_of_bits_add_up():
    """A segment hit or missed: the two probabilities make one, whatever came before."""
    odds = np.zeros(64)
    odds[[3, 7]] = [2.0, -1.0]
    for gates in ([3], [3, 7, 7], [7, 3, 3, 3]):
        size = np.array([len(gates)])
        cost, before = np.zeros(len(gates)), np.zeros(len(gates), bool)
        ends = []
        for last in (True, False):
            hit = before.copy()
            hit[-1] = last
            ends.append(ct.gains_of(odds, size, np.array(gates), hit, cost)[0])
        sooner = ct.gains_of(odds, size - 1, np.array(gates[:-1], int), before[:-1], cost[:-1])[0]
        assert np.exp(ends).sum() == pytest.approx(math.exp(sooner))


def test_texts_that_occur_twice_stand_apart(spark):
    """Two training copies foretell each other; a text of its own does not foretell itself."""
    ids = [i for i in range(1, 400) if not held(i)]
    once = [(i, prose(5000 + i, 200), "en", "s", 0) for i in ids[:100]]
    twice = [(i, prose(9000 + n // 2, 200), "en", "s", 0) for n, i in enumerate(ids[100:140])]
    rates = {r["doc_id"]: r["bits_per_byte"] for r in mm.score_documents(docs_df(spark, once + twice)).collect()}
    assert max(rates[r[0]] for r in twice) < 0.8 * min(rates[r[0]] for r in once)


def test_the_table_grows_with_the_corpus(spark):
    def contexts(n):
        df = docs_df(spark, [(i, prose(i, 200), "en", "s", 0) for i in range(n)])
        return ct.most_frequent(mm.fit(df)[1]).count()

    assert contexts(80) > 3 * contexts(20)
