from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from farewind.llm import mixing_model as mm
from farewind.llm.arrow_text import Words, hash_word
from tests.llm.tables import docs_df, documents, prose


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["\n"]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.mark.parametrize("hot_words", [0, 5, 200_000])
def test_base_score_matches_brute_force(spark, hot_words):
    """However few words are held by the tasks, the rest is found by the join."""
    rows = [(r[0], r[1]) for r in documents()]
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    expected = []
    for doc_id, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in own)
        expected.append((doc_id, held(doc_id), len(own), sum(counts[t] > 0 for t in own), total, round(base, 6)))
    found = [
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
        for r in mm.score_documents(docs_df(spark), hot_words).collect()
    ]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def small_model(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    counted = list(mm._counted([batch]))
    (symbols,) = [b["n"].to_numpy() for b in counted if b["kind"][0].as_py() == 2]
    tree = mm.Tree(symbols)
    cells = [b for b in counted if b["kind"][0].as_py() == 0]
    blocks = [(b["block"][0].as_py(), b["odds"][0].as_py()) for b in mm._tabled(tree)(cells)]
    return mm.Model(tree, blocks, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))


def test_packed_counts_add_up_to_log_odds():
    cells = np.zeros(mm._BLOCK_CELLS, np.uint32)
    cells[[0, 7, mm._BLOCK_CELLS - 1]] = [1, 200_000, 65_535]
    rows = [mm._rows(0, np.array([3]), np.array([0]), [data]) for data in mm._pack(cells)]
    tree = mm.Tree(np.bincount(np.arange(mm._BLOCK_CELLS) % mm.SYMBOLS, cells).astype(np.int64))
    (table,) = mm._tabled(tree)(rows + rows)
    assert table["block"][0].as_py() == 3
    expected = tree.log_odds(2 * cells.astype(np.float32).reshape(-1, mm.SYMBOLS))
    assert table["odds"][0].as_py() == expected.tobytes()


def test_counts_past_sixteen_bits():
    table = mm._Cells()
    cells = np.concatenate([np.full(250_000, 9), np.arange(50_000), np.full(40_000, 9)])
    table.count(cells)
    assert table.block(0)[[8, 9, 10]].tolist() == [1, 290_001, 1]
    assert table.block(0).sum() == len(cells)


def plain_score(model, text):
    """The model's probability of one text, bit by bit, with the same blocks of refinement."""
    stream = mm.Stream(Words(pa.array([text])))
    weights = {k: [float(w) for w in mm.START_WEIGHTS] for k in range(len(model.tree.node))}
    total, at, number = 0.0, 0, 0
    while at < len(stream.symbols):
        size = mm.BLOCKS[min(number, len(mm.BLOCKS) - 1)]
        seen = {k: [] for k in weights}
        for place in range(at, min(at + size, len(stream.symbols))):
            symbol = stream.symbols[place]
            for k in range(model.tree.depth[symbol]):
                node, bit = model.tree.node[k, symbol], model.tree.bit[k, symbol]
                xs = [int(t[row[place] * model.n_nodes + node]) * mm._STEP for t, row in zip(model.tables, stream.rows)]
                mixed = max(-16, min(16, sum(w * x for w, x in zip(weights[k], xs))))
                one = 1 / (1 + math.exp(-mixed))
                total += math.log(one if bit else 1 - one)
                seen[k].append((bit - one, xs))
        for k, bits in seen.items():
            if bits:
                step = mm.RATE * min(1, mm._RATE_BITS / len(bits))
                for c in range(len(weights[k])):
                    weights[k][c] += step * sum(error * xs[c] for error, xs in bits)
        at, number = at + size, number + 1
    return total


def test_scores_match_a_plain_walk():
    model = small_model([prose(i, 60) for i in range(30)])
    for text in ["", prose(3, 40), prose(99, 400), "Unseen ÄÖ words\x00 77"]:
        found = model.score(mm.Stream(Words(pa.array([text]))))[0]
        assert found == pytest.approx(plain_score(model, text), rel=1e-3)


def test_a_text_scores_alike_in_any_company():
    model = small_model([prose(i, 60) for i in range(30)])
    texts = ["", prose(3, 40), prose(99, 400), "", prose(5, 7)]
    together = model.score(mm.Stream(Words(pa.array(texts))))
    for text, score in zip(texts, together):
        assert score == pytest.approx(model.score(mm.Stream(Words(pa.array([text]))))[0], rel=1e-4)


def test_probabilities_of_all_symbols_sum_to_one():
    model = small_model([prose(i, 60) for i in range(10)])
    row = 5
    logs = np.zeros(mm.SYMBOLS)
    for s in range(mm.SYMBOLS):
        for k in range(model.tree.depth[s]):
            x = int(model.tables[0][row * model.n_nodes + model.tree.node[k, s]]) * mm._STEP
            one = 1 / (1 + math.exp(-x))
            logs[s] += math.log(one if model.tree.bit[k, s] else 1 - one)
    assert np.exp(logs).sum() == pytest.approx(1)


def test_like_texts_score_better_than_unlike():
    model = small_model([prose(i, 80) for i in range(60)])
    like, unlike = prose(1000, 80), prose(1000, 80, "fr")
    scores = model.score(mm.Stream(Words(pa.array([like, unlike]))))
    assert scores[0] / len(like.encode()) > 1.5 * scores[1] / len(unlike.encode())


def test_word_hash_is_the_same_for_one_word_and_in_a_text():
    words = Words(pa.array(["Ab cd", None, "x"]))
    assert [hash_word(w) for w in (b"ab", b"cd", b"x")] == [int(h) for h in words.hash]


def test_empty(spark):
    assert mm.score_documents(docs_df(spark, [])).collect() == []
