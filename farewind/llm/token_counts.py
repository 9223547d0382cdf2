"""Token counts under a unigram vocabulary, found once per distinct pre-token over a trie.

A pre-token is a word with the mark of a word's beginning in front. The distinct pre-tokens of
a piece of texts are sorted, which makes them a trie: a node is a prefix, shared by all that
begin with it. Forward scores (best score of any segmentation of the prefix, and its number of
tokens) are computed level by level, once per node; the terminal nodes hold the counts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from farewind.llm.arrow_text import Words, pieces

MARK = "▁"  # fixed value: begins a word in the vocabulary
_SCALE = 2**16
#: Bytes of a pre-token up to which it goes into the trie; longer ones are walked one by one.
_TRIE_BYTES = 64
_P = 0x9E3779B97F4A7C55


class Vocabulary:
    """Pieces (as bytes) with integer scores; bytes that no piece covers cost ``fallback``.

    The files of public vocabularies hold ranks, not probabilities. A piece's score is the
    logarithm of 1 / (rank + 1), as word frequencies fall with their rank; scores are rounded
    to integers, so sums are exact and ties are ties. Of equal scores fewer tokens win.
    """

    def __init__(self, pieces_in_order: list[bytes]):
        scores: dict[bytes, int] = {}
        for rank, piece in enumerate(pieces_in_order):
            if piece and piece not in scores:
                scores[piece] = -round(_SCALE * math.log(rank + 2))
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.fallback = -round(_SCALE * (math.log(len(pieces_in_order) + 2) + 10))
        self.size = 1 << max(10, (4 * max(1, len(scores)) - 1).bit_length())
        self.keys, self.values = self._table()

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """Open addressing by polynomial hash; an empty slot has key 0."""
        keys, values = np.zeros(self.size, np.uint64), np.zeros(self.size, np.int64)
        for piece, score in self.scores.items():
            key = _polynomial(piece)
            slot = _slot(key, self.size)
            while keys[slot]:
                slot = (slot + 1) % self.size
            keys[slot], values[slot] = key, score
        return keys, values

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions among ``keys`` that are pieces, and their scores."""
        shift = np.uint64(64 - self.size.bit_length() + 1)
        slots = ((keys * np.uint64(_P)) >> shift).astype(np.int64)
        open_at, hits, scores = np.arange(len(keys)), [], []
        while len(open_at):
            there = self.keys[slots]
            same = there == keys[open_at]
            hits.append(open_at[same])
            scores.append(self.values[slots[same]])
            on = (there != 0) & ~same
            open_at, slots = open_at[on], (slots[on] + 1) % self.size
        return np.concatenate(hits), np.concatenate(scores)

    def count_one(self, pretoken: bytes) -> int:
        """Tokens of one pre-token, by the plain forward recursion."""
        best = [(0, 0)]
        for end in range(1, len(pretoken) + 1):
            options = [(best[end - 1][0] + self.fallback, best[end - 1][1] - 1)]
            for begin in range(max(0, end - self.longest), end):
                score = self.scores.get(pretoken[begin:end])
                if score is not None:
                    options.append((best[begin][0] + score, best[begin][1] - 1))
            best.append(max(options))
        return -best[-1][1]

    def count_sorted(self, words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of each row of ``words`` (n, width) bytes, sorted, of which ``sizes`` count."""
        n, width = words.shape
        shared = np.zeros(n, np.int64)  # bytes shared with the row before
        if n > 1:
            same = words[1:] == words[:-1]
            shared[1:] = np.where(same.all(axis=1), width, same.argmin(axis=1))
            shared[1:] = np.minimum(shared[1:], np.minimum(sizes[1:], sizes[:-1]))
        powers = np.array([pow(_P, k, 2**64) for k in range(width + 1)], np.uint64)
        node = np.zeros(n, np.int64)  # of each row at the present depth
        levels = [(np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.uint64))]
        parents: list[np.ndarray] = [np.zeros(1, np.int64)]
        result = np.zeros(n, np.int64)
        for depth in range(1, width + 1):
            alive = sizes >= depth
            if not alive.any():
                break
            new = alive & (shared < depth)
            rows = np.flatnonzero(new)
            parent = node[rows]
            node = np.where(alive, np.cumsum(new) - 1, 0)
            _, _, sums = levels[-1]
            total = sums[parent] * np.uint64(_P) + words[rows, depth - 1].astype(np.uint64) + np.uint64(1)
            parents.append(parent)
            score = levels[-1][0][parent] + self.fallback
            count = levels[-1][1][parent] + 1
            up = np.arange(len(rows))
            for back in range(1, min(depth, self.longest) + 1):
                up = parents[depth - back + 1][up]
                old_score, old_count, old_sum = levels[depth - back]
                at, piece_score = self.find(total - old_sum[up] * powers[back])
                if not len(at):
                    continue
                new_score, new_count = old_score[up[at]] + piece_score, old_count[up[at]] + 1
                better = (new_score > score[at]) | ((new_score == score[at]) & (new_count < count[at]))
                score[at[better]], count[at[better]] = new_score[better], new_count[better]
            levels.append((score, count, total))
            ends = np.flatnonzero(sizes == depth)
            result[ends] = count[node[ends]]
        return result

    def count_distinct(self, pretokens: list[bytes]) -> np.ndarray:
        """Tokens of each of the pre-tokens, which are distinct."""
        counts = np.zeros(len(pretokens), np.int64)
        sizes = np.array([len(p) for p in pretokens], np.int64)
        short = np.flatnonzero((sizes <= _TRIE_BYTES) & (sizes > 0))
        if len(short):
            order = short[np.argsort(np.array([pretokens[i] for i in short], dtype=object), kind="stable")]
            width = int(sizes[order].max())
            matrix = np.array([pretokens[i] for i in order], dtype=f"S{width}").view(np.uint8).reshape(-1, width)
            counts[order] = self.count_sorted(matrix, sizes[order])
        for i in np.flatnonzero(sizes > _TRIE_BYTES):
            counts[i] = self.count_one(pretokens[i])
        return counts


def _polynomial(piece: bytes) -> int:
    total = 0
    for byte in piece:
        total = (total * _P + byte + 1) % 2**64
    return total


def _slot(key: int, size: int) -> int:
    return (key * _P % 2**64) >> (64 - size.bit_length() + 1)


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a SentencePiece model file in order of rank; control pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return Vocabulary([
        model.id_to_piece(i).encode()
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ])


def _counter(shared):
    def count(batches):
        vocabulary = shared.value
        mark = MARK.encode()
        for batch in batches:
            for piece in pieces(batch):
                words = Words(piece.column("text"), lower=False)
                _, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
                counts = vocabulary.count_distinct([mark + words.word(i) for i in first])
                n_tokens = np.bincount(words.text, counts[inverse] if len(first) else None, words.n_texts)
                names = piece.schema.names
                columns = [c for c, name in zip(piece.columns, names) if name != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(words.counts.astype(np.int64)), pa.array(n_tokens.astype(np.int64)), pa.array(np.diff(words.offsets))],
                    names=[*[n for n in names if n != "text"], "n_pretokens", "n_tokens", "n_bytes"],
                )

    return count


def count_tokens(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_pretokens, n_tokens and n_bytes of each row of ``docs`` (doc_id, text).

    A pre-token is a run of characters other than blank and U+0009 to U+000D. Null and empty
    texts have none. Repeated rows are counted alike; other columns are ignored.
    """
    rows = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return rows.mapInArrow(
        _counter(shared), f"doc_id {kind}, n_pretokens bigint, n_tokens bigint, n_bytes bigint"
    )
