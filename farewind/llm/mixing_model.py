"""A language model of mixed bit predictors, and scores of texts under it.

A text is read as its words (A to Z in lower case), each followed by a blank, then an end
mark. A symbol is coded as the path to its leaf in a binary tree; every step of the path is a
bit to predict. Predictors are tables of how often each branch was taken in the training texts
after a hashed context: the last three, four or six symbols, or the word so far. At each step
their log-odds are added up with weights and squashed. The depth in the tree is the gate that
chooses the weights; every text starts with the same ones, which are then refined on the text
itself: after each block of symbols the weights move against the coding error of that block,
so a block is always scored with weights that come from what stands before it.

The tables above have a fixed number of rows. What grows with the corpus, besides the counts of
words, are the continuations of ``farewind.llm.continuations``: at anchors in the text one more
bit says whether the words up to the next anchor are those that most often followed the same
context in other training texts, and if so they cost nothing else.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farewind.llm import continuations
from farewind.llm.arrow_text import Words, hash_word, pieces
from farewind.llm.continuations import Anchors
from farewind.scratch import stored

#: Bytes that a lower-cased word in UTF-8 can hold, and the blank; the end mark comes after.
_BYTES = [b for b in range(256) if not (65 <= b <= 90 or 9 <= b <= 13 or b in (0xC0, 0xC1) or b >= 0xF5)]
_SYMBOL_OF = np.zeros(256, np.int64)
_SYMBOL_OF[_BYTES] = np.arange(len(_BYTES))
END = len(_BYTES)
SYMBOLS = END + 1
#: Symbols that each of the first predictors looks back.
ORDERS = (3, 4, 6)
#: log2 of the rows of each predictor's table, the last for the word so far.
ROW_BITS = (14, 16, 16, 17)
#: Letters of a word that its predictor tells apart; further in, it sees the last ones only.
WORD_LETTERS = 6
START_WEIGHTS = (0.25, 0.35, 0.25, 0.40)
RATE = 0.006
_RATE_BITS = 64  # a block moves the weights as this many bits at most
#: Symbols in the blocks after which weights are refined; the last size repeats.
BLOCKS = (128, 128, 256, 512, 1024, 2048, 4096)
#: Added to the count of either branch.
_PRIOR = 0.1
_STEP = 1 / 12  # log-odds are kept as multiples of this, in one byte
#: Rows of the tables that travel together, and their cells: places fit 16 bits.
_BLOCK_ROWS = 256
_BLOCK_CELLS = _BLOCK_ROWS * SYMBOLS
#: Bytes of text counted at once; a task also holds a table of all cells.
_COUNTED_BYTES = 300_000
#: Bytes of text scored at once.
_SCORED_BYTES = 1_000_000
#: Most frequent words whose counts every task holds; the others are joined.
HOT_WORDS = 200_000

_BASES = np.concatenate([[0], np.cumsum([1 << b for b in ROW_BITS])]) * SYMBOLS
_DIGITS = np.array([SYMBOLS**k for k in range(8)], np.uint64)
_SALTS = [np.uint64(x) for x in (0x9E3779B97F4A7C55, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def is_held_out(doc_id: Column) -> Column:
    """Whether the row is kept from training: crc32 of the id as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


class Stream:
    """The symbols of a piece's texts one after the other, and the context rows of each."""

    def __init__(self, words: Words):
        sizes = words.ends - words.starts
        n_texts = words.n_texts
        bytes_of = np.bincount(words.text, sizes + 1, n_texts).astype(np.int64) + 1
        self.lengths = bytes_of
        self.first = np.concatenate([[0], np.cumsum(bytes_of)])
        total = int(self.first[-1])
        # a word's place: the words before it with their blanks, and the end marks before it
        begin = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1] + words.text
        #: The place behind each word and its blank.
        self.after = begin + sizes + 1
        self.symbols = np.full(total, _SYMBOL_OF[32], np.int64)
        ends_at = self.first[1:] - 1
        letters = np.ones(total, bool)
        letters[begin + sizes] = False
        letters[ends_at] = False
        self.symbols[letters] = _SYMBOL_OF[words.data[words.inside]]
        self.symbols[ends_at] = END
        self.rows = self._contexts(begin)

    def _contexts(self, begin: np.ndarray) -> list[np.ndarray]:
        """Rows of each place: the symbols before it as digits, the nearest one lowest, hashed.

        The digits of a number are cut where the text begins, and for the predictor of words
        where the word begins.
        """
        n = len(self.symbols)
        starts = self.first[:-1]
        symbols = self.symbols.astype(np.uint64)
        digits = np.zeros(n, np.uint64)
        keys = []
        for k in range(1, max(*ORDERS, WORD_LETTERS) + 1):
            digits[k:] += symbols[:-k] * _DIGITS[k - 1] if k < n else 0
            if k in ORDERS:
                key = digits.copy()
                for j in range(k):
                    at = starts[self.lengths > j] + j
                    key[at] = digits[at] % _DIGITS[j] + _DIGITS[k]
                keys.append(key)
        origin = np.zeros(n, np.int64)  # where the word of each place begins
        origin[begin] = begin
        ends = self.first[1:] - 1
        origin[ends] = ends
        letters = np.arange(n) - np.maximum.accumulate(origin)
        keys.append(digits % _DIGITS[np.minimum(letters, WORD_LETTERS)] + (letters > WORD_LETTERS) * _DIGITS[7])
        return [
            ((key + np.uint64(1)) * salt >> np.uint64(64 - bits)).astype(np.int64)
            for key, salt, bits in zip(keys, _SALTS, ROW_BITS)
        ]

    def cells(self) -> list[np.ndarray]:
        """Per predictor, the cell (row, symbol) of each place among the cells of all tables."""
        return [base + row * SYMBOLS + self.symbols for base, row in zip(_BASES, self.rows)]


def _counted(batches):
    """Of all training texts of a partition: blocks of cells (kind 0), words (1), symbols (2), anchors (3)."""
    table = _Cells()
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n_held = ends = 0
    symbols = np.zeros(SYMBOLS, np.int64)
    for batch in batches:
        for piece in pieces(batch, limit=_COUNTED_BYTES):
            words = Words(piece.column("text"))
            stream = Stream(words)
            symbols += np.bincount(stream.symbols, minlength=SYMBOLS)
            for cells in stream.cells():
                table.count(cells)
            anchors = Anchors(words)
            if n := len(anchors.key):
                yield _rows(3, anchors.key, np.ones(n, np.int64), [None] * n, anchors.segment)
            ends += words.n_texts
            held.append(np.unique(words.hash, return_counts=True))
            n_held += len(held[-1][0])
            if n_held > 1_000_000:
                held = [_summed(held)]
                n_held = len(held[0][0])
    if ends:
        held.append((np.array([_END_KEY], np.uint64), np.array([ends])))
    yield _rows(2, np.arange(SYMBOLS), symbols, [None] * SYMBOLS)
    found, counts = _summed(held)
    for at in range(0, len(found), 500_000):
        part = slice(at, at + 500_000)
        keys, times = found[part].view(np.int64), counts[part].astype(np.int64)
        yield _rows(1, keys, times, [None] * len(keys))
    for first in range(0, int(_BASES[-1]), 64 * _BLOCK_CELLS):
        numbers, packed = [], []
        for at in range(first, min(first + 64 * _BLOCK_CELLS, int(_BASES[-1])), _BLOCK_CELLS):
            for data in _pack(table.block(at)):
                numbers.append(at // _BLOCK_CELLS)
                packed.append(data)
        if numbers:
            yield _rows(0, np.array(numbers, np.int64), np.zeros(len(numbers), np.int64), packed)


class _Cells:
    """Counts of all cells in 16 bits each; what comes near their limit is put into a dictionary."""

    def __init__(self):
        self.low = np.zeros(_BASES[-1], np.uint16)
        self.high: dict[int, int] = {}

    def count(self, cells: np.ndarray) -> None:
        one = np.uint16(1)
        for at in range(0, len(cells), 30_000):
            part = cells[at : at + 30_000]
            np.add.at(self.low, part, one)
            for cell in np.unique(part[self.low[part] >= 32_768]).tolist():
                self.high[cell] = self.high.get(cell, 0) + int(self.low[cell])
                self.low[cell] = 0

    def block(self, at: int) -> np.ndarray:
        counts = self.low[at : at + _BLOCK_CELLS].astype(np.uint32)
        for cell in self.high:
            if at <= cell < at + len(counts):
                counts[cell - at] += self.high[cell]
        return counts


def _rows(kind: int, keys: np.ndarray, counts: np.ndarray, packed: list, following=None) -> pa.RecordBatch:
    following = pa.nulls(len(keys), pa.int32()) if following is None else pa.array(following)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(counts),
            pa.array(packed, pa.binary()), following,
        ],
        names=["kind", "key", "n", "packed", "next"],
    )


def _pack(cells: np.ndarray):
    """The cells of a block that are not zero, as places and counts of 16 bits; large counts in parts."""
    cells = cells.copy()
    while len(places := np.flatnonzero(cells)):
        part = np.minimum(cells[places], 65535)
        cells[places] -= part
        yield places.astype(np.uint16).tobytes() + part.astype(np.uint16).tobytes()


def _tabled(tree: Tree):
    """Blocks of cells added up and made log-odds; a partition holds the blocks dealt to it."""

    def run(batches):
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(batch.column("key").to_pylist(), batch.column("packed").to_pylist()):
                places, counts = np.frombuffer(data, np.uint16).reshape(2, -1)
                blocks.setdefault(number, np.zeros(_BLOCK_CELLS, np.int64))[places] += counts
        for number, block in blocks.items():
            odds = tree.log_odds(block.reshape(_BLOCK_ROWS, SYMBOLS).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([odds.tobytes()], pa.binary())], names=["block", "odds"]
            )

    return run


def _summed(held) -> tuple[np.ndarray, np.ndarray]:
    if not held:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, inverse = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)


#: The end of a text as a token: no word contains a blank, so none has this hash.
_END_KEY = np.uint64(hash_word(b" end"))


class Tree:
    """A Huffman tree over the symbols: of each depth, the node a symbol passes and its bit."""

    def __init__(self, frequencies: np.ndarray):
        heap = [(int(f) + 1, s, s) for s, f in enumerate(frequencies)]
        heapq.heapify(heap)
        children, number = {}, SYMBOLS
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            children[number] = (a[2], b[2])
            heapq.heappush(heap, (a[0] + b[0], number, number))
            number += 1
        root = number - 1
        # nodes are numbered from the root down, leaves in order, so a subtree is a range
        self.leaves: list[int] = []
        self.ranges: list[tuple[int, int, int]] = []
        paths: dict[int, list[tuple[int, int]]] = {}
        self._walk(root, children, [], paths)
        self.depth = np.array([len(paths[s]) for s in range(SYMBOLS)], np.int64)
        deepest = int(self.depth.max())
        self.node = np.zeros((deepest, SYMBOLS), np.int64)
        self.bit = np.zeros((deepest, SYMBOLS), np.float32)
        for s, path in paths.items():
            for k, (node, bit) in enumerate(path):
                self.node[k, s], self.bit[k, s] = node, bit
        self.sign = 2 * self.bit - 1
        self._drop_unseen(frequencies)

    def _walk(self, root, children, path, paths) -> None:
        stack = [(root, [])]
        open_ranges: list[list[int]] = []
        work: list[tuple] = []
        # explicit stack: a tree of skewed counts is deep
        work.append(("enter", root, []))
        while work:
            action, *rest = work.pop()
            if action == "enter":
                node, way = rest
                if node not in children:
                    paths[node] = way
                    self.leaves.append(node)
                    continue
                number = len(open_ranges)
                open_ranges.append([len(self.leaves), 0, 0])
                left, right = children[node]
                work += [("close", number), ("enter", right, [*way, (number, 1)]), ("middle", number), ("enter", left, [*way, (number, 0)])]
            elif action == "middle":
                open_ranges[rest[0]][1] = len(self.leaves)
            else:
                open_ranges[rest[0]][2] = len(self.leaves)
        self.ranges = [tuple(r) for r in open_ranges]

    def _drop_unseen(self, frequencies: np.ndarray) -> None:
        """Number the nodes that pass seen symbols from 1 on, and all others 0: both their branches
        are alike in every table."""
        sums = np.concatenate([[0], np.cumsum(frequencies[self.leaves])])
        low, _, high = np.array(self.ranges).T
        seen = sums[high] > sums[low]
        number = np.where(seen, np.cumsum(seen), 0)
        self.node = number[self.node]
        self.ranges = [(0, 0, 0), *(r for r, s in zip(self.ranges, seen) if s)]

    def log_odds(self, counts: np.ndarray) -> np.ndarray:
        """Rows of symbol counts as rows of steps of log-odds of bit 1, one per node."""
        sums = np.zeros((len(counts), SYMBOLS + 1), np.float32)
        np.cumsum(counts[:, self.leaves], axis=1, out=sums[:, 1:])
        low, middle, high = np.array(self.ranges).T
        zeros = sums[:, middle] - sums[:, low]
        ones = sums[:, high] - sums[:, middle]
        steps = (np.log(ones + _PRIOR) - np.log(zeros + _PRIOR)) / _STEP
        return np.clip(np.rint(steps), -127, 127).astype(np.int8)


class Model:
    """What scoring needs: the tree, the predictors' tables, and the counts of frequent words.

    ``blocks`` are (number, log-odds) of the blocks of rows in which anything was counted.
    """

    def __init__(self, tree: Tree, blocks, hot: tuple[np.ndarray, np.ndarray]):
        self.tree, self.n_nodes = tree, len(tree.ranges)
        rows = np.zeros((int(_BASES[-1]) // SYMBOLS, self.n_nodes), np.int8)
        for number, odds in blocks:
            first = number * _BLOCK_ROWS
            rows[first : first + _BLOCK_ROWS] = np.frombuffer(odds, np.int8).reshape(-1, self.n_nodes)
        begins = _BASES // SYMBOLS
        self.tables = [rows[a:b].reshape(-1) for a, b in zip(begins, begins[1:])]
        self.hot_keys, self.hot_counts = hot

    def score(self, stream: Stream) -> np.ndarray:
        """Natural log of the probability of each text of the stream."""
        return np.add.reduceat(self.logs(stream), stream.first[:-1])

    def logs(self, stream: Stream) -> np.ndarray:
        """Natural log of the probability of each symbol of the stream."""
        n_texts = len(stream.lengths)
        logs = np.zeros(len(stream.symbols))
        weights = np.empty((len(self.tree.node), n_texts, len(ROW_BITS)), np.float32)
        weights[:] = START_WEIGHTS
        begin, number = 0, 0
        live = np.arange(n_texts)
        while True:
            live = live[stream.lengths[live] > begin]
            if not len(live):
                return logs
            size = BLOCKS[min(number, len(BLOCKS) - 1)]
            sizes = np.minimum(stream.lengths[live] - begin, size)
            text = np.repeat(live, sizes)
            inner = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            place = stream.first[text] + begin + inner
            self._block(stream, place, text, weights, logs)
            begin, number = begin + size, number + 1

    def _block(self, stream, place, text, weights, logs) -> None:
        symbol = stream.symbols[place]
        rows = [row[place] * self.n_nodes for row in stream.rows]
        depth = self.tree.depth[symbol]
        for k in range(len(self.tree.node)):
            going = np.flatnonzero(depth > k)
            if not len(going):
                return
            if len(going) < len(depth):
                symbol, text, depth, place = (a.take(going) for a in (symbol, text, depth, place))
                rows = [row.take(going) for row in rows]
            node, sign = self.tree.node[k].take(symbol), self.tree.sign[k].take(symbol)
            odds = [t.take(row + node).astype(np.float32) for t, row in zip(self.tables, rows)]  # in steps
            mine = weights[k]
            begins = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
            texts = text[begins]
            counts = np.diff(np.append(begins, len(text)))
            mixed = np.zeros(len(symbol), np.float32)
            for c, x in enumerate(odds):
                part = np.repeat(mine[texts, c] * np.float32(_STEP), counts)
                part *= x
                mixed += part
            np.clip(mixed, -16, 16, out=mixed)
            mixed *= sign
            against = np.exp(-mixed)  # the odds against the bit that came
            whole = against + 1
            logs[place] -= np.log(whole)
            error = np.divide(against, whole, out=against)
            error *= sign
            step = (RATE * _STEP) * np.minimum(1, _RATE_BITS / counts)
            for c, x in enumerate(odds):
                x *= error
                mine[texts, c] += step * np.add.reduceat(x, begins)


#: Lists of each text's anchors: context keys, segments, and what these cost without a bit.
_AT_ANCHORS = ("key", "next", "cost")


def _scorer(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            for piece in pieces(batch, limit=_SCORED_BYTES):
                words = Words(piece.column("text"))
                stream = Stream(words)
                sums_to = np.concatenate([[0], np.cumsum(model.logs(stream))])
                score = np.diff(sums_to[stream.first])
                anchors = Anchors(words)
                behind = np.where(anchors.ends, stream.first[anchors.text + 1], stream.after[anchors.last])
                costs = (sums_to[behind] - sums_to[stream.after[anchors.word]]).astype(np.float32)
                anchored = np.concatenate([[0], np.cumsum(anchors.counts)])
                at = np.searchsorted(model.hot_keys, words.hash)
                at[at == len(model.hot_keys)] = 0
                hot = model.hot_keys[at] == words.hash if len(model.hot_keys) else np.zeros(len(at), bool)
                gain = np.where(hot, np.log10(model.hot_counts[at] + 1.0), 0.0) if len(model.hot_keys) else np.zeros(len(at))
                n_hot = np.bincount(words.text, hot, words.n_texts).astype(np.int64)
                sums = np.bincount(words.text, gain, words.n_texts)
                rare = ~hot
                offsets = np.concatenate([[0], np.cumsum(np.bincount(words.text[rare], minlength=words.n_texts))])
                keys = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(words.hash[rare].view(np.int64))
                )
                at_anchors = [
                    pa.ListArray.from_arrays(pa.array(anchored, pa.int32()), pa.array(values))
                    for values in (anchors.key, anchors.segment, costs)
                ]
                lengths = np.bincount(words.text, words.ends - words.starts + 1, words.n_texts).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"), pa.array(words.counts.astype(np.int64)), pa.array(n_hot),
                        pa.array(sums), pa.array(score), pa.array(lengths), keys, *at_anchors,
                    ],
                    names=["doc_id", "n_words", "n_hot", "hot_sum", "mixed", "n_bytes", "rare", *_AT_ANCHORS],
                )

    return run


def _least_hot(words: DataFrame, hot_words: int) -> int:
    """The smallest count of frequent words, so that they are ``hot_words`` at most."""
    steps = words.groupBy(F.floor(4 * F.log2("n")).cast("int").alias("step")).agg(
        F.count("*").alias("words"), F.min("n").alias("least")
    )
    least, room = 2**62, hot_words
    for row in steps.orderBy(F.desc("step")).collect():
        if row["words"] > room:
            break
        least, room = row["least"], room - row["words"]
    return least


def _packed(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array([batch.column(c).to_numpy().tobytes()], pa.binary()) for c in ("key", "n")],
            names=["keys", "counts"],
        )


def _collected(packed: DataFrame, keys: type, counts: type) -> tuple[np.ndarray, np.ndarray]:
    """Packed keys and counts of all rows as arrays on the driver."""
    rows = packed.collect()
    return (
        np.concatenate([np.zeros(0, keys), *[np.frombuffer(r["keys"], keys) for r in rows]]),
        np.concatenate([np.zeros(0, counts), *[np.frombuffer(r["counts"], counts) for r in rows]]),
    )


def fit(texts: DataFrame, hot_words: int = HOT_WORDS) -> tuple[DataFrame, DataFrame, Model, int, int, int]:
    """Counts of words (key, n) and of anchors (key, next, n), the model, and the tokens, kinds of
    token and ends in ``texts``.

    Every text counts. Tasks turn the counts into tables of log-odds; these have a fixed number
    of rows whatever the corpus, 59 MB in all at most, which bounds what the driver and the
    tasks hold.
    """
    counted = stored(
        texts.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
            _counted, "kind int, key bigint, n bigint, packed binary, next int"
        ),
        "counted",
    )
    summed = counted.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n"))
    words = stored(summed, "words")
    n_tokens, n_kinds, ends = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"),
        F.coalesce(F.sum(F.when(F.col("key") == int(_END_KEY.view(np.int64)), F.col("n"))), F.lit(0)),
    ).first()
    hot = words.filter(F.col("n") >= _least_hot(words, hot_words)).mapInArrow(
        _packed, "keys binary, counts binary"
    )
    keys, times = _collected(hot, np.uint64, np.int64)
    order = np.argsort(keys)
    seen = counted.filter("kind = 2").groupBy("key").agg(F.sum("n").alias("n")).collect()
    frequencies = np.zeros(SYMBOLS, np.int64)
    for row in seen:
        frequencies[row["key"]] = row["n"]
    tree = Tree(frequencies)
    blocks = counted.filter("kind = 0").select("key", "packed").repartition("key")
    blocks = blocks.mapInArrow(_tabled(tree), "block bigint, odds binary").collect()
    model = Model(tree, blocks, (keys[order], times[order]))
    pairs = counted.filter("kind = 3").select("key", "next", "n")
    return words, pairs, model, n_tokens, n_kinds, ends


def score_documents(docs: DataFrame, hot_words: int = HOT_WORDS) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text) under the model of the rows not held out.

    doc_id, held_out, n_tokens (words and one end), n_known (tokens seen in training),
    train_tokens, base_score (log10 of the add-one probability of the tokens), score (log10 of
    the model's probability of the text) and bits_per_byte. A training text is scored by what the
    other texts, and its own other places, say about the continuations of its anchors. A null text is empty: its one token
    is the end. A row without a doc_id is not held out; repeated rows count as often as they
    come and are scored alike. Other columns are ignored. Runs jobs when called.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words, pairs, model, n_train, n_kinds, ends = fit(rows.filter(~is_held_out(F.col("doc_id"))), hot_words)
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = stored(
        rows.mapInArrow(
            _scorer(shared),
            f"doc_id {kind}, n_words bigint, n_hot bigint, hot_sum double, mixed double, n_bytes bigint, "
            "rare array<bigint>, key array<bigint>, next array<int>, cost array<float>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "scored",
    )
    rare = scored.select("row", F.explode("rare").alias("key"))
    known = rare.join(words, "key").groupBy("row").agg(
        F.sum(F.log10(F.col("n") + 1.0)).alias("rare_sum"), F.count("*").alias("n_rare")
    )
    anchors = scored.select(
        "row", is_held_out(F.col("doc_id")).alias("held_out"), F.posexplode(F.arrays_zip(*_AT_ANCHORS)).alias("at", "anchor")
    ).select("row", "held_out", "at", *[f"anchor.{c}" for c in _AT_ANCHORS])
    gained = continuations.gains(anchors, pairs)
    score = (F.col("mixed") + F.coalesce("gain", F.lit(0.0))) / float(np.log(10))
    n_tokens = F.col("n_words") + 1
    gains = F.col("hot_sum") + F.coalesce("rare_sum", F.lit(0.0)) + F.log10(F.lit(ends + 1.0))
    return scored.drop("rare", *_AT_ANCHORS).join(known, "row", "left").join(gained, "row", "left").select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"),
        n_tokens.alias("n_tokens"),
        (F.col("n_hot") + F.coalesce("n_rare", F.lit(0)) + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (gains - n_tokens * F.log10(F.lit(float(n_train + n_kinds + 1)))).alias("base_score"),
        score.alias("score"),
        (-score * float(np.log2(10)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
