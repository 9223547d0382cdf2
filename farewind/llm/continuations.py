"""What followed the same words elsewhere in a corpus, as bits for a language model to predict.

A place behind a word is an anchor if the hash of the last three words of its text (fewer near
the text's begin) is divisible by ``EVERY``: equal passages have equal anchors. The segment of
an anchor runs to the next anchor of the text, or through the text's end. A table keyed by the
full hash, whose rows grow with the corpus, holds the segment that most often followed it.
Before a segment of a known context, one bit says whether it is that one; if so, nothing more
has to be coded. The bit's chance is what was found for contexts of like counts over all
training texts, as log-odds weighted anew after each bit of the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farewind.llm.arrow_text import Words, mix
from farewind.scratch import stored

CONTEXT_WORDS = 3
#: One place in so many is an anchor.
EVERY = 16
#: How far a bit moves the weights of its text.
RATE = 0.1
#: Powers of two that counts are told apart by, for the chance of a bit.
_LEVELS = 8
_ODD = np.uint64(0x9E3779B97F4A7C55)


class Anchors:
    """The anchors of a piece: word before, context key, text, last word and hash of the segment."""

    def __init__(self, words: Words):
        key = words.hash.copy()
        for back in range(1, CONTEXT_WORDS):
            before = np.zeros(len(key), np.uint64)
            same = words.text[back:] == words.text[:-back]
            before[back:] = np.where(same, words.hash[:-back], np.uint64(0))
            key = mix(key * _ODD + before)
        self.word = np.flatnonzero(key % np.uint64(EVERY) == 0)
        self.key = key[self.word].view(np.int64)
        self.text = words.text[self.word]
        self.counts = np.bincount(self.text, minlength=words.n_texts)
        self.last = words.first[self.text + 1] - 1
        self.ends = np.ones(len(self.word), bool)
        if len(self.word):
            self.ends[:-1] = self.text[1:] != self.text[:-1]
            following = np.flatnonzero(~self.ends)
            self.last[following] = self.word[following + 1]
        runs = mix(words.runs(self.word + 1, self.last + 1) + self.ends.astype(np.uint64))
        self.segment = (runs >> np.uint64(32)).astype(np.uint32).view(np.int32)


def most_frequent(pairs: DataFrame) -> DataFrame:
    """Of (key, next, n): per key the total, and the next with most (ties: the largest) and its count."""
    counted = pairs.groupBy("key", "next").agg(F.sum("n").alias("n"))
    best = counted.groupBy("key").agg(F.sum("n").alias("total"), F.max(F.struct("n", "next")).alias("best"))
    return best.select("key", "total", F.col("best.n").alias("n_best"), F.col("best.next").alias("best"))


def _level(n: Column) -> Column:
    return F.least(F.floor(F.log2(n)), F.lit(_LEVELS - 1)).cast("int")


def _bits(anchors: DataFrame, table: DataFrame) -> DataFrame:
    """One bit per anchor whose context is known from another place: row, at, held_out, gate, hit, cost.

    A place of a training text does not count itself. If its segment was seen nowhere else, it
    misses, against one of the others that were seen once.
    """
    same = F.col("next") == F.col("best")
    alone = ~F.col("held_out") & same & (F.col("n_best") == 1)
    less = F.when(F.col("held_out"), 0).otherwise(1)
    n_best = F.when(alone | ~same, F.col("n_best")).otherwise(F.col("n_best") - less)
    total = F.col("total") - less
    return anchors.join(table, "key").filter(total > 0).select(
        "row", "at", "held_out",
        (_level(n_best) * _LEVELS + _level(total - n_best + 1)).alias("gate"),
        (same & ~alone).alias("hit"), "cost",
    )


def _chances(bits: DataFrame) -> np.ndarray:
    """Log-odds of a hit per gate over all training texts; 64 rows at most reach the driver."""
    odds = np.zeros(_LEVELS * _LEVELS)
    found = bits.filter(~F.col("held_out")).groupBy("gate").agg(
        F.sum(F.col("hit").cast("long")).alias("hits"), F.count("*").alias("n")
    )
    for r in found.collect():
        odds[r["gate"]] = np.log((r["hits"] + 0.5) / (r["n"] - r["hits"] + 0.5))
    return odds


def gains_of(odds: np.ndarray, sizes: np.ndarray, gate: np.ndarray, hit: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Per text, what its bits add to its log probability; bits of a text follow each other.

    ``cost`` is the log probability of the segment without the bit. All texts with a j-th bit
    take it together.
    """
    gains, weight, bias = np.zeros(len(sizes)), np.ones(len(sizes)), np.zeros(len(sizes))
    first = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    falling = -sizes[order]
    for j in range(int(sizes.max(initial=0))):
        live = order[: np.searchsorted(falling, -j)]
        at = first[live] + j
        x, found = odds[gate[at]], hit[at]
        mixed = np.clip(weight[live] * x + bias[live], -16, 16)
        one = 1 / (1 + np.exp(-mixed))
        gains[live] += np.where(found, np.log(one) - cost[at], np.log1p(-one))
        error = RATE * (found - one)
        weight[live] += error * x
        bias[live] += error
    return gains


def _gains(odds: np.ndarray):
    def run(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch.column("gate")).to_numpy().astype(np.int64)
            gate, hit, cost = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("gate", "hit", "cost"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(gains_of(odds, sizes, gate, hit, cost))], names=["row", "gain"]
            )

    return run


def gains(anchors: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per row that has any bit, what its bits add to its natural log probability: row, gain.

    ``anchors``: row, held_out, at (order in the text), key, next, cost; ``pairs``: key, next, n
    of the training texts. No anchor, or no known context: no row. Contexts meet in a join of
    two stored tables, whose crowded keys Spark splits; only a text's own bits meet in one list.
    Runs jobs when called.
    """
    table = stored(most_frequent(pairs), "continuations")
    bits = stored(_bits(anchors, table), "bits")
    lists = bits.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "gate", "hit", "cost"))).alias("bits"))
    return lists.select(
        "row", *[F.col(f"bits.{c}").alias(c) for c in ("gate", "hit", "cost")]
    ).mapInArrow(_gains(_chances(bits)), "row bigint, gain double")
