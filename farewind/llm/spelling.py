"""Spelling variants: words one letter apart, found through a bit-sliced position index.

The words of a bin are bits of a bitset. At each position, each letter has the bitset of the
words that have it there. All words of a bin are searched at once, letter by letter: the
zero-error set of a searched word holds the words that agree so far, its one-error sets those that
agree but for one replaced letter (same position) or one letter more (position shifted by one).
Pairs with a letter less are the same pairs seen from the other word.

Bins make the bitsets short. A pair's first difference lies in a window of positions of the
shorter word; outside its window the two words agree, so the letters there are the key that brings
both to one bin. Windows are the two halves at first; while a key has more words than a bin may
hold, its windows are halved again. A window of one position is shared by a few words only, so
this ends, and each pair belongs to exactly one window.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farewind.scratch import stored

#: Words of fewer letters are left out, and words that occur less often.
MIN_LETTERS, MIN_COUNT = 7, 2
#: A word's form occurs so many times as often, at least.
MIN_RATIO = 10
#: One letter goes from a run whose checksum this divides.
DAMAGE = 31
#: Entries of an average bin, and of a key before its windows are halved.
BIN_WORDS, MAX_KEY_WORDS = 1024, 4096
#: Letters that the words of an average bin have together, at most.
BIN_LETTERS = 1 << 20
#: Distinct words that a task counts before it passes the counts on.
_HELD_WORDS = 200_000
#: Words looked up together in a bin, so that their bitsets stay small.
_BLOCK_WORDS = 2048

_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)


def damaged(run: str, doc_id: str) -> str:
    """The run without one letter if DAMAGE divides the checksum of ``<doc_id>:<run>``."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{doc_id}:".encode()))
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(batches):
    """Words and counts of (doc_id, text), counted for many texts before they are passed on."""
    counts: Counter[str] = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )
        counts.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            if not text.is_valid:
                continue
            lowered = text.as_buffer().to_pybytes().lower().decode()
            start = zlib.crc32(f"{doc_id}:".encode())
            for run, n in Counter(_RUN.findall(lowered)).items():
                h = zlib.crc32(run.encode(), start)
                if h % DAMAGE == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < MIN_LETTERS:
                        continue
                counts[run] += n
        if len(counts) > _HELD_WORDS:
            yield flush()
    if counts:
        yield flush()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n of the words of ``docs`` (doc_id, text) with letters and occurrences enough.

    A run is a maximal sequence of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case. One letter
    of a run goes if DAMAGE divides the crc32 of ``<doc_id>:<run>`` (a null doc_id is written
    None). A null text has no runs; every occurrence counts, repeated rows too.
    """
    counted = docs.select(F.col("doc_id"), "text").mapInArrow(_count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _key(word: Column, m: Column, lo: Column, hi: Column) -> Column:
    """A hash of the window and of the letters outside it."""
    rest = F.substring(word, F.char_length(word) - (m - hi) + F.lit(1), m - hi)
    return F.xxhash64(m, lo, hi, F.substring(word, F.lit(1), lo), rest)


def _halved(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, lo, hi) with both halves of their windows, and their keys."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi"))
    )
    out = rows.select("word", "n", "m", F.explode(halves).alias("w")).select("word", "n", "m", "w.lo", "w.hi")
    return out.withColumn("key", _key(F.col("word"), F.col("m"), F.col("lo"), F.col("hi")))


def windows(words: DataFrame, max_key_words: int = MAX_KEY_WORDS) -> list[DataFrame]:
    """Tables (word, n, m, lo, hi, key): each word in all its windows, as the shorter (length m)
    or as the longer (m + 1); no key has more than ``max_key_words`` words unless its window is
    one position. Runs jobs when called."""
    length = F.char_length("word")
    as_either = F.explode(F.array(length, length - 1)).alias("m")
    rows = words.select("word", "n", as_either).filter(F.col("m") >= MIN_LETTERS)
    rows = rows.withColumns({"lo": F.lit(0), "hi": F.col("m")})
    done = []
    while True:
        now = stored(_halved(rows), "windows")
        crowded = now.groupBy("key").agg(F.count("*").alias("words"), F.max(F.col("hi") - F.col("lo")).alias("wide"))
        crowded = stored(crowded.filter((F.col("words") > max_key_words) & (F.col("wide") > 1)).select("key"), "crowded")
        if crowded.isEmpty():
            return [*done, now]
        done.append(now.join(crowded, "key", "left_anti"))
        rows = now.join(crowded, "key", "left_semi").drop("key")


def _bits(rows: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    packed = np.packbits(rows, axis=1, bitorder="little")
    wide = np.zeros((len(rows), -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view(np.uint64)


class PositionIndex:
    """Bitsets over words (Latin-1 bytes): who has a letter at a position, who has a length."""

    def __init__(self, words: list[bytes]):
        self.n = len(words)
        self.lengths = np.array([len(word) for word in words])
        longest = int(self.lengths.max())
        joined = b"".join(word.ljust(longest, b"\0") for word in words)
        #: A column of letters for each position; 0 behind a word's end.
        self.letters = np.ascontiguousarray(np.frombuffer(joined, np.uint8).reshape(self.n, longest).T)

    def at(self, position: int) -> np.ndarray:
        """256 bitsets, one a letter."""
        table = np.zeros((256, -(-self.n // 64)), np.uint64)
        if position < len(self.letters):
            column = self.letters[position]
            present = np.unique(column)
            present = present[present > 0]
            table[present] = _bits(column[None, :] == present[:, None])
        return table

    def of_length(self, length: int) -> np.ndarray:
        return _bits((self.lengths == length)[None, :])[0]


def near_in_bin(words: list[bytes], m: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) one letter apart whose first difference is in [lo, hi), or at m if hi is m.

    i has length m; j has length m (both orders come out) or m + 1 (once).
    """
    index = PositionIndex(words)
    queries = np.flatnonzero(index.lengths == m)
    same, longer = index.of_length(m), index.of_length(m + 1)
    found = []
    for at in range(0, len(queries), _BLOCK_WORDS):
        block = queries[at : at + _BLOCK_WORDS]
        width = len(same)
        zero = np.broadcast_to(same | longer, (len(block), width))
        replaced = np.zeros((len(block), width), np.uint64)
        inserted = np.zeros((len(block), width), np.uint64)
        outside = np.zeros((len(block), width), np.uint64)
        here = index.at(0)
        for position in range(m):
            if position == lo:
                within = zero
            if position == hi:
                outside = zero
            after = index.at(position + 1)
            letters = index.letters[position, block]
            stays, shifted = here[letters], after[letters]
            inserted = (inserted | zero) & shifted
            replaced = (replaced & stays) | (zero & ~stays)
            zero = zero & stays
            here = after
        inserted = (inserted | zero) & longer
        hits = ((replaced & same) | inserted) & within & ~outside
        some = np.flatnonzero(hits.any(axis=1))
        flags = np.unpackbits(hits[some].view(np.uint8), axis=1, bitorder="little")[:, : index.n]
        left, right = np.nonzero(flags)
        found.append((block[some[left]], right))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found))


def _best_near(n: int, left: np.ndarray, right: np.ndarray, counts: np.ndarray, rank: np.ndarray):
    """Of each word with near words: how many, and which has the largest count (then first in order)."""
    order = np.lexsort((rank[right], -counts[right], left))
    first = np.append(True, np.diff(left[order]) > 0)
    return left[order][first], np.bincount(left, minlength=n)[left[order][first]], right[order][first]


def _search_bin(rows: pa.Table) -> pa.Table:
    """One bin: near words of each of its words, by count and the best one, window by window."""
    words = np.array([word.encode("latin-1") for word in rows["word"].to_pylist()], object)
    counts = rows["n"].to_numpy()
    window = np.stack([rows[c].to_numpy() for c in ("m", "lo", "hi")])
    order = np.lexsort(window[::-1])
    cuts = np.flatnonzero((np.diff(window[:, order], axis=1) != 0).any(axis=0)) + 1
    names, numbers = [], []
    for members in np.split(order, cuts):
        if len(members) < 2:
            continue
        m, lo, hi = window[:, members[0]].tolist()
        own, n = words[members], counts[members]
        left, right = near_in_bin(own.tolist(), m, lo, hi)
        if not len(left):
            continue
        longer = np.array([len(word) for word in own])[right] > m
        left, right = np.append(left, right[longer]), np.append(right, left[longer])
        rank = np.argsort(np.argsort(own, kind="stable"), kind="stable")
        who, n_near, best = _best_near(len(own), left, right, n, rank)
        names.append((own[who], own[best]))
        numbers.append((n[who], n_near, n[best]))
    word, best = (
        pa.array([w.decode("latin-1") for part in names for w in part[side]], pa.string()) for side in (0, 1)
    )
    n, n_near, best_n = (
        pa.array(np.concatenate([part[side] for part in numbers]) if numbers else [], pa.int64()) for side in (0, 1, 2)
    )
    return pa.table({"word": word, "n": n, "n_near": n_near, "best_n": best_n, "best": best})


def near_words(words: DataFrame, max_key_words: int = MAX_KEY_WORDS, bin_words: int = BIN_WORDS) -> DataFrame:
    """word, n, n_near, best and best_n of the words of ``words`` (word, n) with a near word.

    Near words differ by one inserted, deleted or replaced letter; best is the near word of
    largest n, of equal ones the first in code-point order. Words are of A-Z, a-z and U+00C0 to
    U+00FF, each in one row. Runs jobs when called.
    """
    found = None
    for table in windows(words, max_key_words):
        size = table.agg(F.count("*"), F.sum("m")).first()
        n_bins = max(1, math.ceil(size[0] / bin_words), math.ceil((size[1] or 0) / BIN_LETTERS))
        binned = table.select(
            "word", "n", "m", "lo", "hi", F.pmod("key", F.lit(n_bins)).alias("bin"),
        )
        part = binned.groupBy("bin").applyInArrow(
            _search_bin, "word string, n bigint, n_near bigint, best_n bigint, best string"
        )
        found = part if found is None else found.unionByName(part)
    first = F.min_by(F.struct("best_n", "best"), F.struct(-F.col("best_n"), F.col("best")))
    return found.groupBy("word").agg(F.first("n").alias("n"), F.sum("n_near").alias("n_near"), first.alias("b")).select(
        "word", "n", "n_near", F.col("b.best").alias("best"), F.col("b.best_n").alias("best_n")
    )


def group_variants(words: DataFrame, max_key_words: int = MAX_KEY_WORDS, bin_words: int = BIN_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of ``words`` (word, n).

    A word's form is its best near word, if that occurs MIN_RATIO times as often or more; its root
    is the end of the chain of forms, the word itself if it has none. Counts grow tenfold along a
    chain, so chains are short and each round of joins settles the words one step further away.
    Runs jobs when called.
    """
    words = stored(words.select("word", "n"), "words")
    near = near_words(words, max_key_words, bin_words).drop("n")
    formed = F.col("best_n") >= MIN_RATIO * F.col("n")
    told = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    open_ = told.filter("form is not null").select("word", "form")
    settled = open_.join(open_.select(F.col("word").alias("form")), "form", "left_anti").select("word", F.col("form").alias("root"))
    roots = []
    while True:
        settled = stored(settled, "roots")
        roots.append(settled)
        ends = settled.select(F.col("word").alias("form"), "root")
        settled = open_.join(ends, "form").select("word", "root")
        if settled.isEmpty():
            break
    known = roots[0]
    for more in roots[1:]:
        known = known.unionByName(more)
    return told.join(known, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def document_variants(docs: DataFrame) -> DataFrame:
    """``group_variants`` of the vocabulary of ``docs`` (doc_id, text)."""
    return group_variants(vocabulary(docs))
