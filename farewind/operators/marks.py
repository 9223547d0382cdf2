"""Sets of keys as bits, small enough to be sent to every task.

A key's bit is the place of its hash among ``BITS``. A set never misses a key that was put into it, and
takes some others for one of its own, more of them the fuller it is: rows without the bit are known to
stay out of a join or a grouping, and the rest must still go through it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a set, and words of 64 bits in a row of it: half a million rows, some 46 MB, when all are there.
BITS, WORDS = 1 << 28, 8


def bit_set(rows: DataFrame, hashed: Column) -> DataFrame:
    """(__chunk, __word0, ...) of the hashes of ``rows``, combined on the map side; chunks without a bit are left out."""
    chunk, word, bit = _place(hashed)
    marked = rows.select(chunk.alias("__chunk"), word.alias("__word"), bit.alias("__bit"))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__bit"))
    words = [F.bit_or(F.when(F.col("__word") == i, mask)).alias(f"__word{i}") for i in range(WORDS)]
    return marked.groupBy("__chunk").agg(*words)


def split_by_bits(rows: DataFrame, hashed: Column, bits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose hash has its bit in the set, and the others; ``bits`` is broadcast."""
    chunk, word, bit = _place(hashed)
    held = reduce(lambda so_far, i: so_far.when(word == i, F.col(f"__word{i}")), range(1, WORDS), F.when(word == 0, F.col("__word0")))
    held = F.getbit(held, bit) == 1
    placed = rows.withColumn("__chunk", chunk)
    inside = placed.join(F.broadcast(bits), "__chunk").filter(held).select(*rows.columns)
    outside = placed.join(F.broadcast(bits), "__chunk", "left")
    return inside, outside.filter(~F.coalesce(held, F.lit(False))).select(*rows.columns)


def _place(hashed: Column) -> tuple[Column, Column, Column]:
    """Row, word in the row, and bit in the word of a hash."""
    place = F.pmod(hashed, F.lit(BITS))
    word = F.shiftright(place, 6)
    return F.shiftright(place, 5 + WORDS.bit_length()), word.bitwiseAND(F.lit(WORDS - 1)), place.bitwiseAND(F.lit(63)).cast("int")
