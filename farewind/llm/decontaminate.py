"""Benchmark decontamination with one Aho-Corasick automaton over all benchmark windows.

Texts are lower-cased (A to Z) and reduced to words of digits, letters a to z and characters
beyond ASCII, joined by single blanks. A window is ``window`` consecutive words of an item,
or the whole item if it is shorter; with a blank on either side it is one pattern. Matching is
done on UTF-8 bytes, of which every normalised one stands for exactly one original byte.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farewind.llm.arrow_text import pieces

WINDOW = 10
#: Characters of benchmark text in one automaton (about ten trie nodes each); a larger benchmark
#: is scanned in several passes.
BLOCK_CHARS = 300_000

_TABLE = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20
    for b in range(256)
)

def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


class Automaton:
    """Patterns of the items given, each with the items it comes from."""

    def __init__(self, items: Iterable[tuple[str | None, str | None]], window: int):
        owners: dict[bytes, set[str | None]] = defaultdict(set)
        lengths: dict[bytes, int] = {}
        for item_id, text in items:
            words = words_of(text)
            for start in range(max(1, len(words) - window + 1) if words else 0):
                part = words[start : start + window]
                pattern = b" " + b" ".join(part) + b" "
                owners[pattern].add(item_id)
                lengths[pattern] = len(part)
        self.finder = ahocorasick.Automaton()
        self.owners = []
        for pattern, ids in owners.items():
            self.finder.add_word(pattern.decode("latin-1"), (len(self.owners), len(pattern), lengths[pattern]))
            self.owners.append(sorted(i for i in ids if i is not None))
        self.finder.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words; hit words as merged [first, last] ranges; items found."""
        words = words_of(text)
        if not words or not self.owners:
            return len(words), [], set()
        normal = f" {b' '.join(words).decode('latin-1')} "
        ranges, found = [], set()
        place, counted = 0, 0
        for end, (number, size, n_words) in self.finder.iter(normal):
            counted += normal.count(" ", place, end)
            place = end  # words before the blank at ``end``
            last = counted - 1
            ranges.append((last - n_words + 1, last))
            found.add(number)
        items = {i for number in found for i in self.owners[number]}
        return len(words), merged(ranges), items


def merged(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def original_spans(text: str, ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets [start, end) in ``text`` of ranges of words."""
    data = text.encode().translate(_TABLE)
    starts, ends, inside = [], [], False
    for at, byte in enumerate(data + b" "):
        if (byte != 0x20) != inside:
            (ends if inside else starts).append(at)
            inside = not inside
    raw = text.encode()
    return [
        (len(raw[: starts[a]].decode()), len(raw[: ends[b]].decode())) for a, b in ranges
    ]


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[str | None, str | None]]]:
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1] or "")
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


_built: dict[str, Automaton] = {}


def _scanner(items, name: str, window: int):
    def scan(batches):
        if name not in _built:  # once per worker process
            _built.clear()
            _built[name] = Automaton(items.value, window)
        automaton = _built[name]
        for whole in batches:
            for batch in pieces(whole):
                counts, hits, spans, found = [], [], [], []
                for text in batch.column("text"):
                    text = text.as_py()
                    n, ranges, ids = automaton.scan(text)
                    counts.append(n)
                    hits.append(ranges)
                    spans.append(original_spans(text, ranges) if ranges else [])
                    found.append(sorted(ids))
                pairs = pa.list_(pa.list_(pa.int64()))
                names = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c) for c in names], pa.array(counts, pa.int64()), pa.array(hits, pairs),
                        pa.array(spans, pairs), pa.array(found, pa.list_(pa.string())),
                    ],
                    names=[*names, "n_words", "hits", "spans", "items"],
                )

    return scan


_FOUND = "n_words bigint, hits array<array<bigint>>, spans array<array<bigint>>, items array<string>"


def _scan(rows: DataFrame, block: list, window: int) -> DataFrame:
    """The columns of ``rows`` but ``text``, and what the automaton of one block found in it."""
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    items = rows.sparkSession.sparkContext.broadcast(block)
    name = hashlib.sha256(repr((window, block)).encode()).hexdigest()
    return rows.mapInArrow(_scanner(items, name, window), f"{schema}, {_FOUND}")


def scan_documents(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """doc_id of every row of ``docs`` (doc_id, text) with what the automaton found.

    n_words; hits, the hit words as ranges [first, last] counted from 0; spans, the same as
    character offsets [start, end) of the original text; items, the ids of the items found,
    as sorted strings. A null or empty text has no words. Items without words have no window;
    windows of an item without an id hit words but name no item. Items of equal text are all
    named. Repeated rows are scanned alike, other columns ignored.

    The benchmark goes to the driver in blocks of ``block_chars`` characters at most (and one
    item); each block is one automaton and one pass over the documents. Reading the benchmark
    runs a job when the function is called.
    """
    blocks = list(_blocks(benchmark, block_chars)) or [[]]
    if len(blocks) == 1:
        return _scan(docs.select("doc_id", "text"), blocks[0], window)
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_row"), "text")
    return _union_of([_scan(keyed, block, window) for block in blocks])


def _union_of(passes: list[DataFrame]) -> DataFrame:
    """One row per document from the rows of all passes; repeated rows of a document stay."""
    numbered = passes[0].withColumn("_pass", F.lit(0))
    for number, rows in enumerate(passes[1:], 1):
        numbered = numbered.unionByName(rows.withColumn("_pass", F.lit(number)))
    joined = numbered.groupBy("doc_id", "_row").agg(
        F.first("n_words").alias("n_words"),
        F.count_if(F.col("_pass") == 0).alias("_copies"),
        F.array_distinct(F.flatten(F.collect_set("hits"))).alias("hits"),
        F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return joined.select(
        "doc_id", "n_words", merged_ranges("hits", 1).alias("hits"),
        F.array_sort("spans").alias("spans"), "items",
        F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"),
    ).drop("_copy")


def merged_ranges(name: str, gap: int):
    """Sorted ranges with those that overlap or touch made one."""
    empty = F.lit(None).cast("array<array<bigint>>")
    start = F.coalesce(empty, F.array().cast("array<array<bigint>>"))

    def add(out, r):
        last = F.element_at(out, -1)
        joins = (F.size(out) > 0) & (r[0] <= F.get(last, 1) + gap)
        wider = F.concat(
            F.slice(out, 1, F.size(out) - 1),
            F.array(F.array(F.get(last, 0), F.greatest(F.get(last, 1), r[1]))),
        )
        return F.when(joins, wider).otherwise(F.concat(out, F.array(r)))

    return F.aggregate(F.array_sort(name), start, add)


def digest(found: DataFrame) -> DataFrame:
    """The counts of ``scan_documents`` per document, and a digest of the items' ids."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0] + 1)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The rows of ``docs`` without those that hold a window; columns as they were.

    Rows are judged one by one, so a clean row stays whatever shares its doc_id.
    """
    for block in _blocks(benchmark, block_chars):
        whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
        docs = _scan(whole, block, window).filter(F.size("hits") == 0).select("row.*")
    return docs
