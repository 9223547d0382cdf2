"""Removal of long repeated strings by a Burrows-Wheeler transform built column by column.

A string of ``length`` bytes that starts twice anywhere must be found though its two places are in
different documents. Each window of that length has an anchor: its leftmost run of ``anchor``
bytes of least hash. Equal windows have equal anchors at the same offset, so the consecutive
windows of a text that share an anchor are one segment, and only segments of one anchor
need comparing. Segments of equal bytes are one class. Anchors that occur once go.

The classes are dealt into shards by their anchors. A shard's documents are its classes, those with
copies twice. Their symbols carry the column, counted from the anchor; equal windows start in
the same column. Round by round, from the last column to the first, one symbol of each document is
put before its suffix: the symbols in the order of the suffixes are the next column of the
collection's transform, a stable distribution by symbol gives the new order, and the common
prefix of neighbours is one more than the least between them before. As symbols of different
columns differ, suffixes of a column are neighbours in the collection's suffix array, so a round
only appends to the transform and the prefixes, and reads nothing but the column before. A window is
repeated if its suffix has ``length`` symbols in common with a neighbour.

An anchor with too many classes for a shard (a passage in very many texts) is split: its windows
are cut at fixed columns into narrow ranges, whose windows all hold a common core, and the core is the
new key. Ranges of one window that share a core are equal windows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farewind.llm.arrow_text import _P, _P_INVERSE, _power, mix, pieces, text_bytes
from farewind.scratch import stored

#: Bytes of a repeated string, and of an anchor.
LENGTH, ANCHOR = 400, 32
#: Classes of one key that a shard takes, and rows of an average shard.
MAX_CLASSES, SHARD_ROWS = 8192, 2048
#: Windows in a range when crowded keys are split, time after time.
WIDTHS = (64, 16, 4, 1)
#: Bytes of text that leave a task in one batch, about.
_BATCH_BYTES = 4_000_000
# Windows whose anchors are sought together; positions fit in the low bits of their hashes.
_STRETCH, _PLACE_BITS = 1 << 19, 20

_SEGMENT = "struct<anchor:bigint,class:bigint,start:int,n:int,lead:int>"
_ROW = "key bigint, anchor bigint, class bigint, text binary, lead int, n int, at int, copies int"


class _Sums:
    """Hashes of any spans of some bytes."""

    def __init__(self, data: np.ndarray):
        terms = (data.astype(np.uint64) + np.uint64(1)) * _power("up", _P, len(data))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
        self.down = _power("down", _P_INVERSE, len(data) + 1)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def runs(self, size: int) -> np.ndarray:
        """Of all runs of ``size`` bytes."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def anchor_places(hashes: np.ndarray, choices: int) -> np.ndarray:
    """Where the leftmost least of each ``choices`` consecutive hashes is (by their upper bits)."""
    found = []
    for at in range(0, len(hashes) - choices + 1, _STRETCH):
        part = hashes[at : at + _STRETCH + choices - 1]
        packed = (part >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(part), dtype=np.uint64)
        rows = np.full(-(-len(part) // choices) * choices, 2**64 - 1, np.uint64)
        rows[: len(part)] = packed
        rows = rows.reshape(-1, choices)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()[choices - 1 : len(part)]
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()[: len(part) - choices + 1]
        least = np.minimum(ahead, behind)
        found.append((least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64) + at)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def segments(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Of texts behind each other: text number, anchor's hash, class, start, windows and anchor's
    offset of each segment; starts count from the text's own."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none, none
    sums = _Sums(data)
    hashes = sums.runs(anchor)
    places = anchor_places(hashes, length - anchor + 1)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(places)]
    whole = np.flatnonzero(np.arange(len(places)) + length <= offsets[text + 1])
    if not len(whole):
        return none, none, none, none, none, none
    fresh = np.append(True, (np.diff(places[whole]) != 0) | (np.diff(text[whole]) != 0))
    first = np.flatnonzero(fresh)
    n = np.diff(np.append(first, len(whole)))
    start = whole[first]
    place, own = places[start], text[start]
    kind = sums.spans(start, start + n - 1 + length)
    return own, hashes[place].view(np.int64), kind.view(np.int64), start - offsets[own], n, place - start


def text_key(text: bytes) -> tuple[int, int]:
    digest = hashlib.blake2b(text, digest_size=16).digest()
    return tuple(np.frombuffer(digest, np.int64).tolist())


def _find_segments(length: int, anchor: int):
    """Of each text its key and its segments."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                data, offsets = text_bytes(piece.column("text"))
                own, *columns = segments(data, offsets, length, anchor)
                keys = np.array([text_key(data[a:b]) for a, b in zip(offsets, offsets[1:])], np.int64).reshape(-1, 2)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                rows = pa.StructArray.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, kinds)],
                    names=["anchor", "class", "start", "n", "lead"],
                )
                cuts = np.searchsorted(own, np.arange(piece.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), pa.ListArray.from_arrays(pa.array(cuts), rows)],
                    names=["d1", "d2", "segments"],
                )

    return run


def _packed_texts(batches):
    """Each text's key and its bytes, compressed for the shuffle; with the other columns."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for piece in pieces(batch):
            data, offsets = text_bytes(piece.column("text"))
            texts = [data[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
            keys = np.array([text_key(text) for text in texts], np.int64).reshape(-1, 2)
            others = [name for name in piece.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[piece.column(name) for name in others], pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()),
                    pa.array([packer.compress(text) for text in texts], pa.binary()),
                ],
                names=[*others, "d1", "d2", "packed"],
            )


class _Rows:
    """Output rows held until they are worth a batch."""

    def __init__(self, names: list[str], kinds: list[pa.DataType]):
        self.names, self.kinds, self.rows, self.bytes = names, kinds, [], 0

    def add(self, *row, size: int = 64) -> bool:
        """Whether there is enough for a batch now."""
        self.rows.append(row)
        self.bytes += size
        return self.bytes > _BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[]] * len(self.names)
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, self.kinds)], names=self.names)
        self.rows, self.bytes = [], 0
        return out


def _class_rows() -> _Rows:
    wide, narrow = pa.int64(), pa.int32()
    names = ["key", "anchor", "class", "text", "lead", "n", "at", "copies"]
    return _Rows(names, [wide, wide, wide, pa.binary(), narrow, narrow, narrow, narrow])


def _cut_classes(length: int):
    """The bytes of the classes whose first occurrences are listed with each text."""

    def run(batches):
        unpacker, out = zstandard.ZstdDecompressor(), _class_rows()
        for batch in batches:
            for packed, found in zip(batch.column("packed"), batch.column("found")):
                text = unpacker.decompress(packed.as_py())
                for s in found.as_py():
                    part = text[s["start"] : s["start"] + s["n"] - 1 + length]
                    row = (s["anchor"], s["anchor"], s["class"], part, s["lead"], s["n"], 0, s["copies"])
                    if out.add(*row, size=len(part) + 64):
                        yield out.batch()
        yield out.batch()

    return run


def split_rows(row: tuple, width: int, length: int) -> Iterator[tuple]:
    """The row (key, anchor, class, text, lead, n, at, copies) cut into ranges of ``width`` windows
    at columns that are multiples of it; the key is a hash of the bytes all windows of a range hold."""
    _, anchor, kind, text, lead, n, at, copies = row
    first = -lead
    while n > 0:
        take = min(n, width - first % width)
        low = first - first % width
        # The core of the full range, whether or not this row has all of its windows.
        core = text[max(0, low + width - 1 - first) : max(0, low + length - first)]
        tag = hashlib.blake2b(core + b"%d %d" % (low, width), digest_size=8).digest()
        key = int.from_bytes(tag, "little", signed=True)
        yield key, anchor, kind, text[: take - 1 + length], -first, take, at, copies
        text, first, n, at = text[take:], first + take, n - take, at + take


def _split(width: int, length: int):
    def run(batches):
        out = _class_rows()
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns]):
                for part in split_rows(row, width, length):
                    if out.add(*part, size=len(part[3]) + 64):
                        yield out.batch()
        yield out.batch()

    return run


def _least_between(common: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The least of common[before + 1 : after + 1] for each pair (before < after)."""
    power = np.frexp(after - before)[1] - 1
    least = np.empty(len(before), common.dtype)
    level, table = 0, common
    for level in range(int(power.max(initial=0)) + 1):
        if level:
            half = 1 << (level - 1)
            table = np.minimum(table[:-half], table[half:])
        here = np.flatnonzero(power == level)
        least[here] = np.minimum(table[before[here] + 1], table[after[here] + 1 - (1 << level)])
    return least


def transform_columns(symbols: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Build the transform of documents laid out in columns, from the last column to the first.

    ``symbols[column, document]`` is 0 where a document has none; ``last`` is each document's last
    column. Yields, for each column, its number, the documents in the order of their suffixes that
    begin there, the symbols put in front (sorted: the column's part of the first symbols; the
    next round reads the transform through the order), and the common prefixes of neighbours.
    A document that has no more symbols stays among those with symbol 0.
    """
    arrivals = np.argsort(last, kind="stable")
    edges = np.searchsorted(last[arrivals], np.arange(len(symbols) + 1))
    order, common = np.zeros(0, np.int64), np.zeros(0, np.int16)
    for column in range(len(symbols) - 1, -1, -1):
        new = arrivals[edges[column] : edges[column + 1]]
        if len(new):
            # An empty suffix comes first and has nothing in common with others.
            order, common = np.append(new, order), np.append(np.zeros(len(new), np.int16), common)
        transform = symbols[column, order]
        moved = np.argsort(transform, kind="stable")
        order, put = order[moved], transform[moved]
        longer = np.zeros(len(order), np.int16)
        same = np.flatnonzero(put[1:] == put[:-1]) + 1
        longer[same] = _least_between(common, moved[same - 1], moved[same]) + 1
        common = longer
        yield column, order, put, common


def repeated_windows(texts: list[bytes], leads: np.ndarray, n: np.ndarray, copies: np.ndarray, length: int) -> np.ndarray:
    """repeated[k, i]: whether window k of text i occurs in another text in the same column, or in a copy."""
    twice = np.flatnonzero(copies > 1)
    document = np.append(np.arange(len(texts)), twice)
    sizes = np.array([len(text) for text in texts])
    left = int(leads.max())
    width = int((sizes - leads).max()) + left
    rows = np.zeros((len(texts), width), np.uint8)
    for i, text in enumerate(texts):
        at = left - leads[i]
        # UTF-8 has no byte above 0xF4, so one more still fits.
        rows[i, at : at + len(text)] = np.frombuffer(text, np.uint8) + np.uint8(1)
    symbols = np.ascontiguousarray(rows.T)[:, document]
    first = left - leads
    marks = np.zeros((width, len(texts)), bool)
    highest = int((first + n).max())
    for column, order, _, common in transform_columns(symbols, (first + sizes - 1)[document]):
        if column >= highest:
            continue
        enough = common >= length
        if enough.any():
            enough[:-1] |= enough[1:]
            hit = order[enough]
            marks[column, document[hit]] = True
    out = np.zeros((int(n.max()), len(texts)), bool)
    for i in range(len(texts)):
        out[: n[i], i] = marks[first[i] : first[i] + n[i], i]
    return out


def _search_shard(length: int):
    def run(rows: pa.Table) -> pa.Table:
        texts = rows["text"].to_pylist()
        leads, n, copies, at = (rows[c].to_numpy().astype(np.int64) for c in ("lead", "n", "copies", "at"))
        marks = repeated_windows(texts, leads, n, copies, length)
        padded = np.zeros((len(marks) + 2, len(texts)), np.int8)
        padded[1:-1] = marks
        change = np.diff(padded, axis=0).T
        who, begin = np.nonzero(change == 1)
        _, end = np.nonzero(change == -1)
        return pa.table({
            "anchor": rows["anchor"].to_numpy()[who], "class": rows["class"].to_numpy()[who],
            "at": (at[who] + begin).astype(np.int32), "n": (end - begin).astype(np.int32),
        })

    return run


def _uncrowded(rows: DataFrame, max_classes: int, length: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Rows whose keys a shard can take, and rows of single windows whose keys it cannot."""
    ready = []
    for width in WIDTHS:
        crowded = rows.groupBy("key").count().filter(F.col("count") > max_classes).select("key")
        crowded = stored(crowded, "crowded")
        if crowded.isEmpty():
            return [*ready, rows], None
        ready.append(rows.join(crowded, "key", "left_anti"))
        parts = stored(rows.join(crowded, "key", "left_semi").select(*rows.columns).mapInArrow(_split(width, length), _ROW), "ranges")
        several = stored(parts.groupBy("key").agg(F.sum("copies").alias("c")).filter("c > 1").select("key"), "several")
        rows = stored(parts.join(several, "key", "left_semi"), "ranges")
    return ready, rows


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, max_classes: int = MAX_CLASSES
) -> DataFrame:
    """d1, d2 (a text's key) and spans (from, to) of every text of ``docs`` (text) with repeated bytes.

    Spans may overlap. Copies of a text are counted, then treated as one text. Runs jobs when called.
    """
    own = docs.select("text").mapInArrow(
        _find_segments(length, anchor), f"d1 bigint, d2 bigint, segments array<{_SEGMENT}>"
    )
    # One row a text: copies meet on the map side already.
    texts = own.filter(F.size("segments") > 0).groupBy("d1", "d2").agg(
        F.count("*").alias("copies"), F.first("segments").alias("segments")
    )
    every = stored(texts, "segments").select("d1", "d2", "copies", F.inline("segments"))
    several = every.groupBy("anchor").agg(F.sum("copies").alias("c")).filter("c > 1").select("anchor")
    found = stored(every.join(stored(several, "anchors"), "anchor", "left_semi"), "found")
    place = F.struct("d1", "d2", "start", "n", "lead")
    classes = found.groupBy("anchor", "class").agg(F.sum("copies").alias("copies"), F.min(place).alias("first"))
    listed = F.struct(
        "anchor", "class", "first.start", "first.n", "first.lead", F.least("copies", F.lit(2)).cast("int").alias("copies")
    )
    wanted = classes.groupBy(F.col("first.d1").alias("d1"), F.col("first.d2").alias("d2")).agg(F.collect_list(listed).alias("found"))
    packed = docs.select("text").mapInArrow(_packed_texts, "d1 bigint, d2 bigint, packed binary").dropDuplicates(["d1", "d2"])
    rows = packed.join(wanted, ["d1", "d2"]).select("packed", "found").mapInArrow(_cut_classes(length), _ROW)
    rows = stored(rows, "classes")

    ready, single = _uncrowded(rows, max_classes, length)
    results = []
    for part in ready:
        shards = max(1, math.ceil(part.count() / SHARD_ROWS))
        results.append(
            part.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("shard")
            .applyInArrow(_search_shard(length), "anchor bigint, class bigint, at int, n int")
        )
    if single is not None:
        results.append(single.select("anchor", "class", "at", "n"))
    repeated = results[0]
    for more in results[1:]:
        repeated = repeated.unionByName(more)
    repeated = stored(repeated.withColumnRenamed("n", "n_windows"), "repeated")
    begin = F.col("start") + F.col("at")
    spans = found.join(repeated, ["anchor", "class"]).select(
        "d1", "d2", F.struct(begin.alias("from"), (begin + F.col("n_windows") + F.lit(length - 1)).alias("to")).alias("span")
    )
    return stored(spans.groupBy("d1", "d2").agg(F.collect_list("span").alias("spans")), "spans")


def _without_spans(batches):
    unpacker = zstandard.ZstdDecompressor()
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    for batch in batches:
        out = _Rows(["doc_id", "n_bytes", "spans", "kept"], [batch.column("doc_id").type, pa.int64(), pa.list_(span), pa.binary()])
        for doc_id, packed, spans in zip(*[batch.column(c) for c in ("doc_id", "packed", "spans")]):
            text = unpacker.decompress(packed.as_py())
            merged: list[list[int]] = []
            for s in sorted((s["from"], s["to"]) for s in spans.as_py() or []):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            kept, at = [], 0
            for start, stop in merged:
                kept.append(text[at:start])
                at = stop
            kept.append(text[at:])
            runs = [{"start": start, "stop": stop} for start, stop in merged]
            if out.add(doc_id.as_py(), len(text), runs, b"".join(kept), size=len(text) + 64):
                yield out.batch()
        yield out.batch()


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, max_classes: int = MAX_CLASSES
) -> DataFrame:
    """doc_id, n_bytes, spans (start, stop) removed and kept (the bytes left) of ``docs`` (doc_id, text).

    A byte goes if a string of ``length`` bytes that covers it also starts at another place in any
    text of ``docs``, as given; overlapping places count, and so do repeated rows, each a document of
    its own. Spans are maximal. Bytes are those of UTF-8, so a cut may fall inside a character. A
    null text is empty; a text shorter than ``length`` keeps all. Other columns are ignored. Texts
    are told apart by hashes of 128 bits. Runs jobs when called.
    """
    spans = repeated_spans(docs, length, anchor, max_classes)
    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = docs.select("doc_id", "text").mapInArrow(_packed_texts, f"doc_id {kind}, d1 bigint, d2 bigint, packed binary")
    joined = packed.join(spans, ["d1", "d2"], "left").select("doc_id", "packed", "spans")
    return joined.mapInArrow(
        _without_spans, f"doc_id {kind}, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary"
    )


def digest(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of what ``remove_repeats`` returns."""
    return removed.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
