"""Near duplicates by MinHash: universal hash minima, banding, verification, components.

A text's set holds its distinct shingles of ``size`` words (64-bit hashes of them). Texts of
equal words are one class from the start. ``HASHES`` multiply-shift hashes give the minima of a
class; ``ROWS`` minima are a band's key, and classes that share a key may be linked. With 6
rows and 36 bands a pair of similarity 0.8 shares none with probability 2e-5. Before full sets
are compared, the lowest bits of all minima must agree as those of pairs of 0.8 do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farewind.llm.arrow_text import Words, mix, pieces
from farewind.llm.components import connected_components
from farewind.scratch import stored

BANDS, ROWS = 36, 6
HASHES = BANDS * ROWS
#: Lowest bits of the minima that may differ: of a pair of similarity 0.8 a tenth do, and six
#: standard deviations more.
MAX_DIFFERING = HASHES // 10 + 27
SKETCH = ["s0", "s1", "s2", "s3"]
#: Rounds at most in which the members of a bucket are compared with one of them, before all
#: that are still in different components are compared with each other.
PIVOT_ROUNDS = 1

_rng = np.random.default_rng(20240917)
_FACTORS = (_rng.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1))[:, None]
_TERMS = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)[:, None]
_BAND_SALT = _rng.integers(1, 2**63, (1, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND_NUMBER = (np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C55))

_BLOCK = 1024  # shingles hashed at once: their values stay in the processor's cache


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of the runs of ``size`` words; of all words, if there are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total = mix(total * np.uint64(0x9E3779B97F4A7C55) + words[k : k + n])
    return np.unique(total)


def minima(shingles: np.ndarray) -> np.ndarray:
    """HASHES minima of the values of universal hashes over the shingles (one at least)."""
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    best = None
    for at in range(0, len(low), _BLOCK):
        values = low[at : at + _BLOCK] * _FACTORS
        values += _TERMS
        least = values.min(axis=1)
        best = least if best is None else np.minimum(best, least)
    return best


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = mix(least.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_SALT)
    return mix(rows.sum(axis=1, dtype=np.uint64) + _BAND_NUMBER).view(np.int64)


def sketch(least: np.ndarray) -> np.ndarray:
    """The lowest bits of all minima, as four numbers."""
    bits = np.zeros(256, np.uint8)
    bits[:HASHES] = least & np.uint32(1)
    return np.packbits(bits).view(np.int64)


def _sequence_hash(words: np.ndarray) -> int:
    """A 64-bit hash of the words in their order: the class of the text."""
    place = mix(np.arange(1, len(words) + 1, dtype=np.uint64))
    total = mix(words ^ place).sum(dtype=np.uint64) + np.uint64(len(words))
    return int(mix(np.array([total]))[0].view(np.int64))


def _per_text(size: int, full_sets: bool):
    """Of each text its class (None without words) and its set, or the set's size and minima."""
    longs = pa.list_(pa.int64())

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                words = Words(piece.column("text"))
                nodes, firsts, seconds, thirds = [], [], [], []
                for i in range(words.n_texts):
                    own = words.hash[words.first[i] : words.first[i + 1]]
                    found = shingle_hashes(own, size)
                    nodes.append(_sequence_hash(own) if len(own) else None)
                    if full_sets:
                        firsts.append(found.view(np.int64))
                        continue
                    firsts.append(len(found))
                    least = minima(found) if len(found) else None
                    seconds.append(None if least is None else band_keys(least))
                    thirds.append(sketch(least) if least is not None else np.zeros(4, np.int64))
                known = [piece.column("id"), pa.array(nodes, pa.int64())]
                if full_sets:
                    yield pa.RecordBatch.from_arrays(
                        [*known, pa.array(firsts, longs)], names=["id", "node", "shingles"]
                    )
                else:
                    yield pa.RecordBatch.from_arrays(
                        [
                            *known, pa.array(firsts, pa.int64()), pa.array(seconds, longs),
                            *[pa.array(part) for part in np.array(thirds, np.int64).reshape(-1, 4).T.copy()],
                        ],
                        names=["id", "node", "n_shingles", "bands", *SKETCH],
                    )

    return run


def _differing(left: str, right: str) -> Column:
    """In how many of their lowest bits two sketches differ."""
    parts = [F.bit_count(F.col(f"{left}{c}").bitwiseXOR(F.col(f"{right}{c}"))) for c in SKETCH]
    return parts[0] + parts[1] + parts[2] + parts[3]


def _told(pairs: DataFrame, classes: DataFrame, end: str) -> DataFrame:
    """Pairs with the size and the sketch of one end, whose names begin with the end's."""
    names = {"node": end, "n_shingles": f"{end}n", **{c: f"{end}{c}" for c in SKETCH}}
    return pairs.join(classes.select(*[F.col(old).alias(new) for old, new in names.items()]), end)


def _likely(pct: int) -> Column:
    sized = 100 * F.least("an", "bn") >= pct * F.greatest("an", "bn")
    return sized & (_differing("a", "b") <= MAX_DIFFERING)


def _verified(likely: DataFrame, sets: DataFrame, pct: int, whole: bool = False) -> DataFrame:
    """The pairs (a, b, an, bn) that are linked by their full sets; ``whole``: most are needed."""
    if not whole:
        needed = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
        sets = sets.join(needed, "node", "left_semi")
    for end in "ba":
        own = sets.select(F.col("node").alias(end), F.col("shingles").alias(f"{end}s"))
        likely = likely.join(own, end)
    both = F.size(F.array_intersect("as", "bs"))
    return likely.filter(100 * both >= pct * (F.col("an") + F.col("bn") - both)).select("a", "b")


def _open_members(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """Members (bucket, node, company) with their component, of buckets that hold several."""
    named = members.withColumn("component", F.col("node"))
    if found is not None:
        named = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (
        named.groupBy("bucket")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .filter("lo < hi").select("bucket")
    )
    return named.join(mixed, "bucket")


def _pivots(members: DataFrame) -> DataFrame:
    """Of each bucket the member with most company, with its component."""
    best = members.groupBy("bucket").agg(F.max(F.struct("company", "node", "component")).alias("p"))
    return best.select(
        "bucket", F.col("p.node").alias("a"), F.col("p.component").alias("ca"), F.col("p.company").alias("most")
    )


def _rest_of_buckets(members: DataFrame, involved: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """Pairs (a, b, an, bn) of members of one bucket in different components that look linked.

    All are compared inside the join, first by size and sketch, then by their sets in 31 bits
    a shingle, with room for all of a set's shingles that coincide there. A pair is compared in its first common bucket
    only; where that bucket is done or one of the two has left it, it was compared before.
    """
    short = sets.select("node", F.transform("shingles", lambda x: x.bitwiseAND(2**31 - 1).cast("int")).alias("short"))
    # how many shingles of the set are lost among its own in 31 bits: common ones may be among them
    short = short.withColumn("lost", F.size("short") - F.size(F.array_distinct("short")))
    told = involved.join(members.select("node").distinct(), "node", "left_semi").join(short, "node")
    wide = members.select("bucket", "node", "component").join(told, "node")
    left, right = (
        wide.select(
            F.col("bucket").alias(f"{end}bucket"), F.col("component").alias(f"c{end}"), F.col("node").alias(end),
            F.col("n_shingles").alias(f"{end}n"), F.col("short").alias(f"{end}s"), F.col("lost").alias(f"{end}lost"), F.col("bands").alias(f"{end}bands"),
            *[F.col(c).alias(f"{end}{c}") for c in SKETCH],
        )
        for end in "ab"
    )
    both = F.size(F.array_intersect("as", "bs")) + F.least("alost", "blost")
    condition = (
        (F.col("abucket") == F.col("bbucket"))
        & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _likely(pct)
        & (F.array_min(F.array_intersect("abands", "bbands")) == F.col("abucket"))
        & (100 * both >= pct * (F.col("an") + F.col("bn") - both))
    )
    return left.join(right, condition).select("a", "b", "an", "bn")


def link_classes(classes: DataFrame, sets_of, pct: int, rounds: int = PIVOT_ROUNDS) -> DataFrame | None:
    """node and component of the classes (node, n_shingles, bands, sketch) linked to others.

    Buckets hold the classes of a band's key; a bucket's pivot is its member with most company
    over all buckets. First every class is compared with the one pivot of its buckets that has
    most company, which links most of a group of copies by one comparison each. Then, in up to
    ``rounds`` rounds, all members of a bucket are compared with its pivot, which then leaves
    the bucket, as nothing in it is left to compare with. Linked classes are one component; a
    bucket whose members are all in one is done. Last, every two members of a bucket in
    different components are compared, inside a join that only likely pairs leave. So each pair that shares a bucket is
    compared, unless it is connected already.
    """
    rows = classes.select("node", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").count().filter("count > 1")
    in_company = stored(rows.join(shared, "bucket"), "members")
    company = in_company.groupBy("node").agg(F.sum("count").alias("company"))
    involved = stored(classes.join(company.select("node"), "node", "left_semi"), "involved")
    sets = stored(sets_of(involved), "shingles")
    members = stored(in_company.drop("count").join(company, "node"), "open").withColumn("component", F.col("node"))

    found = None
    for number in range(rounds + 2):
        if members.isEmpty():
            break
        if number <= rounds:
            best = _pivots(members)
            pairs = members.withColumnRenamed("node", "b").join(best, "bucket").filter("component <> ca")
            if number == 0:
                chosen = pairs.groupBy("b").agg(F.max(F.struct("most", "a")).alias("p"))
                pairs = chosen.select(F.col("p.a").alias("a"), "b")
            pairs = _told(_told(pairs.select("a", "b").distinct(), involved, "a"), involved, "b")
            likely = pairs.filter(_likely(pct))
        else:
            likely = _rest_of_buckets(members, involved, sets, pct)
        likely = stored(likely.select("a", "b", "an", "bn"), "likely")
        links = stored(_verified(likely, sets, pct, whole=number == 0), "links")
        if not links.isEmpty():
            known = links if found is None else links.unionByName(
                found.select(F.col("node").alias("a"), F.col("component").alias("b"))
            )
            found = connected_components(known)
        if number > rounds:
            break
        rest = members.drop("component")
        if number:
            rest = rest.join(best.select("bucket", F.col("a").alias("node")), ["bucket", "node"], "left_anti")
        members = stored(_open_members(rest, found), "open")
    return found


def _judge(rows: DataFrame, size: int, pct: int) -> tuple[DataFrame, DataFrame, bool]:
    """Features of each row of ``rows`` (id, text); of each class the smallest id within reach
    (least) and whether it is the class of that id (lead); whether rows repeat."""
    features = stored(
        rows.mapInArrow(
            _per_text(size, False),
            f"id bigint, node bigint, n_shingles bigint, bands array<bigint>, {' bigint, '.join(SKETCH)} bigint",
        ),
        "features",
    )
    named = features.filter("id is not null and node is not null")
    classes = stored(
        named.groupBy("node").agg(
            F.min("id").alias("first"), F.min_by(F.struct("n_shingles", "bands", *SKETCH), "id").alias("s")
        ).select("node", "first", "s.*"),
        "classes",
    )
    repeats = not named.groupBy("node", "id").count().filter("count > 1").isEmpty()

    def sets_of(involved: DataFrame) -> DataFrame:
        owners = involved.select(F.col("first").alias("id"), "node")
        texts = rows.join(owners.select("id").distinct(), "id", "left_semi")
        sets = texts.mapInArrow(_per_text(size, True), "id bigint, node bigint, shingles array<bigint>")
        sets = sets.join(owners, ["id", "node"], "left_semi").select("node", "shingles")
        return sets.dropDuplicates(["node"]) if repeats else sets

    found = link_classes(classes, sets_of, pct)
    judged = classes.select("node", "first")
    if found is None:
        judged = judged.select("node", F.col("first").alias("least"), F.lit(True).alias("lead"))
    else:
        told = stored(judged.join(found, "node"), "told")
        best = told.groupBy("component").agg(F.min(F.struct("first", "node")).alias("best"))
        linked = told.join(best, "component").select(
            "node", F.col("best.first").alias("least"), (F.col("node") == F.col("best.node")).alias("lead")
        )
        judged = judged.join(linked, "node", "left").select(
            "node", F.coalesce("least", "first").alias("least"), F.coalesce("lead", F.lit(True)).alias("lead")
        )
    return features.select("id", "node", "n_shingles"), judged, repeats


def deduplicate(docs: DataFrame, size: int = 5, pct: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs`` (doc_id, text).

    Two texts are linked if the shingles they share are ``pct`` percent of their union or more.
    Words are runs of characters other than blank and U+0009 to U+000D, with A to Z in lower
    case; a text of fewer than ``size`` words has them all as its one shingle; a null text or
    one without words has none and is linked with nothing. component_id is the smallest doc_id
    that can be reached by links, and the row with it is kept. Rows with one doc_id and
    different texts are different documents; repeated rows are judged alike. A row without a
    doc_id is no document to link: it has no component and is kept. Other columns are ignored.
    Runs jobs when called.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    features, judged, _ = _judge(rows, size, pct)
    joined = features.join(judged, "node", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("least", "id"))
    return joined.select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _with_node(batches):
    for batch in batches:
        for piece in pieces(batch):
            words = Words(piece.column("text"))
            own = [words.hash[a:b] for a, b in zip(words.first, words.first[1:])]
            nodes = pa.array([_sequence_hash(w) if len(w) else None for w in own], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [piece.column("row"), piece.column("id"), nodes], names=["row", "id", "node"]
            )


def keep_one(docs: DataFrame, size: int = 5, pct: int = 80) -> DataFrame:
    """One row of each group of near duplicates of ``docs`` (doc_id, text), columns as they were.

    It is the row with the group's smallest doc_id. Of rows that repeat a doc_id and the words
    of its text one stays. Rows without a doc_id or without words all stay.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    features, judged, repeats = _judge(rows, size, pct)
    gone = features.filter("id is not null").join(judged, "node").filter("not lead or id <> least").select("id", "node").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    whole = docs.select(row, F.col("doc_id").cast("long").alias("id"), "text")
    kind = whole.schema["row"].dataType.simpleString()
    marked = whole.mapInArrow(_with_node, f"row {kind}, id bigint, node bigint")
    rest = marked.join(gone, ["id", "node"], "left_anti")
    if repeats:
        told = "id is not null and node is not null"
        rest = rest.filter(told).dropDuplicates(["id", "node"]).unionByName(rest.filter(f"not ({told})"))
    return rest.select("row.*")
