"""Prefix trie of conversations, from vertical bitmaps.

A conversation is a sequence of turns (role, text). Conversations are dealt into shards by
ranges of conv_id. In a shard, each (position, turn) has a posting: a bitset of the shard's
conversations that have this turn at this position. A node's children come from intersecting
the node's bitset with the postings of the next position, depth first: the lowest conversation
not yet placed names the next posting. A bitset's population count is the shard's number of
members, and those whose length is the node's depth are its end list. Nodes of different shards
with equal prefixes are one node: a prefix is known by its depth and two 64-bit hashes.

Sums over subtrees are made in the shards too. Each node belongs to one of the shards that hold
it; the shard's nodes are numbered depth first, so that a subtree is a run of numbers and its
sum a difference of running sums. A node's sums over all shards are then added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farewind.llm.arrow_text import mix
from farewind.scratch import stored

#: Turns of a shard, unless a single conversation has more.
SHARD_TURNS = 20_000
#: Conversations that one of the rebuilt ones may take its first turns from: every fifth.
FAMILY = 5
#: Turns taken are a checksum modulo this.
MOST_TAKEN = 9

_KEY = ["depth", "k1", "k2"]
_PARTS = (
    "shard bigint, pre bigint, last bigint, up bigint, depth bigint, k1 bigint, k2 bigint, "
    "bytes bigint, n bigint, conv bigint, ends array<bigint>"
)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def placed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (1-based), two hashes of (role, text) and the text's UTF-8 bytes.

    Turns are ordered by ``turn``, null first; turns of equal number by role, then by a hash of
    the text. Null role and text are empty. Rows without a conv_id belong to no conversation.
    """
    content = [F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")]
    narrow = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", content[0].alias("role"),
        F.xxhash64(F.lit(1), *content).alias("t1"), F.xxhash64(F.lit(2), *content).alias("t2"),
        F.octet_length(content[1]).cast("long").alias("bytes"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "t1", "t2"]
    pos = F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long")
    return narrow.select("conv_id", pos.alias("pos"), "t1", "t2", "bytes")


def rebuild(turns: DataFrame) -> DataFrame:
    """Placed turns of every conversation after it took the start of another.

    Conversation c gets the first h turns of conversation c - c % 5 (all, if there are fewer;
    none, if there is no such conversation), then its own turns after its first h; h is the
    checksum of c's decimal digits modulo 9. Each conversation also has a row at position 0.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_TAKEN).alias("h")
    convs = stored(sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), taken, "n_turns"), "convs")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("n_base"))
    convs = convs.drop("n_turns").join(bases, "base", "left")
    convs = convs.withColumn("n_taken", F.least("h", F.coalesce("n_base", F.lit(0)))).drop("n_base")
    own = turns.join(convs, "conv_id").filter("pos > h").withColumn("pos", F.expr("pos - h + n_taken"))
    # Only the first few turns of every fifth conversation, each for five conversations at most.
    heads = turns.filter((F.col("pos") < MOST_TAKEN) & (F.col("conv_id") % FAMILY == 0))
    heads = heads.withColumnRenamed("conv_id", "base").join(convs.filter("n_taken > 0"), "base").filter("pos <= h")
    columns = ["conv_id", "pos", "t1", "t2", "bytes"]
    zero = F.lit(0).cast("long")
    return (
        own.select(columns).unionByName(heads.select(columns))
        .unionByName(convs.select("conv_id", *[zero.alias(c) for c in columns[1:]]))
    )


def _whole_conversations(batches, limit: int) -> Iterator[np.ndarray]:
    """Runs of whole conversations of ``limit`` rows at most, or a single longer one."""
    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.array([column.to_numpy(zero_copy_only=False) for column in batch.columns], np.int64)
        held.append(rows)
        if not (rows[1] == 0).any():
            continue
        rows = np.hstack(held)
        begins = np.flatnonzero(rows[1] == 0)
        at = 0
        while rows.shape[1] - at > limit:
            last = int(np.searchsorted(begins, at + limit, side="right")) - 1
            cut = begins[last] if begins[last] > at else (begins[last + 1] if last + 1 < len(begins) else at)
            if cut == at:
                break
            yield rows[:, at:cut]
            at = cut
        held = [rows[:, at:]]
    if held:
        yield np.hstack(held)


def shard_trie(rows: np.ndarray) -> dict[str, list]:
    """The nodes of one shard, depth first. ``rows``: conv_id, pos, t1, t2, bytes, in order."""
    conv, pos, t1, t2, size = rows
    begins = np.flatnonzero(pos == 0)
    ids = conv[begins].tolist()
    lengths = np.diff(np.append(begins, len(pos))) - 1

    order = np.lexsort((t2, t1, pos))
    sorted_rows = np.array([pos[order], t1[order], t2[order]])
    fresh = np.append(True, (sorted_rows[:, 1:] != sorted_rows[:, :-1]).any(axis=0))
    posting = np.empty(len(pos), np.int64)
    posting[order] = np.cumsum(fresh) - 1
    heads = order[fresh]
    salt = mix(pos[heads].astype(np.uint64) + np.uint64(1))
    h1 = mix(t1[heads].view(np.uint64) ^ salt).tolist()
    h2 = mix(t2[heads].view(np.uint64) + salt).tolist()
    sizes = size[heads].tolist()
    postings = [0] * len(heads)
    owner = (np.searchsorted(begins, np.arange(len(pos)), side="right") - 1).tolist()
    for p, i in zip(posting.tolist(), owner):
        postings[p] |= 1 << i
    ended: dict[int, int] = {}
    for i, n in enumerate(lengths.tolist()):
        ended[n] = ended.get(n, 0) | 1 << i
    posting, begins = posting.tolist(), begins.tolist()

    found: dict[str, list] = {name: [] for name in ("last", "up", "depth", "k1", "k2", "bytes", "n", "conv", "ends")}
    add = [found[name].append for name in ("up", "depth", "k1", "k2", "bytes", "n", "conv", "ends")]
    waiting = [(-1, 0, 0, 0, 0, (1 << len(ids)) - 1)]
    while waiting:
        up, depth, k1, k2, n_bytes, members = waiting.pop()
        me = len(found["up"])
        over = members & ended.get(depth, 0)
        ends, rest = [], over
        while rest:
            low = rest & -rest
            ends.append(ids[low.bit_length() - 1])
            rest ^= low
        first = (members & -members).bit_length() - 1
        for put, value in zip(add, (up, depth, k1, k2, n_bytes, members.bit_count(), ids[first], ends)):
            put(value)
        rest = members ^ over
        while rest:
            i = (rest & -rest).bit_length() - 1
            p = posting[begins[i] + depth + 1]
            child = rest & postings[p]
            rest ^= child
            waiting.append((me, depth + 1, k1 ^ h1[p], k2 ^ h2[p], sizes[p], child))
    last = list(range(len(found["up"])))
    for me in range(len(last) - 1, 0, -1):
        up = found["up"][me]
        last[up] = max(last[up], last[me])
    found["last"] = last
    return found


def _tries(batches, limit: int):
    for rows in _whole_conversations(batches, limit):
        found = shard_trie(rows)
        n = len(found["up"])
        signed = [np.array(found[k], np.uint64).view(np.int64) for k in ("k1", "k2")]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, rows[0, 0])), pa.array(np.arange(n)), pa.array(found["last"], pa.int64()),
                pa.array(found["up"], pa.int64()), pa.array(found["depth"], pa.int64()), *map(pa.array, signed),
                *[pa.array(found[k], pa.int64()) for k in ("bytes", "n", "conv")],
                pa.array(found["ends"], pa.list_(pa.int64())),
            ],
            names=["shard", "pre", "last", "up", *_KEY, "bytes", "n", "conv", "ends"],
        )


def _subtree_sums(nodes: pd.DataFrame) -> pd.DataFrame:
    """Of a shard's nodes: sums over their subtrees of what the shard's own nodes bring."""
    nodes = nodes.sort_values("pre", ignore_index=True)
    last, up = nodes["last"].to_numpy(), nodes["up"].to_numpy()
    own = nodes["own"].to_numpy()
    out = nodes[_KEY].copy()
    for name, value in (("leaves", nodes["leaf"]), ("saved", nodes["saves"])):
        total = np.append(0, np.cumsum(np.where(own, value.to_numpy(np.int64), 0)))
        out[name] = total[last + 1] - total[:-1]
    out["children"] = np.bincount(up[own & (up >= 0)], minlength=len(nodes))
    out["parent"] = pd.Series(np.where(up >= 0, nodes["whole_conv"].to_numpy()[up], 0), dtype="Int64").mask(up < 0)
    return out


def _hash_ends(batches):
    """SHA-256 of each node's end list: a node's lists follow each other in order of their shards."""
    state, key, done = None, None, []

    def rows():
        out = pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*done), [pa.int64()] * 3 + [pa.string()])],
            names=[*_KEY, "ends_sha256"],
        )
        done.clear()
        return out

    for batch in batches:
        for *here, ends in zip(*[batch.column(c).to_pylist() for c in (*_KEY, "ends")]):
            if here != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                state, key = hashlib.sha256(), here
            else:
                state.update(b",")
            state.update(",".join(map(str, ends)).encode())
        if done:
            yield rows()
    if key is not None:
        done.append((*key, state.hexdigest()))
        yield rows()


def trie_nodes(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Every node of the trie of ``turns`` (conv_id, pos, t1, t2, bytes; a row at pos 0 for each).

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves, saved_tokens (over the subtree, copies of a node's last text times its bytes) and
    ends_sha256 (of the conv_ids that end at the node, ascending, comma-joined). A conversation
    without turns ends at the root; without conversations there is no node. A shard holds the
    hashes of its turns in memory, so a single conversation's turns (32 bytes each) must fit in a
    task; an end list passes through one task in pieces, a shard's at a time. Runs jobs when called.
    """
    ordered = turns.select("conv_id", "pos", "t1", "t2", "bytes").repartitionByRange("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", "pos")
    parts = stored(ordered.mapInArrow(lambda batches: _tries(batches, shard_turns), _PARTS), "tries")
    whole = parts.groupBy(*_KEY).agg(
        F.sum("n").alias("n_convs"), F.min("conv").alias("whole_conv"), F.max("bytes").alias("whole_bytes"),
        F.max(F.col("last") > F.col("pre")).alias("inner"), F.min(F.struct("shard", "pre")).alias("owner"),
    )
    told = parts.drop("ends", "n", "conv", "bytes").join(whole, _KEY).select(
        *_KEY, "shard", "pre", "last", "up", "n_convs", "whole_conv",
        (F.struct("shard", "pre") == F.col("owner")).alias("own"),
        (~F.col("inner")).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("whole_bytes")).alias("saves"),
    )
    told = stored(told, "nodes")
    summed = told.groupBy("shard").applyInPandas(
        _subtree_sums,
        "depth bigint, k1 bigint, k2 bigint, leaves bigint, saved bigint, children bigint, parent bigint",
    )
    sums = summed.groupBy(*_KEY).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
        F.sum("children").alias("n_children"), F.max("parent").alias("parent_conv_id"),
    )
    ends = parts.filter(F.size("ends") > 0).select(*_KEY, "shard", "ends").repartition(*_KEY)
    hashes = ends.sortWithinPartitions(*_KEY, "shard").mapInArrow(
        _hash_ends, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string"
    )
    nodes = told.filter("own").select(*_KEY, F.col("whole_conv").alias("conv_id"), "n_convs")
    return nodes.join(sums, _KEY).join(hashes, _KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"), "k1", "k2",
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """``trie_nodes`` of conversations as they are (conv_id, turn, role, text)."""
    turns = placed_turns(conversations)
    zero = F.lit(0).cast("long")
    columns = ["pos", "t1", "t2", "bytes"]
    return trie_nodes(turns.unionByName(turns.select("conv_id").distinct().select("conv_id", *[zero.alias(c) for c in columns])))


def rebuilt_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """``trie_nodes`` of the conversations as ``rebuild`` makes them."""
    return trie_nodes(rebuild(stored(placed_turns(conversations), "turns")), shard_turns)
