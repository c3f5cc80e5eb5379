"""A prefix trie of conversations from padded matrices of turn ids.

Conversations become sequences of turn ids (128 bits of hashes of role and text) and equal sequences one row. The distinct
sequences are dealt into ranges of their order, so every shard holds a stretch of the trie from left to right. A shard pads
its sequences to a matrix, sorts the rows with ``lexsort``, and marks where a column differs from the row above; the marks,
or-ed from left to right, say where a node starts at each depth, and ``reduceat`` sums every node's rows at all depths.
Long sequences are taken a stretch of columns at a time, so that a matrix stays within ``CELLS``. Counts of subtrees are
then added up from the deepest nodes to the root, again by ``reduceat`` over children, which lie side by side.

The last row of the shard before and the first of the shard behind take part as guests without weight. They show which
nodes go on across a border, which shard a node starts in (that one counts it) and which rows have longer ones behind them.
The few nodes on both sides of a border leave each shard as parts, keyed by a digest of their path, and are summed by key;
their sums then go back to the shards that hold children of theirs.

The digest of a node's ends is over all ids in order, one value; the ids are joined in blocks of ``ID_BLOCK`` first, so a
sequence that very many conversations share is a few rows there. A conversation is one row; its turns are one task's.

Turns are ordered by turn (null first), then role and text; a null role or text is empty. Rows without a conv_id belong to
no conversation and are left out. Repeated rows are turns of their own. Extra columns are ignored. Empty table: no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomlog.llm.common import saved

#: Cells of a matrix, turns of a shard and ids of a block.
CELLS, SHARD_TURNS, ID_BLOCK = 1 << 20, 400_000, 256
NO_ENDS = hashlib.sha256(b"").hexdigest()
_FAR = np.iinfo(np.int64).max


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as seq (two longs each) and words (of each text)."""
    schema = "conv_id long, seq array<long>, words array<long>"
    kind = pa.schema([("conv_id", pa.int64()), ("seq", pa.list_(pa.int64())), ("words", pa.list_(pa.int64()))])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for batch in batches:
            done = []
            for conv, high, low, words in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if conv != now:
                    if held:
                        done.append(held)
                    now, held = conv, {"conv_id": conv, "seq": [], "words": []}
                held["seq"] += high, low
                held["words"].append(words)
            yield pa.RecordBatch.from_pylist(done, schema=kind)
        yield pa.RecordBatch.from_pylist([held] if held else [], schema=kind)

    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return ordered.select(
        "conv_id", F.xxhash64("role", "text"), F.xxhash64(F.lit("turn"), "text", "role"), words).mapInArrow(gather, schema)


def with_shared_heads(convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Every conversation c of :func:`sequences` with its first h turns from conversation c - c % ``every``; h is the
    checksum of c modulo ``most``."""
    own = convs.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(every))).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int"))
    heads = convs.filter(F.pmod("conv_id", F.lit(every)) == 0).select(
        F.col("conv_id").alias("head"), F.slice("seq", 1, 2 * (most - 1)).alias("hs"), F.slice("words", 1, most - 1).alias("hw"))
    none = F.array().cast("array<long>")

    def joined(head: str, body: str, size: int):
        first, rest = size * F.col("h"), F.greatest(F.size(body) - size * F.col("h"), F.lit(0))
        return F.concat(F.slice(F.coalesce(head, none), F.lit(1), first), F.slice(body, first + 1, rest))
    return own.join(heads, F.col("base") == F.col("head"), "left").select(
        "conv_id", joined("hs", "seq", 2).alias("seq"), joined("hw", "words", 1).alias("words"))


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """seq, words, n, least (conv_id) and ends (digest of all conv_ids) of each distinct sequence."""
    schema = "seq array<long>, words array<long>, n long, least long, ends string"
    kind = pa.schema([("seq", pa.list_(pa.int64())), ("words", pa.list_(pa.int64())), ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None

        def finished() -> dict:
            return {**held, "ends": total.hexdigest()}

        for batch in batches:
            done = []
            for seq, words, n, least, ids in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if held is None or held["seq"] != seq:
                    if held is not None:
                        done.append(finished())
                    held, total = {"seq": seq, "words": words, "n": 0, "least": least}, hashlib.sha256()
                elif held["n"]:
                    total.update(b",")
                total.update(ids.encode())
                held["n"] += n
            yield pa.RecordBatch.from_pylist(done, schema=kind)
        yield pa.RecordBatch.from_pylist([finished()] if held is not None else [], schema=kind)

    block = F.floor(F.col("conv_id") / ID_BLOCK)
    pieces = convs.groupBy("seq", block.alias("block")).agg(
        F.first("words").alias("words"), F.count("*").alias("n"), F.min("conv_id").alias("least"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    ordered = pieces.repartition("seq").sortWithinPartitions("seq", "block")
    return ordered.select("seq", "words", "n", "least", "ids").mapInArrow(digest, schema)


def sharded(distinct: DataFrame) -> DataFrame:
    """The distinct sequences with the number of their range; each shard has the neighbours' nearest rows as guests (n = 0).

    Every row has place: 0 before the shard, 1 in it, 2 behind it.
    """
    turns = distinct.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    dealt = saved(distinct.repartitionByRange(1 + turns // SHARD_TURNS, "seq").withColumn("shard", F.spark_partition_id()), "shards")
    key = F.struct("seq", "words")
    borders = dealt.groupBy("shard").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    along = Window.orderBy("shard")  # a row for each shard
    near = borders.select("shard", F.lag("high").over(along).alias("before"), F.lead("low").over(along).alias("behind"))
    guests = near.select("shard", F.explode(F.array(
        F.struct(F.col("before").alias("row"), F.lit(0).alias("place")), F.struct(F.col("behind").alias("row"), F.lit(2).alias("place")))).alias("g")
    ).filter("g.row is not null").select("shard", "g.row.seq", "g.row.words", F.lit(0).cast("long").alias("n"), F.lit(_FAR).alias("least"),
                                         F.lit(None).cast("string").alias("ends"), "g.place")
    return dealt.withColumn("place", F.lit(1)).unionByName(guests)


class Level:
    """The nodes that one stretch of columns adds, ordered by depth, then from left to right."""

    def __init__(self, depth, parent, n, least, start, guests):
        self.depth, self.parent, self.n, self.least, self.start, self.guests = depth, parent, n, least, start, guests


def turn_ranks(flat: np.ndarray) -> np.ndarray:
    """Pairs of longs as their ranks, in order."""
    if not len(flat):
        return np.zeros(0, dtype=np.int32)
    order = np.lexsort((flat[:, 1], flat[:, 0]))
    new = np.any(flat[order][1:] != flat[order][:-1], axis=1)
    out = np.empty(len(flat), dtype=np.int32)
    out[order] = np.concatenate([[0], np.cumsum(new)])
    return out


def levels(ranks: np.ndarray, first: np.ndarray, size: np.ndarray, n: np.ndarray, least: np.ndarray, guest: np.ndarray) -> Iterator[Level]:
    """The trie's nodes below the root, a stretch of columns at a time; row r has ``ranks[first[r]:first[r] + size[r]]``.

    A node's parent is its number, counted from the root (0) on; start is a row of it with the shortest of its sequences.
    """
    active, parent, done, total = np.flatnonzero(size > 0), np.zeros(len(size), dtype=np.int64), 0, 1
    while len(active):
        width = int(max(1, min(CELLS // len(active), size[active].max() - done)))
        cells = np.minimum(size[active] - done, width)
        matrix = np.full((len(active), width), -1, dtype=np.int32)
        row = np.repeat(np.arange(len(active)), cells)
        column = np.arange(len(row)) - np.repeat(np.cumsum(cells) - cells, cells)
        matrix[row, column] = ranks[first[active][row] + done + column]
        if len(active) > 1:
            order = np.lexsort((*matrix.T[::-1], parent[active]))
            active, matrix = active[order], matrix[order]
        change = np.ones(matrix.shape, dtype=bool)
        change[1:] = matrix[1:] != matrix[:-1]
        change[1:, 0] |= parent[active][1:] != parent[active][:-1]
        starts = np.logical_or.accumulate(change, axis=1)
        depth, row = np.nonzero(matrix.T >= 0)  # by depth, then from left to right
        at = np.flatnonzero(starts[row, depth])
        rows = active[row]
        number = np.full(matrix.shape, -1, dtype=np.int64)
        number[row, depth] = total + np.cumsum(starts[row, depth]) - 1
        above = np.where(depth[at] > 0, number[row[at], depth[at] - 1], parent[active][row[at]])
        yield Level(done + 1 + depth[at], above, np.add.reduceat(n[rows], at), np.minimum.reduceat(least[rows], at), rows[at],
                    np.bitwise_or.reduceat(guest[rows], at))
        total += len(at)
        longer = size[active] > done + width
        parent[active[longer]] = number[longer, width - 1]
        active, done = active[longer], done + width


NODE = ("shard int, key string, parent_key string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")
#: Bits of a node with a guest in it: the row before the shard, the row behind it.
_BEFORE, _BEHIND = 1, 2


def shard_nodes(shard: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one shard; those that cross its border have a key, children of such ones a parent_key."""
    shard = shard.reset_index(drop=True)
    size = shard.words.map(len).to_numpy(dtype=np.int64)
    first = np.cumsum(size) - size
    flat = np.concatenate([*shard.seq, np.zeros(0, dtype=np.int64)]).astype(np.int64).reshape(-1, 2)
    words = np.concatenate([*shard.words, np.zeros(0, dtype=np.int64)]).astype(np.int64)
    n, least = shard.n.to_numpy(dtype=np.int64), shard.least.to_numpy(dtype=np.int64)
    guest = shard.place.map({0: _BEFORE, 1: 0, 2: _BEHIND}).to_numpy(dtype=np.int64)

    # the root is the first node; its start is any row
    found = [Level(*(np.array([x]) for x in (0, -1, n.sum(), least.min(), 0, np.bitwise_or.reduce(guest))))]
    found += levels(turn_ranks(flat), first, size, n, least, guest)
    depth, parent, count, least_of, start, guests = (
        np.concatenate([getattr(x, name) for x in found]) for name in ("depth", "parent", "n", "least", "start", "guests"))

    real = count > 0
    own = real & (guests & _BEFORE == 0)  # starts in this shard
    last_words = np.where(depth > 0, words[np.maximum(first[start] + depth - 1, 0)] if len(words) else 0, 0)
    saved_tokens = last_words * (count - own)
    children = np.zeros(len(depth), dtype=np.int64)
    below = np.zeros(len(depth), dtype=bool)
    below[parent[1:]] = True
    leaves = (real & ~below).astype(np.int64)
    borders = np.flatnonzero(np.concatenate([[True], depth[1:] != depth[:-1], [True]]))
    for a, b in zip(borders[-2:0:-1], borders[:0:-1]):  # the deepest first, without the root
        at = np.flatnonzero(np.concatenate([[True], parent[a + 1:b] != parent[a:b - 1]]))
        up = parent[a:b][at]
        for sums, part in ((children, own), (leaves, leaves), (saved_tokens, saved_tokens)):
            sums[up] += np.add.reduceat(part[a:b].astype(np.int64), at)

    ends = np.full(len(depth), None, dtype=object)
    ending = real & (size[start] == depth)  # the shortest sequence of a node comes first in it
    ending[0] = False
    ends[ending] = shard.ends.to_numpy()[start[ending]]
    empty = np.flatnonzero((size == 0) & (n > 0))
    if len(empty):
        ends[0] = shard.ends[empty[0]]
    keys, crossing = np.full(len(depth), None, dtype=object), np.flatnonzero(real & (guests > 0))
    for node in crossing:
        row = start[node]
        keys[node] = hashlib.md5(flat[first[row]:first[row] + depth[node]].tobytes()).hexdigest()
    up = np.maximum(parent, 0)
    return pd.DataFrame({
        "shard": np.int32(shard["shard"].iloc[0]), "key": keys, "parent_key": np.where(parent >= 0, keys[up], None), "conv_id": least_of, "depth": depth,
        "parent_conv_id": pd.array(np.where(parent >= 0, least_of[up], 0), dtype="Int64").copy(), "n_convs": count, "n_children": children,
        "n_leaves": leaves, "saved_tokens": saved_tokens, "ends_sha256": np.where((ends == None) & (keys == None), NO_ENDS, ends),  # noqa: E711
    }).assign(parent_conv_id=lambda x: x.parent_conv_id.mask(x.depth == 0))[real]


def prefix_trie(convs: DataFrame) -> DataFrame:
    """Every node of the trie of ``convs`` (conv_id, seq, words)."""
    nodes = saved(sharded(distinct_sequences(convs)).groupBy("shard").applyInPandas(shard_nodes, NODE), "nodes")
    columns = [c.split()[0] for c in NODE.split(", ")][3:]
    parts = nodes.filter("key is not null")
    whole = saved(parts.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.coalesce(F.max("ends_sha256"), F.lit(NO_ENDS)).alias("ends_sha256")), "crossing")
    known = whole.select(F.col("key").alias("at"), F.col("conv_id").alias("parent_conv_id"))
    crossing = whole.join(known, whole.parent_key == known["at"], "left").select(*columns)
    inside = nodes.filter("key is null")
    back = parts.select(F.col("shard").alias("in"), F.col("key").alias("up")).join(known, F.col("up") == F.col("at")).select("in", "up", F.col("parent_conv_id").alias("least"))
    under = inside.filter("parent_key is not null").join(back, (F.col("shard") == F.col("in")) & (F.col("parent_key") == F.col("up"))).withColumn(
        "parent_conv_id", F.col("least")).select(*columns)
    return inside.filter("parent_key is null").select(*columns).unionByName(under).unionByName(crossing)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations with shared heads."""
    return prefix_trie(with_shared_heads(saved(sequences(conversations), "sequences")))
