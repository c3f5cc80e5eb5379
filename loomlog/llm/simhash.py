"""SimHash near-duplicate groups, searched with BK-trees.

A fingerprint of 64 bits comes from the hashes of a text's word shingles. Two fingerprints at most ``radius`` bits apart
agree in at least one of ``radius + 1`` blocks of bits, so every distinct fingerprint goes to one shard per block, keyed by
the block's bits. A shard is one BK-tree: a node's children are keyed by their Hamming distance to it, and a search follows
only edges whose key lies within the radius of its own distance. The task that owns a shard builds its tree and looks each
member up in it; the trees are not broadcast, because together they hold as many fingerprints as the corpus. A shard of
more than ``shard_limit`` fingerprints is split in turn: among its members the other bits differ by at most ``radius``, so
they fall into shards by blocks of those bits, and so on. Each tree yields a spanning forest of its links, never all pairs,
and the forests are merged by label propagation with pointer jumping over links between distinct fingerprints only.

Nulls: a null text is empty and gets the fingerprint zero, which links like any other; a null doc_id takes part, but
is never a group's smallest id while there is another. Repeated rows stay apart and share a component. Extra columns are
ignored by :func:`components` and carried along by :func:`first_of_each`. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomlog.llm.common import saved, texts_of

BITS = 64
#: A shard with more fingerprints is split by further blocks.
SHARD_LIMIT = 2_000


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a text: a bit is set if it is set in over half of the shingles' hashes; 0 without words."""
    import xxhash
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[k:] for k in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, seed) for p in parts], dtype=">u8")
    set_bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(hashes)).tobytes(), "big")


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every row."""
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b.doc_id.astype("Int64"), "fp": [_signed(fingerprint(t, shingle)) for t in b.text]})
    return texts_of(docs).mapInPandas(compute, "doc_id long, fp long")


class BKTree:
    """Numbers keyed by Hamming distance to their parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near_then_add(self, value: int, radius: int) -> list[int]:
        """Positions of the members within ``radius`` of ``value``, which then becomes a member."""
        near, stack, values, children = [], [0] if self.values else [], self.values, self.children
        while stack:
            at = stack.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                near.append(at)
            edges = children[at]
            if len(edges) <= 2 * radius + 1:
                stack += [node for key, node in edges.items() if d - radius <= key <= d + radius]
            else:
                stack += [edges[key] for key in range(d - radius, d + radius + 1) if key in edges]
        at = 0
        while values:
            d = (values[at] ^ value).bit_count()
            if d not in children[at]:
                children[at][d] = len(values)
                break
            at = children[at][d]
        values.append(value)
        children.append({})
        return near


def forest(members: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``members`` (distinct numbers): pairs of linked ones, no cycle."""
    tree, root, links = BKTree(), list(range(len(members))), []

    def find(a: int) -> int:
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for n, value in enumerate(members):
        for m in tree.near_then_add(value, radius):
            a, b = find(m), find(n)
            if a != b:
                root[b] = a
                links.append((members[m], value))
    return links


def blocks(bits: list[int], count: int) -> list[list[int]]:
    """``bits`` (positions) dealt into ``count`` blocks of nearly equal size."""
    return [bits[len(bits) * k // count:len(bits) * (k + 1) // count] for k in range(count)]


def shard_paths(radius: int, depth: int) -> list[tuple[str, str, int, list[int]]]:
    """(path, parent path, mask, bits left) of the shards at ``depth``: one block more is fixed than at the parent."""
    paths = [("", "", 0, list(range(BITS)))]
    for _ in range(depth + 1):
        paths = [(f"{path}.{k}", path, mask | sum(1 << x for x in block), [x for x in bits if x not in block])
                 for path, _, mask, bits in paths for k, block in enumerate(blocks(bits, radius + 1))]
    return paths


def _sharded(members: DataFrame, radius: int, depth: int) -> DataFrame:
    """fp, path and key: a row for each shard at ``depth`` below the row's present ``path``."""
    options = F.array(*[F.struct(F.lit(path).alias("path"), F.lit(parent).alias("parent"),
                                 F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long")).alias("key"))
                        for path, parent, mask, _ in shard_paths(radius, depth)])
    return members.select("fp", F.explode(F.filter(options, lambda o: o["parent"] == F.col("path"))).alias("s")).select(
        "fp", "s.path", "s.key")


def links(distinct: DataFrame, radius: int, shard_limit: int = SHARD_LIMIT, depths: int = 3) -> DataFrame:
    """a, b: linked fingerprints that connect whatever is linked within ``radius``; ``distinct`` has each fp once."""
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, members = None, []
        for b in batches:
            found = []
            for path, key, fp in zip(b.path.tolist(), b.key.tolist(), b.fp.tolist()):
                if (path, key) != shard:
                    if len(members) > 1:
                        found += forest(members, radius)
                    shard, members = (path, key), []
                members.append(fp & (2**64 - 1))
            yield _pairs(found)
        yield _pairs(forest(members, radius) if len(members) > 1 else [])

    rows, members = None, distinct.select("fp", F.lit("").alias("path"))
    for depth in range(depths):
        keyed = saved(_sharded(members, radius, depth), "shards")
        if depth == depths - 1:
            large = None
        else:
            large = saved(keyed.groupBy("path", "key").count().filter(F.col("count") > shard_limit).drop("count"), "large")
            large = large if large.limit(1).count() else None
        small = keyed if large is None else keyed.join(large, ["path", "key"], "left_anti")
        rows = small if rows is None else rows.unionByName(small)
        if large is None:
            break
        members = keyed.join(large, ["path", "key"], "left_semi").select("fp", "path")
    return rows.repartition("path", "key").sortWithinPartitions("path", "key", "fp").mapInPandas(search, "a long, b long")


def _pairs(found: list[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame([(_signed(a), _signed(b)) for a, b in found], columns=["a", "b"]).astype("int64")


def labels_of(pairs: DataFrame) -> DataFrame:
    """fp, label for every fingerprint in ``pairs``; equal labels mark what is connected.

    Every node takes the smallest label around it, then the label of its label, so long chains shrink fast.
    """
    edges = saved(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = saved(edges.groupBy(F.col("a").alias("fp")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:  # labels only shrink, and each round halves what a chain has left
        near = edges.join(labels, edges.b == labels.fp).groupBy("a").agg(F.min("label").alias("near"))
        closer = labels.join(near, labels.fp == near.a, "left").select("fp", "label", F.least("label", "near").alias("new"))
        hop = labels.select(F.col("fp").alias("via"), F.col("label").alias("far"))
        jumped = closer.join(hop, closer.new == hop.via, "left").select("fp", "label", F.least("new", "far").alias("new"))
        stepped = saved(jumped, "labels")
        changed = stepped.filter("new <> label").limit(1).count()
        labels = stepped.select("fp", F.col("new").alias("label"))
        if not changed:
            return labels


def components(docs: DataFrame, shingle: int = 3, radius: int = 2, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id that is reachable by links) of every row."""
    marked = saved(fingerprints(docs, shingle), "fingerprints")
    distinct = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    labels = labels_of(links(distinct.select("fp"), radius, shard_limit))
    return _with_smallest(marked, distinct, labels)


def _with_smallest(marked: DataFrame, distinct: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, fp and component_id of ``marked``; fingerprints without a label are components of their own."""
    grouped = distinct.join(labels, "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    smallest = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    of_fp = grouped.join(smallest, "label").select("fp", "component_id")
    return marked.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    return components(docs, shingle, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document of each component in ``found``: the one with the smallest doc_id.

    Of repeated rows with that doc_id one stays; documents without a doc_id stay only where a component has no other.
    """
    chosen = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    rows = docs.select(F.col("doc_id").alias("id"), F.struct("*").alias("row")).join(
        chosen, F.col("id").eqNullSafe(F.col("doc_id")), "left_semi")
    order = Window.partitionBy("id").orderBy(F.col("row").cast("string"))
    return rows.withColumn("nth", F.row_number().over(order)).filter("nth = 1").select("row.*")
