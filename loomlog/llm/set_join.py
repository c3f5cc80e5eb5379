"""Texts linked by the Jaccard similarity of their sets of word shingles, exactly, by skipping along set relations.

Equal sets are one set. Two sets that are ``percent`` alike share a token among the first ``n - ceil(percent * n / 100) + 1``
of either, in any order of tokens that holds for all. Tokens are hashes; the order puts the ``LOW`` share of smallest hashes
first, of these the ones that fewer than ``HOT`` sets have by hash, then the others by the number of sets, which is counted
over all of them; the rest follows by hash. An index list holds the sets with one token among their first, in blocks of like
size, ordered by the position that the token has in the set. Similar sets' positions differ by little, so a set reads one
run of its own block and one of the next and skips the rest of the list. What it reads is tested by sizes, positions and
then parities: each set has a bit for each of at least n / 2 classes of hashes, set if it has an odd number of them, and two
sets differ in at least as many tokens as bits. What passes is connected, and each connected group is settled on the sets.

There a set's overlaps with all others are first counted along the lists of all its tokens. A set similar to one that has
been counted derives its own from those: it takes off the lists of the tokens it lacks and adds those of the ones it has
besides. So near copies cost their differences only.

Lists and groups have no size limit: those over ``MEMBERS`` sets (or ``TOKENS`` tokens) are dealt into parts. All parts meet
the first one; then what is not connected to the largest component meets every part. No link between components is lost,
and members of one component need not all meet.

A null text is empty. A text without words has no shingles, is linked with nothing and is a component of its own; one with
fewer words than a shingle has one. Rows without a doc_id take part but name no component while there is another id.
Repeated rows stay, and so do rows of one doc_id with different texts. Extra columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import kept_in_worker, saved, small, texts_of
from loomlog.llm.simhash import labels_of

SHINGLE, PERCENT = 3, 90
#: Share of hashes whose tokens are counted, and the count from which a token is put behind the others.
LOW, HOT = 0.2, 32
_LIMIT = int(LOW * 2**63)
#: Sets and tokens of a part.
MEMBERS, TOKENS = 500, 2_000_000
#: Rows of index lists taken at once, and words (of 64 bits) or pairs held at once.
ROWS, WORDS = 50_000, 1 << 21


def tokens_of(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text as hashes of 63 bits, in order."""
    from xxhash import xxh3_64_intdigest
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    hashes = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    odd = kept_in_worker(f"odd{shingle}", lambda: np.array(
        [2 * int.from_bytes(hashlib.md5(b"shingle%d" % k).digest()[:7], "big") + 1 for k in range(shingle)], dtype=np.uint64))
    count = max(1, len(words) - shingle + 1)
    mixed = np.full(count, min(len(words), shingle), dtype=np.uint64)
    for k in range(min(shingle, len(words))):
        mixed += hashes[k:k + count] * odd[k]
    for shift in (33, 29, 32):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(0xFF51AFD7ED558CCD)
    return np.unique(((mixed ^ (mixed >> np.uint64(33))) >> np.uint64(1)).view(np.int64))


def first_tokens(n: int, percent: int) -> int:
    """How many tokens of n one shares with any set that is this much alike."""
    return n - -(-percent * n // 100) + 1


def parities(tokens: np.ndarray) -> bytes:
    """A bit for each class of hashes, as many as the power of two from 64 on that reaches half the number of tokens."""
    width = max(64, 1 << ((len(tokens) - 1) // 2).bit_length())
    odd = (np.bincount(tokens & (width - 1), minlength=width) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def sets(docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """doc_id, n, key (digest of the set), low (its first tokens by hash) and bits (parities) of every row."""
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 1_000):
                part, out = b.iloc[at:at + 1_000], []
                for text in part.text:
                    t = tokens_of(text, shingle)
                    first = max(int(np.searchsorted(t, _LIMIT)), first_tokens(len(t), percent)) if len(t) else 0
                    out.append((len(t), hashlib.blake2b(t.tobytes(), digest_size=16).digest(), t[:first], parities(t) if len(t) else b""))
                rows = pd.DataFrame(out, columns=["n", "key", "low", "bits"])
                rows.insert(0, "doc_id", part.doc_id.to_numpy())
                yield rows
    texts = texts_of(docs).select(F.col("doc_id").cast("string").alias("doc_id"), "text")  # a null would make ids floats
    return texts.mapInPandas(compute, "doc_id string, n long, key binary, low array<long>, bits binary").withColumn("doc_id", F.col("doc_id").cast("long"))


def index_rows(distinct: DataFrame, percent: int) -> DataFrame:
    """grp (a token), id, n and pos of each set's first tokens, in the order of tokens that holds for all sets.

    Tokens that one set alone has are left out, and so are lists that hold the same sets as another: a pair is tested alike in
    each list that holds it. Membership is compared by count and two hashes of the ids, 128 bits.
    """
    counts = saved(distinct.select(F.explode("low").alias("token")).groupBy("token").count().filter("count > 1"), "counts")
    hot = saved(counts.filter((F.col("count") >= HOT) & (F.col("token") < _LIMIT)), "hot")
    of_set = distinct.select("id", F.explode("low").alias("token")).join(small(hot), "token").groupBy("id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("count", "token"))), lambda x: x["token"]).alias("behind"))
    behind = F.coalesce("behind", F.array().cast("array<long>"))
    order = F.concat(F.array_except(F.filter("low", lambda t: t < _LIMIT), behind), behind, F.filter("low", lambda t: t >= _LIMIT))
    first = F.expr(f"cast(n - (n * {percent} + 99) div 100 + 1 as int)")
    rows = distinct.select("id", "n", "low").join(of_set, "id", "left").select(
        "id", "n", F.posexplode(F.slice(order, F.lit(1), first)).alias("pos", "token"))
    shared = saved(rows.join(counts.select("token"), "token"), "index")
    lists = shared.groupBy("token").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64(F.lit("id"), "id")).alias("y"))
    kept = saved(lists.filter("size > 1").groupBy("size", "x", "y").agg(F.min("token").alias("token")).select("token"), "lists")
    return saved(shared.join(kept, "token").withColumnRenamed("token", "grp"), "index")


# Lists and groups, whole or dealt into parts.

def connected(members: DataFrame, marks: DataFrame, meet: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """fp (an id) and label of what is linked within the groups of ``members`` (grp, id, weight and other columns).

    ``meet`` gets the members' rows with what ``marks`` has of their id, a block and query, and returns a, b: ids that connect
    what is linked in a block by links of which one end at least is a query. The marks join before rows are dealt, and by
    merging: the planner goes by the size of files, which is far below that of the rows they are dealt into, and would
    broadcast those.
    """
    own = ["grp", "id", *[c for c in members.columns + marks.columns if c not in ("grp", "id", "weight")]]
    sizes = saved(members.groupBy("grp").agg(F.count("*").alias("size"), F.sum("weight").alias("total")).filter("size > 1").select(
        "grp", F.ceil(F.greatest(F.col("size") / MEMBERS, F.col("total") / TOKENS)).cast("int").alias("parts")), "sizes")

    def dealt(groups: DataFrame) -> DataFrame:
        marked = members.join(groups, "grp").join(marks.hint("merge"), "id")
        return marked.withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    blocks = F.when(F.col("part") == 0, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
    star = dealt(sizes).withColumn("block", F.explode(blocks.cast("array<long>"))).withColumn("query", F.col("part") == F.col("block"))
    links = saved(meet(star.select(*own, "block", "query")), "links")
    labels = labels_of(links)
    large = saved(sizes.filter("parts > 1"), "large")
    if not large.limit(1).count():
        return labels
    lists = saved(dealt(large).join(labels.withColumnRenamed("fp", "i"), F.col("id") == F.col("i"), "left").select(
        *own, "parts", "part", F.coalesce("label", "id").alias("label")), "parted")
    # a row for each group here and in ``asked``, which are the smaller side whatever the files' sizes
    largest = saved(lists.groupBy("grp", "label").count().groupBy("grp").agg(F.max_by("label", F.struct("count", "label")).alias("most")), "largest")
    apart = saved(lists.join(small(largest), "grp").filter("label <> most").select(*own, "parts", "part"), "apart")
    if not apart.limit(1).count():
        return labels
    asked = saved(apart.groupBy("grp").agg(F.collect_set("part").alias("asking")), "asked")

    def block(asking: Column, part: Column) -> Column:
        return (asking.cast("long") * (1 << 31) + part).alias("block")
    queries = apart.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        *own, block(F.col("part"), F.col("other")), F.lit(True).alias("query"))
    index = lists.join(small(asked), "grp").withColumn("from", F.explode("asking")).select(
        *own, block(F.col("from"), F.col("part")), F.lit(False).alias("query"))
    more = saved(meet(queries.unionByName(index)), "links")
    return labels_of(links.unionByName(more))


def whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames of at least ROWS rows that cut no (grp, block); equal ones stand together."""
    held, count = [], 0
    for b in batches:
        held.append(b)
        count += len(b)
        if count >= ROWS:
            rows = pd.concat(held, ignore_index=True)
            last = (rows.grp.to_numpy() == rows.grp.iloc[-1]) & (rows.block.to_numpy() == rows.block.iloc[-1])
            cut = int(np.argmax(last))
            if cut:
                yield rows.iloc[:cut].reset_index(drop=True)
            held, count = [rows.iloc[cut:]], len(rows) - cut
    if count:
        yield pd.concat(held, ignore_index=True)


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (the smallest number that each is connected with) with the pairs a, b as further links."""
    label = label.copy()
    while len(a):
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def as_links(ids: np.ndarray, label: np.ndarray) -> pd.DataFrame:
    """Links of each to the first of its component, by number."""
    other = np.flatnonzero(label != np.arange(len(label)))
    a, b = ids[label[other]], ids[other]
    return pd.DataFrame({"a": a, "b": b})[a != b].drop_duplicates()


def needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of sets of n and m tokens that are this much alike."""
    return -(-percent * (n + m) // (100 + percent))


def runs(group: np.ndarray, n: np.ndarray, pos: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a group that their sizes and positions may link, read by runs of the size blocks of the lists.

    A size differs from a similar one's by a factor 100 / percent at most, a class of sizes spans a little more. So a row's
    partners are in its own block, where each pair is read by its first row, or in the next one.
    """
    step = math.log(100 / percent) * 1.001
    kind = np.floor(np.log(n) / step).astype(np.int64)
    order = np.lexsort((pos, kind, group))
    group, n, pos, kind = group[order], n[order], pos[order], kind[order]
    reach, kinds = int(pos.max()) + 1, int(kind.max()) + 2
    key = (group * kinds + kind) * reach + pos
    share = percent / (100 + percent)  # of the sizes' sum, the overlap needed
    row = np.arange(len(n))
    for up in (0, 1):
        low, high = np.exp((kind + up) * step), np.exp((kind + up + 1) * step)
        block = (group * kinds + kind + up) * reach
        ahead = np.floor((1 - share) * high - share * n + 1e-6).astype(np.int64)
        back = np.floor((1 - share) * n - share * low + 1e-6).astype(np.int64)
        first = row + 1 if not up else np.searchsorted(key, block + np.clip(pos - back, 0, reach))
        last = np.searchsorted(key, block + np.clip(pos + ahead, -1, reach - 1), side="right")
        many = np.maximum(last - first, 0)
        total, at = np.cumsum(many), 0
        while at < len(row):
            done = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, done + WORDS, side="right")))
            part, a = many[at:end], None
            a = np.repeat(row[at:end], part)
            b = np.arange(len(a)) - np.repeat(total[at:end] - part - done, part) + first[a]
            at = end
            na, nb, pa, pb = n[a], n[b], pos[a], pos[b]
            fits = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
            fits &= 1 + np.minimum(pa, pb) + np.minimum(na - pa, nb - pb) - 1 >= needed(na, nb, percent)
            yield order[a[fits]], order[b[fits]]


class Parities:
    """The parities of many sets, as matrices of words by width; a wider set is folded to half its width as well."""

    def __init__(self, bits: list[bytes]):
        self.width = np.array([len(b) // 8 for b in bits], dtype=np.int64)
        self.bits, self.known = bits, {}

    def _at(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        if width not in self.known:
            own, twice = np.flatnonzero(self.width == width), np.flatnonzero(self.width == 2 * width)
            rows = np.full(len(self.bits), -1, dtype=np.int64)
            rows[own], rows[twice] = np.arange(len(own)), len(own) + np.arange(len(twice))
            one = np.frombuffer(b"".join(self.bits[k] for k in own), dtype=np.uint64).reshape(-1, width)
            two = np.frombuffer(b"".join(self.bits[k] for k in twice), dtype=np.uint64).reshape(-1, 2 * width)
            self.known[width] = rows, np.concatenate([one, two[:, :width] ^ two[:, width:]])
        return self.known[width]

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A number of tokens by which the sets differ at least; their widths are equal or one is twice the other."""
        width, out = np.minimum(self.width[a], self.width[b]), np.zeros(len(a), dtype=np.int64)
        for w in np.unique(width).tolist():
            rows, words = self._at(w)
            mine = np.flatnonzero(width == w)
            for at in range(0, len(mine), max(1, WORDS // w)):
                some = mine[at:at + max(1, WORDS // w)]
                out[some] = np.bitwise_count(words[rows[a[some]]] ^ words[rows[b[some]]]).sum(axis=1, dtype=np.int64)
        return out


def listed(rows: DataFrame, percent: int) -> DataFrame:
    """a, b: connect the sets that may be linked by what the index lists tell (rows: grp, block, query, id, n, pos, bits)."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches):
            group = np.unique(np.stack([part.grp.to_numpy(), part.block.to_numpy()]), axis=1, return_inverse=True)[1].reshape(-1)
            ids, number = np.unique(part.id.to_numpy(), return_inverse=True)
            n, query, bits = part.n.to_numpy(), part["query"].to_numpy(), Parities(part.bits.tolist())
            label = np.arange(len(ids))
            for a, b in runs(group, n, part.pos.to_numpy().astype(np.int64), percent):
                asked = (query[a] | query[b]) & (label[number[a]] != label[number[b]])
                a, b = a[asked], b[asked]
                close = bits.differ(a, b) <= n[a] + n[b] - 2 * needed(n[a], n[b], percent)
                label = merged(label, number[a[close]], number[b[close]])
            yield as_links(ids, label)

    ordered = rows.repartition("grp", "block").sortWithinPartitions("grp", "block")
    return ordered.select("grp", "block", "query", "id", "n", "pos", "bits").mapInPandas(read, "a long, b long")


def overlaps(tokens: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """Each set's number and its overlaps with all sets, derived where it can be from those of a similar set."""
    size = np.array([len(t) for t in tokens])
    _, flat = np.unique(np.concatenate(tokens), return_inverse=True)
    own = np.split(flat, np.cumsum(size)[:-1])  # tokens as places of their lists
    member = np.repeat(np.arange(len(tokens)), size)
    lists = member[np.argsort(flat, kind="stable")]
    start = np.concatenate([[0], np.cumsum(np.bincount(flat))])

    def counted(places: np.ndarray) -> np.ndarray:
        many = start[places + 1] - start[places]
        at = np.repeat(start[places] - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.bincount(lists[at], minlength=len(tokens))

    todo = np.ones(len(tokens), dtype=bool)
    for leader in np.argsort(size, kind="stable"):
        if not todo[leader]:
            continue
        of_leader, todo[leader] = counted(own[leader]), False
        yield leader, of_leader
        # a difference of less than half of the set is cheaper than its own lists
        near = np.flatnonzero(todo & (size + size[leader] - 2 * of_leader < size / 2))
        todo[near] = False
        for k in near.tolist():
            lacks = np.setdiff1d(own[leader], own[k], assume_unique=True)
            adds = np.setdiff1d(own[k], own[leader], assume_unique=True)
            yield k, of_leader - counted(lacks) + counted(adds)


def settled(rows: DataFrame, percent: int) -> DataFrame:
    """a, b: connect the sets of a block (rows: grp, block, query, id, tokens) that are linked, by their exact overlaps."""
    def settle(block: pd.DataFrame) -> pd.DataFrame:
        size, query = block.tokens.map(len).to_numpy(), block["query"].to_numpy()
        label = np.arange(len(block))
        for k, common in overlaps(block.tokens.tolist()):
            linked = (100 * common >= percent * (size + size[k] - common)) & (query | query[k])
            linked[k] = True
            of = label[linked]
            if (of != of[0]).any():
                label[np.isin(label, of)] = of.min()
        return as_links(block.id.to_numpy(), label)
    return rows.groupBy("grp", "block").applyInPandas(settle, "a long, b long")


def exact_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """id and tokens of the sets in ``wanted`` (id, key, least), made anew from one of their documents."""
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 200):
                found = [tokens_of(t, shingle) for t in b.text[at:at + 200]]
                yield pd.DataFrame({"key": [hashlib.blake2b(t.tobytes(), digest_size=16).digest() for t in found], "tokens": found})
    ids = wanted.select(F.col("least").alias("of")).distinct()
    texts = texts_of(docs).join(small(saved(ids, "wanted")), F.col("doc_id").eqNullSafe(F.col("of")), "left_semi")
    # a repeated doc_id brings other texts too; they have other keys
    return texts.select("text").mapInPandas(compute, "key binary, tokens array<long>").join(
        small(wanted.select("id", "key")), "key").groupBy("id").agg(F.first("tokens").alias("tokens"))


def linked_components(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row."""
    marked = saved(sets(docs, percent, shingle), "sets")
    distinct = saved(marked.filter("n > 0").groupBy("key").agg(
        F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("low").alias("low"), F.first("bits").alias("bits")
    ).withColumn("id", F.monotonically_increasing_id()), "distinct")
    lists = index_rows(distinct, percent).withColumn("weight", F.lit(0))
    near = connected(lists, distinct.select("id", "bits"), lambda rows: listed(rows, percent))
    wanted = saved(near.withColumnRenamed("fp", "id").join(distinct.select("id", "key", "least", "n"), "id"), "wanted")
    tokens = saved(exact_sets(docs, wanted, shingle), "tokens")
    groups = wanted.select(F.col("label").alias("grp"), "id", F.col("n").alias("weight"))
    labels = connected(groups, tokens, lambda rows: settled(rows, percent))
    grouped = distinct.select("id", "key", "least").join(labels, F.col("id") == F.col("fp"), "left").withColumn("label", F.coalesce("label", "id"))
    smallest = grouped.groupBy("label").agg(F.min("least").alias("component"))
    of_key = grouped.join(smallest, "label").select("key", "component")
    return marked.select("doc_id", "n", "key").join(of_key, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))
