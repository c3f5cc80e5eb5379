"""Document fingerprints by one-permutation MinHash.

The shingles of a text (five words, ASCII letters lower-cased) are hashed once. The upper bits of a hash name its bin, and
each bin keeps its smallest hash. Empty bins are filled by optimal densification: a bin tries other bins in an order of its
own, drawn by a fixed hash of bin and attempt, and copies the first that is not empty. Of each bin's hash only the low
``BITS`` bits are stored, packed into one string of hex digits. Equal bits may agree by chance, so the likeness of two
fingerprints is their share of equal bins, corrected for that: ``(share - c) / (1 - c)`` with ``c = 2 ** -BITS``, at least 0.

Nulls: a null text is empty. A text without words has the empty fingerprint, which is like another empty one (1) and unlike
all others (0); fewer than five words make one shingle. A null doc_id comes last in the order of documents. Rows with equal
doc_id follow one another in the order of their texts. Extra columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import kept_in_worker, texts_of

SHINGLE, BINS, BITS = 5, 256, 4
#: Rows a bucket of neighbouring documents has at least, and the most buckets there are.
BUCKET_ROWS, MOST_BUCKETS = 2_000, 20_000

_ODD = np.array([2 * int.from_bytes(hashlib.md5(b"word%d" % k).digest()[:7], "big") + 1 for k in range(SHINGLE)], dtype=np.uint64)
_MIX = np.uint64(0xFF51AFD7ED558CCD)

RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def shingle_hashes(text: str) -> np.ndarray:
    from xxhash import xxh3_64_intdigest
    words = text.encode().lower().split()
    hashes = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    count = max(1, len(words) - SHINGLE + 1) if words else 0
    mixed = np.zeros(count, dtype=np.uint64)
    for k in range(min(SHINGLE, len(words))):
        mixed += hashes[k:k + count] * _ODD[k]
    for shift in (33, 29, 32):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * _MIX
    return mixed ^ (mixed >> np.uint64(33))


def probes() -> np.ndarray:
    """For each bin the order in which it tries others: a row for each attempt, every bin in each column's tail."""
    def make():
        drawn = [[int.from_bytes(hashlib.md5(b"%d:%d" % (b, a)).digest()[:4], "big") % BINS for b in range(BINS)] for a in range(4 * BINS)]
        rest = [[(b + a) % BINS for b in range(BINS)] for a in range(BINS)]
        return np.array(drawn + rest)
    return kept_in_worker("probes", make)


def minima(text: str) -> np.ndarray | None:
    """The low bits of each bin's smallest hash after densification; None without words."""
    hashes = np.sort(shingle_hashes(text))
    if not len(hashes):
        return None
    width = np.uint64(64 - int(BINS).bit_length() + 1)
    bins = hashes >> width
    at = np.searchsorted(bins, np.arange(BINS, dtype=np.uint64))
    filled = at < len(hashes)
    filled[filled] = bins[at[filled]] == np.flatnonzero(filled).astype(np.uint64)
    low = np.zeros(BINS, dtype=np.uint8)
    low[filled] = (hashes[at[filled]] & np.uint64(2**BITS - 1)).astype(np.uint8)
    source, order, empty, attempt = np.arange(BINS), probes(), np.flatnonzero(~filled), 0
    while len(empty):
        tried = order[attempt, empty]
        hit = filled[tried]
        source[empty[hit]] = tried[hit]
        empty, attempt = empty[~hit], attempt + 1
    return low[source]


def packed_hex(low: np.ndarray | None) -> str:
    """Two bins to a byte, as hex digits."""
    return "" if low is None else (low[0::2] << 4 | low[1::2]).tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    if a is None or b is None:
        return float(a is b)
    chance = 2.0 ** -BITS
    return max(0.0, (float((a == b).mean()) - chance) / (1 - chance))


def fingerprint_likeness(a: str, b: str) -> float:
    """The likeness of two stored fingerprints."""
    def unpack(x: str) -> np.ndarray | None:
        raw = np.frombuffer(bytes.fromhex(x), dtype=np.uint8)
        return np.stack([raw >> 4, raw & 15], axis=1).ravel() if x else None
    return likeness(unpack(a), unpack(b))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row."""
    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b.doc_id.astype("Int64"), "fingerprint": [packed_hex(minima(t)) for t in b.text]})
    return texts_of(docs).mapInPandas(compute, "doc_id long, fingerprint string")


def neighbours(docs: DataFrame) -> DataFrame:
    """bucket, follower, doc_id, text: documents in buckets of the order of doc_id, each bucket followed by the next one's first.

    The borders are doc_ids of documents, so the first row of a bucket is known by its doc_id and can be sent along with
    the bucket before; the last bucket gets the first document of all.
    """
    texts = texts_of(docs)
    rows = docs.count()
    count = max(1, min(rows // BUCKET_ROWS, MOST_BUCKETS))
    shares = [k / count for k in range(1, count)] or [1.0]
    least, borders = docs.agg(F.min("doc_id"), F.percentile_approx("doc_id", shares, 10 * count)).first()
    borders = np.array(sorted(set(borders or [])) if count > 1 else [], dtype=np.int64)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = b.doc_id.astype("Int64")
            missing = ids.isna().to_numpy()
            number = ids.fillna(0).to_numpy(dtype=np.int64)
            bucket = np.where(missing, len(borders), np.searchsorted(borders, number, side="right"))
            own = pd.DataFrame({"bucket": bucket, "follower": False, "doc_id": ids, "text": b.text})
            starts = ~missing & np.isin(number, borders)
            first = missing if least is None else ~missing & (number == least)
            yield pd.concat([own, own[starts].assign(bucket=bucket[starts] - 1, follower=True),
                             own[first].assign(bucket=len(borders), follower=True)])

    dealt = texts.mapInPandas(deal, "bucket long, follower boolean, doc_id long, text string")
    return dealt.repartition(count, "bucket").sortWithinPartitions("bucket", "follower", F.asc_nulls_last("doc_id"), "text")


def edit_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and its likeness to that and to the next document.

    The edited text has the last half of the code points replaced by the first as many of the next document.
    """
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None  # bucket, doc_id, text, minima of the row before
        for b in batches:
            out = []
            for bucket, follower, doc_id, text in zip(b.bucket, b.follower, b.doc_id.astype("Int64"), b.text):
                if before is None and follower or before is not None and before[0] != bucket and follower:
                    continue  # a bucket of followers alone, or one follower too many
                low = minima(text)
                if before is not None and before[0] == bucket:
                    out.append(_compared(before, text, low))
                before = None if follower else (bucket, doc_id, text, low)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")]).astype({"doc_id": "Int64"})
    return neighbours(docs).mapInPandas(compare, RESULT)


def _compared(row: tuple, following: str, following_low: np.ndarray | None) -> tuple:
    _, doc_id, text, low = row
    half = len(text) // 2
    edited = text[:len(text) - half] + following[:half]
    edited_low = minima(edited)
    return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), packed_hex(low), packed_hex(edited_low),
            likeness(low, edited_low), likeness(low, following_low))
