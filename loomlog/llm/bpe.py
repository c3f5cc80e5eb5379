"""BPE encoding and decoding with tree concatenation for long texts.

A short text is encoded in its task, blank-separated word by word; a word's ids are computed once per worker. A long text
is halved until every part has at most ``part_chars`` code points. The parts are encoded in parallel as rows of their own
and joined pairwise, level by level. A cut may fall anywhere, also inside a word, so a join re-encodes a window around it
and doubles the window until its tokens agree with ``AGREE`` successive tokens (id, start and end) of both sides. Every
neighbouring pair of the result then comes from one encoding of both tokens together, which makes the joined sequence the
encoding of the whole. Where no agreement is found the window reaches both ends and is the encoding itself.

Nulls: a null text is empty (no tokens); a null doc_id is kept. Repeated rows give repeated results. Extra columns are
ignored. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import kept_in_worker, texts_of

#: Tokens that a window and a side must share for a join.
AGREE = 4
#: First window, in code points on each side of a join.
FIRST_WINDOW = 32
#: Words whose ids a worker keeps (about 250 bytes each); words beyond are encoded when met.
KEPT_WORDS = 400_000
#: Documents of a batch whose words are held at once.
SLICE = 200

DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
PART = "doc_id long, text_key string, part int, text string"


def load(path: str):
    """The tokenizer at ``path``, loaded once per worker, without truncation and padding."""
    def make():
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        return t
    return kept_in_worker(f"tokenizer:{path}", make)


def special_strings(tokenizer) -> list[str]:
    """The added tokens' strings."""
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def encode_tokens(tokenizer, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, starts and ends (code points) of ``text`` by the library."""
    e = tokenizer.encode(text, add_special_tokens=False)
    offsets = np.array(e.offsets, dtype=np.int64).reshape(-1, 2)
    return np.array(e.ids, dtype=np.uint32), offsets[:, 0], offsets[:, 1]


class Node:
    """An encoded stretch [start, end) of a text; offsets count from the beginning of the whole text."""

    def __init__(self, start: int, end: int, ids, starts, ends):
        self.start, self.end, self.ids, self.starts, self.ends = start, end, ids, starts, ends


def _first_run(a: tuple, b: tuple, last: bool = False) -> tuple[int, int] | None:
    """Where AGREE successive tokens of ``a`` also are successive in ``b``: positions in a and b, of the first or last run."""
    where = {(i, s, e): n for n, (i, s, e) in enumerate(zip(*b))}
    mine = list(zip(*a))
    order = range(len(mine) - AGREE, -1, -1) if last else range(len(mine) - AGREE + 1)
    for n in order:
        at = where.get(mine[n])
        if at is not None and all(where.get(mine[n + k]) == at + k for k in range(1, AGREE)):
            return n, at
    return None


def join_nodes(left: Node, right: Node, text: str, tokenizer, base: int = 0) -> Node:
    """The encoding of ``left`` and ``right`` together; ``text`` begins at offset ``base`` and covers both."""
    cut, reach = left.end, FIRST_WINDOW
    while True:
        a, b = max(left.start, cut - reach), min(right.end, cut + reach)
        ids, starts, ends = encode_tokens(tokenizer, text[a - base:b - base])
        starts, ends = starts + a, ends + a
        window = (ids.tolist(), starts.tolist(), ends.tolist())
        if a == left.start:
            head = (0, 0)
        else:
            lo = int(np.searchsorted(left.starts, a))
            near = tuple(x[lo:].tolist() for x in (left.ids, left.starts, left.ends))
            found = _first_run(window, near)
            head = found and (found[0], lo + found[1])
        if b == right.end:
            tail = (len(ids), len(right.ids))
        else:
            hi = int(np.searchsorted(right.ends, b, side="right"))
            near = tuple(x[:hi].tolist() for x in (right.ids, right.starts, right.ends))
            tail = _first_run(window, near, last=True)
        if head and tail and head[0] <= tail[0]:
            glue = [np.concatenate([l[:head[1]], w[head[0]:tail[0]], r[tail[1]:]])
                    for l, w, r in ((left.ids, ids, right.ids), (left.starts, starts, right.starts), (left.ends, ends, right.ends))]
            return Node(left.start, right.end, *glue)
        reach *= 2


def concat_tree(nodes: list[Node], text: str, tokenizer) -> Node:
    """Joins neighbours level by level until one node is left."""
    while len(nodes) > 1:
        pairs = [join_nodes(nodes[i], nodes[i + 1], text, tokenizer) for i in range(0, len(nodes) - 1, 2)]
        nodes = pairs + nodes[2 * len(pairs):]
    return nodes[0]


def cuts(length: int, part_chars: int) -> list[int]:
    """Borders of the halves of halves of ``length`` that have at most ``part_chars``."""
    count = 1
    while -(-length // count) > part_chars:
        count *= 2
    return [length * k // count for k in range(count + 1)]


class WordCodes:
    """ids and decoded text of blank-separated words, kept per worker.

    White space is dropped by this kind of tokenizer, so ids never depend on what stands across a blank. ASCII
    texts are lower-cased first when the normaliser does that too, which lets more words share an entry.
    """

    def __init__(self, tokenizer, kept: int = KEPT_WORDS):
        self.tokenizer, self.kept, self.known = tokenizer, kept, {}
        self.lower = tokenizer.normalizer is not None and tokenizer.normalizer.normalize_str("A") == "a"
        self.specials = [s.lower() for s in special_strings(tokenizer)]

    def words(self, text: str) -> list[str]:
        if self.lower and text.isascii():
            low = text.lower()
            text = text if any(s in low for s in self.specials) else low
        return re.split("[ \n\t\r]+", text) if re.search("[\n\t\r]", text) else text.split(" ")

    def learn(self, batch: list[list[str]]) -> dict:
        """Codes of all words of the batch: (n, ids joined by blanks, decoded)."""
        known = self.known
        new = list({w for words in batch for w in words if w and w not in known})
        if not new:
            return known
        codes = {}
        for k in range(0, len(new), 20_000):
            part = new[k:k + 20_000]
            for word, e in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False)):
                ids = e.ids
                codes[word] = (len(ids), " ".join(map(str, ids)), self.tokenizer.decode(ids, skip_special_tokens=False))
        room = self.kept - len(known)
        if room >= len(codes):
            known.update(codes)
            return known
        for word in list(codes)[:max(0, room)]:
            known[word] = codes[word]
        return _Two(known, codes)


class _Two:
    """Lookup in the kept words, else in those of this batch."""

    def __init__(self, kept: dict, batch: dict):
        self.kept, self.batch = kept, batch

    def __getitem__(self, word):
        return self.kept.get(word) or self.batch[word]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def digest_short(path: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tokenizer = load(path)
    if tokenizer.decoder is not None:  # decoding joins words in some other way
        for b in batches:
            yield pd.DataFrame([(d, *_digest(tokenizer, tokenizer.encode(t, add_special_tokens=False).ids)) for d, t in zip(b.doc_id, b.text)],
                               columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        return
    codes = kept_in_worker(f"words:{path}", lambda: WordCodes(tokenizer))
    for b in batches:
        for k in range(0, len(b), SLICE):
            out = []
            split = [codes.words(t) for t in b.text[k:k + SLICE]]
            known = codes.learn(split)
            for doc_id, words in zip(b.doc_id[k:k + SLICE], split):
                got = [c for c in (known[w] for w in words if w) if c[0]]
                out.append((doc_id, sum(c[0] for c in got), _sha(" ".join([c[1] for c in got])), _sha(" ".join([c[2] for c in got]))))
            yield pd.DataFrame(out, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]).astype({"doc_id": "Int64"})


def _digest(tokenizer, ids: list[int]) -> tuple[int, str, str]:
    return len(ids), _sha(" ".join(map(str, ids))), _sha(tokenizer.decode(ids, skip_special_tokens=False))


def packed_numbers(x: np.ndarray) -> bytes:
    return zlib.compress(x.astype("<u4").tobytes(), 1)


def unpacked_numbers(x: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(x), dtype="<u4")


def encode_parts(path: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tokenizer = load(path)
    for b in batches:
        rows = []
        for r in b.itertuples(index=False):
            ids, starts, ends = encode_tokens(tokenizer, r.text)
            rows.append((packed_numbers(ids), packed_numbers(np.diff(starts, prepend=0)), packed_numbers(ends - starts)))
        yield b.assign(**{c: [x[k] for x in rows] for k, c in enumerate(("ids", "starts", "ends"))})


def join_parts(path: str, group: pd.DataFrame) -> Node:
    """The parts of one text, in any order and any number of equal copies, as one node."""
    tokenizer = load(path)
    group = group.sort_values("part").drop_duplicates("part")
    nodes, at, pieces = [], 0, group.text.tolist()
    for text, i, s, n in zip(pieces, group.ids, group.starts, group.ends):
        ids, steps, sizes = (unpacked_numbers(x) for x in (i, s, n))
        starts = steps.astype(np.int32).cumsum(dtype=np.int64) + at
        nodes.append(Node(at, at + len(text), ids, starts, starts + sizes))
        at += len(text)
    return concat_tree(nodes, "".join(pieces), tokenizer)


def parts_of(docs: DataFrame, part_chars: int) -> DataFrame:
    """The parts of long texts as rows. Equal (doc_id, text) rows share ``text_key``."""
    def cut(batches):
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                borders = cuts(len(r.text), part_chars)
                key = hashlib.md5(r.text.encode()).hexdigest()
                out += [(r.doc_id, key, k, r.text[x:y]) for k, (x, y) in enumerate(zip(borders, borders[1:]))]
            yield pd.DataFrame(out, columns=["doc_id", "text_key", "part", "text"]).astype({"doc_id": "Int64"})
    return docs.mapInPandas(cut, PART)


def encoded_digests(docs: DataFrame, path: str, part_chars: int = 32_768) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text, a row for each row of ``docs``."""
    texts = texts_of(docs)
    long = F.char_length("text") > part_chars
    short = texts.filter(~long).mapInPandas(lambda batches: digest_short(path, batches), DIGEST)

    def finish(key, group: pd.DataFrame) -> pd.DataFrame:
        copies = int((group.part == 0).sum())
        row = (key[0], *_digest(load(path), join_parts(path, group).ids.tolist()))
        return pd.DataFrame([row] * copies, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]).astype({"doc_id": "Int64"})

    tokens = "doc_id long, text_key string, part int, text string, ids binary, starts binary, ends binary"
    encoded = (
        parts_of(texts.filter(long), part_chars).repartition("doc_id", "text_key", "part")
        .mapInPandas(lambda batches: encode_parts(path, batches), tokens)
    )
    return short.unionByName(encoded.groupBy("doc_id", "text_key").applyInPandas(finish, DIGEST))
