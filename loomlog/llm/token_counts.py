"""Token counts per document from pre-token frequencies.

A document's token count is the sum, over its distinct pre-tokens, of how often each occurs times how many pieces it has.
Pieces are counted once for each distinct pre-token of the corpus; no ids of documents are kept. The frequent pre-tokens
(at most ``frequent``, a bounded table) are sent to all tasks, which sum them where the document is read; a document's
frequencies of all other pre-tokens are joined to the table of pieces and summed.

Documents that contain a special token's string are encoded whole, since the string may fall inside a pre-token.

Nulls: a null text is empty (no bytes, no tokens); a null doc_id is kept. Repeated rows give repeated results. Extra
columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlog.llm.bpe import load, special_strings
from loomlog.llm.byte_units import PRETOKEN, ranked, units_of
from loomlog.llm.common import kept_in_worker, saved, texts_of

#: Pre-tokens whose piece counts are broadcast (some 15 bytes each).
FREQUENT = 400_000
#: Units whose pre-tokens a worker keeps.
KEPT_UNITS = 400_000


class PreTokens:
    """Pre-token frequencies of texts; a unit between blanks is cut by the pattern once per worker."""

    def __init__(self):
        import regex
        self.find, self.known = regex.compile(PRETOKEN).findall, {}

    def counts(self, text: str) -> Counter:
        first, *units = units_of(text)
        found = Counter(self.find(first))
        known, find = self.known, self.find
        for unit, n in Counter(units).items():
            parts = known.get(unit)
            if parts is None:
                parts = tuple(find(" " + unit))
                if len(known) < KEPT_UNITS and len(unit) < 64:
                    known[unit] = parts
            for p in parts:
                found[p] += n
        return found


def pre_tokens() -> PreTokens:
    return kept_in_worker("pre-tokens", PreTokens)


def vocabulary(texts: DataFrame, path: str) -> DataFrame:
    """Each distinct pre-token, how often it occurs, and its number of pieces."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut, specials, total = pre_tokens(), special_strings(load(path)), Counter()
        for b in batches:
            for text in b.text:
                if not any(s in text for s in specials):
                    total.update(cut.counts(text))
            if len(total) > 500_000:
                yield pd.DataFrame({"pre_token": total.keys(), "n": total.values()})
                total = Counter()
        yield pd.DataFrame({"pre_token": total.keys(), "n": total.values()}).astype({"pre_token": str, "n": "int64"})

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranks, tokenizer = ranked(path), load(path)
        for b in batches:
            words = b.pre_token.tolist()
            if ranks is not None:
                sizes = [len(ranks.encode_ordinary(w)) for w in words]
            else:
                sizes = [len(e.ids) for e in tokenizer.encode_batch(words, add_special_tokens=False)]
            yield b.assign(pieces=sizes)

    found = texts.select("text").mapInPandas(count, "pre_token string, n long").groupBy("pre_token").agg(F.sum("n").alias("n"))
    return found.mapInPandas(pieces, "pre_token string, n long, pieces int")


def least_frequency(known: DataFrame, most: int) -> float:
    """A frequency that at most ``most`` pre-tokens reach, from a histogram of at most 64 x 8 steps."""
    steps = known.groupBy(F.floor(F.log2("n") * 8).alias("step")).count().orderBy(F.desc("step")).collect()
    least, total = float("inf"), 0
    for step, count in steps:
        total += count
        if total > most:
            break
        least = 2.0 ** (step / 8) * (1 - 1e-9)
    return least


def token_counts(docs: DataFrame, path: str, limit: int = 1024, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row of ``docs``."""
    texts = texts_of(docs)
    spark = docs.sparkSession
    known = saved(vocabulary(texts, path), "pre-tokens")
    top = known.filter(F.col("n") >= least_frequency(known, frequent)).select("pre_token", "pieces").toPandas()
    table = spark.sparkContext.broadcast(dict(zip(top.pre_token, top.pieces.tolist())))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        cut, tokenizer, sizes = pre_tokens(), load(path), table.value
        specials = special_strings(tokenizer)
        for b in batches:
            out = []
            for doc_id, text in zip(b.doc_id, b.text):
                raw = text.encode()
                key, size = xxhash.xxh3_64_intdigest(raw) - 2**63, len(raw)
                here, rest = 0, []
                if any(s in text for s in specials):
                    here = len(tokenizer.encode(text, add_special_tokens=False).ids)
                else:
                    for p, n in cut.counts(text).items():
                        got = sizes.get(p)
                        if got is None:
                            rest.append((p, n))
                        else:
                            here += got * n
                # the first row of a document carries its sum; a key of its own where nothing is to be joined
                p, n = rest[0] if rest else (f"\0{key}", 0)
                out.append((doc_id, key, size, 1, here, p, n))
                out += [(doc_id, key, size, 0, 0, p, n) for p, n in rest[1:]]
            yield pd.DataFrame(out, columns=["doc_id", "text_key", "n_bytes", "firsts", "here", "pre_token", "n"]).astype({"doc_id": "Int64"})

    rows = texts.mapInPandas(split, "doc_id long, text_key long, n_bytes long, firsts int, here long, pre_token string, n long")
    summed = (
        rows.join(known.select("pre_token", "pieces"), "pre_token", "left")
        .groupBy("doc_id", "text_key", "n_bytes")
        .agg(F.sum("firsts").alias("copies"), F.sum(F.col("here") + F.col("n") * F.coalesce("pieces", F.lit(0))).alias("total"))
    )
    tokens = F.expr("total div copies")  # equal rows have added up
    return summed.select(
        "doc_id", "n_bytes", tokens.alias("n_tokens"), (tokens > limit).alias("over_limit"),
        F.explode(F.expr("array_repeat(0, int(copies))")).alias("copy")).drop("copy")
