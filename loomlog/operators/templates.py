"""Message templates: what stays the same between similar messages.

Only distinct messages are compared, and only inside groups that share a token count and the first token. A group is streamed
in text order and merged greedily; the task holds its clusters, never its messages. A group of more than ``GROUP_TEXTS``
messages is dealt into parts by the hash of the text, as many as its size asks for. The parts are merged side by side, and
their templates, which are far fewer, are merged again by the same rule as if they were messages; each template of a part
then becomes the one it has gone into. So a group has no size limit, runs in as many tasks as it needs, and its templates
depend on its messages alone, not on row order, partitioning or what else is in the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.checkpoints import written
from loomlog.operators.lookups import lookup
from loomlog.options import TemplateOptions

WILD = "<*>"
# A token of digits and punctuation only, or a long hex number.
_VALUE_TOKEN = (
    r"(?<!\S)(?:[^A-Za-z0-9\s]*[0-9][^A-Za-z\s]*|0[xX][0-9a-fA-F]+"
    r"|(?=[0-9a-fA-F]*[0-9])[0-9a-fA-F]{6,})(?!\S)"
)


def clean_text(message: Column, opts: TemplateOptions = TemplateOptions()) -> Column:
    """Single blanks between tokens; extra delimiters count as blanks."""
    if opts.extra_delimiters:
        message = F.translate(message, "".join(opts.extra_delimiters), " " * len(opts.extra_delimiters))
    return F.trim(F.regexp_replace(message, r"\s+", " "))


def tokens_of(message: Column, opts: TemplateOptions = TemplateOptions()) -> Column:
    """Tokens of a message; none for a blank one."""
    return F.array_remove(F.split(clean_text(message, opts), " "), "")


def masked(message: Column, opts: TemplateOptions = TemplateOptions()) -> Column:
    """Message with plain values (numbers, addresses, hex) replaced by the wildcard, in two regex passes."""
    return F.regexp_replace(clean_text(message, opts), _VALUE_TOKEN, WILD)


class _Clusters:
    """The greedy merge of one group's messages, fed in text order: only clusters are held, not messages."""

    def __init__(self, width: int, similarity: float):
        self.ids: dict[str, int] = {WILD: 0}
        self.rows, self.used, self.similarity = np.empty((8, width), dtype=np.int64), 0, similarity

    def add(self, text: str) -> int:
        ids = self.ids
        row = np.array([ids.setdefault(t, len(ids)) for t in text.split(" ")], dtype=np.int64)
        if self.used:
            live = self.rows[:self.used]
            same = ((live == row) & (live != 0)).sum(axis=1) / len(row)
            best = int(same.argmax())
            if same[best] >= self.similarity:
                live[best] = np.where(live[best] == row, row, 0)
                return best
        if self.used == len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[self.used] = row
        self.used += 1
        return self.used - 1

    def templates(self) -> list[str]:
        words = list(self.ids)
        return [" ".join(words[w] for w in row) for row in self.rows[:self.used]]


def _merge(similarity: float):
    """Streams parts of groups in text order; gives each message its cluster, and after a part its clusters' templates."""
    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, clusters = None, None

        def closed() -> list[tuple]:
            return [] if clusters is None else [(*group, n, None, t) for n, t in enumerate(clusters.templates())]

        for b in batches:
            out = []
            for key, part, text in zip(b.key, b.part, b.masked):
                if (key, part) != group:
                    out += closed()
                    group, clusters = (key, part), _Clusters(text.count(" ") + 1, similarity)
                out.append((key, part, clusters.add(text), text, None))
            yield _merged(out)
        yield _merged(closed())
    return merge


def _merged(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["key", "part", "cluster", "masked", "template"]).astype({"part": "int32", "cluster": "int32"})


#: Texts of a part, and the share of them that a round of merging must at least take away for another round in parts.
GROUP_TEXTS, SHRINK = 5_000, 0.1


def _one_pass(parted: DataFrame, similarity: float) -> DataFrame:
    """key, masked, template: the texts of each (key, part) merged by themselves."""
    # Messages and templates come from one pass; it is written, since both of its parts are read.
    merged = written(
        parted.repartition("key", "part").sortWithinPartitions("key", "part", "masked")
        .mapInPandas(_merge(similarity), "key string, part int, cluster int, masked string, template string"), "templates")
    names = merged.filter(F.col("template").isNotNull()).select("key", "part", "cluster", "template")
    texts = merged.filter(F.col("masked").isNotNull()).select("key", "part", "cluster", "masked")
    return lookup(texts, names, ["key", "part", "cluster"], "inner").select("key", "masked", "template")


def merged_texts(keyed: DataFrame, similarity: float) -> DataFrame:
    """key, masked, template for distinct texts (key, masked); texts of one key may become one template."""
    parts = F.ceil(F.col("texts") / GROUP_TEXTS).cast("int")
    large = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).filter(F.col("texts") > GROUP_TEXTS).select("key", "texts"), "large")
    if not large.limit(1).count():
        return _one_pass(keyed.withColumn("part", F.lit(0)), similarity)
    part = F.pmod(F.xxhash64("masked"), F.coalesce(parts, F.lit(1))).cast("int")
    first = written(_one_pass(lookup(keyed, large, ["key"], "left").select("key", "masked", part.alias("part")), similarity), "merged")
    again = written(lookup(first, large.select("key"), ["key"], "left_semi").select("key", F.col("template").alias("masked")).distinct(), "again")
    if again.count() > (1 - SHRINK) * (large.agg(F.sum("texts")).first()[0] or 0):
        second = _one_pass(again.withColumn("part", F.lit(0)), similarity)  # texts that hardly merge: whole keys, once
    else:
        second = merged_texts(again, similarity)
    final = second.select("key", F.col("masked").alias("template"), F.col("template").alias("final"))
    return lookup(first, final, ["key", "template"], "left").select("key", "masked", F.coalesce("final", "template").alias("template"))


def template_table(df: DataFrame, message: str, opts: TemplateOptions = TemplateOptions()) -> DataFrame:
    """masked, template_id, template for every distinct masked message."""
    distinct = df.select(masked(F.col(message), opts).alias("masked")).filter(F.length("masked") > 0).distinct()
    parts = F.split("masked", " ")
    keyed = written(distinct.select("masked", F.concat_ws(" ", F.size(parts).cast("string"), F.get(parts, F.lit(0))).alias("key")), "messages")
    return merged_texts(keyed, opts.similarity).select("masked", F.xxhash64("template").alias("template_id"), "template")


def mine_templates(df: DataFrame, message: str, opts: TemplateOptions = TemplateOptions()) -> DataFrame:
    """The input rows with template_id, template and params (the values under the wildcards)."""
    rows = df.withColumn("masked", masked(F.col(message), opts))
    joined = lookup(rows, template_table(df, message, opts), ["masked"], "left")
    return joined.withColumn("params", params_of(tokens_of(F.col(message), opts), F.col("template"))).drop("masked")


def params_of(tokens: Column, template: Column) -> Column:
    pairs = F.arrays_zip(tokens.alias("t"), F.split(template, " ").alias("p"))
    return F.transform(F.filter(pairs, lambda x: x["p"] == WILD), lambda x: x["t"])


def fits(tokens: Column, template: Column) -> Column:
    """Does every token equal the template's or stand under a wildcard?"""
    parts = F.split(template, " ")
    same = F.zip_with(tokens, parts, lambda t, p: (p == WILD) | (t == p))
    return (F.size(tokens) == F.size(parts)) & F.forall(same, lambda s: F.coalesce(s, F.lit(False)))


def unique_templates(df: DataFrame, column: str = "EventTemplate") -> DataFrame:
    """Distinct templates of a structured table that already names them."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct()
