"""Conversations from reply trees.

Messages form trees: each names its parent, roots name none. Iterative self-joins extend the paths from all messages to
their ancestors, doubling the reach each time (a message that knows its 2^k-th ancestor learns the 2^(k+1)-th from it), so
a chain of n messages takes log2(n) joins. A branch is a path from the root to a leaf; branches of a tree are ranked by
score, and each chosen branch is written as one conversation: every turn between control strings, with control strings
inside texts escaped so that they can be told from real ones and restored.

Rows of a conversation are streamed in order of depth, never gathered; only the finished conversation is one value.

Nulls: a null text or role is empty; rows without a conversation id form one conversation of their own. Messages are
told apart by their place: repeated rows and rows with the same turn stay, one after the other, in the order of role and
text. Extra columns are ignored. Empty table: no conversations but those that are added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomlog.llm.common import saved

#: Control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
#: Written after "<" of a control string, or of one that has been escaped already, inside a text.
ESCAPE = "\\"
_TO_ESCAPE = re.compile(r"<(\\*)\|im_(start|end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|im_(start|end)\|>")
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)
#: Role whose texts are learned.
LEARNED = "assistant"


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(lambda m: f"<{ESCAPE}{m[1]}|im_{m[2]}|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"<{m[1]}|im_{m[2]}|>", text)


def escape_role(role: str) -> str:
    """As :func:`escape`; line ends, which close a role, and backslashes become codes."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role, text and the place of the (escaped) text of each turn of a formatted conversation."""
    return [(unescape_role(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in _TURN.finditer(formatted)]


def linear_tree(conversations: DataFrame) -> DataFrame:
    """tree, node, parent, role, text, score: rows of a conversation, each the reply to the one before it."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.select(
        F.col("conv_id").alias("tree"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    node = F.row_number().over(order).cast("long")
    return rows.withColumn("node", node).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def branches(messages: DataFrame, best: int | None = None) -> DataFrame:
    """tree, branch (its rank), depth and node of the messages on each chosen branch.

    ``messages`` has tree, node, parent and score. A branch's score is the sum over its messages; ties go to the smaller
    leaf. ``best`` keeps so many branches of a tree, None all. A message whose parent is missing is a root; messages on a
    cycle belong to no branch.
    """
    known = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    parents = known.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    linked = known.join(parents, known.tree.eqNullSafe(F.col("t")) & (known.parent == F.col("p")), "left").select(
        "tree", "node", F.col("p").alias("parent"), "score")
    # reach: each message with all ancestors found so far; up: its farthest ancestor's parent, if any
    step = saved(linked.select("tree", "node", F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth"), F.col("score").alias("total")), "chat-up")
    links = saved(linked.select("tree", "node", "parent"), "chat-links")
    # a chain has at most as many messages as there are; what is still open after the last join leads into a cycle
    for _ in range(links.count().bit_length()):
        above = step.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("up2"), F.col("depth").alias("d2"), F.col("total").alias("s2"))
        going = step.filter("up is not null")  # messages that have found their root are done
        longer = going.join(above, going.tree.eqNullSafe(F.col("t")) & (going.up == F.col("n")), "left").select(
            "tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("d2", F.lit(0).cast("long"))).alias("depth"),
            (F.col("total") + F.coalesce("s2", F.lit(0.0))).alias("total"))
        step = saved(step.filter("up is null").unionByName(longer), "chat-up")
        if not step.filter("up is not null").limit(1).count():
            break
    rooted = step.filter("up is null")
    with_child = links.select(F.col("tree").alias("t"), F.col("parent").alias("p")).filter("p is not null").distinct()
    leaves = rooted.join(with_child, rooted.tree.eqNullSafe(F.col("t")) & (rooted.node == F.col("p")), "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
    chosen = leaves.withColumn("branch", F.row_number().over(order))
    if best is not None:
        chosen = chosen.filter(F.col("branch") <= best)
    return _on_paths(chosen, rooted, links)


def _on_paths(chosen: DataFrame, rooted: DataFrame, links: DataFrame) -> DataFrame:
    """The messages of each chosen leaf's path. Paths without a fork are taken from depths alone, others walked by doubling."""
    forks = links.groupBy("tree", "parent").count().filter("parent is not null and count > 1").select(F.col("tree").alias("t")).distinct()
    roots = links.filter("parent is null").groupBy("tree").count().filter("count > 1").select(F.col("tree").alias("t"))
    forked = saved(forks.union(roots).distinct(), "chat-forked")
    chosen = saved(chosen, "chat-chosen")
    on_forked = F.col("tree").eqNullSafe(F.col("t"))
    single = rooted.join(forked, on_forked, "left_anti").select("tree", F.lit(1).alias("branch"), "depth", "node")
    # Doubling: after k joins a path holds the messages within 2^k of its leaf; ``edge`` is the parent of the farthest.
    jump = links.join(forked, on_forked, "left_semi").select("tree", "node", "parent")
    jump = saved(jump, "chat-jump")
    path = chosen.join(forked, on_forked, "left_semi").select("tree", "branch", "node")
    for _ in range(links.count().bit_length()):
        up = jump.filter("parent is not null").select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("parent").alias("up"))
        if not up.limit(1).count():
            break
        more = path.join(up, path.tree.eqNullSafe(F.col("t")) & (path.node == F.col("n"))).select("tree", "branch", F.col("up").alias("node"))
        path = saved(path.union(more), "chat-path")
        jump = jump.filter("parent is not null")
        jump = saved(jump.join(up, jump.tree.eqNullSafe(F.col("t")) & (jump.parent == F.col("n")), "left").select(
            "tree", "node", F.col("up").alias("parent")), "chat-jump")
    depths = rooted.select(F.col("tree").alias("t"), F.col("node").alias("n"), "depth")
    walked = path.join(depths, path.tree.eqNullSafe(F.col("t")) & (path.node == F.col("n"))).select("tree", "branch", "depth", "node")
    return single.unionByName(walked)


def formatted(messages: DataFrame, best: int | None = None) -> DataFrame:
    """tree, branch and, for each chosen branch, the conversation as one string."""
    chosen = branches(messages, best)
    texts = messages.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    rows = chosen.join(texts, chosen.tree.eqNullSafe(F.col("t")) & (chosen.node == F.col("n"))).select("tree", "branch", "depth", "role", "text")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, turns = None, []
        for b in batches:
            done = []
            for tree, branch, role, text in zip(b.tree.astype("Int64"), b.branch, b.role, b.text):
                key = (None if tree is pd.NA else tree, branch)
                if key != now:
                    if now is not None:
                        done.append((*now, "".join(turns)))
                    now, turns = key, []
                turns.append(format_turn(role, text))
            yield _frame(done)
        yield _frame([(*now, "".join(turns))] if now is not None else [])

    return rows.repartition("tree", "branch").sortWithinPartitions("tree", "branch", "depth").mapInPandas(
        write, "tree long, branch int, conversation string")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["tree", "branch", "conversation"]).astype({"tree": "Int64", "branch": "int32"})


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(conversations: DataFrame) -> DataFrame:
    """Counts and digests of each formatted conversation, from its text alone."""
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for tree, text in zip(b.tree.astype("Int64"), b.conversation):
                turns, loss = parse(text), hashlib.sha256()
                every, chars = hashlib.sha256(), 0
                for role, said, start, end in turns:
                    every.update(f"{role}\n{said}\n".encode())
                    if role == LEARNED:
                        learned = unescape(text[start:end])
                        loss.update(learned.encode())
                        chars += len(learned)
                out.append((tree, len(turns), every.hexdigest(), chars, loss.hexdigest(), len(text)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in DIGEST.split(", ")]).astype({"conv_id": "Int64"})
    return conversations.mapInPandas(digest, DIGEST)


def with_probe(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of ``conversations`` and of conversation -1, whose two texts are made of control strings."""
    said = f"{END}{START}assistant ok"
    probe = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe)
