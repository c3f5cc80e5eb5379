"""Conversation structure repair: the cheapest edits that give every conversation a sound order of roles.

A conversation is sound if the initials of its roles read ``(s?(ua)+)?``: an optional system turn, then user and assistant
turns by turns, or nothing at all. Each row is kept, given another role or deleted, and empty turns may be inserted anywhere;
every edit has a cost and a letter. Among the cheapest edits those with the least string of letters (the audit) are taken.

Cost and audit are one number. An audit of at most L letters has L octal digits, the first letter in the highest, zeros
behind its end; the cost stands above them. An edit that writes the letter at place p weighs ``cost * 8**L + code *
8**(L - 1 - p)``, so the weight of a path is the sum of its edits' weights, and the smallest integer is the cheapest path
with the least audit. The nodes of the graph are (row, state of the pattern, letters written); a pass from the end over
costs alone bounds what each node has still to pay, and edges that cannot reach the least cost are left out. The audit
tells the roles too: the n-th turn that is not deleted has one possible role.

Rows of a conversation are streamed in order, once to find the audit (a byte a row is held, never a text) and once more,
behind their audit, to apply it. One conversation is one task; its digest and its audit are single values in any case.

Rows with equal turns are ordered by role and text; a null turn comes first. A null role or text is one space, so such a
text is blank; an empty role has no initial and cannot be kept. Rows without a conv_id form one conversation. Repeated rows
stay (the later ones are duplicates). Extra columns are ignored. Empty table: no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog.llm.common import saved

#: Pattern states: nothing yet, after the system turn, after a user turn, after an assistant turn.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
SOUND = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
#: Letters in ASCII order; an octal digit is the place in this string.
LETTERS = " DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
NONE, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
FAR = 1 << 60


class Costs(NamedTuple):
    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def row_edits(state: int, initial: str, fault: int, costs: Costs) -> list[tuple[int, int, int]]:
    """(cost, code, next state) of all that can be done to a row; blank and duplicate rows can only be deleted."""
    edits = [(costs.delete, DELETE, state)]
    if fault not in (BLANK, DUPLICATE):
        more = costs.truncated if fault == TRUNCATED else 0
        if initial in NEXT[state]:
            edits.append((costs.keep + more, KEEP, NEXT[state][initial]))
        edits += [(costs.rerole + more, REROLE, NEXT[state][r]) for r in ROLES if r in NEXT[state]]
    return edits


def insertions(state: int, costs: Costs) -> list[tuple[int, int, int]]:
    return [(costs.insert, INSERT, NEXT[state][r]) for r in ROLES if r in NEXT[state]]


def still_to_pay(initials: str, faults: bytes, costs: Costs) -> list[list[int]]:
    """The least cost from each row (and the end) in each state."""
    states = range(len(NEXT))

    def with_insertions(pay: list[int]) -> list[int]:
        for _ in states:  # a chain of insertions passes each state once at most
            pay = [min([pay[q], *(c + pay[to] for c, _, to in insertions(q, costs))]) for q in states]
        return pay

    out = [with_insertions([0 if q in SOUND else FAR for q in states])]
    known: dict = {}
    for initial, fault in zip(reversed(initials), reversed(faults)):
        if (initial, fault) not in known:
            known[initial, fault] = [row_edits(q, initial, fault, costs) for q in states]
        after, edits = out[-1], known[initial, fault]
        out.append(with_insertions([min(c + after[to] for c, _, to in edits[q]) for q in states]))
    return out[::-1]


def cheapest(initials: str, faults: bytes, costs: Costs = Costs()) -> tuple[int, str]:
    """Cost and audit of a conversation whose rows have these initials (one character each) and faults."""
    pay = still_to_pay(initials, faults, costs)
    least, rows = pay[0][0], len(initials)
    length = rows + least // costs.insert  # digits: the longest audit that costs no more
    width = 3 * length
    at: dict[tuple[int, int], int] = {(0, 0): 0}  # (state, letters written) -> weight
    for row in range(rows + 1):
        after: dict[tuple[int, int], int] = {}
        todo = sorted(at, key=lambda node: node[1])
        for state, written in todo:  # grows by insertions, which write one letter more
            weight = at[state, written]
            paid = weight >> width
            digit = width - 3 * (written + 1)
            moves = [(at, row, e) for e in insertions(state, costs)]
            if row < rows:
                moves += [(after, row + 1, e) for e in row_edits(state, initials[row], faults[row], costs)]
            for nodes, there, (cost, code, to) in moves:
                if paid + cost + pay[there][to] == least:
                    total, node = weight + (cost << width) + (code << digit), (to, written + 1)
                    if node not in nodes:
                        nodes[node] = total
                        if nodes is at:
                            todo.append(node)
                    elif total < nodes[node]:
                        nodes[node] = total
        if row < rows:
            at = after
    best = min(weight for (state, _), weight in at.items() if state in SOUND)
    digits = format(best & ((1 << width) - 1), f"0{length}o") if length else ""
    return best >> width, "".join(LETTERS[int(x)] for x in digits.rstrip("0"))


def marked(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows with null texts and roles as one space; ``was`` orders rows of one turn."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text")).withColumn(
        "was", F.struct("role", "text", F.lit(0).alias("copy"))).withColumn("there", F.lit(True))


def damaged(conversations: DataFrame) -> DataFrame:
    """:func:`marked` rows with faults planted by the checksum of conv_id and turn; ``there`` is false for dropped rows.

    Remainder 0 of 20 drops a row, 1 empties its text, 2 takes its full stops, exclamation and question marks, 3 repeats it,
    4 makes it a user's.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = marked(conversations).withColumn("kind", kind)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        "was", (F.col("kind") != 0).alias("there"), F.explode(copies).alias("copy"),
    ).withColumn("was", F.struct("was.role", "was.text", "copy")).drop("copy")


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("was").asc()]


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` with each one's first fault; rows of a conversation share a task from here on."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = F.col("text").rlike(r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z")
    same = F.when(F.col("there"), F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    nth = F.row_number().over(Window.partitionBy("conv_id", "same").orderBy(*_order()))
    fault = F.when(blank, BLANK).when(F.col("nth") > 1, DUPLICATE).when(cut, TRUNCATED).otherwise(NONE)
    return rows.withColumn("same", same).repartition("conv_id").withColumn("nth", nth).select(
        "conv_id", "turn", "role", "text", "was", "there", fault.cast("int").alias("fault"))


DECISION = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def decisions(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Counts, least cost and audit of every conversation in ``rows`` (as :func:`with_faults` gives them)."""
    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None

        def result() -> dict:
            initials, faults, turns = held
            pairs = zip(initials, initials[1:])
            # a character for each row; an empty role has none and fits nowhere
            cost, audit = cheapest("".join(x or "-" for x in initials), bytes(faults), costs)
            return {
                "conv_id": now[0], "gaps": turns[1] - turns[0] + 1 - turns[2] if turns else 0,
                "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
                "illegal": sum(a + b not in ("su", "ua", "au") for a, b in pairs), "cost": cost, "audit": audit}

        for batch in batches:
            done = []
            for conv, there, turn, initial, fault in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append(result())
                    now, held = (conv,), [[], bytearray(), None]
                if there:
                    held[0].append(initial)
                    held[1].append(fault)
                    if turn is not None:
                        low, high, n = held[2] or (turn, None, 0)
                        held[2] = (low, turn, n + (turn != high))
            yield _batch(done, DECISION)
        yield _batch([result()] if now is not None else [], DECISION)

    ordered = rows.sortWithinPartitions("conv_id", *_order())
    return ordered.select("conv_id", "there", "turn", F.substring("role", 1, 1), "fault").mapInArrow(decide, DECISION)


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
    fields = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])
    return pa.RecordBatch.from_pylist(rows, schema=fields)


def _behind_audit(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, all in one task."""
    heads = decided.select("conv_id", F.lit(0).alias("kind"), "audit", F.lit(None).cast("string").alias("role"), F.lit("").alias("text"),
                           F.lit(None).cast("long").alias("turn"), F.struct(F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).alias("copy")).alias("was"))
    body = rows.filter("there").select("conv_id", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "role", "text", "turn", "was")
    both = heads.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_order())
    return both.select("conv_id", "kind", "audit", "role", "text")


class _Repair:
    """Applies one audit to the rows that follow it."""

    def __init__(self, audit: str):
        self.audit, self.at, self.written, self.shift = audit, 0, 0, 0

    def _role(self) -> str:
        return "assistant" if (self.written - self.shift) % 2 else "user"

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield "I", self._role(), ""
            self.at, self.written = self.at + 1, self.written + 1

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """Edit, role and text of what stands for a row: insertions before it, then itself unless it is deleted."""
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "D":
            return
        if letter == "K" and not self.written and role[:1] == "s":
            self.shift = 1
        yield letter, role if letter == "K" else self._role(), text
        self.written += 1


REPAIRED = "conv_id long, place long, edit string, role string, text string"


def repaired(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """conv_id, place (from 0), edit (K, R or I), role and text of all rows that the audits leave or add."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, conv, place = None, None, 0

        def numbered(edits: Iterator[tuple[str, str, str]]) -> Iterator[dict]:
            nonlocal place
            for edit, role, text in edits:
                yield {"conv_id": conv, "place": place, "edit": edit, "role": role, "text": text}
                place += 1

        for batch in batches:
            out = []
            for c, kind, audit, role, text in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if kind == 0:
                    if repair is not None:
                        out += numbered(repair.inserted())
                    repair, conv, place = _Repair(audit), c, 0
                else:
                    out += numbered(repair.row(role, text))
            yield _batch(out, REPAIRED)
        yield _batch(list(numbered(repair.inserted())) if repair is not None else [], REPAIRED)

    return _behind_audit(rows, decided).mapInArrow(apply, REPAIRED)


def repaired_digests(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """conv_id and digest of the repaired rows, ``role:text`` joined by line ends, of every conversation."""
    schema = "conv_id long, repaired_sha256 string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair, conv, total, first = None, None, None, True

        def take(edits: Iterator[tuple[str, str, str]]) -> None:
            nonlocal first
            for _, role, text in edits:
                total.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False

        def finished() -> list[dict]:
            if repair is None:
                return []
            take(repair.inserted())
            return [{"conv_id": conv, "repaired_sha256": total.hexdigest()}]

        for batch in batches:
            out = []
            for c, kind, audit, role, text in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if kind == 0:
                    out += finished()
                    repair, conv, total, first = _Repair(audit), c, hashlib.sha256(), True
                else:
                    take(repair.row(role, text))
            yield _batch(out, schema)
        yield _batch(finished(), schema)

    return _behind_audit(rows, decided).mapInArrow(digest, schema)


def structure_report(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Faults, cost, audit and digest of the repaired rows of every conversation of ``rows`` (:func:`marked` or :func:`damaged`)."""
    judged = saved(with_faults(rows), "faults")
    decided = saved(decisions(judged.repartition("conv_id"), costs), "decisions")
    digests = repaired_digests(judged, decided).withColumnRenamed("conv_id", "id")
    return decided.join(digests, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")
