"""The prefix trie and the structure repair against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loomlog.llm import structure, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rows_of(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def messy(seed: int, convs: int, turns: int) -> list[tuple]:
    """Conversations with nulls, gaps, ties, repeated rows, odd roles and empty texts."""
    draw = random.Random(seed)
    texts = ["Hello there.", "why not", "  ", "", None, "One two three!", "a b", "é ö?"]
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", ""]
    out = []
    for c in draw.sample(range(-30, 4 * convs), convs):
        for t in range(draw.randrange(0, turns)):
            out.append((c, draw.choice([t, t, t, t + 3, 0, None]), draw.choice(roles), draw.choice(texts)))
            if draw.random() < 0.1:
                out.append(out[-1])
    return out + [(None, 0, "user", "lost"), (None, 1, "assistant", "lost.")]


# The trie.

def rebuilt(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + seq[h:]
    return out


def brute_trie(seqs: dict) -> set:
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    out = set()
    for node, convs in members.items():
        below = [x for x in members if x[:len(node)] == node]
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x)
        leaves = sum(not any(len(y) == len(x) + 1 and y[:-1] == x for y in below) for x in below)
        out.add((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                 sum(len(x) == len(node) + 1 for x in below), leaves, saved,
                 hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()))
    return out


def found_trie(df) -> list:
    return [tuple(r) for r in df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]


@pytest.mark.parametrize("cells, turns, block", [(1 << 20, 400_000, 256), (7, 400_000, 256), (40, 15, 4), (1, 4, 1)])
def test_trie_does_not_depend_on_shards_and_matrices(spark, monkeypatch, cells, turns, block):
    monkeypatch.setattr(trie, "CELLS", cells)
    monkeypatch.setattr(trie, "SHARD_TURNS", turns)
    monkeypatch.setattr(trie, "ID_BLOCK", block)
    rows = messy(3, 45, 6)
    rows += [(c, t, "user" if t % 2 else "assistant", "same words here") for c in range(1000, 1030) for t in range(5)]
    rows += [(2000 + k, t, "user", f"deep {t}" if t < 20 + k else "end") for k in range(3) for t in range(30)]
    got = found_trie(trie.conversation_trie(rows_of(spark, rows)))
    want = brute_trie(rebuilt(rows))
    assert len(got) == len(want) and set(got) == want


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert found_trie(trie.conversation_trie(rows_of(spark, []))) == []
    assert found_trie(trie.conversation_trie(rows_of(spark, [(None, 1, "user", "x")]))) == []
    # conversation 1 keeps nothing where h is over its turns and its base is absent
    short = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    got = found_trie(trie.conversation_trie(rows_of(spark, [(short, 0, "user", "x")])))
    assert got == [(short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]


def test_trie_ignores_clashing_columns(spark):
    rows = messy(5, 12, 4)
    plain = rows_of(spark, rows)
    wide = plain.withColumn("seq", F.lit("x")).withColumn("words", F.lit(1)).withColumn("depth", F.lit(2)).withColumn("base", F.lit(0)).withColumn("n", F.lit(0))
    assert sorted(found_trie(trie.conversation_trie(wide)), key=str) == sorted(found_trie(trie.conversation_trie(plain)), key=str)


# Structure repair.

def all_paths(initials, faults, costs):
    """Cost and audit of the best path, by trying all with as many letters as could pay."""
    best = None

    def go(row, state, cost, audit, limit):
        nonlocal best
        if cost > limit:
            return
        if row == len(initials) and state in structure.SOUND and (best is None or (cost, audit) < best):
            best = (cost, audit)
        for c, _, to in structure.insertions(state, costs):
            go(row, to, cost + c, audit + "I", limit)
        if row < len(initials):
            for c, code, to in structure.row_edits(state, initials[row], faults[row], costs):
                go(row + 1, to, cost + c, audit + structure.LETTERS[code], limit)
    go(0, 0, 0, "", costs.delete * len(initials))
    return best


@pytest.mark.parametrize("costs", [structure.Costs(), structure.Costs(insert=1, delete=3), structure.Costs(rerole=2, delete=2, insert=1, truncated=0)])
def test_least_integer_is_the_cheapest_path_with_the_least_audit(costs):
    draw = random.Random(7)
    for _ in range(250):
        n = draw.randrange(0, 5)
        initials = "".join(draw.choice("suaxuua-") for _ in range(n))
        faults = bytes(draw.choice([0, 0, 0, 1, 2, 3]) for _ in range(n))
        assert structure.cheapest(initials, faults, costs) == all_paths(initials, faults, costs)


def brute_repair(rows):
    """Every row of the report, straight from the rules."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{c if c is not None else ' '}:{t if t is not None else ' '}"
        kind = zlib.crc32(key.encode()) % 20
        new = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        convs[c] += [((t is not None, t or 0, role, text, k), t, "user" if kind == 4 else role, new)
                     for k in range(0 if kind == 0 else 2 if kind == 3 else 1)]
    out = set()
    for c, there in convs.items():
        there.sort(key=lambda x: x[0])
        seen, faults = set(), []
        for _, _, role, text in there:
            last = text.strip(" \t\n\x0b\x0c\r")
            faults.append(1 if not last else 2 if (role, text) in seen else 3 if last[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = [x[2][:1] for x in there]
        turns = {x[1] for x in there} - {None}
        cost, audit = all_paths([x or "-" for x in initials], faults, structure.Costs())
        left, at, first = [], 0, 0
        for letter in audit:
            _, _, role, text = there[at] if letter != "I" else (None, None, None, "")
            at += letter != "I"
            if letter == "K":
                first += not left and role[0] == "s"
                left.append(f"{role}:{text}")
            elif letter != "D":
                left.append(("assistant:" if (len(left) - first) % 2 else "user:") + text)
        out.add((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
                 sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                 hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return out


def report(df) -> list:
    return [tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()]


def test_repair_of_messy_conversations(spark):
    rows = messy(11, 60, 7)
    wide = rows_of(spark, rows).withColumn("kind", F.lit("x")).withColumn("was", F.lit(1)).withColumn("there", F.lit(False)).withColumn("nth", F.lit(9))
    got = report(structure.structure_report(structure.damaged(wide)))
    want = brute_repair(rows)
    assert len(got) == len(want) and set(got) == want


def test_repair_of_nothing_and_of_dropped_conversations(spark):
    assert report(structure.structure_report(structure.damaged(rows_of(spark, [])))) == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = report(structure.structure_report(structure.damaged(rows_of(spark, [(gone, 0, "user", "x")]))))
    assert got == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_rows_alternate(spark):
    rows = structure.with_faults(structure.damaged(rows_of(spark, messy(13, 40, 9))))
    decided = structure.decisions(rows.repartition("conv_id"), structure.Costs(insert=1))
    by = defaultdict(list)
    for r in structure.repaired(rows, decided).collect():
        by[r.conv_id].append((r.place, r.edit, r.role))
    assert by and any(e == "I" for v in by.values() for _, e, _ in v)
    for turns in by.values():
        turns.sort()
        assert [p for p, _, _ in turns] == list(range(len(turns)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for _, _, r in turns))
