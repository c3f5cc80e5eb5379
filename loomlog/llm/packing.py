"""Best-fit packing by a configuration linear program.

Only the histogram of piece lengths (at most ``capacity`` counts) reaches the driver. A configuration is a multiset of
lengths that fit one sequence. The covering program "fewest configurations that hold all pieces" is solved by
multiplicative weights: lengths that are covered least get the highest prices, a knapsack dynamic program finds the most
valuable configuration, and it is used as often as its scarcest length allows. The fractional use is scaled so that no
length is over-covered and rounded down; the pieces left go through the program again, and what then remains is placed
best fit first, longest pieces first, equal sequences together. Pieces find their place by their number among pieces of
the same length, so no group of rows is ever gathered.

Nulls: a null text is empty, a document of the end token alone; a null doc_id is kept. Repeated rows are packed each on
its own. Extra columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomlog.llm.byte_units import unit_ids
from loomlog.llm.common import saved, texts_of

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"

Configuration = tuple[tuple[int, int], ...]


def best_configuration(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> Counter:
    """The multiset of ``lengths`` (ascending) within ``capacity`` with the highest sum of prices."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if upto[c]:
            gain = best[c - lengths[:upto[c]]] + prices[:upto[c]]
            k = int(gain.argmax())
            if gain[k] > best[c]:
                best[c], choice[c] = gain[k], k
    found, c = Counter(), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            found[int(choice[c])] += 1
            c -= int(lengths[choice[c]])
    return found


def fractional_use(counts: np.ndarray, lengths: np.ndarray, capacity: int, steps: int, rate: float = 0.5) -> dict[Configuration, float]:
    """Multiplicative weights for the covering program: uses of configurations, scaled to over-cover no length."""
    covered = np.zeros(len(lengths))
    use: Counter = Counter()
    for _ in range(steps):
        weights = np.exp(-rate * (covered - covered.min()))
        found = best_configuration(weights / counts, lengths, capacity)
        step = min(counts[k] / n for k, n in found.items())
        for k, n in found.items():
            covered[k] += step * n / counts[k]
        use[tuple(sorted((int(lengths[k]), n) for k, n in found.items()))] += step
    return {c: x / covered.max() for c, x in use.items()}


def best_fit(left: Counter, capacity: int) -> Counter:
    """Places pieces, longest first, each where the least room stays; equal sequences are filled together."""
    rooms: dict[int, Counter] = {}

    def put(room: int, config: Counter, length: int, times: int, count: int) -> None:
        config = Counter(config)
        config[length] += times
        rooms.setdefault(room - times * length, Counter())[tuple(sorted(config.items()))] += count

    for length in sorted(left, reverse=True):
        n = left[length]
        for room in range(length, capacity):
            each = room // length
            while n and rooms.get(room):
                config, count = rooms[room].popitem()
                full = min(count, n // each)
                n -= full * each
                if full:
                    put(room, dict(config), length, each, full)
                if full < count and n:  # fewer than ``each`` are left for one more sequence
                    put(room, dict(config), length, n, 1)
                    full, n = full + 1, 0
                if full < count:
                    rooms[room][config] += count - full
            if not n:
                break
        each = capacity // length
        if n >= each:
            put(capacity, {}, length, each, n // each)
        if n % each:
            put(capacity, {}, length, n % each, 1)
    return sum(rooms.values(), Counter())


def pack_lengths(histogram: dict[int, int], capacity: int, steps: int = 400, rounds: int = 3) -> Counter:
    """Configurations and how often each is used; together they hold exactly the pieces of ``histogram``."""
    left = Counter({length: n for length, n in histogram.items() if n > 0})
    plan: Counter = Counter()
    if left.get(capacity):
        plan[((capacity, 1),)] += left.pop(capacity)
    for _ in range(rounds):
        if not left:
            break
        lengths = np.array(sorted(left))
        counts = np.array([left[int(x)] for x in lengths], dtype=float)
        use = fractional_use(counts, lengths, capacity, steps)
        for config, x in sorted(use.items(), key=lambda cx: (-cx[1], cx[0])):
            times = min([int(x), *(left[length] // n for length, n in config)])
            if times > 0:
                plan[config] += times
                for length, n in config:
                    left[length] -= times * n
        left = +left
    return plan + best_fit(left, capacity)


def slot_table(plan: Counter) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length its runs of places: first place, first sequence, places a sequence, offset of the first."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    filled: Counter = Counter()
    sequence = 0
    for config, times in sorted(plan.items()):
        offset = 0
        for length, n in config:
            runs.setdefault(length, []).append((filled[length], sequence, n, offset))
            filled[length] += n * times
            offset += n * length
        sequence += times
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*r)) for length, r in runs.items()}


def cut_pieces(path: str, batches: Iterator[pd.DataFrame], capacity: int, end_id: int) -> Iterator[pd.DataFrame]:
    """Encodes texts and cuts them; the pieces of a task are numbered within their length."""
    encoder, task, seen = unit_ids(path), TaskContext.get().partitionId(), Counter()
    end = np.array([end_id], dtype="<u4").tobytes()
    for b in batches:
        out = []
        for doc_id, text in zip(b.doc_id, b.text):
            ids = encoder.encode(text) + end
            total = len(ids) // 4
            first = total % capacity or capacity
            borders = [0, *range(first, total + 1, capacity)]
            for k, (x, y) in enumerate(zip(borders, borders[1:])):
                out.append((doc_id, k, x, y - x, zlib.crc32(ids[4 * x:4 * y]), task, seen[y - x]))
                seen[y - x] += 1
        yield pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")]).astype({"doc_id": "Int64"})


def packed(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    pieces = saved(texts_of(docs).mapInPandas(lambda batches: cut_pieces(path, batches, capacity, end_id), PIECES), "pieces")
    by_task = pieces.groupBy("task", "length").count()
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = saved(by_task.select("task", "length", "count", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first")), "firsts")
    histogram = {r[0]: r[1] for r in firsts.groupBy("length").agg(F.sum("count")).collect()}
    slots = slot_table(pack_lengths(histogram, capacity))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sequence, offset = np.zeros(len(b), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
            numbers, lengths = b["number"].to_numpy(), b["length"].to_numpy()
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                first, start, each, at = slots[int(length)]
                run = np.searchsorted(first, numbers[rows], side="right") - 1
                nth = numbers[rows] - first[run]
                sequence[rows] = start[run] + nth // each[run]
                offset[rows] = at[run] + nth % each[run] * length
            yield b.drop(columns="number").assign(sequence_id=sequence, offset=offset).astype({"doc_id": "Int64"})

    numbered = pieces.join(firsts.drop("count"), ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("first")).alias("number"))
    return numbered.mapInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
