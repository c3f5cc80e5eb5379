"""Joins of rows to one-row-per-key tables.

The tables come from data, so their size is measured: a table of at most
``BROADCAST_BYTES`` is sent to all tasks and the rows stay where they are.
A larger one is joined by shuffle, where adaptive execution splits the partitions
of hot keys.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.checkpoints import written
from loomlog.functions.ip import ip_key

#: Size of a lookup table that may be sent to every task: its texts, and 16 bytes for every value.
BROADCAST_BYTES = 16 << 20


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``rows`` to ``table`` (unique on ``keys``); ``how`` is left, inner, left_semi or left_anti.

    The table is written first, so that measuring it does not compute it twice.
    """
    table = written(table, "lookup")
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in table.dtypes if kind == "string"]
    each = sum(texts, F.lit(16 * len(table.columns)).cast("long"))
    small = (table.agg(F.sum(each)).first()[0] or 0) <= BROADCAST_BYTES
    return rows.join(F.broadcast(table) if small else table, keys, how)


def with_reputation(ips: DataFrame, scores: DataFrame) -> DataFrame:
    """Attach abuse_score and ipqs_score, clamped to 0-100; null for unknown addresses."""
    def clamp(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.greatest(F.lit(0), F.least(F.lit(100), F.col(name)))).alias(name)
    table = scores.select("ip", clamp("abuse_score"), clamp("ipqs_score"))
    return ips.join(table, "ip", "left")


def range_prefixes(ranges: DataFrame) -> DataFrame:
    """prefix (hexadecimal digits), country, city: address ranges cut at the borders of whole digits.

    ``start`` and ``end`` (inclusive) are IPv4 numbers, or texts of IPv4 or IPv6 addresses. A range is at most 30 prefixes of
    each length. Ranges that do not read, or end before they start, have none.
    """
    def cut(batches):
        for b in batches:
            out = []
            for start, end, country, city in zip(b["from"], b["to"], b["country"], b["city"]):
                if start is None or end is None:
                    continue
                low, high = int(start, 16), int(end, 16) + 1
                while low < high:
                    free = 0  # digits that the next prefix leaves free: as many as its start and the rest of the range allow
                    while free < 32 and low % 16 ** (free + 1) == 0 and low + 16 ** (free + 1) <= high:
                        free += 1
                    out.append((f"{low:032x}"[:32 - free], country, city))
                    low += 16 ** free
            yield pd.DataFrame(out, columns=["prefix", "country", "city"])

    def key(name: str) -> Column:
        if dict(ranges.dtypes)[name] == "string":
            return ip_key(F.col(name))
        return F.concat(F.lit("0" * 20 + "ffff"), F.lpad(F.lower(F.hex(F.col(name).cast("long"))), 8, "0"))
    keyed = ranges.select(key("start").alias("from"), key("end").alias("to"), F.col("country").cast("string"), F.col("city").cast("string"))
    return keyed.mapInPandas(cut, "prefix string, country string, city string")


def with_geo(ips: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    """Attach country and city of the smallest range an address lies in; IPv4 and IPv6.

    Ranges are cut into prefixes of whole hexadecimal digits. An address looks up one prefix of each length that occurs, 33 at
    most, and takes the longest that is found; of equal ranges the greatest place. Addresses are looked up once each.
    """
    prefixes = written(range_prefixes(ranges).groupBy("prefix").agg(F.max(F.struct("country", "city")).alias("place")), "prefixes")
    lengths = [r[0] for r in prefixes.select(F.length("prefix")).distinct().orderBy(F.length("prefix")).collect()]  # 0 to 32
    known = ips.select(F.col(ip).alias("_ip"), ip_key(F.col(ip)).alias("_key")).filter("_key is not null").distinct()
    candidates = known.select("_ip", F.explode(
        F.array(*[F.expr(f"substring(_key, 1, {n})") for n in lengths]) if lengths else F.array().cast("array<string>")).alias("prefix"))
    flat = prefixes.select("prefix", "place.country", "place.city")
    found = lookup(candidates, flat, ["prefix"], "inner").groupBy("_ip").agg(
        F.max_by(F.struct("country", "city"), F.length("prefix")).alias("_place"))
    places = found.select(F.col("_ip").alias(ip), "_place.country", "_place.city")
    return lookup(ips.drop("country", "city"), places, [ip], "left").select(
        *[c for c in ips.columns if c not in ("country", "city")], "country", "city")
