"""Address expressions: find, validate, convert and classify, with no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog.functions.text import first_extract, let

# IPv6: eight groups, or a "::" standing for at least one group, with an optional dotted tail.
_H = "[0-9A-Fa-f]{1,4}"
_V4 = fv.VALID_IPV4.strip("^$")


def _ipv6_pattern() -> str:
    shapes = [f"(?:{_H}:){{7}}{_H}", f"(?:{_H}:){{6}}{_V4}"]
    for left in range(0, 8):
        head = f"{_H}(?::{_H}){{{left - 1}}}" if left else ""
        room = 7 - left
        tail = f"(?:{_H}(?::{_H}){{0,{room - 1}}})?" if room > 0 else ""
        shapes.append(f"{head}::{tail}")
        if room >= 2:
            groups = f"(?:{_H}:){{0,{room - 2}}}" if room > 2 else ""
            shapes.append(f"{head}::{groups}{_V4}")
    return "^(?:" + "|".join(f"(?:{s})" for s in shapes) + ")(?:%[^%/]+)?$"


VALID_IPV6 = _ipv6_pattern()


def is_valid_ipv4(col: Column) -> Column:
    return F.coalesce(col.rlike(fv.VALID_IPV4), F.lit(False))


def is_valid_ip(col: Column) -> Column:
    """IPv4 without leading zeros, or IPv6."""
    return F.coalesce(col.rlike(fv.VALID_IPV4) | col.rlike(VALID_IPV6), F.lit(False))


def ipv4_number(col: Column) -> Column:
    """Dotted quad to a number; null unless it is a valid IPv4 address."""
    part = F.split(col, "\\.")
    value = F.lit(0).cast("long")
    for i in range(4):
        value = value * 256 + F.get(part, F.lit(i)).try_cast("long")
    return F.when(is_valid_ipv4(col), value)


_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"


def _block_pattern(first: str, prefix: int) -> str:
    """Regex of the addresses in one block, octet by octet."""
    octets = []
    for i, value in enumerate(int(p) for p in first.split(".")):
        fixed = min(max(prefix - 8 * i, 0), 8)
        if fixed == 0:
            octets.append(_OCTET)
        elif fixed == 8:
            octets.append(str(value))
        else:
            octets.append("(?:" + "|".join(str(v) for v in range(value, value + 2 ** (8 - fixed))) + ")")
    return r"\.".join(octets)


PRIVATE_IPV4 = "^(?:" + "|".join(_block_pattern(*block) for block in fv.NON_GLOBAL_IPV4) + ")$"


def is_private(col: Column) -> Column:
    """Not globally reachable. A malformed quad counts as not private."""
    return F.coalesce(col.rlike(PRIVATE_IPV4), F.lit(False))


def has_external_ip(text: Column) -> Column:
    """Does any address-shaped token in the text lie outside the private ranges?"""
    found = F.regexp_extract_all(text, F.lit(fv.ANY_IP), F.lit(0))
    return F.coalesce(F.exists(found, lambda ip: ~is_private(ip)), F.lit(False))


def extract_ip(text: Column) -> Column:
    """One address per text, octet-checked, in the order rhost, from, disconnected, closed."""
    found = first_extract(text, fv.STRICT_IP_FINDERS)
    return F.when(is_valid_ip(found), found)


def extract_ip_loose(text: Column) -> Column:
    """As :func:`extract_ip` with any 1-3 digit octets, the form used for rankings."""
    return first_extract(text, fv.LOOSE_IP_FINDERS)


def ip_key(col: Column) -> Column:
    """An address as 32 hexadecimal digits, in the order of addresses; null unless it is valid. IPv4 is mapped into IPv6."""
    def hexed(number: Column) -> Column:
        return F.lpad(F.lower(F.hex(number)), 8, "0")
    text = F.lower(F.regexp_replace(col, "%.*$", ""))
    dotted = F.regexp_extract(text, "[0-9.]*$", 0)
    tail = hexed(ipv4_number(dotted))
    plain = F.when(dotted.contains("."), F.concat(
        F.substring(text, F.lit(1), F.length(text) - F.length(dotted)), F.substring(tail, 1, 4), F.lit(":"), F.substring(tail, 5, 4))).otherwise(text)

    def expanded(s: Column) -> Column:
        halves = F.split(s, "::", 2)
        left, right = (F.filter(F.split(F.coalesce(F.get(halves, F.lit(k)), F.lit("")), ":"), lambda g: g != "") for k in (0, 1))
        zeros = F.array_repeat(F.lit("0"), F.greatest(8 - F.size(left) - F.size(right), F.lit(0)))
        return F.array_join(F.transform(F.concat(left, zeros, right), lambda g: F.lpad(g, 4, "0")), "")
    mapped = F.concat(F.lit("0" * 20 + "ffff"), hexed(ipv4_number(col)))
    return F.when(is_valid_ipv4(col), mapped).when(is_valid_ip(col), let(plain, expanded))
