"""Small builders for the checking SQL."""

from __future__ import annotations

from loomlog import fixed_values as fv
from loomlog.sources.views import view_sql


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def has(col: str, pattern: str, ignore_case: bool = False) -> str:
    """Regex search as a non-null boolean."""
    flags = ", 'i'" if ignore_case else ""
    return f"coalesce(regexp_matches({col}, {lit(pattern)}{flags}), false)"


def any_has(col: str, patterns: list[str], ignore_case: bool = False) -> str:
    return "(" + " OR ".join(has(col, p, ignore_case) for p in patterns) + ")"


def only_group(pattern: str, k: int) -> str:
    """The pattern with its k-th group as the only capturing one."""
    out, seen, i, in_class = [], 0, 0, False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            out.append(pattern[i:i + 2])
            i += 2
            continue
        if ch == "[" and not in_class:
            in_class = True
            out.append(ch)
            if pattern[i + 1:i + 2] == "^":
                out.append("^")
                i += 1
            if pattern[i + 1:i + 2] == "]":
                out.append("]")
                i += 1
        elif ch == "]" and in_class:
            in_class = False
            out.append(ch)
        elif ch == "(" and not in_class and pattern[i + 1:i + 2] != "?":
            seen += 1
            out.append("(" if seen == k else "(?:")
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def group(col: str, pattern: str, k: int = 1) -> str:
    """Text of the k-th group, '' without a match."""
    return f"regexp_extract({col}, {lit(only_group(pattern, k))}, 1)"


def first_group(col: str, patterns: list[str]) -> str:
    return "coalesce(" + ", ".join(f"nullif({group(col, p)}, '')" for p in patterns) + ")"


def contains_any(col: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({col}, {lit(w)})" for w in words) + ")"


def frm(view: str, alias: str = "v") -> str:
    return f"{view_sql(view)} AS {alias}"


def union(selects: list[str]) -> str:
    return " UNION ALL ".join(selects)


def number(ip: str) -> str:
    """Dotted quad to a number, null unless valid."""
    parts = [f"TRY_CAST(split_part({ip}, '.', {i}) AS bigint)" for i in range(1, 5)]
    total = f"((({parts[0]} * 256 + {parts[1]}) * 256 + {parts[2]}) * 256 + {parts[3]})"
    return f"CASE WHEN regexp_matches({ip}, {lit(fv.VALID_IPV4)}) THEN {total} END"


def private(ip: str) -> str:
    import ipaddress
    ranges = []
    for first, prefix in fv.NON_GLOBAL_IPV4:
        low = int(ipaddress.IPv4Address(first))
        ranges.append(f"({number(ip)}) BETWEEN {low} AND {low + 2 ** (32 - prefix) - 1}")
    return "coalesce(" + " OR ".join(ranges) + ", false)"


def external(text: str) -> str:
    """Any address-shaped token outside the private ranges?"""
    found = f"regexp_extract_all({text}, {lit(fv.ANY_IP)})"
    return f"coalesce(list_bool_or(list_transform({found}, lambda x: NOT {private('x')})), false)"


def classify(text: str) -> str:
    low = f"lower({text})"
    ext = external(text)
    return (
        f"CASE WHEN {contains_any(low, fv.ROUTINE_WORDS)} OR (contains({low}, 'http') AND contains({low}, ' 200 ') AND NOT {ext}) THEN 'normal'"
        f" WHEN {contains_any(low, fv.FAILED_LOGIN_WORDS)} THEN 'anomaly'"
        f" WHEN {contains_any(low, fv.LOGIN_OK_WORDS)} AND {contains_any(low, fv.PRIVILEGED_ACCOUNTS)} THEN 'anomaly'"
        f" WHEN {ext} AND {contains_any(low, fv.SENSITIVE_SERVICES)} THEN 'anomaly'"
        f" WHEN {contains_any(low, fv.SYSTEM_ERROR_WORDS)} THEN 'anomaly' ELSE 'normal' END"
    )
