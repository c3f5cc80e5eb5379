"""SQL that mines templates as :mod:`loomlog.operators.templates` does for groups that are one part."""

from __future__ import annotations

from loomlog.operators.templates import WILD

_VALUE = r"'^([^A-Za-z0-9]*[0-9][^A-Za-z]*|0[xX][0-9a-fA-F]+)$'"
_HEX = r"'^[0-9a-fA-F]{6,}$'"


def mined(lines: str, similarity: float) -> str:
    """CTEs that end in mined (id, tokens, template as a list) for ``lines`` (id, message).

    A group's texts are folded in order over the list of its clusters: ``c`` holds the clusters, ``a`` the one each text took.
    """
    wild = f"'{WILD}'"
    alike = f"list_transform(y.c, lambda k: len(list_filter(range(1, len(k) + 1), lambda i: k[i] = x.t[i] AND k[i] <> {wild}))::double / len(x.t))"
    best = "list_position(s, list_max(s))"
    joined = (f"list_transform(range(1, len(y.c) + 1), lambda j: CASE WHEN j = {best} THEN list_transform(range(1, len(x.t) + 1),"
              f" lambda i: CASE WHEN y.c[j][i] = x.t[i] THEN x.t[i] ELSE {wild} END) ELSE y.c[j] END)")
    step = (f"list_transform([{alike}], lambda s: CASE WHEN len(s) > 0 AND list_max(s) >= {similarity} THEN {{'t': x.t, 'c': {joined}, 'a': list_append(y.a, {best})}}"
            " ELSE {'t': x.t, 'c': list_append(y.c, x.t), 'a': list_append(y.a, len(y.c) + 1)} END)[1]")
    empty = "CAST([] AS varchar[][])"
    return f"""pieces AS (SELECT id, list_filter(regexp_split_to_array(message, '\\s+'), lambda w: w <> '') AS tokens FROM ({lines})),
 plain AS (SELECT id, tokens, list_transform(tokens, lambda w: CASE WHEN regexp_matches(w, {_VALUE}) OR (regexp_matches(w, {_HEX}) AND regexp_matches(w, '[0-9]'))
   THEN {wild} ELSE w END) AS t FROM pieces),
 texts AS (SELECT DISTINCT t, len(t) || ' ' || t[1] AS key FROM plain WHERE len(t) > 0),
 folded AS (SELECT key, list(t ORDER BY encode(array_to_string(t, ' '))) AS ts, list_reduce(list({{'t': t, 'c': {empty}, 'a': CAST([] AS bigint[])}} ORDER BY encode(array_to_string(t, ' '))),
   lambda y, x: {step}, {{'t': CAST([] AS varchar[]), 'c': {empty}, 'a': CAST([] AS bigint[])}}) AS f FROM texts GROUP BY key),
 named AS (SELECT key, ts[i] AS t, f.c[f.a[i]] AS template FROM (SELECT *, unnest(range(1, len(ts) + 1)) AS i FROM folded)),
 mined AS (SELECT id, tokens, template FROM plain LEFT JOIN named USING (t))"""
