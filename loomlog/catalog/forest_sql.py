"""SQL that grows an isolation forest and scores with it, as :mod:`loomlog.operators.forest` does."""

from __future__ import annotations


def _draw(what: str, seed: int) -> str:
    """A node's number in [0, 1): the first 32 bits of an md5."""
    return f"(CAST('0x' || substr(md5('{seed}:' || tree || ':' || node || ':{what}'), 1, 8) AS bigint) / 4294967296.0::double)"


def _average(n: str) -> str:
    return f"CASE WHEN {n} <= 1 THEN 0 WHEN {n} = 2 THEN 1 ELSE 2 * (ln({n} - 1.0::double) + 0.5772156649015329::double) - 2 * ({n} - 1.0::double) / {n} END"


def forest(points: str, train: str, trees: int, contamination: float, sample: int = 256, seed: int = 42, depth: int = 8,
           ids: str | None = None) -> str:
    """CTEs that end in scored (id, score) and cut (q). ``points`` selects id, f, v; a feature that a point lacks is 0.

    ``train`` selects the ids to learn from, ``ids`` all of them (those of the points if not given). ``depth`` is the most
    levels a tree of ``sample`` rows can have.
    """
    every = f"SELECT unnest(range({trees})) AS tree"
    parts = [
        f"given AS MATERIALIZED ({points})",
        f"names AS MATERIALIZED (SELECT id, CAST(row_number() OVER (ORDER BY id) AS int) AS i FROM (SELECT DISTINCT id FROM ({ids or 'SELECT id FROM given'})))",
        "x AS MATERIALIZED (SELECT i, CAST(f AS int) AS f, round(v, 9) AS v FROM given JOIN names USING (id))",
        f"pool AS MATERIALIZED (SELECT i, row_number() OVER (ORDER BY m, id) - 1 AS r FROM (SELECT DISTINCT id, i, md5('{seed}|' || id) AS m FROM ({train}) JOIN names USING (id)) QUALIFY r < {trees * sample})",
        f"size AS (SELECT count(*) AS n, least(count(*), {sample}) AS psi, ceil(log2(greatest(least(count(*), {sample}), 2))) AS levels FROM pool)",
        f"n0 AS (SELECT CAST(tree AS smallint) AS tree, 1::int AS node, i FROM pool, size, ({every}) WHERE ((r - tree * psi) % n + n) % n < psi)",
        f"p0 AS (SELECT CAST(tree AS smallint) AS tree, 1::int AS node, i FROM names, ({every}))",
    ]
    for k in range(depth + 1):
        if k < depth:
            parts += [
                f"m{k} AS (SELECT tree, node, count(*) AS m FROM n{k} GROUP BY tree, node)",
                f"r{k} AS (SELECT tree, node, f, CASE WHEN count(*) < m THEN least(min(v), 0) ELSE min(v) END AS low, CASE WHEN count(*) < m THEN greatest(max(v), 0) ELSE max(v) END AS high"
                f" FROM n{k} JOIN x USING (i) JOIN m{k} USING (tree, node) GROUP BY tree, node, f, m)",
                f"s{k} AS (SELECT tree, node, list({{'f': f, 'low': low, 'high': high}} ORDER BY f) AS usable FROM r{k} WHERE high > low AND {k} < (SELECT levels FROM size) GROUP BY tree, node)",
                f"c{k} AS MATERIALIZED (SELECT tree, node, u.f AS f, CASE WHEN u.low + {_draw('cut', seed)} * (u.high - u.low) < u.high"
                f" THEN u.low + {_draw('cut', seed)} * (u.high - u.low) ELSE u.low END AS cut"
                f" FROM (SELECT tree, node, usable[CAST(floor({_draw('feature', seed)} * len(usable)) AS int) + 1] AS u FROM s{k}))",
            ]
            parts += [f"{t}{k + 1} AS (SELECT g.tree, CAST(2 * g.node + CASE WHEN coalesce(x.v, 0) <= g.cut THEN 0 ELSE 1 END AS int) AS node, g.i"
                      f" FROM (SELECT {t}{k}.tree, {t}{k}.node, i, f, cut FROM {t}{k} JOIN c{k} USING (tree, node)) g LEFT JOIN x ON x.i = g.i AND x.f = g.f)" for t in "np"]
        last = f"n{k} ANTI JOIN c{k} USING (tree, node)" if k < depth else f"n{k}"
        parts.append(f"l{k} AS (SELECT tree, node, {k} + {_average('count(*)')} AS path FROM {last} GROUP BY tree, node)")
    paths = " UNION ALL ".join(f"SELECT i, path FROM p{k} JOIN l{k} USING (tree, node)" for k in range(depth + 1))
    parts.append(f"scored AS MATERIALIZED (SELECT id, round(pow(2, -(sum(path) / {trees}) / (SELECT CASE WHEN {_average('psi')} = 0 THEN 1 ELSE {_average('psi')} END FROM size)), 12) AS score"
                 f" FROM ({paths}) JOIN names USING (i) GROUP BY id)")
    parts.append(f"cut AS (SELECT quantile_cont(-score, {contamination}::double) AS q FROM scored JOIN (SELECT DISTINCT id FROM ({train})) USING (id))")
    return ",\n ".join(parts)


def log_features(logs: str, numbers: dict[str, str], stop_words: list[str], terms: int = 5000) -> str:
    """CTEs that end in points (id, f, v): the features of log rows, fitted on the rows that are not held.

    ``logs`` selects id, log_level, module, message and held; ``numbers`` are expressions over its columns.
    """
    words = ", ".join("'" + w.replace("'", "''") + "'" for w in stop_words)
    return f"""logs AS MATERIALIZED (SELECT id, held, coalesce(log_level, 'unknown') AS log_level, coalesce(module, 'unknown') AS module, coalesce(message, 'unknown') AS message FROM ({logs})),
 cut_up AS (SELECT id, held, list_filter(regexp_extract_all(lower(concat_ws(' ', log_level, module, message)), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda x: x NOT IN ({words})) AS l FROM logs),
 grams AS (SELECT id, held, unnest(list_concat(l, list_transform(range(1, greatest(len(l), 1)), lambda i: l[i] || ' ' || l[i + 1]))) AS term FROM cut_up),
 tf AS MATERIALIZED (SELECT id, held, term, count(*) AS tf FROM grams GROUP BY ALL),
 vocabulary AS MATERIALIZED (SELECT term, df, row_number() OVER (ORDER BY n DESC, term) - 1 AS f FROM (SELECT term, sum(tf) AS n, count(*) AS df FROM tf WHERE NOT held
   GROUP BY term HAVING count(*) >= 2 ORDER BY n DESC, term LIMIT {terms})),
 weighed AS (SELECT id, f, tf * (ln((1.0 + (SELECT count(*) FROM logs WHERE NOT held)) / (1.0 + df)) + 1.0) AS w FROM tf JOIN vocabulary USING (term)),
 kinds AS (SELECT 1 AS k, log_level AS v FROM logs WHERE NOT held GROUP BY log_level UNION ALL SELECT 2, module FROM logs WHERE NOT held GROUP BY module),
 places AS (SELECT k, v, (SELECT count(*) FROM vocabulary) + row_number() OVER (ORDER BY k, v) - 1 AS f FROM kinds),
 numbers AS (SELECT id, held, unnest(range({len(numbers)})) AS j, unnest([{', '.join(numbers.values())}]) AS v FROM logs),
 ranges AS (SELECT j, min(v) AS low, max(v) AS high FROM numbers WHERE NOT held GROUP BY j),
 points AS (SELECT id, f, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS v FROM weighed
  UNION ALL SELECT id, f, 1.0 FROM logs JOIN places ON (k = 1 AND v = log_level) OR (k = 2 AND v = module)
  UNION ALL SELECT id, (SELECT count(*) FROM vocabulary) + (SELECT count(*) FROM kinds) + j, (v - low) / (high - low) FROM numbers JOIN ranges USING (j) WHERE high > low)"""


def report(pairs: str) -> str:
    """Classification report of ``pairs`` (y, pred), numbers rounded to six digits."""
    def ratio(a: str, b: str) -> str:
        return f"CASE WHEN {b} = 0 THEN 0 ELSE {a}::double / {b} END"
    f1 = "CASE WHEN p + r = 0 THEN 0 ELSE p * r * 2 / (p + r) END"
    return f"""n AS (SELECT count(*) FILTER (y = 0 AND pred = 0) AS a, count(*) FILTER (y = 0 AND pred = 1) AS b, count(*) FILTER (y = 1 AND pred = 0) AS c,
  count(*) FILTER (y = 1 AND pred = 1) AS d FROM ({pairs})),
 k AS (SELECT '0' AS class, {ratio('a', '(a + c)')} AS p, {ratio('a', '(a + b)')} AS r, a + b AS s FROM n
  UNION ALL SELECT '1', {ratio('d', '(d + b)')}, {ratio('d', '(d + c)')}, c + d FROM n),
 f AS (SELECT class, p, r, {f1} AS f1, s FROM k),
 o AS (SELECT class, p, r, f1, s FROM f UNION ALL SELECT 'accuracy', z, z, z, s FROM (SELECT {ratio('(a + d)', '(a + b + c + d)')} AS z, a + b + c + d AS s FROM n)
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f1), sum(s) FROM f
  UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f1 * s) / sum(s), sum(s) FROM f)
 SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, CAST(s AS bigint) AS support FROM o"""
