"""The path-template tree against a plain recursive one."""

import random
import re
from collections import defaultdict

import pytest
from loomlog.llm import urls

RULES = [("allow", "good.org", "/"), ("block", "bad.org", "/"), ("allow", "mixed.net", "/a/"), ("block", "mixed.net", "/b/"), ("block", "mixed.net", "/c/9")]


def general(segment):
    if re.fullmatch(r"[0-9]+(\.[A-Za-z0-9]+)?", segment):
        return re.sub("^[0-9]+", "*", segment)
    return "*" if re.fullmatch("[A-Za-z0-9_-]{8,}", segment) and re.search("[0-9]", segment) else segment


def parse(url):
    after = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", after)[0]
    path = re.match("[^?#]*", after[len(host):])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule_of(host, path, rules):
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fits, key=lambda r: (len(r[1] + r[2]), r[1] + r[2]), default=None)


def brute(pages, rules):
    """page_id and verdict of every page, from a tree built by recursion over the whole list of paths."""
    counts, out = defaultdict(lambda: [0, 0, 0]), []
    for _, url in pages:
        host, path = parse(url)
        rule = rule_of(host, path, rules)
        labels = tuple(reversed(host.split(".")))
        c = counts[labels + ("/",) + tuple(general(s) for s in path.split("/") if s), len(labels)]
        c[0] += 1
        c[1] += bool(rule and rule[0] == "allow")
        c[2] += bool(rule and rule[0] == "block")
    total = [sum(c[k] for c in counts.values()) for k in (1, 2)]
    purity = {}

    def descend(node, level, prior):
        for key in [k for k in node if len(k[0]) == level]:
            purity[key] = prior
        by = defaultdict(list)
        for key in node:
            if len(key[0]) > level:
                by[key[0][level]].append(key)
        groups = defaultdict(list)
        if by:
            in_path = level > next(iter(by.values()))[0][1]
            sums = {s: [sum(counts[k][j] for k in keys) for j in range(3)] for s, keys in by.items()}
            wild = in_path and len(by) > urls.MANY_SEGMENTS and sum(x[0] for x in sums.values()) < len(by) * urls.FEW_URLS
            bins = defaultdict(lambda: [0, 0])
            for s, (_, a, b) in sums.items():
                if in_path and not wild and a + b:
                    bins[100 * b // (a + b)][0] += a
                    bins[100 * b // (a + b)][1] += b
            branch, number, held = {}, 0, [0, 0]
            for x in sorted(bins):
                n, m = sum(held), sum(bins[x])
                share = (held[1] + bins[x][1]) / (n + m)
                gap = bins[x][1] / m - held[1] / max(n, 1)
                if n and gap * gap > urls.Z ** 2 * share * (1 - share) * (1 / n + 1 / m):
                    number, held = number + 1, [0, 0]
                held = [held[0] + bins[x][0], held[1] + bins[x][1]]
                branch[x] = number
            for s, keys in by.items():
                _, a, b = sums[s]
                name = "*" if wild else ("=", branch[100 * b // (a + b)]) if in_path and a + b else ("/", s)
                groups[name] += keys
        for keys in groups.values():
            a, b = (sum(counts[k][j] for k in keys) for j in (1, 2))
            descend(keys, level + 1, (b + urls.SMOOTH * prior) / (a + b + urls.SMOOTH))
    descend(list(counts), 0, total[1] / sum(total) if sum(total) else 0.0)
    for page, url in pages:
        host, path = parse(url)
        rule = rule_of(host, path, rules)
        labels = tuple(reversed(host.split(".")))
        p = purity[labels + ("/",) + tuple(general(s) for s in path.split("/") if s), len(labels)]
        out.append((page, rule[0] if rule else "block" if p >= urls.BLOCK_AT - 1e-12 else "allow"))
    return out


def pages_of(seed, deep):
    draw, out = random.Random(seed), []
    prefix = "".join(f"/d{k}" for k in range(deep))
    for k in range(260):
        host = draw.choice(["good.org", "bad.org", "www.bad.org", "mixed.net", "m.mixed.net", "new.com", "x.bad.org.uk", ""])
        tail = "/".join(draw.choice(["a", "b", "c", "news", "7", "12.html", f"id{draw.randrange(10**6):06d}x", "x" * 300]) for _ in range(draw.randrange(0, 5)))
        out.append((k, f"https://{host}{prefix if draw.random() < 0.6 else ''}/{tail}" + draw.choice(["", "?q=1", "#top"])))
    out += [(1000 + k, f"http://mixed.net/{draw.choice('abc')}{prefix}/{'p' if k % 2 else 'q'}{k % 40}/{k}") for k in range(200)]
    return out + [(None, None), (5000, "no scheme"), (5001, ""), (5001, "https://bad.org/a"), (5001, "https://bad.org/a")]


@pytest.mark.parametrize("seed, deep", [(1, 0), (2, 3), (3, 9)])
def test_verdicts_match_a_recursive_tree(spark, seed, deep):
    pages = pages_of(seed, deep)
    frame = spark.createDataFrame([(p, u, "n", 1, "x") for p, u in pages], "page_id long, url string, node string, n int, segments string")
    got = [(r.page_id, r.verdict) for r in urls.judged_urls(frame, RULES).collect()]
    assert sorted(got, key=repr) == sorted(brute(pages, RULES), key=repr)


@pytest.mark.parametrize("deep", [0, 6, 12])
def test_depth_does_not_change_verdicts(spark, deep):
    prefix = "".join(f"/{x}" for x in "abcdefghijkl"[:deep])
    rules = [("allow", "one.example", f"{prefix}/good/1"), ("block", "one.example", f"{prefix}/bad/1")]
    rows = [(k, f"https://one.example{prefix}/{kind}/{1 if k % 2 else 2}{k}x") for k in range(40) for kind in ("good", "bad")]
    found = urls.judged_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).filter("rule is null").collect()
    assert len(found) == 40 and all(r.verdict == ("allow" if "/good/" in r.path else "block") for r in found)


def test_a_very_long_url(spark):
    rows = [(1, "https://a.org" + "/s" * 400), (2, "https://a.org/s/t"), (3, "https://b.org/x")]
    rules = [("block", "a.org", "/s/t"), ("allow", "b.org", "/")]
    found = {r.page_id: r.verdict for r in urls.judged_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert sorted(found.items()) == brute(rows, rules)
