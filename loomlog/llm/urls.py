"""URL verdicts from written rules and, for all other URLs, from a path-template tree per host.

The URLs that a rule decides are the labelled ones. Hosts form a tree by their labels from the top domain down, and below
each host its paths form one by their segments, of any depth. The tree is built from the root down, a level at a time, over
the distinct paths with their counts; each path carries the node it has reached and that node's purity, so nothing is looked
up among ancestors.

At a node, segments that are numbers or mixed codes by themselves are wildcards, and so are those of a node that has many
different ones with few URLs each. Then branches that do not differ are merged into one node before it is descended: the
labelled children of a node are put in order by their share of blocked labels, in hundredths, and neighbours are joined as
long as a two-proportion z test does not tell the next from what has been joined so far. Children without labels stay apart.
Hosts are never merged. A node's purity is its share of blocked labels, smoothed towards its parent's, the root's its plain
share; a URL is blocked if the purity of the node it ends in reaches ``block_at``.

A node that holds a single path is followed to its end at once: all nodes below have the same labels, so the purity there
has a closed form, and the number of levels built is that of the deepest branching, not of the longest URL.

Nulls: a null URL, or one without ``://``, has an empty host and path, fits no rule and gets the verdict of the empty host;
a null page_id is kept. Repeated rows count each. Extra columns are ignored. Empty table: no rows. Without labels nothing is
blocked by the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import saved, small

#: A node with more than this many different segments, and fewer than this many URLs for each, has a wildcard.
MANY_SEGMENTS, FEW_URLS = 20, 4
#: Weight of the parent's purity, the z value of a difference, and the purity that blocks.
SMOOTH, Z, BLOCK_AT = 4.0, 1.96, 0.5

Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    after = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_extract(after, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(rules: list[Rule]) -> Column:
    """Struct of the longest rule that fits ``host`` and ``path``: its text and verdict; null if none fits."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        chosen = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def general(segment: Column) -> Column:
    """A segment that is a number, possibly with an ending, or a long mixed code, as a wildcard; others as they are."""
    return (
        F.when(segment.rlike(r"^[0-9]+(\.[A-Za-z0-9]+)?$"), F.regexp_replace(segment, "^[0-9]+", "*"))
        .when(segment.rlike("^(?=.*[0-9])[A-Za-z0-9_-]{8,}$"), "*").otherwise(segment)
    )


def parsed(pages: DataFrame) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    segments = F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), general)
    return pages.select("page_id", F.coalesce("url", F.lit("")).alias("url")).select(
        "page_id", host.alias("host"), path.alias("path")).withColumn("segments", segments)


def merged_bins(bins: Column) -> Column:
    """(bin, branch) for a node's bins (bin, a, b: allowed and blocked labels), which are in order: like neighbours share a branch."""
    def join(state: Column, x: Column) -> Column:
        n, m = state["a"] + state["b"], x["a"] + x["b"]
        share = (state["b"] + x["b"]) / (n + m)
        gap = x["b"] / m - state["b"] / F.greatest(n, F.lit(1))
        alike = (n == 0) | (gap * gap <= Z * Z * share * (1 - share) * (1 / F.greatest(n, F.lit(1)) + 1 / m))
        branch = F.when(alike, state["branch"]).otherwise(state["branch"] + 1)
        return F.struct(
            (x["a"] + F.when(alike, state["a"]).otherwise(0)).alias("a"), (x["b"] + F.when(alike, state["b"]).otherwise(0)).alias("b"),
            branch.alias("branch"), F.concat(state["done"], F.array(F.struct(x["bin"].alias("bin"), branch.alias("branch")))).alias("done"))
    nothing = F.lit(0).cast("long")
    start = F.struct(nothing.alias("a"), nothing.alias("b"), F.lit(0).alias("branch"), F.array().cast("array<struct<bin:int,branch:int>>").alias("done"))
    return F.aggregate(bins, start, join)["done"]


def children(rows: DataFrame) -> DataFrame:
    """node, label, to (the node that the label leads to), purity and paths of it, for the step each of ``rows`` takes next.

    ``rows`` has node, purity, label, in_path, n, allowed and blocked.
    """
    each = saved(rows.groupBy("node", "label", "in_path", "purity").agg(
        F.sum("n").alias("n"), F.sum("allowed").alias("a"), F.sum("blocked").alias("b"), F.count("*").alias("paths")), "children")
    many = each.filter("in_path").groupBy("node").agg(F.count("*").alias("different"), F.sum("n").alias("urls")).filter(
        (F.col("different") > MANY_SEGMENTS) & (F.col("urls") < F.col("different") * FEW_URLS)).select("node", F.lit(True).alias("wild"))
    kept = each.join(many, "node", "left").withColumn("wild", F.coalesce("wild", F.lit(False)))
    labels = F.col("a") + F.col("b")
    bin_ = F.when(~F.col("wild") & F.col("in_path") & (labels > 0), F.floor(100 * F.col("b") / labels).cast("int"))
    kept = saved(kept.withColumn("bin", bin_), "kept")
    bins = kept.filter("bin is not null").groupBy("node", "bin").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    per_node = bins.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("bin", "a", "b"))).alias("bins"))  # 101 at most
    branches = per_node.select("node", F.explode(merged_bins(F.col("bins"))).alias("x")).select("node", "x.bin", "x.branch")
    named = kept.join(branches, ["node", "bin"], "left").withColumn("name", F.when(F.col("wild"), "*").when(
        F.col("branch").isNotNull(), F.concat(F.lit("="), F.col("branch").cast("string"))).otherwise(F.concat(F.lit("/"), F.col("label"))))
    a, b, prior = F.sum("a"), F.sum("b"), F.first("purity")
    merged = saved(named.groupBy("node", "name").agg(
        ((b + SMOOTH * prior) / (a + b + SMOOTH)).alias("purity"), F.sum("paths").alias("paths")).withColumn(
        "to", F.sha2(F.concat("node", F.lit("|"), F.col("name")), 256)), "merged")
    return saved(named.select("node", "name", "label").join(merged, ["node", "name"]).select("node", "label", "to", "purity", "paths"), "steps")


def path_purities(paths: DataFrame) -> DataFrame:
    """host, segments and purity of the node each distinct path ends in; ``paths`` has n, allowed and blocked of each."""
    steps = F.concat(F.reverse(F.split("host", r"\.")), F.array(F.lit("/")), "segments")
    total = paths.agg(F.try_divide(F.sum("blocked").cast("double"), F.sum(F.col("allowed") + F.col("blocked"))).alias("p")).first()
    left = paths.select("*", steps.alias("steps"), F.size(F.split("host", r"\.")).alias("labels"), F.lit("").alias("node"),
                        F.lit((total["p"] if total else None) or 0.0).alias("purity"))
    done, level = None, 0
    keep = ["host", "segments", "n", "allowed", "blocked", "steps", "labels"]
    while True:
        going = left.withColumn("label", F.get("steps", F.lit(level))).withColumn("in_path", F.lit(level) > F.col("labels"))
        found = children(going)
        after = saved(going.drop("purity").join(small(found), ["node", "label"]).select(*keep, F.col("to").alias("node"), "purity", "paths"), "level")
        level += 1
        more, labelled = F.size("steps") - level, F.col("allowed") + F.col("blocked")
        share = F.col("blocked") / F.greatest(labelled, F.lit(1))
        end = F.when(labelled == 0, F.col("purity")).otherwise(
            share + (F.col("purity") - share) * F.pow(SMOOTH / (labelled + SMOOTH), more))
        ended = after.filter((more == 0) | (F.col("paths") == 1)).select("host", "segments", end.alias("purity"))
        done = ended if done is None else done.unionByName(ended)
        left = after.filter((more > 0) & (F.col("paths") > 1)).drop("paths")
        if not left.limit(1).count():
            return done


def judged_urls(pages: DataFrame, rules: list[Rule], block_at: float = BLOCK_AT) -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict of every page."""
    found = saved(parsed(pages).withColumn("by", fitting_rule(rules)).select("page_id", "host", "path", "segments", "by.*"), "urls")
    paths = saved(
        found.groupBy("host", "segments").agg(
            F.count("*").alias("n"), F.count_if(F.col("verdict") == "allow").alias("allowed"),
            F.count_if(F.col("verdict") == "block").alias("blocked")), "paths")
    tree = path_purities(paths)
    left = found.join(tree, ["host", "segments"], "left")
    method = F.when(F.coalesce("purity", F.lit(0.0)) >= block_at, "block").otherwise("allow")
    return left.select("page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"))
