"""Leave-one-source-out evaluation of log forests as one job for all folds.

What a fold's model is fitted on is the whole without one source, so nothing is fitted fold by fold: terms, values and ranges
are counted once per source, and each fold's counts are those of the whole less those of its source. All folds' trees are
grown in one grouped pass keyed by (fold, tree), all rows are scored in one pass keyed by (fold, part), and the cuts of all
folds come from one grouped quantile. The number of sources is nowhere a number of jobs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomlog.checkpoints import written
from loomlog.operators import evaluation
from loomlog.operators.features import ENGLISH, NUMERIC_FEATURES, full_text, stop_word_list, terms_of, with_numeric_features
from loomlog.operators.forest import _walker, drawn_rows, grow_forests
from loomlog.operators.lookups import lookup
from loomlog.operators.quantiles import grouped_quantiles
from loomlog.options import ForestOptions

CONTAMINATIONS = [0.05, 0.10, 0.15, 0.20]
#: Rows that are scored together with one copy of their fold's state.
PART_ROWS = 200_000

STATE = "held string, kind string, name string, place int, low double, high double"


def _less_one(per_source: DataFrame, keys: list[str], counts: list[str], folds: DataFrame) -> DataFrame:
    """held, keys and counts of the whole without the source ``held``, for every fold; ``per_source`` has keys, src, counts."""
    whole = per_source.groupBy(*keys).agg(
        F.collect_list(F.struct("src", *counts)).alias("_own"), *[F.sum(c).alias(c) for c in counts])  # an entry for each source
    each = whole.crossJoin(F.broadcast(folds)).withColumn("held", F.explode("sources"))  # folds is one row
    own = F.get(F.filter("_own", lambda x: x["src"] == F.col("held")), F.lit(0))
    return each.select("held", *keys, *[(F.col(c) - F.coalesce(own[c], F.lit(0))).alias(c) for c in counts])


def fold_states(rows: DataFrame, folds: DataFrame, max_terms: int, min_docs: int) -> DataFrame:
    """What each fold's features are made with: its terms with documents and idf, its values with places, its ranges."""
    sizes = rows.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    others = _less_one(sizes.withColumn("all", F.lit(0)), ["all"], ["n"], folds).select("held", F.col("n").alias("rows"))
    marks = F.explode(F.concat(
        F.transform("terms", lambda w: F.struct(w.alias("term"), F.lit(1).alias("n"), F.lit(0).alias("docs"))),
        F.transform(F.array_distinct("terms"), lambda w: F.struct(w.alias("term"), F.lit(0).alias("n"), F.lit(1).alias("docs")))))
    terms = rows.select("src", marks.alias("m")).groupBy("src", "m.term").agg(F.sum("m.n").alias("n"), F.sum("m.docs").alias("docs"))
    most = Window.partitionBy("held").orderBy(F.desc("n"), "term")
    vocabulary = (
        _less_one(terms, ["term"], ["n", "docs"], folds).filter(F.col("docs") >= min_docs)
        .withColumn("place", F.row_number().over(most) - 1).filter(F.col("place") < max_terms).join(others, "held")
        .select("held", F.lit("term").alias("kind"), F.col("term").alias("name"), "place", F.col("docs").cast("double").alias("low"), F.col("rows").cast("double").alias("high"))
    )
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("name")) for c in ("log_level", "module")]))
    values = rows.select("src", pairs.alias("p")).groupBy("src", "p.kind", "p.name").agg(F.count(F.lit(1)).alias("n"))
    by_name = Window.partitionBy("held", "kind").orderBy("name")
    none = F.lit(None).cast("double")
    places = _less_one(values, ["kind", "name"], ["n"], folds).filter("n > 0").select(
        "held", "kind", "name", (F.row_number().over(by_name) - 1).alias("place"), none.alias("low"), none.alias("high"))
    ends = rows.groupBy("src").agg(*[f(c).alias(f"{p}{c}") for c in NUMERIC_FEATURES for f, p in ((F.min, "lo_"), (F.max, "hi_"))])
    each = ends.select("src", F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.lit(k).alias("place"), F.col(f"lo_{c}").alias("low"), F.col(f"hi_{c}").alias("high")) for k, c in enumerate(NUMERIC_FEATURES)
    ])).alias("r")).select("src", "r.*")
    # the least of all other sources is the least or, for its own source, the next
    two = each.groupBy("name", "place").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("low", "src"))), 1, 2).alias("lows"),
        F.slice(F.sort_array(F.collect_list(F.struct("high", "src")), asc=False), 1, 2).alias("highs"))
    ranges = two.crossJoin(F.broadcast(folds)).withColumn("held", F.explode("sources")).select(
        "held", F.lit("range").alias("kind"), "name", "place",
        F.get(F.filter("lows", lambda x: x["src"] != F.col("held")), F.lit(0))["low"].alias("low"),
        F.get(F.filter("highs", lambda x: x["src"] != F.col("held")), F.lit(0))["high"].alias("high"))
    return vocabulary.unionByName(places).unionByName(ranges)


class FoldFeatures:
    """Makes the sparse features of rows as one fold's model sees them: terms, level, module, numbers."""

    def __init__(self, state: pd.DataFrame, max_terms: int):
        by = dict(tuple(state.groupby("kind")))
        terms = by.get("term", state.iloc[:0])
        self.terms = {t: (p, math.log((1 + n) / (1 + d)) + 1.0) for t, p, d, n in zip(terms.name, terms.place, terms.low, terms.high)}
        self.values, start = [], max_terms
        for kind in ("log_level", "module"):
            own = by.get(kind, state.iloc[:0])
            self.values.append({v: start + p for v, p in zip(own.name, own.place)})
            start += len(own)
        ranges = by.get("range", state.iloc[:0]).sort_values("place")
        self.start, self.low, self.width = start, ranges.low.to_numpy(), (ranges.high - ranges.low).to_numpy()

    def of(self, terms, level: str, module: str, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts: dict[int, list] = {}
        for t in terms:
            if t in self.terms:
                place, idf = self.terms[t]
                counts.setdefault(place, [0, idf])[0] += 1
        places = sorted(counts)
        weights = [counts[p][0] * counts[p][1] for p in places]
        norm = math.sqrt(sum(w * w for w in weights)) or 1.0
        seen = [v[x] for v, x in zip(self.values, (level, module)) if x in v]
        scaled = np.divide(numbers - self.low, self.width, out=np.zeros(len(numbers)), where=self.width != 0)
        stored = np.flatnonzero(scaled)
        return (np.concatenate([places, seen, self.start + stored]).astype(np.int32),
                np.concatenate([np.array(weights) / norm, np.ones(len(seen)), scaled[stored]]))

    def frame(self, rows: pd.DataFrame) -> pd.DataFrame:
        numbers = rows[NUMERIC_FEATURES].to_numpy(dtype=np.float64)
        made = [self.of(t, level, module, x) for t, level, module, x in zip(rows.terms, rows.log_level, rows.module, numbers)]
        return pd.DataFrame({"indices": [i for i, _ in made], "values": [v for _, v in made]}, index=rows.index)


def leave_one_out(labelled: DataFrame, source: str = "source_file", contaminations: list[float] | None = None, ids: list[str] | None = None,
                  trees: int = 100, max_terms: int = 5000, min_docs: int = 2, stop_words: list[str] | str | None = ENGLISH,
                  bigrams: bool = True, seed: int = 42) -> DataFrame:
    """test_dataset, contamination and scores of a forest that was trained on all other sources, at every contamination.

    ``labelled`` has ids, ``source``, ``y``, log_level, module and message. Rows without a source are left out; a single
    source has no others to learn from and gives no rows.
    """
    ids, cuts = ids or ["line_id"], contaminations or CONTAMINATIONS
    base = labelled.filter(F.col(source).isNotNull()).withColumns({c: F.coalesce(F.col(c), F.lit("unknown")) for c in ("log_level", "module", "message")})
    text = full_text(F.col("log_level"), F.col("module"), F.col("message"))
    rows = written(with_numeric_features(base).select(
        *ids, F.col(source).cast("string").alias("src"), "y", "log_level", "module", *NUMERIC_FEATURES,
        terms_of(text, stop_word_list(stop_words), bigrams).alias("terms")), "fold-rows")
    folds = rows.select("src").distinct().agg(F.sort_array(F.collect_list("src")).alias("sources"))  # a name for each source
    each = rows.crossJoin(F.broadcast(folds)).withColumn("held", F.explode("sources")).drop("sources")
    state = written(fold_states(rows, folds, max_terms, min_docs), "fold-states")
    opts = ForestOptions(trees=trees, seed=seed)

    drawn, sizes = drawn_rows(each.filter("src <> held").select("held", *ids), ids, opts, by="held")
    chosen = drawn.groupBy("held", *ids).agg(F.collect_list("tree").alias("trees"))
    picked = lookup(each.filter("src <> held"), chosen, ["held", *ids], "inner")
    picked = lookup(picked, sizes, ["held"], "inner")

    def featurise(state_: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(state_):
            return pd.DataFrame(columns=["held", "trees", "psi", "indices", "values"])
        return pd.concat([some[["held", "trees", "psi"]], FoldFeatures(state_, max_terms).frame(some)], axis=1)
    made = _with_state(picked, state, ids).applyInPandas(featurise, "held string, trees array<int>, psi int, indices array<int>, values array<double>")
    nodes = written(grow_forests(made.select("held", F.explode("trees").alias("tree"), "psi", "indices", "values"), "held", seed), "fold-nodes")

    packed = nodes.select("held", F.lit("node").alias("kind"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("place"),
                          F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), "tree", "node", "feature", "cut", "path",
                          F.lit(None).cast("int").alias("psi"))
    empty = [F.lit(None).cast(t).alias(c) for c, t in (("tree", "int"), ("node", "int"), ("feature", "int"), ("cut", "double"), ("path", "double"))]
    full = lookup(state, sizes, ["held"], "inner").select("held", "kind", "name", "place", "low", "high", *empty, "psi").unionByName(packed)

    def score(state_: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        grown = state_[state_.kind == "node"]
        if not len(some) or not len(grown):
            return pd.DataFrame(columns=["held", "src", "y", "decision"])
        tree = grown.drop(columns=["name"]).astype({"tree": "int64", "node": "int64", "feature": "int64"})
        walk = _walker(tree, trees, int(state_.psi.max()))
        rest, out = FoldFeatures(state_[state_.kind != "node"], max_terms), some[["held", "src", "y"]].copy()
        features = rest.frame(some)
        out["decision"] = -walk(features["indices"], features["values"]).to_numpy()
        return out
    scored = written(_with_state(each, full, ids).applyInPandas(score, "held string, src string, y int, decision double"), "fold-scores")
    offsets = grouped_quantiles(scored.filter("src <> held"), "held", "decision", cuts)  # held, prob, value
    table = F.explode(F.map_from_entries("offsets")).alias("contamination", "offset")
    wide = offsets.groupBy("held").agg(F.collect_list(F.struct("prob", "value")).alias("offsets"))
    pairs = lookup(scored.filter("src = held"), wide, ["held"], "inner").select("held", "y", "decision", table).select(
        "held", "contamination", "y", (F.col("decision") < F.col("offset")).cast("int").alias("pred"))
    report = evaluation.classification_report(pairs, by=["held", "contamination"])
    return report.groupBy(F.col("held").alias("test_dataset"), "contamination").agg(
        *[F.max(F.when(F.col("class") == "1", F.col(m))).alias(f"{m}_anomaly") for m in ("f1", "recall", "precision")],
        F.max(F.when(F.col("class") == "accuracy", F.col("f1"))).alias("accuracy"),
        F.max(F.when(F.col("class") == "weighted avg", F.col("f1"))).alias("f1_weighted"))


def _with_state(rows: DataFrame, state: DataFrame, ids: list[str]):
    """Rows of each fold in parts of about PART_ROWS, each part together with a copy of its fold's state."""
    sizes = rows.groupBy("held").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("parts"))
    sizes = written(sizes, "parts")
    own = lookup(rows, sizes, ["held"], "inner").withColumn("part", F.pmod(F.xxhash64(*ids), "parts").cast("int")).drop("parts")
    copies = lookup(state, sizes, ["held"], "inner").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return copies.groupBy("held", "part").cogroup(own.groupBy("held", "part"))
