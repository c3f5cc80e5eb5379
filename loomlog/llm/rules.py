"""Quality rules whose cutoffs carry a guarantee, in DataFrame functions alone.

Every document gets six measures in thousandths. A rule rejects a document whose measure lies beyond a cutoff, and the
cutoffs are chosen per stratum on labelled good documents: a cutoff is admitted only if the exact binomial probability of
seeing so few rejected good documents, were the true share of false rejections ``alpha / rules``, is at most
``delta / (strata * rules)``. Cutoffs of a rule are nested, so they are tested from lax to strict and those that pass in an
unbroken row are admitted (fixed sequence); the division by strata and rules is the Bonferroni correction. With
probability ``1 - delta`` no stratum then loses more than the share ``alpha`` of its good documents, whichever admitted
cutoffs are used. Of these the one with the largest share of labelled bad documents caught, less ``COST`` times the share of good
ones lost, is used, the laxest of equals, and none where that is not positive. A stratum with too few labels admits no
cutoff, and only the base rule holds there.

Nulls: a null text has no words and fails the base rule; a null lang belongs to the stratum of other languages; null
doc_ids or labels find no partner and calibrate nothing. Repeated rows are judged each on its own; repeated labels of a
document count once, and a document with contradicting labels does not count as good. Extra columns are ignored by
:func:`judged` and carried along by :func:`kept_documents`. Empty tables give no rows, and without labels no cutoffs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog.llm.common import BLANKS, let, saved, small

#: Strata: these languages and one for all others, so the table of cutoffs has a bounded size.
STRATA = ("en", "de", "fr", "es")
#: Measures where large values speak against a document; the short-word measure is turned round to fit.
RULES = ("symbols", "repeated_lines", "repeated_words", "long_words", "short_words", "capitals")
#: Share of good documents a stratum may lose, and the chance that this fails.
ALPHA, DELTA = 0.05, 0.05
#: How much heavier a lost share of good documents weighs than a caught share of bad ones.
COST = 20.0
#: Largest value of a measure; every larger one counts as this.
TOP = 20_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def repeated_words(words: Column) -> Column:
    """Number of words inside windows of 8 words that occur twice or more in the text."""
    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(hashes) - 7), lambda i: F.xxhash64(F.slice(hashes, i, F.lit(8))))

    def covered(found: Column) -> Column:
        numbered = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(numbered, lambda s: F.filter(s, lambda e, j: F.coalesce(
            (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"]),
            F.get(s, j - 1)["h"] == e["h"], F.get(s, j + 1)["h"] == e["h"], F.lit(False))))
        starts = F.array_sort(F.transform(again, lambda e: e["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(-8).alias("last"))
        return F.aggregate(starts, zero, lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(8), i - a["last"])).alias("n"), i.alias("last")))["n"]

    found = let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    counted = let(found, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(F.lit(0)))
    return F.when(F.size(words) < 9, F.lit(0)).otherwise(counted).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """``row`` (the whole input row), the base counts and the rules' measures."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select(F.struct("*").alias("row"), text.alias("text"), words_of(text).alias("words"),
                        F.filter(F.split(text, "\n"), lambda line: line.rlike("[^ \\t-\\r]")).alias("lines"))
    counted = split.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
    )

    def share(part: str, whole: str) -> Column:
        value = F.when(F.col(whole) > 0, F.floor(1000 * F.col(part) / F.col(whole))).otherwise(0)
        return F.least(value, F.lit(TOP)).cast("int")

    long_words = share("word_chars", "n_words")
    lang = F.col("row.lang")
    return counted.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.coalesce((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")), F.lit(False)).alias("base_failed"),
        F.when(lang.isin(*STRATA), lang).otherwise("other").alias("stratum"),
        share("n_symbols", "word_chars").alias("symbols"), share("n_dup_lines", "n_lines").alias("repeated_lines"),
        share("n_repeat_words", "n_words").alias("repeated_words"), long_words.alias("long_words"),
        (F.lit(TOP) - long_words).alias("short_words"), share("n_capitals", "word_chars").alias("capitals"),
    )


def log_factorial(n: Column) -> Column:
    """ln n! for n >= 0, by Stirling's series at n + 8."""
    x = n + 8.0
    series = x * F.log(x) - x + 0.5 * F.log(2 * F.pi() * x) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5.0)))
    return series - sum((F.log(n + float(k)) for k in range(2, 9)), F.log(n + 1.0))


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X binomial with n trials and chance p, k <= n.

    Summed downward from the largest term at or below k; terms beyond 40 standard deviations are less than the rounding.
    """
    def term(i: Column) -> Column:
        i = i.cast("double")
        return F.exp(log_factorial(n) - log_factorial(i) - log_factorial(n - i) + i * F.log(F.lit(p)) + (n - i) * F.log1p(F.lit(-p)))
    mode = F.least(k, F.floor(n * p))
    low = F.greatest(F.lit(0), (mode - 40 * F.sqrt(n * p + 1)).cast("long"))
    high = F.least(k, (mode + 40 * F.sqrt(n * p + 1)).cast("long"))
    return F.least(F.lit(1.0), F.aggregate(F.sequence(low, high), F.lit(0.0), lambda a, i: a + term(i)))


def cutoffs(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """stratum and, for each rule, its certified cutoff: a document with a larger measure is rejected (null: no cutoff).

    Only labelled documents are measured; every row of a labelled doc_id counts.
    """
    known = saved(labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("most")).filter(
        "q = most and q in (0, 1)").select(F.col("doc_id").alias("known_id"), "q"), "labels")
    labelled = docs.select("doc_id", "text", "lang").join(small(known), F.col("doc_id") == F.col("known_id")).drop("known_id")
    held = measured(labelled).filter("not base_failed").select("stratum", F.col("row.q").alias("q"), *RULES)
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES]))
    bins = held.select("stratum", "q", pairs.alias("p")).groupBy("stratum", "p.rule", "p.value").agg(
        F.count_if(F.col("q") == 1).alias("n"), F.count_if(F.col("q") == 0).alias("bad"))
    each = Window.partitionBy("stratum", "rule")
    upward = each.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    tests = (len(STRATA) + 1) * len(RULES)
    tested = bins.select(
        "stratum", "rule", "value", F.sum("n").over(each).alias("good"),
        (F.sum("n").over(each) - F.sum("n").over(upward)).alias("lost"), F.sum("bad").over(each).alias("bad"),
        (F.sum("bad").over(each) - F.sum("bad").over(upward)).alias("caught"),
    ).filter("good > 0 and bad > 0").filter(F.col("lost") <= F.col("good") * alpha / len(RULES)).select(
        "stratum", "rule", "value", (F.col("caught") / F.col("bad") - COST * (F.col("lost") / F.col("good"))).alias("gain"),
        (binomial_tail(F.col("good").cast("double"), F.col("lost"), alpha / len(RULES)) <= delta / tests).alias("passed"))
    # the tail grows as the cutoff falls, so what passes is an unbroken row from the laxest cutoff down
    best = tested.filter("passed and gain > 0").groupBy("stratum", "rule").agg(
        F.max_by("value", F.struct("gain", "value")).alias("cutoff"))
    return best.groupBy("stratum").agg(*[F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"max_{r}") for r in RULES])


def _with_verdict(docs: DataFrame, labels: DataFrame, alpha: float, delta: float) -> DataFrame:
    found, limits = measured(docs), F.broadcast(cutoffs(docs, labels, alpha, delta))  # at most a row for each stratum
    broken = [F.coalesce(F.col(r) > F.col(f"max_{r}"), F.lit(False)) for r in RULES]
    rejected = broken[0]
    for b in broken[1:]:
        rejected = rejected | b
    return found.join(limits, "stratum", "left").withColumn("kept", ~F.col("base_failed") & ~rejected)


def judged(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """doc_id, the base counts, base_failed and kept for every document."""
    return _with_verdict(docs, labels, alpha, delta).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def kept_documents(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    return _with_verdict(docs, labels, alpha, delta).filter("kept").select("row.*")
