"""Features for log rows, entities and network flows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, OneHotEncoder, StopWordsRemover, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog.checkpoints import written
from loomlog.functions.severity import any_healthcheck_usage, classify_entry
from loomlog.functions.text import let
from loomlog.operators.lookups import BROADCAST_BYTES
from loomlog.operators.numbering import with_numbers

WORDS = r"[\p{L}\p{N}_]{2,}"


def words_of(text: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))


def terms_of(text: Column, stop_words: list[str] | None = None, bigrams: bool = False) -> Column:
    """Words, stop words removed, and with ``bigrams`` also the pairs of neighbours."""
    words = words_of(text)
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(*stop_words))
    if not bigrams:
        return words

    def with_pairs(w: Column) -> Column:
        after = F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0)))
        before = F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0)))
        return F.concat(w, F.zip_with(before, after, lambda a, b: F.concat_ws(" ", a, b)))

    return let(words, with_pairs)


# ---------------------------------------------------------------- TF-IDF

@dataclass(frozen=True)
class TfidfModel:
    """Vocabulary (bounded by ``max_terms``), its inverse document frequencies and how text is cut."""

    terms: list[str]
    idf: list[float]
    stop_words: list[str]
    bigrams: bool

    def weights(self, df: DataFrame, doc: str, text: str) -> DataFrame:
        """doc, term, weight: L2-normalised TF-IDF in long form."""
        spark = df.sparkSession
        table = spark.createDataFrame(list(zip(self.terms, self.idf)), "term string, idf double")
        counts = term_counts(df, doc, text, self.stop_words, self.bigrams)
        return _normalised(counts.join(F.broadcast(table), "term"), doc)  # at most max_terms rows

    def vectors(self, df: DataFrame, text: Column, output: str) -> DataFrame:
        """Add the sparse TF-IDF vector of each row; no shuffle."""
        cut = df.withColumn("_terms", terms_of(text, self.stop_words, self.bigrams))
        counted = CountVectorizerModel.from_vocabulary(self.terms, "_terms", "_tf").transform(cut)
        scaled = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_w").transform(counted)
        return Normalizer(p=2.0, inputCol="_w", outputCol=output).transform(scaled).drop("_terms", "_tf", "_w")


def term_counts(df: DataFrame, doc: str, text: str, stop_words: list[str] | None = None, bigrams: bool = False) -> DataFrame:
    """doc, term, tf. Texts of one entity are never joined up: their terms are counted together instead."""
    return (
        df.select(doc, F.explode(terms_of(F.col(text), stop_words, bigrams)).alias("term"))
        .groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))
    )


def _normalised(weighted: DataFrame, doc: str) -> DataFrame:
    raw = weighted.withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(doc)))  # one doc: at most the vocabulary
    return raw.select(doc, "term", (F.col("_w") / norm).alias("weight"))


def _row_term_totals(df: DataFrame, text: str, stop_words: list[str] | None, bigrams: bool) -> DataFrame:
    """term, n, docs when every row is a document: one reduction by term, none by document."""
    terms = df.select(terms_of(F.col(text), stop_words, bigrams).alias("t"))
    marks = terms.select(F.explode(F.concat(
        F.transform("t", lambda w: F.struct(w.alias("term"), F.lit(1).alias("n"), F.lit(0).alias("docs"))),
        F.transform(F.array_distinct("t"), lambda w: F.struct(w.alias("term"), F.lit(0).alias("n"), F.lit(1).alias("docs"))),
    )).alias("m")).select("m.term", "m.n", "m.docs")
    return marks.groupBy("term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


ENGLISH = "english"


def stop_word_list(stop_words: list[str] | str | None) -> list[str]:
    """A list as it is, or the one of a language that Spark brings along."""
    if isinstance(stop_words, str):
        return fv.ENGLISH_STOP_WORDS if stop_words == ENGLISH else StopWordsRemover.loadDefaultStopWords(stop_words)
    return stop_words or []


def fit_tfidf(df: DataFrame, doc: str | None, text: str, max_terms: int = 1000, min_docs: int = 1,
              stop_words: list[str] | str | None = None, bigrams: bool = False) -> TfidfModel:
    """Smoothed idf over the ``max_terms`` most frequent terms; equal counts are cut in term order.

    ``doc`` names the entity whose rows form one document; None makes every row its own document.
    ``stop_words`` is a list or the name of a language whose list Spark brings along.
    """
    stop_words = stop_word_list(stop_words)
    if doc is None:
        totals, docs = _row_term_totals(df, text, stop_words, bigrams), df.count()
    else:
        totals = term_counts(df, doc, text, stop_words, bigrams).groupBy("term").agg(
            F.sum("tf").alias("n"), F.count(F.lit(1)).alias("docs"))
        docs = df.select(doc).distinct().count()
    vocabulary = totals.filter(F.col("docs") >= min_docs).orderBy(F.desc("n"), "term").limit(max_terms).collect()
    idf = [math.log((1 + docs) / (1 + r["docs"])) + 1.0 for r in vocabulary]
    return TfidfModel([r["term"] for r in vocabulary], idf, stop_words, bigrams)


# ---------------------------------------------------------------- log rows

NUMERIC_FEATURES = [
    "hc_cpu", "hc_mem", "message_len", "digit_count", "ip_count", "has_private_ip", "has_external_ip", "url_count",
    "status_5xx", "status_4xx", "rule_flag",
]


def full_text(level: Column, module: Column, message: Column) -> Column:
    unknown = F.lit("unknown")
    return F.concat_ws(" ", *[F.coalesce(c, unknown) for c in (level, module, message)])


def numeric_features(level: Column, module: Column, message: Column) -> dict[str, Column]:
    """The eleven numeric features of a log row."""
    msg = F.coalesce(message, F.lit("unknown"))
    cpu, mem = any_healthcheck_usage(msg)
    private = msg.rlike(fv.PRIVATE_IP_IN_TEXT)
    columns = [
        cpu, mem, F.length(msg), F.regexp_count(msg, F.lit(r"\d")), F.regexp_count(msg, F.lit(fv.ANY_IP)),
        private.cast("int"), (msg.rlike(fv.ANY_IP) & ~private).cast("int"), F.regexp_count(msg, F.lit("https?://")),
        msg.rlike(r"\s5\d{2}\s").cast("int"), msg.rlike(r"\s4\d{2}\s").cast("int"),
        (classify_entry(full_text(level, module, message)) == "anomaly").cast("int"),
    ]
    return {n: c.cast("double") for n, c in zip(NUMERIC_FEATURES, columns)}


def with_numeric_features(df: DataFrame, level: str = "log_level", module: str = "module", message: str = "message") -> DataFrame:
    cols = numeric_features(F.col(level), F.col(module), F.col(message))
    return df.select("*", *[c.alias(n) for n, c in cols.items()])


@dataclass(frozen=True)
class MinMax:
    """Column ranges of the training rows; a constant column scales to 0."""

    low: dict[str, float]
    high: dict[str, float]

    def scaled(self, name: str) -> Column:
        width = self.high[name] - self.low[name]
        if not width:
            return F.lit(0.0)
        return (F.col(name) - F.lit(self.low[name])) / F.lit(width)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({n: self.scaled(n) for n in self.low})


def fit_minmax(df: DataFrame, columns: list[str]) -> MinMax:
    row = df.agg(*[f(c).cast("double").alias(f"{p}{c}") for c in columns for f, p in ((F.min, "lo_"), (F.max, "hi_"))]).first()
    return MinMax({c: row[f"lo_{c}"] or 0.0 for c in columns}, {c: row[f"hi_{c}"] or 0.0 for c in columns})


@dataclass(frozen=True)
class Categories:
    """The values of text columns, numbered from 0 in order, as a table (column, value, index), and how many each has."""

    table: DataFrame
    sizes: dict[str, int]
    small: bool

    def with_index(self, df: DataFrame, column: str, output: str) -> DataFrame:
        """Add the number of the column's value; values not seen in training get the number behind the last."""
        own = self.table.filter(F.col("column") == column).select(F.col("value").alias("_value"), F.col("index").alias(output))
        joined = df.join(F.broadcast(own) if self.small else own, F.col(column).cast("string") == F.col("_value"), "left")
        return joined.drop("_value").withColumn(output, F.coalesce(output, F.lit(self.sizes[column])).cast("double"))

    def transform(self, df: DataFrame, suffix: str = "_vec") -> DataFrame:
        """Add a sparse 0/1 vector per column; nulls and values not seen in training give an all-zero vector."""
        for c, size in self.sizes.items():
            # The encoder learns how many values there are from the greatest index; a row of none stands for one that never comes.
            last = df.sparkSession.createDataFrame([(float(max(size, 1) - 1),)], f"`_index_{c}` double")
            encoder = OneHotEncoder(inputCols=[f"_index_{c}"], outputCols=[f"{c}{suffix}"], handleInvalid="keep", dropLast=True).fit(last)
            indexed = self.with_index(df, c, f"_index_{c}")
            if not size:
                indexed = indexed.withColumn(f"_index_{c}", F.lit(1.0))
            df = encoder.transform(indexed).drop(f"_index_{c}")
        return df

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, columns: list[str]) -> "Categories":
        return cls.of(spark.read.parquet(path), columns)

    @classmethod
    def of(cls, table: DataFrame, columns: list[str]) -> "Categories":
        found = {r["column"]: r for r in table.groupBy("column").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value") + 32).alias("bytes")).collect()}  # a row for each column
        sizes = {c: found[c]["n"] if c in found else 0 for c in columns}
        return cls(table, sizes, sum(r["bytes"] for r in found.values()) <= BROADCAST_BYTES)


def fit_categories(df: DataFrame, columns: list[str]) -> Categories:
    """The distinct values of the columns, any number of them; they are numbered on the executors."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
                      if columns else F.array().cast("array<struct<column:string,value:string>>"))
    values = df.select(pairs.alias("p")).select("p.column", "p.value").filter("value is not null").distinct()
    numbered = with_numbers(values, ["column", "value"], "_n")
    first = numbered.groupBy("column").agg(F.min("_n").alias("_first"))
    table = numbered.join(F.broadcast(first), "column").select("column", "value", (F.col("_n") - F.col("_first")).cast("int").alias("index"))
    return Categories.of(written(table, "categories"), columns)


def one_hot(df: DataFrame, categories: Categories, suffix: str = "_vec") -> DataFrame:
    """A sparse 0/1 vector per column; values not seen in training give an all-zero vector."""
    return categories.transform(df, suffix)


@dataclass(frozen=True)
class LogFeaturizer:
    """TF-IDF, one-hot level and module and scaled numbers, fitted on training rows only."""

    tfidf: TfidfModel
    categories: Categories
    ranges: MinMax

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        base = df.withColumns({c: F.coalesce(F.col(c), F.lit("unknown")) for c in ("log_level", "module", "message")})
        rows = self.ranges.transform(with_numeric_features(base))
        rows = one_hot(rows, self.categories)
        rows = self.tfidf.vectors(rows, full_text(F.col("log_level"), F.col("module"), F.col("message")), "_text")
        parts = ["_text", "log_level_vec", "module_vec", *NUMERIC_FEATURES]
        return VectorAssembler(inputCols=parts, outputCol=output, handleInvalid="keep").transform(rows).drop(*parts)

    @property
    def size(self) -> int:
        return len(self.tfidf.terms) + sum(max(n, 1) for n in self.categories.sizes.values()) + len(NUMERIC_FEATURES)


def fit_log_featurizer(df: DataFrame, max_terms: int = 5000, min_docs: int = 2,
                       stop_words: list[str] | str | None = ENGLISH, bigrams: bool = True) -> LogFeaturizer:
    base = df.withColumns({c: F.coalesce(F.col(c), F.lit("unknown")) for c in ("log_level", "module", "message")})
    text = base.withColumn("_t", full_text(F.col("log_level"), F.col("module"), F.col("message")))
    return LogFeaturizer(
        fit_tfidf(text, None, "_t", max_terms, min_docs, stop_words, bigrams),
        fit_categories(base, ["log_level", "module"]),
        fit_minmax(with_numeric_features(base), NUMERIC_FEATURES),
    )


# ---------------------------------------------------------------- flow tables

@dataclass(frozen=True)
class FlowFeaturizer:
    """One-hot text columns and numbers divided by their population deviation (no centring)."""

    categories: Categories
    scale: dict[str, float]

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        present = set(df.columns)
        rows = df.withColumns({c: F.lit(None).cast("string") for c in (*self.categories.sizes, *self.scale) if c not in present})
        rows = one_hot(rows, self.categories)
        names = {f"_n{i}": coerced(F.col(c)) / F.lit(s) for i, (c, s) in enumerate(self.scale.items())}
        rows = rows.withColumns(names)
        parts = [f"{c}_vec" for c in self.categories.sizes] + list(names)
        return VectorAssembler(inputCols=parts, outputCol=output).transform(rows).drop(*parts)


def coerced(col: Column) -> Column:
    """Number, with unreadable, NaN and infinite values as 0."""
    number = col.cast("string").try_cast("double")
    bad = number.isNull() | F.isnan(number) | (F.abs(number) == float("inf"))
    return F.when(bad, 0.0).otherwise(number)


def fit_flow_featurizer(df: DataFrame, drop: list[str]) -> FlowFeaturizer:
    kinds = {n: t for n, t in df.dtypes if n not in drop}
    texts = [n for n, t in kinds.items() if t == "string"]
    numbers = [n for n in kinds if n not in texts]
    scale: dict[str, float] = {}
    if numbers:
        row = df.agg(*[F.stddev_pop(coerced(F.col(c))).alias(c) for c in numbers]).first()
        scale = {c: (row[c] or 1.0) for c in numbers}
    return FlowFeaturizer(fit_categories(df, texts), scale)


def prefer_normal(df: DataFrame, label: str, style: str) -> DataFrame:
    """Normal-only training rows: ``zero`` (label = 0), ``prefix`` (starts with normal) or ``words``; all rows when none."""
    if label not in df.columns:
        return df
    value = F.lower(F.col(label).cast("string"))
    keep = {
        "zero": F.col(label).cast("string").try_cast("double") == 0,
        "prefix": value.startswith("normal"),
        "words": value.isin(*fv.NORMAL_FLOW_LABELS),
    }[style]
    normal = df.filter(keep)
    return df if normal.isEmpty() else normal
