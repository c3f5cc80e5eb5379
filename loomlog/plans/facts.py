"""What reports are cut from: one scan of a log reduced to counts.

Every row names the facts it adds to - its categories, level, status, method, path, signals, address and minute, threat labels
- and the facts are counted by (kind, key) with a partial count in each task. The table of counts is written; it has a row for
each distinct value, not for each log row, and all counting sections of all reports are read from it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog import fixed_values as fv
from loomlog import schema
from loomlog.checkpoints import written
from loomlog.functions.ip import extract_ip_loose
from loomlog.functions.text import let, percent, to_number
from loomlog.operators import threats
from loomlog.operators import websignals as web
from loomlog.options import ReportOptions
from loomlog.rules import RuleSet

#: Between the parts of a key.
_SEP, _NULL = "\u0001", "\u0002"


def _key(*parts: Column) -> Column:
    return F.concat_ws(_SEP, *[F.coalesce(p.cast("string"), F.lit(_NULL)) for p in parts])


def _part(k: int) -> Column:
    return F.nullif(F.get(F.split("key", _SEP), F.lit(k)), F.lit(_NULL))


def attacker_ip(df: DataFrame, message: str) -> Column:
    """The address a row counts for: its ip column, else the one its texts name."""
    if "ip" in df.columns:
        return F.trim(F.col("ip").cast("string"))
    other = "Content" if message != "Content" else "message"
    names = ([other] if other in df.columns else []) + [message]
    return let(F.concat_ws(" ", *[F.col(n).cast("string") for n in names]), extract_ip_loose)


@dataclass
class Facts:
    """The counts (kind, key, n) of a log and the questions reports ask of them."""

    table: DataFrame
    access_like: bool
    by_address: bool
    opts: ReportOptions
    rules: RuleSet

    def of(self, kind: str) -> DataFrame:
        return self.table.filter(F.col("kind") == kind).select("key", "n")

    def total(self, kind: str, name: str) -> DataFrame:
        """One row with the count of a fact that has no key, 0 if no row had it."""
        return self.of(kind).agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))

    def _named(self, kind: str, names: list[str], column: str) -> DataFrame:
        frame = self.table.sparkSession.createDataFrame(list(enumerate(names)), f"ord int, {column} string")
        return frame.join(F.broadcast(self.of(kind).withColumnRenamed("key", column)), column, "left").withColumn("n", F.coalesce("n", F.lit(0)))

    def categories(self) -> DataFrame:
        """category, ord, is_baseline, n, pct for every category."""
        counts = self._named("category", self.rules.names, "category").crossJoin(F.broadcast(self.total("all", "_total")))
        return counts.select("category", "ord", F.col("category").isin(*self.rules.baseline).alias("is_baseline"), "n",
                             percent(F.col("n"), F.col("_total")).alias("pct"))

    def levels(self) -> DataFrame:
        one = self._named("level", list(fv.SEVERE_LEVELS), "level").select("level", "n")
        return one.unionByName(one.agg(F.lit("TOTAL").alias("level"), F.sum("n").alias("n")))

    def values(self, kind: str, column: str, top: int | None = None) -> DataFrame:
        """column, n by count, ties by value."""
        out = self.of(kind).withColumnRenamed("key", column).orderBy(F.desc("n"), column)
        return out.limit(top) if top else out

    def statuses(self) -> DataFrame:
        codes = self.of("status").crossJoin(F.broadcast(self.total("all", "_total")))
        return codes.select(F.col("key").cast("int").alias("status"), "n", percent(F.col("n"), F.col("_total"), 2).alias("pct")).orderBy("status")

    def status_classes(self) -> DataFrame:
        shares = self._named("class", ["2", "3", "4", "5"], "class").crossJoin(F.broadcast(self.total("all", "_total")))
        return shares.agg(*[F.max(F.when(F.col("class") == c, percent(F.col("n"), F.col("_total")))).alias(f"pct_{c}xx") for c in "2345"])

    def failed_logins(self) -> DataFrame:
        return self.of("failed_login").select(F.nullif("key", F.lit(_NULL)).alias("ip"), F.col("n").alias("failures")).filter(
            F.col("failures") >= self.opts.web.bruteforce_threshold)

    def busy_ips(self) -> DataFrame:
        minutes = self.of("minute").select(_part(0).alias("ip"), "n")
        return minutes.groupBy("ip").agg(F.max("n").alias("max_per_minute")).filter(F.col("max_per_minute") >= self.opts.web.requests_per_minute)

    def counters(self) -> DataFrame:
        """counter, n for all 19 counters, or the note of a log that is no access log."""
        if not self.access_like:
            return self.table.sparkSession.createDataFrame([(web.NOTE, None)], "counter string, n long")
        out = self._named("signal", list(fv.SIGNAL_NAMES), "counter").select("counter", "n")
        for name, rows in (("bruteforce_offenders", self.failed_logins()), ("high_freq_offenders", self.busy_ips())):
            out = out.unionByName(rows.agg(F.lit(name).alias("counter"), F.count(F.lit(1)).alias("n")))
        return out

    def attackers(self, top: int, linux: bool = False) -> DataFrame:
        return self.values("linux_attacker" if linux else "attacker", "ip", top)

    def threats(self, labels: list[str] | None = None) -> DataFrame:
        """The threat summary, from the counts of (label, address)."""
        hits = self.of("threat").select(_part(0).alias("key"), _part(1).alias("ip"), "n")
        return threats.summary_of(threats.labelled_counts(hits, self.opts.web.bruteforce_threshold, self.by_address), labels)

    def agents(self, top: DataFrame, limit: int = 10) -> DataFrame:
        """ip, user_agent: the most common agent of each of the top addresses."""
        head = top.orderBy(F.desc("n"), "ip").limit(limit).select("ip")
        pairs = self.of("agent").select(_part(0).alias("ip"), _part(1).alias("ua"), "n").join(F.broadcast(head), "ip", "left_semi")
        best = pairs.groupBy("ip").agg(F.min_by("ua", F.struct(-F.col("n"), F.col("ua"))).alias("ua"))
        return best.select("ip", F.substring("ua", 1, 32).alias("user_agent"))


def collect_facts(df: DataFrame, opts: ReportOptions, rules: RuleSet, message: str, linux_message: str, flagged: Column, linux_flagged: Column,
                  threat_rules: RuleSet | None = None) -> Facts:
    """Count all facts of ``df`` (with its request parts) in one scan; ``threat_rules`` adds the threat labels."""
    found: list[Column] = []

    def fact(kind: str, key: Column | None = None, when: Column | None = None) -> None:
        key = F.lit("") if key is None else key
        holds = key.isNotNull() if when is None else F.coalesce(when, F.lit(False)) & key.isNotNull()
        found.append(F.when(holds, F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"))))

    text = F.col(message)
    fact("all")
    for name in rules.names:
        fact("category", F.lit(name), rules.matches(name, text))
    level = schema.level_column(df)
    if level:
        value = F.upper(F.trim(F.col(level)))
        fact("level", value, value.isin(*fv.SEVERE_LEVELS))
    if "status" in df.columns:
        code = to_number(F.col("status")) if dict(df.dtypes)["status"] == "string" else F.col("status")
        fact("status", code.cast("int"))
        number = web.number_column(df, "status", -1)
        for c in (2, 3, 4, 5):
            fact("class", F.lit(str(c)), number.between(c * 100, c * 100 + 99))
    for name in ("method", "path"):
        if name in df.columns:
            fact(name, F.col(name))
    access_like = web.is_access_like(df)
    if access_like:
        signals, ip = web.signal_columns(df, opts.web), schema.text_or(df, "ip")
        for name, column in signals.items():
            fact("signal", F.lit(name), column)
        if "path" in df.columns:
            fact("suspicious_path", F.col("path"), signals["suspicious_endpoints"])
        if "user_agent" in df.columns:
            fact("malicious_agent", F.col("user_agent"), signals["malicious_user_agent"])
        fact("failed_login", _key(ip), signals["bruteforce_events"])
        if "timestamp" in df.columns:
            minute = web.minute_of(df, "timestamp")
            fact("minute", _key(ip, minute), minute.isNotNull())
    fact("flagged", None, flagged)
    fact("attacker", attacker_ip(df, message), flagged)
    fact("linux_attacker", attacker_ip(df, linux_message), linux_flagged)
    ip_name, agent = schema.ip_column(df), schema.agent_column(df)
    if ip_name and agent:
        fact("agent", _key(F.col(ip_name), F.col(agent)), F.col(ip_name).isNotNull() & F.col(agent).isNotNull())
    every = F.filter(F.array(*found), lambda x: x.isNotNull())
    if threat_rules is not None:
        address = F.col(ip_name).cast("string") if ip_name else F.lit(None).cast("string")
        hits = threats.label_hits(df, threat_rules, message)
        every = F.concat(every, F.transform(hits, lambda k: F.struct(F.lit("threat").alias("kind"), _key(k, address).alias("key"))))
    counts = df.select(F.explode(every).alias("f")).groupBy("f.kind", "f.key").agg(F.count(F.lit(1)).alias("n"))
    return Facts(written(counts, "facts"), access_like, ip_name is not None, opts, rules)
