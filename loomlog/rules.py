"""Rule sets: ordered categories of regexes, checked when they are built."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog import fixed_values as fv


class RuleError(ValueError):
    """A rule that cannot be used; the message names the category and the pattern."""


def _checked(category: str, patterns: Sequence[str]) -> tuple[str, ...]:
    for pattern in patterns:
        try:
            re.compile(pattern)
        except re.error as exc:
            raise RuleError(f"category {category!r}: bad pattern {pattern!r}: {exc}") from exc
    return tuple(patterns)


def any_of(patterns: Sequence[str], ignore_case: bool = False) -> str:
    """One regex that matches when any of ``patterns`` does, so each row is searched once per category."""
    body = "|".join(f"(?:{p})" for p in patterns)
    return f"(?i){body}" if ignore_case else body


@dataclass(frozen=True)
class RuleSet:
    """Ordered ``category -> patterns``; ``baseline`` names the categories that count as generic."""

    categories: tuple[tuple[str, tuple[str, ...]], ...]
    baseline: frozenset[str] = frozenset()
    ignore_case: bool = True

    @classmethod
    def of(cls, categories: Mapping[str, Sequence[str]], baseline=(), ignore_case: bool = True) -> "RuleSet":
        checked = tuple((name, _checked(name, pats)) for name, pats in categories.items())
        return cls(checked, frozenset(baseline), ignore_case)

    def extended(self, custom: Mapping[str, Sequence[str]] | None) -> "RuleSet":
        """Add categories; one with an existing name replaces that category's patterns in place."""
        merged = dict(self.categories)
        for name, patterns in (custom or {}).items():
            merged[name] = _checked(name, patterns or ())
        return RuleSet(tuple(merged.items()), self.baseline, self.ignore_case)

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.categories]

    def matches(self, name: str, message: Column) -> Column:
        """Non-null boolean: does ``message`` fall in the category? A null message never does."""
        patterns = dict(self.categories)[name]
        if not patterns:
            return F.lit(False)
        return F.coalesce(message.rlike(any_of(patterns, self.ignore_case)), F.lit(False))

    def table(self, spark: SparkSession) -> DataFrame:
        """The rules as rows: category, regex, position, is_baseline."""
        rows = [
            (name, pattern, i, name in self.baseline)
            for i, (name, pats) in enumerate(self.categories)
            for pattern in pats
        ]
        return spark.createDataFrame(rows, "category string, regex string, ord int, is_baseline boolean")


BASELINE_RULES = RuleSet.of(fv.BASELINE_CATEGORIES, baseline=fv.BASELINE_CATEGORIES)
ALL_RULES = BASELINE_RULES.extended(fv.DOMAIN_CATEGORIES)
# Threat labels and the tuple detector honour each pattern's own case flag.
DOMAIN_RULES = RuleSet.of(fv.DOMAIN_CATEGORIES, ignore_case=False)
TUPLE_RULES = RuleSet.of(fv.TUPLE_DETECTOR_CATEGORIES, ignore_case=False)
