"""Typed, immutable options. A partial override is ``options.replace(...)``."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field


@dataclass(frozen=True)
class WebOptions:
    """Thresholds and extra words for the HTTP access-log signals."""

    large_bytes: int = 5000
    bruteforce_threshold: int = 5
    requests_per_minute: int = 100
    failure_statuses: tuple[int, ...] = (401, 403)
    sensitive_paths: tuple[str, ...] = ()
    scanner_agents: tuple[str, ...] = ()
    login_paths: tuple[str, ...] = ()
    case_sensitive: bool = True
    nulls_as_empty: bool = False

    def replace(self, **changes) -> "WebOptions":
        return dataclasses.replace(self, **changes)


# The values a report run uses when the caller overrides nothing.
REPORT_WEB_OPTIONS = WebOptions(
    large_bytes=1_048_576,
    bruteforce_threshold=10,
    requests_per_minute=120,
    sensitive_paths=("/admin", "/wp-admin", "/.git", "/config", "/etc/passwd"),
    scanner_agents=("sqlmap", "nikto", "acunetix"),
    login_paths=("/login", "/signin"),
)


@dataclass(frozen=True)
class EnrichOptions:
    enabled: bool = False
    top_n: int = 5


@dataclass(frozen=True)
class ReportOptions:
    """Everything a report run can be told."""

    web: WebOptions = REPORT_WEB_OPTIONS
    enrich: EnrichOptions = EnrichOptions()
    top_n_paths: int = 10
    top_n_large_paths: int = 5
    top_n_user_agents: int = 5
    custom_categories: dict[str, list[str]] = field(default_factory=dict)

    def replace(self, **changes) -> "ReportOptions":
        """Override fields; a dict given for ``web`` or ``enrich`` overrides only the keys it names."""
        known = {f.name for f in dataclasses.fields(self)}
        unknown = set(changes) - known
        if unknown:
            raise ValueError(f"unknown report options: {sorted(unknown)}")
        for name in ("web", "enrich"):
            if isinstance(changes.get(name), dict):
                changes[name] = dataclasses.replace(getattr(self, name), **changes[name])
        return dataclasses.replace(self, **changes)


@dataclass(frozen=True)
class TemplateOptions:
    """Template mining: the share of equal tokens that merges messages, and characters that count as blanks."""

    similarity: float = 0.4
    extra_delimiters: tuple[str, ...] = ()


COMPACT_TEMPLATES = TemplateOptions(
    similarity=0.2,
    extra_delimiters=(",", ";", ":", "(", ")", "[", "]", "{", "}", "<", ">", "\t"),
)


@dataclass(frozen=True)
class ForestOptions:
    trees: int = 100
    sample_size: int = 256
    contamination: float = 0.2
    seed: int = 42

    def replace(self, **changes) -> "ForestOptions":
        return dataclasses.replace(self, **changes)
