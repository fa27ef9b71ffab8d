"""Configuration of a merge: YAML, checked field by field, with all problems at once."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from .functions.domains import CATEGORY_PRIORITY
from .operators.audit import LAYERS, SIGNALS, WEIGHTS, AuditOptions
from .operators.compile import CompileOptions, FoldOptions
from .operators.parse import ParseOptions
from .plans.exports import FORMATS


class ConfigError(ValueError):
    """All problems of a configuration, one a line."""

    def __init__(self, problems: list[str]):
        super().__init__("\n".join(problems))
        self.problems = problems


@dataclass(frozen=True)
class Source:
    name: str
    url: str
    category: str = "other"
    enabled: bool = True
    id: int | None = None
    timeout: int = 60


@dataclass(frozen=True)
class AuditConfig:
    """The audit of allow rules: its options, the tables and feeds that it reads, and what it writes."""

    enabled: bool = False
    options: AuditOptions = AuditOptions()
    #: Signal tables by name (Parquet), and feeds by source: ``hosts:NAME`` or ``csv:NAME`` with a path or address.
    signals: dict[str, str] = field(default_factory=dict)
    feeds: dict[str, str] = field(default_factory=dict)
    feed_ttl_seconds: int = 3600
    known_domains: str | None = None
    ai_replies: str | None = None
    cache_results: bool = False
    by_rating: bool = True
    by_category: bool = True
    include_all_ratings: bool = False
    categories: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class MergeConfig:
    sources: list[Source]
    parse: ParseOptions = ParseOptions()
    compile: CompileOptions = CompileOptions()
    audit: AuditConfig = AuditConfig()
    formats: list[str] = field(default_factory=lambda: ["hosts", "domains"])
    tiered: bool = True
    diff: bool = True
    suffix_list: str | None = None
    failure_threshold: float = 0.5
    retries: int = 2
    retry_delay: float = 1.0
    backoff: str = "linear"
    concurrency: int = 50
    source_deadline: float = 120.0
    cache_folder: str | None = None
    cache_ttl_seconds: int = 0
    negative_ttl_seconds: int = 0
    cache_parsed: bool = True
    use_cache: bool = True

    @property
    def enabled(self) -> list[Source]:
        return [s for s in self.sources if s.enabled]


#: Section, key, kind and bounds of each setting, and where it goes.
_SETTINGS: list[tuple[str, str, type, float | None, float | None]] = [
    ("parse", "strip_www", bool, None, None),
    ("parse", "quality_filter", bool, None, None),
    ("parse", "min_domain_length", int, 1, 253),
    ("parse", "max_domain_length", int, 1, 253),
    ("parse", "filter_localhost", bool, None, None),
    ("parse", "filter_ip_rules", bool, None, None),
    ("fold", "enabled", bool, None, None),
    ("fold", "min_labels", int, 1, 10),
    ("fold", "fold_wildcards", bool, None, None),
    ("fold", "promotion_threshold", int, 0, None),
    ("fold", "mode", str, None, None),
    ("fold", "pattern_ratio", float, 0, 1),
    ("conflicts", "enabled", bool, None, None),
    ("conflicts", "cascade", bool, None, None),
    ("download", "failure_threshold", float, 0, 1),
    ("download", "retries", int, 0, 10),
    ("download", "retry_delay", float, 0, 60),
    ("download", "backoff", str, None, None),
    ("download", "concurrency", int, 1, 1000),
    ("download", "source_deadline", float, 0, 3600),
    ("fold", "suffix_guard", bool, None, None),
    ("fold", "suffix_list", str, None, None),
    ("cache", "folder", str, None, None),
    ("cache", "ttl_seconds", int, 0, None),
    ("cache", "negative_ttl_seconds", int, 0, None),
    ("cache", "parsed", bool, None, None),
    ("cache", "enabled", bool, None, None),
    ("output", "tiered", bool, None, None),
    ("output", "diff", bool, None, None),
    ("audit", "enabled", bool, None, None),
    ("audit", "new_domain_days", int, 1, 3650),
    ("audit", "ai_min_confidence", float, 0, 1),
    ("audit", "ai_max_domains", int, 0, 1_000_000),
    ("audit", "cache_results", bool, None, None),
    ("audit", "cache_ttl_seconds", int, 0, None),
    ("audit", "feed_ttl_seconds", int, 0, None),
    ("audit", "known_domains", str, None, None),
    ("audit", "ai_replies", str, None, None),
    ("allow_output", "by_rating", bool, None, None),
    ("allow_output", "by_category", bool, None, None),
    ("allow_output", "include_all_ratings", bool, None, None),
]
_CHOICES = {("fold", "mode"): ["count", "pattern"], ("download", "backoff"): ["linear", "exponential"]}


def _resolved(value: Any) -> Any:
    """``${NAME}`` from the environment."""
    if isinstance(value, str):
        return re.sub(r"\$\{(\w+)\}", lambda m: os.environ.get(m[1], ""), value)
    return value


def check_config(document: Any) -> tuple[dict[tuple[str, str], Any], list[Source], list[str], list[str]]:
    """(settings, sources, formats, problems) of a parsed document."""
    problems: list[str] = []
    document = document if isinstance(document, dict) else {}
    settings: dict[tuple[str, str], Any] = {}
    for section, key, kind, low, high in _SETTINGS:
        part = document.get(section) or {}
        if not isinstance(part, dict):
            problems.append(f"{section}: must be a mapping")
            continue
        if key not in part:
            continue
        value = _resolved(part[key])
        if kind is float and isinstance(value, int) and not isinstance(value, bool):
            value = float(value)
        if not isinstance(value, kind) or (kind is int and isinstance(value, bool)):
            problems.append(f"{section}.{key}: must be {kind.__name__}")
        elif (low is not None and value < low) or (high is not None and value > high):
            problems.append(f"{section}.{key}: must be from {low} to {high}")
        elif (section, key) in _CHOICES and value not in _CHOICES[section, key]:
            problems.append(f"{section}.{key}: must be one of {', '.join(_CHOICES[section, key])}")
        else:
            settings[section, key] = value
    if settings.get(("parse", "min_domain_length"), 4) > settings.get(("parse", "max_domain_length"), 253):
        problems.append("parse.min_domain_length: must not exceed max_domain_length")
    sources: list[Source] = []
    for i, raw in enumerate(document.get("sources") or []):
        if not isinstance(raw, dict) or not raw.get("name") or not raw.get("url"):
            problems.append(f"sources[{i}]: needs name and url")
            continue
        if raw.get("category", "other") not in CATEGORY_PRIORITY:
            problems.append(f"sources[{i}].category: must be one of {', '.join(CATEGORY_PRIORITY)}")
        if not isinstance(raw.get("timeout", 60), int) or not 1 <= raw.get("timeout", 60) <= 600:
            problems.append(f"sources[{i}].timeout: must be from 1 to 600")
            continue
        sources.append(Source(str(raw["name"]), str(_resolved(raw["url"])), raw.get("category", "other"), bool(raw.get("enabled", True)), raw.get("id"), int(raw.get("timeout", 60))))
    if not any(s.enabled for s in sources):
        problems.append("sources: at least one must be enabled")
    for what in ("url", "id"):
        values = [getattr(s, what) for s in sources if getattr(s, what) is not None]
        for v in sorted({v for v in values if values.count(v) > 1}, key=str):
            problems.append(f"sources: {what} {v} stands twice")
    formats = (document.get("output") or {}).get("formats", ["hosts", "domains"])
    for f in formats:
        if f not in FORMATS:
            problems.append(f"output.formats: {f} is none of {', '.join(FORMATS)}")
    return settings, sources, list(formats), problems


def _maps(document: Any, problems: list[str]) -> dict[str, Any]:
    """Settings of the audit that are lists or maps."""
    part = document.get("audit") if isinstance(document, dict) else None
    part = part if isinstance(part, dict) else {}
    allow = document.get("allow_output") if isinstance(document, dict) else None
    found = {"off": part.get("off") or [], "weights": part.get("weights") or {}, "signals": part.get("signals") or {}, "feeds": part.get("feeds") or {}, "categories": (allow or {}).get("categories") or [] if isinstance(allow, dict) else []}
    for key, kind in (("off", list), ("weights", dict), ("signals", dict), ("feeds", dict), ("categories", list)):
        if not isinstance(found[key], kind):
            problems.append(f"audit.{key}: must be a {'list' if kind is list else 'mapping'}")
            found[key] = kind()
    for key, known in (("off", LAYERS), ("weights", list(WEIGHTS)), ("signals", list(SIGNALS))):
        problems += [f"audit.{key}: {x} is none of {', '.join(known)}" for x in found[key] if x not in known]
    problems += [f"audit.weights.{k}: must be from 0 to 100" for k, v in found["weights"].items() if not isinstance(v, int) or not 0 <= v <= 100]
    problems += [f"audit.feeds: {k} must begin with hosts: or csv:" for k in found["feeds"] if str(k).split(":")[0] not in ("hosts", "csv")]
    return found


def load_config(path: str, use_cache: bool = True) -> MergeConfig:
    """Reads and checks a YAML file; raises :class:`ConfigError` with everything that is wrong."""
    import yaml

    document = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    settings, sources, formats, problems = check_config(document)
    maps = _maps(document, problems)
    if problems:
        raise ConfigError(problems)
    of = lambda section, *but: {k: v for (s, k), v in settings.items() if s == section and k not in but}
    get = lambda section, key, other: settings.get((section, key), other)
    compile_ = CompileOptions(fold=FoldOptions(**of("fold", "enabled", "suffix_list")), folding=get("fold", "enabled", True), cascade=get("conflicts", "cascade", True), resolve_conflicts=get("conflicts", "enabled", True), provenance=True)
    options = AuditOptions(weights=WEIGHTS | maps["weights"], off=tuple(maps["off"]), **{k: v for k, v in of("audit").items() if k in ("new_domain_days", "ai_min_confidence", "ai_max_domains", "cache_ttl_seconds")})
    audit = AuditConfig(options=options, signals=maps["signals"], feeds=maps["feeds"], categories=maps["categories"], **of("allow_output"), **{k: v for k, v in of("audit").items() if k in ("enabled", "feed_ttl_seconds", "known_domains", "ai_replies", "cache_results")})
    return MergeConfig(
        sources, ParseOptions(**of("parse")), compile_, audit, formats, **of("output"), **of("download"), suffix_list=get("fold", "suffix_list", None),
        cache_folder=get("cache", "folder", None), cache_ttl_seconds=get("cache", "ttl_seconds", 0), negative_ttl_seconds=get("cache", "negative_ttl_seconds", 0), cache_parsed=get("cache", "parsed", True), use_cache=use_cache and get("cache", "enabled", True),
    )
