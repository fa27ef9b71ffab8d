"""Lines of rule lists to rules, as one narrow projection.

The first form that matches decides: blank, comment, cosmetic, address, pattern,
then - behind the modifiers being split off - allow, block, hosts line (IPv4, IPv6),
plain wildcard, plain domain; what matches none is dropped without a count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import domains as D
from ..functions.stages import computed

#: Modifiers that name resolution knows.
FLAGS = ["important", "badfilter"]
VALUED = ["dnstype", "dnsrewrite", "client", "ctag", "ipset", "resolver"]
#: The forms of a line. ``(?U)`` makes white space and digits Unicode's.
COMMENT = r"^!|^#(?!#|@#|%)"
COSMETIC = r"#@?#|#%#"
ADDRESS = r"^\|?https?://"
PATTERN = r"^(?:@@)?/.+/\$?[a-z,]*$"
PATTERN_FLAGS = r"^((?:@@)?.+/)\$([a-z,]+)$"
NAME = r"(?U)^(?:@@)?\|\|([^/^\s$]+)"
HOSTS_4 = r"(?U)^(?:\d{1,3}\.){3}\d{1,3}\s+(\S+)"
HOSTS_6 = r"(?U)^(?:(?:[0-9a-fA-F]{0,4}:){2,7}[0-9a-fA-F]{0,4}|::1?)\s+(\S+)"
WILDCARD = r"^\*\.([a-zA-Z0-9][-a-zA-Z0-9]*\.)+[a-zA-Z]{2,}$"
PLAIN = r"^([a-zA-Z0-9][-a-zA-Z0-9]*\.)+[a-zA-Z]{2,}$"


@dataclass(frozen=True)
class ParseOptions:
    """Bounds and switches of the quality filter."""

    strip_www: bool = False
    quality_filter: bool = True
    min_domain_length: int = 4
    max_domain_length: int = 253
    filter_localhost: bool = True
    filter_ip_rules: bool = False


def _pattern_text(line: Column) -> Column:
    """A pattern with its flags sorted and once each."""
    flags = F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(F.regexp_extract(line, PATTERN_FLAGS, 2), ","), lambda f: f != ""))), ",")
    return F.when(line.rlike(PATTERN_FLAGS), F.concat(F.regexp_extract(line, PATTERN_FLAGS, 1), F.lit("$"), flags)).otherwise(line)


def _modifiers(section: Column) -> tuple[Column, Column]:
    """Modifiers of a section (flags first, then those with values, sorted each), and whether any was dropped."""
    items = F.filter(F.transform(F.split(section, ","), D.strip_space), lambda m: m != "")
    key = lambda m: F.lower(D.strip_space(F.substring_index(m, "=", 1)))
    value = lambda m: D.strip_space(F.regexp_replace(m, r"^[^=]*=", ""))
    flags = F.filter(F.transform(F.filter(items, lambda m: ~m.contains("=")), F.lower), lambda m: m.isin(FLAGS))
    valued = F.transform(F.filter(items, lambda m: m.contains("=") & key(m).isin(VALUED)), lambda m: F.concat(key(m), F.lit("="), value(m)))
    dropped = F.exists(items, lambda m: ~F.when(m.contains("="), key(m).isin(VALUED)).otherwise(F.lower(m).isin(FLAGS)))
    tidy = lambda a: F.array_sort(F.array_distinct(a))
    return F.array_join(F.concat(tidy(flags), tidy(valued)), ","), dropped


def _poor(domain: Column, o: ParseOptions) -> Column:
    """Whether the quality filter rejects a domain."""
    if not o.quality_filter:
        return F.lit(False)
    bare = F.when(domain.startswith("*."), F.regexp_replace(domain, r"^\*\.", "")).otherwise(domain)
    poor = (F.length(bare) < o.min_domain_length) | (F.length(bare) > o.max_domain_length) | ~bare.contains(".") | bare.startswith(".") | bare.endswith(".") | bare.contains("..")
    if o.filter_localhost:
        poor = poor | bare.isin(D.LOCAL_NAMES) | bare.endswith(".localhost") | bare.endswith(".local")
    if o.filter_ip_rules:
        poor = poor | D.is_ipv4(bare)
    return poor


def parse(lines: DataFrame, options: ParseOptions = ParseOptions()) -> DataFrame:
    """Rules and drops of ``source_ord, line_no, line, category``.

    Result, one row per line: ``source_ord, line_no, category, rule_type, domain,
    wildcard, modifiers, raw, modifier_stripped, drop_reason``. A rule has a null
    drop_reason; its domain is '' for a pattern. Reasons: blank, comment, css, url,
    pattern, quality, and none for lines of no known form. A null line is blank.
    """
    s = F.col("_s")
    stripped = computed(lines.select("source_ord", "line_no", "category", "line"), {"_s": D.strip_space(F.coalesce("line", F.lit("")))})
    # cheap tests stand in front of the patterns they stand for
    comment = s.startswith("!") | (s.startswith("#") & s.rlike(COMMENT))
    early = F.when(s == "", "blank").when(comment, "comment").when(s.contains("#") & s.rlike(COSMETIC), "css").when(s.contains("://") & s.rlike(ADDRESS), "url")
    stage = computed(stripped, {"_early": early, "_pattern": (s.startswith("/") | s.startswith("@@/")) & s.rlike(PATTERN)})
    rule = F.col("_early").isNull() & ~F.col("_pattern")
    has = s.contains("$")
    text, dropped = _modifiers(F.when(has, F.regexp_replace(s, r"(?s)^[^$]*\$", "")).otherwise(""))
    split = computed(stage, {"_b": F.when(rule, F.when(has, D.strip_space(F.substring_index("_s", "$", 1))).otherwise(s)).otherwise(""), "_m": F.when(rule & has, text).otherwise(""), "_x": rule & has & dropped})
    b = F.col("_b")
    lead = F.when(b.startswith("@@||"), 4).when(b.startswith("||"), 2).otherwise(0)
    marked = computed(split, {"_lead": lead, "_name": F.when(b.startswith("@@||") | b.startswith("||"), F.regexp_extract(b, NAME, 1)).otherwise("")})
    name = F.col("_name")
    bare = (F.col("_lead") == 0) & (b != "")
    # lines of hosts files hold white space and plain domains none, so these may be tried first
    form = (
        F.when(name != "", F.when(F.col("_lead") == 4, "allow").otherwise("block"))
        .when(bare & b.startswith("*.") & b.rlike(WILDCARD), "wildcard")
        .when(bare & b.rlike(PLAIN), "plain")
        .when(bare & b.rlike(HOSTS_4), "hosts4")
        .when(bare & b.contains(":") & b.rlike(HOSTS_6), "hosts6")
    )
    named = computed(marked, {"_form": form})
    f = F.col("_form")
    text_of = F.when(name != "", name).when(f == "hosts4", F.regexp_extract(b, HOSTS_4, 1)).when(f == "hosts6", F.regexp_extract(b, HOSTS_6, 1)).otherwise(b)
    behind = F.expr("substring(_b, _lead + length(_name) + 1)")
    rest = F.when(name != "", F.when(behind.startswith("^"), F.expr("substring(_b, _lead + length(_name) + 2)")).otherwise(behind)).otherwise("")
    found = computed(named, {"_d": D.clean(text_of), "_rest": rest})
    d = F.col("_d")
    hosts = f.isin("hosts4", "hosts6")
    bad_star = d.contains("*") & ~(d.startswith("*.") & ~F.expr("substring(_d, 3)").contains("*"))
    reason = (
        F.when(F.col("_early").isNotNull(), F.col("_early"))
        .when(F.col("_pattern"), None)
        .when(f.isNull(), "none")
        .when(F.col("_rest") != "", "pattern")
        .when(hosts & d.isin(D.LOCAL_NAMES), "none")
        .when(hosts & d.contains("*"), "pattern")
        .when(d == "", "none")
        .when(bad_star, "pattern")
        .when(_poor(d, options), "quality")
    )
    kept = computed(found, {"drop_reason": reason})
    ok, is_pattern = F.col("drop_reason").isNull(), F.col("_pattern")
    allow = F.when(is_pattern, s.startswith("@@")).otherwise(f == "allow")
    tail = F.when(F.col("_m") != "", F.concat(F.lit("$"), F.col("_m"))).otherwise("")
    raw = F.when(is_pattern, _pattern_text(s)).otherwise(F.concat(F.when(f == "allow", "@@||").otherwise("||"), d, F.lit("^"), tail))
    done = computed(
        kept,
        {
            "rule_type": F.when(ok, F.when(allow, "allow").otherwise("block")),
            "domain": F.when(ok, F.when(is_pattern, "").otherwise(D.normalize(d, options.strip_www))),
            "wildcard": F.when(ok, ~is_pattern & d.startswith("*.")),
            "modifiers": F.when(ok, F.when(is_pattern, "").otherwise(F.col("_m"))),
            "raw": F.when(ok, raw),
        },
    )
    return done.select("source_ord", "line_no", "category", "rule_type", "domain", "wildcard", "modifiers", "raw", F.col("_x").alias("modifier_stripped"), "drop_reason")


def rules_of(parsed: DataFrame) -> DataFrame:
    return parsed.filter("drop_reason IS NULL").drop("drop_reason")


def drop_counters(parsed: DataFrame) -> DataFrame:
    """``source_ord`` with counts of lines dropped as pattern, quality, css and comment, and of lines that lost modifiers."""
    named = {f"{r}_dropped": F.count_if(F.col("drop_reason") == r) for r in ("pattern", "quality", "css", "comment")}
    return parsed.groupBy("source_ord").agg(*[c.alias(n) for n, c in named.items()], F.count_if("modifier_stripped").alias("modifier_stripped"))


def raw_counts(parsed: DataFrame) -> DataFrame:
    """Rules that each source brought, before any merging."""
    return parsed.groupBy("source_ord").agg(F.count_if(F.col("drop_reason").isNull()).alias("raw_rules"))
