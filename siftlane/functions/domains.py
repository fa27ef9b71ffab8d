"""Column functions on domains and rule texts. All of them are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Categories by priority; the smaller number wins.
CATEGORY_PRIORITY = {"malware": 0, "phishing": 1, "mining": 2, "tracking": 3, "ads": 4, "other": 99}
LEAST_PRIORITY = 99
#: Names that stand for the own machine.
LOCAL_NAMES = ["localhost", "localhost.localdomain", "localhost6", "localhost6.localdomain6", "local", "localdomain"]
#: Second labels that belong to the suffix in front of a country code.
SECOND_LEVEL = ["co", "com", "net", "org", "gov", "edu"]


#: White space of any kind.
SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip_space(text: Column) -> Column:
    """Without outer white space of any kind (Spark's ``trim`` takes blanks only)."""
    return F.btrim(text, F.lit(SPACE))


def _without_dots(text: Column) -> Column:
    """Without one dot at the end and one at the start."""
    return F.when(text.startswith(".") | text.endswith("."), F.regexp_replace(F.regexp_replace(text, r"\.$", ""), r"^\.", "")).otherwise(text)


def clean(domain: Column) -> Column:
    """Lower case, without outer white space, one dot at the end and one at the start."""
    return _without_dots(F.lower(strip_space(domain)))


def normalize(domain: Column, strip_www: bool = False) -> Column:
    """As :func:`clean`, and without ``*.`` in front; with ``strip_www`` without ``www.`` too."""
    lowered = F.lower(strip_space(domain))
    bare = _without_dots(F.when(lowered.startswith("*."), F.regexp_replace(lowered, r"^\*\.", "")).otherwise(lowered))
    return F.regexp_replace(bare, r"^www\.", "") if strip_www else bare


def is_ipv4(text: Column) -> Column:
    """Four numbers from 0 to 255."""
    part = r"(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9]))"
    return text.rlike(rf"^{part}(?:\.{part}){{3}}$")


def labels(domain: Column) -> Column:
    return F.split(domain, r"\.")


def ancestors(domain: Column, min_labels: int = 1) -> Column:
    """Strict parents, nearest first, with at least ``min_labels`` labels; empty for null and short domains."""
    parts = labels(domain)
    n = F.size(parts)
    least = max(1, min_labels)
    # sequence counts down where its end is below its start, hence the guard
    found = F.transform(F.sequence(F.lit(2), n - least + 1), lambda i: F.array_join(F.slice(parts, i, n), "."))
    return F.when(n > least, found).otherwise(F.array().cast("array<string>"))


def immediate_parent(domain: Column) -> Column:
    return F.when(domain.contains("."), F.regexp_replace(domain, r"^[^.]*\.", ""))


def suffix(domain: Column) -> Column:
    """The last two labels, or three where a country code follows a common second level; '' for ''."""
    parts = labels(domain)
    n = F.size(parts)
    three = (n >= 3) & F.get(parts, n - 2).isin(SECOND_LEVEL) & (F.length(F.get(parts, n - 1)) == 2)
    return F.when(n < 2, domain).otherwise(F.array_join(F.slice(parts, F.when(three, n - 2).otherwise(n - 1), F.when(three, 3).otherwise(2)), "."))


def priority(category: Column) -> Column:
    ordered = F.lit(LEAST_PRIORITY)
    for name, number in CATEGORY_PRIORITY.items():
        ordered = F.when(category == name, number).otherwise(ordered)
    return ordered


def output_text(rule_type: Column, domain: Column, wildcard: Column, modifiers: Column, raw: Column) -> Column:
    """``[@@]||[*.]domain^[$modifiers]``; a pattern as it is."""
    start = F.when(rule_type == "allow", "@@||").otherwise("||")
    text = F.concat(start, F.when(wildcard, "*.").otherwise(""), domain, F.lit("^"), F.when(modifiers != "", F.concat(F.lit("$"), modifiers)).otherwise(""))
    return F.when(domain == "", raw).otherwise(text)


def rule_kind(domain: Column, wildcard: Column) -> Column:
    """regex, wildcard, ip or domain, the first that holds."""
    return F.when(domain == "", "regex").when(wildcard, "wildcard").when(is_ipv4(domain), "ip").otherwise("domain")


def modifier_list(modifiers: Column) -> Column:
    return F.filter(F.transform(F.split(modifiers, ","), F.trim), lambda m: m != "")
