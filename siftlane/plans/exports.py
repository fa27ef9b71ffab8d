"""Text formats of a compiled rule set, as lines in their final order."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import domains as D
from ..operators import compile as K
from ..operators import stats as S

#: How a bare domain is written in each format.
FORMATS = {"hosts": ("0.0.0.0 ", ""), "domains": ("", ""), "clash": ("  - DOMAIN-SUFFIX,", ""), "surge": ("DOMAIN-SUFFIX,", ""), "smartdns": ("address /", "/#")}
KINDS = ["block", "allow", "tiered", *FORMATS]


def lines(kind: str, blocks: DataFrame, allows: DataFrame) -> DataFrame:
    """``line`` (and ``category`` for tiered) of one format, ordered. Formats of bare domains leave rules with modifiers out."""
    if kind in FORMATS:
        before, after = FORMATS[kind]
        return S.plain_domains(blocks).orderBy("domain").select(F.concat(F.lit(before), "domain", F.lit(after)).alias("line"))
    rules = K.ordered(allows if kind == "allow" else blocks)
    text = D.output_text(F.col("rule_type"), F.col("domain"), F.col("wildcard"), F.col("modifiers"), F.col("raw"))
    return rules.select("category", text.alias("line")) if kind == "tiered" else rules.select(text.alias("line"))


def _ordered_lines(frame: DataFrame) -> Iterator[str]:
    """Lines in order, one partition at a time on the driver."""
    return (row["line"] for row in frame.select("line").toLocalIterator())


def write_list(frame: DataFrame, path: str, header: list[str]) -> int:
    """One text file with a header; written beside and then renamed. Gives the number of lines."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    beside = target.with_suffix(target.suffix + ".tmp")
    n = 0
    with beside.open("w", encoding="utf-8", newline="\n") as f:
        for text in header:
            f.write(f"! {text}\n")
        for text in _ordered_lines(frame):
            f.write(text + "\n")
            n += 1
    beside.replace(target)
    return n


def write_parts(frame: DataFrame, path: str) -> None:
    """Ordered text files, one per partition; for sizes one file can't hold."""
    frame.select("line").write.mode("overwrite").text(path)


def write_tiers(frame: DataFrame, path: str) -> None:
    """A folder per category."""
    frame.select("category", "line").write.mode("overwrite").partitionBy("category").text(path)


def content_version(blocks: DataFrame, allows: DataFrame) -> str:
    """The first twelve hexadecimal digits of SHA-256 over all lines in order, from one sort."""
    digest = hashlib.sha256()
    for text in _ordered_lines(numbered(blocks.unionByName(allows))):
        digest.update(text.encode() + b"\n")
    return digest.hexdigest()[:12]


def write_json(document: object, path: str) -> None:
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    beside = target.with_suffix(target.suffix + ".tmp")
    beside.write_text(json.dumps(document, ensure_ascii=False, indent=2, default=str), encoding="utf-8")
    beside.replace(target)


def numbered(rules: DataFrame) -> DataFrame:
    """``rule_type, category, domain, bare, line`` of a final rule set in its total order; ``bare`` tells whether formats of bare domains take the rule."""
    text = D.output_text(F.col("rule_type"), F.col("domain"), F.col("wildcard"), F.col("modifiers"), F.col("raw"))
    bare = (F.col("rule_type") == "block") & (F.col("modifiers") == "") & (F.col("domain") != "")
    return K.ordered(rules).select("rule_type", "category", "domain", bare.alias("bare"), text.alias("line"))


class _File:
    """A text file whose header is known last: written beside, then put behind its header."""

    def __init__(self, path: Path):
        path.parent.mkdir(parents=True, exist_ok=True)
        self.path, self.beside, self.lines, self.digest = path, path.with_suffix(path.suffix + ".tmp"), 0, hashlib.sha256()
        self.out = self.beside.open("w", encoding="utf-8", newline="\n")

    def add(self, line: str) -> None:
        self.out.write(line + "\n")
        self.digest.update(line.encode() + b"\n")
        self.lines += 1

    def close(self, title: str, version: str | None = None) -> None:
        self.out.close()
        whole = self.path.with_suffix(self.path.suffix + ".new")
        with whole.open("w", encoding="utf-8", newline="\n") as out, self.beside.open(encoding="utf-8", newline="\n") as body:
            out.write(f"! version: {version or self.digest.hexdigest()[:12]}\n! title: {title}\n! count: {self.lines}\n")
            while part := body.read(1 << 20):
                out.write(part)
        whole.replace(self.path)
        self.beside.unlink()


def write_all(lines: DataFrame, out: str, formats: list[str], tiered: bool) -> tuple[str, dict[str, int]]:
    """All lists of a rule set from one pass over :func:`numbered` lines, one partition at a time on the driver.

    Gives the content version (over all lines in order) and the lines of each file. For
    sets that one machine can't hold, :func:`write_parts` writes without the driver.
    """
    files = {kind: _File(Path(out, f"{kind}.txt")) for kind in ("block", "allow", *formats)}
    tiers: dict[str, _File] = {}
    digest, last = hashlib.sha256(), None
    for row in lines.toLocalIterator():
        files[row["rule_type"]].add(row["line"])
        digest.update(row["line"].encode() + b"\n")
        if row["rule_type"] == "block" and tiered:
            name = row["category"] or "other"
            if name not in tiers:
                tiers[name] = _File(Path(out, "tiered", f"{name}.txt"))
            tiers[name].add(row["line"])
        if row["bare"] and row["domain"] != last:
            last = row["domain"]
            for kind in formats:
                before, after = FORMATS[kind]
                files[kind].add(before + last + after)
    version = digest.hexdigest()[:12]
    for kind, file in files.items():
        file.close(kind, version)
    for name, file in tiers.items():
        file.close(f"{name} rules")
    return version, {kind: f.lines for kind, f in files.items()} | {f"tier:{k}": f.lines for k, f in tiers.items()}


def write_graded(records: DataFrame, out: str, by_rating: bool = True, by_category: bool = True, include_all_ratings: bool = False, only: list[str] | None = None) -> dict[str, int]:
    """Allow lists by rating (``allow_safe.txt``) and by rating and category (``allow_by_category/safe_cdn.txt``, safe ones only unless all are asked for); categories not in ``only`` become other. Gives the lines of each file."""
    files: dict[str, _File] = {}
    for row in records.select("rating", "category", "rule").toLocalIterator():
        names = [f"allow_{row['rating']}.txt"] if by_rating else []
        if by_category and (include_all_ratings or row["rating"] == "safe"):
            category = row["category"] if not only or row["category"] in only else "other"
            names.append(f"allow_by_category/{row['rating']}_{category}.txt")
        for name in names:
            if name not in files:
                files[name] = _File(Path(out, name))
            files[name].add(row["rule"])
    for name, file in files.items():
        file.close(Path(name).stem.replace("_", " "))
    return {name: f.lines for name, f in files.items()}


def write_json_rows(frame: DataFrame, path: str, first: int = 0, change: Callable[[dict[str, object]], dict[str, object]] = lambda r: r) -> list[dict[str, object]]:
    """All rows in order as one JSON array, one partition at a time on the driver. Gives the ``first`` rows."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    beside = target.with_suffix(target.suffix + ".tmp")
    kept: list[dict[str, object]] = []
    between = "[\n  "
    with beside.open("w", encoding="utf-8", newline="\n") as f:
        for row in frame.toLocalIterator():
            document = change(row.asDict())
            f.write(between + json.dumps(document, ensure_ascii=False, indent=2, default=str).replace("\n", "\n  "))
            between = ",\n  "
            if len(kept) < first:
                kept.append(document)
        f.write("[]" if between[0] == "[" else "\n]")
    beside.replace(target)
    return kept


def script_safe(document: object) -> str:
    """JSON that can stand inside a script element."""
    return json.dumps(document, ensure_ascii=False, default=str).replace("</", "<\\/")


def graded_allow_lines(audited: DataFrame, include_all_ratings: bool = False, only: list[str] | None = None) -> DataFrame:
    """``rating, category, line`` of audited allow rules; categories not in ``only`` become other."""
    rated = audited if include_all_ratings else audited.filter("rating = 'safe'")
    category = F.coalesce("domain_category", F.lit("other"))
    kept = F.when(category.isin(only), category).otherwise("other") if only else category
    return rated.select("rating", kept.alias("category"), F.col("rule").alias("line")).orderBy("rating", "category", "line")
