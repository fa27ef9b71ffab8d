"""Reports in Markdown and HTML from the metrics of a merge. Both show the same tables."""

from __future__ import annotations

import html as H
from typing import Any

from .exports import script_safe

#: How many rows the reports show.
CONTRIBUTIONS, PAIRS, CONFLICTS = 25, 20, 50
#: Heads and keys of the table of conflicts.
_CONFLICT = {"domain": "domain", "block rule": "blocked_rule", "block sources": "blocked_sources", "allow rule": "whitelist_rule", "allow sources": "whitelist_sources", "type": "conflict_type"}
_SOURCE = {"source": "name", "raw": "raw_rules", "unique": "unique_rules", "shared": "shared_rules", "effective": "effective_rules", "coverage %": "coverage_rate", "unique %": "unique_rate", "self-dedup %": "self_dedup_rate"}

Table = tuple[str, list[str], list[list[Any]]]


def _by_count(counts: dict[str, int]) -> list[list[Any]]:
    return [[k, f"{v:,}"] for k, v in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]


def tables(m: dict[str, Any], conflicts: list[dict[str, Any]]) -> list[Table]:
    """Titles, heads and rows of everything that the reports show."""
    rules, name = m["rules"], {c["source_ord"]: c["name"] for c in m["contributions"]}
    funnel = [["raw rules", rules["before"]], ["after deduplication", rules["after_dedup"]], ["final", rules["after"]]]
    steps = [[k.replace("_", " "), v] for part in ("dedup", "folding") for k, v in m[part].items()] + [["badfilter", m["badfilter_removed"]], ["conflicts", m["conflicts"]]]
    out: list[Table] = [
        ("Funnel", ["stage", "rules"], [[k, f"{v:,}"] for k, v in funnel]),
        ("Steps", ["step", "rules"], [[k, f"{v:,}"] for k, v in steps]),
        ("Dropped lines", ["reason", "lines"], [[k.replace("_", " "), f"{v:,}"] for k, v in m["dropped"].items()]),
        ("Categories", ["category", "block rules"], _by_count(m["categories"])),
        ("Kinds of rules", ["kind", "rules"], _by_count(m["kinds"])),
        ("Suffixes", ["suffix", "block rules"], _by_count(m["suffixes"])),
        ("Lengths of domains", ["measure", "characters"], [[k.replace("_", " "), v] for k, v in m["lengths"].items()]),
        (f"Modifiers ({m['modifier_total']:,})", ["modifier", "rules"], _by_count(m["modifiers"])),
        ("Sources", [*_SOURCE], [[c[k] for k in _SOURCE.values()] for c in m["contributions"][:CONTRIBUTIONS]]),
        ("Overlap", ["a", "b", "rules", "a %", "b %", "jaccard %", "heat"], [[name.get(p["source_a"]), name.get(p["source_b"]), p["overlap"], p["rate_a"], p["rate_b"], p["jaccard"], p["heat"]] for p in m["overlap"][:PAIRS]]),
        (f"Conflicts ({m['conflicts']:,} in all)", [*_CONFLICT], [[c[k] for k in _CONFLICT.values()] for c in conflicts[:CONFLICTS]]),
        ("Changes", ["side", "domains"], [[k.replace("_", " "), f"{v:,}"] for k, v in m["diff"].items()]),
    ]
    if m["sources"]["errors"]:
        out.append(("Errors", ["source", "error"], [[k, v] for k, v in m["sources"]["errors"].items()]))
    if "audit" in m:
        a = m["audit"]
        out += [
            ("Audit of allow rules", ["rating", "rules"], [[r, a[r]] for r in a["by_rating"]]),
            ("Audit layers", ["layer", "hits"], _by_count(a["layer_hits"])),
            ("Audit categories", ["category", *a["by_rating"]], [[c, *(a["by_rating"][r][c] for r in a["by_rating"])] for c in a["category_counts"]]),
            ("Riskiest allow rules", ["domain", "rule", "rating", "score"], [[r["domain"], r["rule"], r["rating"], r["risk_score"]] for r in a["top_risky"]]),
        ]
    return [t for t in out if t[2]]


def _headline(m: dict[str, Any]) -> str:
    rules, sources = m["rules"], m["sources"]
    return f"{rules['block']:,} block and {rules['allow']:,} allow rules from {rules['before']:,} ({rules['dedup_rate']} % less), {sources['ok']} of {sources['total']} sources ({sources['cached']} cached)."


def markdown(m: dict[str, Any], conflicts: list[dict[str, Any]]) -> str:
    cell = lambda x: str(x).replace("|", "\\|")
    line = lambda row: "| " + " | ".join(map(cell, row)) + " |"
    out = [f"# Merge {m['content_version']}", "", _headline(m), ""]
    for title, head, rows in tables(m, conflicts):
        out += [f"## {title}", "", line(head), "|" + " --- |" * len(head), *map(line, rows), ""]
    return "\n".join(out)


_HEAT = {"low": "#e3f1e3", "medium": "#fff5d6", "high": "#fbdcc0", "very high": "#f3b7b7"}


def _matrix(m: dict[str, Any]) -> str:
    """All overlaps as a heat map, sources with most rules first."""
    sources = sorted(m["contributions"], key=lambda c: (-c["effective_rules"], c["source_ord"]))
    heat = {(p["source_a"], p["source_b"]): p for p in m["overlap"]}
    rows = []
    for a in sources:
        cells = []
        for b in sources:
            p = heat.get((min(a["source_ord"], b["source_ord"]), max(a["source_ord"], b["source_ord"])))
            cells.append(f'<td style="background:{_HEAT[p["heat"]]}">{p["jaccard"]}</td>' if p and a is not b else "<td></td>")
        rows.append(f"<tr><th>{H.escape(str(a['name']))}</th>{''.join(cells)}</tr>")
    return "<table>" + "".join(rows) + "</table>"


def html(m: dict[str, Any], conflicts: list[dict[str, Any]]) -> str:
    """The tables as one page, with the overlaps as a heat map and the metrics as JSON inside."""
    cells = lambda tag, row: "<tr>" + "".join(f"<{tag}>{H.escape(str(x))}</{tag}>" for x in row) + "</tr>"
    parts = [f"<h2>{H.escape(title)}</h2><table>{cells('th', head)}{''.join(cells('td', r) for r in rows)}</table>" for title, head, rows in tables(m, conflicts)]
    return f"""<!doctype html><meta charset="utf-8"><title>Merge {H.escape(str(m['content_version']))}</title>
<h1>Merge {H.escape(str(m['content_version']))}</h1><p>{H.escape(_headline(m))}</p>
{''.join(parts)}<h2>Overlap (jaccard %)</h2>{_matrix(m)}
<script type="application/json" id="metrics">{script_safe(m)}</script>
"""
