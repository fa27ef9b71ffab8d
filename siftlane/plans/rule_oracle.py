"""SQL for the queries on rule lists, written independently of the operators."""

from __future__ import annotations

_LINES = r"""
p AS (SELECT o_orderkey AS k, (o_custkey % 6)::INTEGER AS source_ord,
  'd' || (o_orderkey * 13 % 61) || '.' || ['example.com', 'example.co.uk', 'test.net', 'promo.click'][(o_orderkey // 40) % 4 + 1] AS b,
  ['ads' || o_orderkey % 7, 'cdn' || o_orderkey % 9, 'www', 'm.track', 'x' || o_orderkey % 11][(o_orderkey // 7) % 5 + 1] AS s,
  (o_orderkey * 7 + 3) % 40 AS shape FROM orders),
l AS (SELECT source_ord, k AS line_no, ['ads', 'tracking', 'malware', 'phishing', 'mining', 'other'][source_ord + 1] AS category,
  CASE WHEN shape <= 11 THEN '||' || s || '.' || b || '^' WHEN shape <= 14 THEN '||' || b || '^' WHEN shape = 15 THEN '||*.' || b || '^'
    WHEN shape = 16 THEN '||*.' || s || '.' || b || '^' WHEN shape <= 19 THEN '0.0.0.0 ' || s || '.' || b WHEN shape = 20 THEN '::1 ' || s || '.' || b
    WHEN shape <= 23 THEN s || '.' || b WHEN shape = 24 THEN '*.' || s || '.' || b
    WHEN shape = 25 THEN CASE k % 3 WHEN 0 THEN '@@||' || s || '.' || b || '^' WHEN 1 THEN '@@||*.' || b || '^' ELSE '@@||' || b || '^' END
    WHEN shape = 26 THEN '||' || s || '.' || b || '^$important' WHEN shape = 27 THEN '||' || s || '.' || b || '$script,third-party'
    WHEN shape = 28 THEN '||' || s || '.' || b || '^$badfilter' WHEN shape = 29 THEN '||' || upper(b) || '.^$dnstype=A'
    WHEN shape = 30 THEN '! note ' || k WHEN shape = 31 THEN '# note ' || k WHEN shape = 32 THEN b || '##.banner'
    WHEN shape = 33 THEN '/^ads' || k % 13 || '\./$b,a' WHEN shape = 34 THEN '||' || b || '/path^' WHEN shape = 35 THEN '||*-' || b || '^'
    WHEN shape = 36 THEN 'https://' || b || '/x' WHEN shape = 37 THEN '127.0.0.1 localhost' WHEN shape = 38 THEN '||a.b^'
    ELSE '@@/^cdn' || k % 5 || '\./' END AS line FROM p)"""

_SIBLINGS = r"""
sp0 AS (SELECT o_orderkey AS k, (o_custkey % 6)::INTEGER AS source_ord, ['s' || o_orderkey * 7 % 23 || '.example.com', 'co.uk', 'x' || o_orderkey % 5 || '.ck', 'www.ck', 't' || o_orderkey * 3 % 11 || '.test.net'][(o_orderkey // 3) % 5 + 1] AS parent,
  CASE WHEN (o_orderkey // 15) % 4 <= o_orderkey * 7 % 23 % 5 THEN 'cdn' || o_orderkey % 89 ELSE 'w' || o_orderkey % 37 || 'x' END AS label FROM orders),
l AS (SELECT source_ord, k AS line_no, ['ads', 'tracking', 'malware', 'phishing', 'mining', 'other'][source_ord + 1] AS category, '||' || label || '.' || parent || '^' AS line FROM sp0)"""

_PARSED = r"""
p1 AS (SELECT *, trim(line) AS t FROM l),
p2 AS (SELECT *, CASE WHEN t = '' THEN 'blank' WHEN regexp_matches(t, '^!|^#($|[^#@%]|@($|[^#]))') THEN 'comment' WHEN regexp_matches(t, '#@?#|#%#') THEN 'css'
    WHEN regexp_matches(t, '^\|?https?://') THEN 'url' END AS early FROM p1),
p3 AS (SELECT *, early IS NULL AND regexp_matches(t, '^(@@)?/.+/\$?[a-z,]*$') AS is_pattern,
  CASE WHEN contains(t, '$') THEN trim(split_part(t, '$', 1)) ELSE t END AS body,
  CASE WHEN contains(t, '$') THEN list_filter(list_transform(string_split(regexp_replace(t, '^[^$]*\$', ''), ','), lambda x: trim(x)), lambda x: x <> '') ELSE [] END AS items FROM p2),
p4 AS (SELECT *, list_sort(list_distinct(list_filter(list_transform(items, lambda x: lower(x)), lambda x: x IN ('important', 'badfilter')))) AS flags,
  list_sort(list_distinct(list_transform(list_filter(items, lambda x: regexp_matches(lower(x), '^(dnstype|dnsrewrite|client|ctag|ipset|resolver)=')), lambda x: lower(split_part(x, '=', 1)) || '=' || regexp_replace(x, '^[^=]*=', '')))) AS valued FROM p3),
p5 AS (SELECT *, array_to_string(list_concat(flags, valued), ',') AS mods,
  early IS NULL AND NOT is_pattern AND len(list_filter(items, lambda x: NOT (lower(x) IN ('important', 'badfilter') OR regexp_matches(lower(x), '^(dnstype|dnsrewrite|client|ctag|ipset|resolver)=')))) > 0 AS stripped,
  CASE WHEN early IS NOT NULL OR is_pattern OR body = '' THEN NULL WHEN regexp_matches(body, '^@@\|\|[^/^\s$]+') THEN 'allow' WHEN regexp_matches(body, '^\|\|[^/^\s$]+') THEN 'block'
    WHEN regexp_matches(body, '^([0-9]{1,3}\.){3}[0-9]{1,3}\s+\S') THEN 'hosts' WHEN regexp_matches(body, '^(([0-9a-fA-F]{0,4}:){2,7}[0-9a-fA-F]{0,4}|::1?)\s+\S') THEN 'hosts'
    WHEN regexp_matches(body, '^\*\.([a-zA-Z0-9][-a-zA-Z0-9]*\.)+[a-zA-Z]{2,}$') THEN 'plain' WHEN regexp_matches(body, '^([a-zA-Z0-9][-a-zA-Z0-9]*\.)+[a-zA-Z]{2,}$') THEN 'plain' END AS form FROM p4),
p6 AS (SELECT *, regexp_replace(regexp_replace(lower(CASE form WHEN 'allow' THEN regexp_extract(body, '^@@\|\|([^/^\s$]+)', 1) WHEN 'block' THEN regexp_extract(body, '^\|\|([^/^\s$]+)', 1)
    WHEN 'hosts' THEN regexp_extract(body, '^\S+\s+(\S+)', 1) ELSE body END), '\.$', ''), '^\.', '') AS d,
  CASE form WHEN 'allow' THEN regexp_replace(body, '^@@\|\|[^/^\s$]+\^?', '') WHEN 'block' THEN regexp_replace(body, '^\|\|[^/^\s$]+\^?', '') ELSE '' END AS rest FROM p5),
p7 AS (SELECT *, regexp_replace(d, '^\*\.', '') AS bare FROM p6),
parsed_all AS (SELECT source_ord, line_no, category, is_pattern, d, bare, mods, stripped, form, t,
  CASE WHEN early IS NOT NULL THEN early WHEN is_pattern THEN NULL WHEN form IS NULL THEN 'none' WHEN rest <> '' THEN 'pattern'
    WHEN form = 'hosts' AND d IN ('localhost', 'localhost.localdomain', 'localhost6', 'localhost6.localdomain6', 'local', 'localdomain') THEN 'none'
    WHEN form = 'hosts' AND contains(d, '*') THEN 'pattern' WHEN d = '' THEN 'none' WHEN contains(bare, '*') THEN 'pattern'
    WHEN length(bare) < 4 OR length(bare) > 253 OR NOT contains(bare, '.') OR contains(bare, '..') OR bare LIKE '.%' OR bare LIKE '%.' OR bare LIKE '%.localhost' OR bare LIKE '%.local' THEN 'quality' END AS drop_reason FROM p7),
r AS (SELECT source_ord, line_no, category, CASE WHEN form = 'allow' OR (is_pattern AND t LIKE '@@%') THEN 'allow' ELSE 'block' END AS rule_type,
  CASE WHEN is_pattern THEN '' ELSE {domain} END AS domain, NOT is_pattern AND d LIKE '*.%' AS wildcard, CASE WHEN is_pattern THEN '' ELSE mods END AS modifiers,
  CASE WHEN is_pattern THEN CASE WHEN regexp_matches(t, '/\$[a-z,]+$') THEN regexp_replace(t, '\$[a-z,]+$', '') || '$' || array_to_string(list_sort(list_distinct(string_split(regexp_extract(t, '\$([a-z,]+)$', 1), ','))), ',') ELSE t END
    ELSE CASE WHEN form = 'allow' THEN '@@' ELSE '' END || '||' || d || '^' || CASE WHEN mods <> '' THEN '$' || mods ELSE '' END END AS raw, stripped AS modifier_stripped
  FROM parsed_all WHERE drop_reason IS NULL)"""

_DEDUPED = r"""
pr AS (SELECT * FROM (VALUES ('malware', 0), ('phishing', 1), ('mining', 2), ('tracking', 3), ('ads', 4), ('other', 99)) v(category, pri)),
d0 AS (SELECT r.*, pri, CASE WHEN domain = '' THEN raw ELSE '' END AS pat FROM r JOIN pr USING (category)),
dd AS (SELECT rule_type, domain, wildcard, modifiers, pat AS raw, arg_min(category, pri) AS category, list_sort(list_distinct(list(source_ord))) AS ords, count(*) AS copies,
  arg_min(raw, (source_ord, line_no)) AS first_raw FROM d0 GROUP BY 1, 2, 3, 4, 5)"""

_CLEARED = r"""
bf AS (SELECT *, list_sort(string_split(modifiers, ',')) AS ms, list_contains(string_split(modifiers, ','), 'badfilter') AS bad FROM dd),
cl AS (SELECT * FROM bf x WHERE NOT bad AND NOT EXISTS (SELECT 1 FROM bf y WHERE y.bad AND y.rule_type = x.rule_type AND y.domain = x.domain AND y.wildcard = x.wildcard
  AND x.modifiers = array_to_string(list_filter(y.ms, lambda m: m <> 'badfilter'), ','))),
cancelled AS (SELECT DISTINCT domain, wildcard FROM bf WHERE bad),
bl AS (SELECT * FROM cl WHERE rule_type = 'block'), al AS (SELECT * FROM cl WHERE rule_type = 'allow')"""

#: Ancestors of every plain block domain, with depth; then keepers and fates.
_FOLD = r"""
pl AS (SELECT * FROM base WHERE domain <> '' AND modifiers = ''),
dm AS (SELECT DISTINCT domain, string_split(domain, '.') AS lb FROM pl),
an AS (SELECT domain, i AS depth, array_to_string(lb[i + 1:], '.') AS up FROM (SELECT domain, lb, unnest(range(1, len(lb))) AS i FROM dm) WHERE len(lb) - i >= 2),
kp AS (SELECT a.domain, arg_min({{'d': k.domain, 'w': k.wildcard}}, (a.depth, NOT k.wildcard)) AS keeper FROM an a JOIN pl k ON k.domain = a.up GROUP BY 1),
fa AS (SELECT b.*, kp.keeper, EXISTS (SELECT 1 FROM pl e WHERE e.domain = b.domain AND NOT e.wildcard) AS self_exact,
    EXISTS (SELECT 1 FROM al WHERE al.domain = b.domain) AS allowed FROM base b LEFT JOIN kp ON kp.domain = b.domain),
fo AS (SELECT *, CASE WHEN {promoted} THEN 'promoted' WHEN domain = '' OR modifiers <> '' OR allowed THEN 'kept' WHEN NOT wildcard AND keeper IS NOT NULL THEN 'exact'
    WHEN wildcard AND (self_exact OR keeper IS NOT NULL) THEN 'wildcard' ELSE 'kept' END AS fate FROM fa),
sv AS (SELECT rule_type, domain, wildcard, modifiers, raw, category, ords FROM fo WHERE fate = 'kept')"""

_BASE = "base AS (SELECT rule_type, domain, wildcard, modifiers, raw, category, ords FROM bl)"

_PROMOTIONS = r"""
sib AS (SELECT *, regexp_replace(domain, '^[^.]*\.', '') AS parent FROM bl WHERE domain <> '' AND modifiers = '' AND NOT wildcard AND len(string_split(domain, '.')) >= 3),
pm AS (SELECT parent, count(*) AS children, sum(regexp_matches(regexp_extract(domain, '^[^.]*'), '^(cdn[0-9]+|ads?[0-9]*|img[0-9]+|static[0-9]+|s[0-9]+|ns[0-9]+|[0-9]+|server[0-9]+)$')::INTEGER) AS numbered,
    arg_min(category, pri) AS category, list_sort(list_distinct(flatten(list(ords)))) AS ords
  FROM sib JOIN pr USING (category) GROUP BY parent
  HAVING NOT EXISTS (SELECT 1 FROM bl WHERE bl.modifiers = '' AND bl.domain = sib.parent) AND NOT EXISTS (SELECT 1 FROM cancelled c WHERE c.wildcard AND c.domain = sib.parent))"""

_CONFLICTS = r"""
ca AS (SELECT domain AS up, wildcard AS bw, min({{'m': modifiers, 'o': ords}}) AS aw FROM al WHERE domain <> '' GROUP BY 1, 2),
cb AS (SELECT * FROM {blocks} WHERE domain <> '' AND NOT list_contains(string_split(modifiers, ','), 'important')),
cu AS (SELECT domain, i AS depth, array_to_string(lb[i + 1:], '.') AS up FROM (SELECT DISTINCT domain, string_split(domain, '.') AS lb FROM cb), unnest(range(0, 20)) u(i) WHERE i < len(lb)),
cm AS (SELECT cu.domain, arg_min({{'kind': CASE WHEN depth = 0 THEN 'exact' WHEN bw THEN 'wildcard' ELSE 'cascade' END, 'up': cu.up, 'bw': bw, 'aw': aw}}, (depth, NOT bw)) AS m
  FROM cu JOIN ca ON ca.up = cu.up WHERE (depth > 0 OR NOT bw) AND ({cascade} OR depth = 0 OR bw) GROUP BY 1),
cf AS (SELECT cb.*, m FROM cb JOIN cm USING (domain)),
fb AS (SELECT * FROM {blocks} x WHERE NOT EXISTS (SELECT 1 FROM cf WHERE cf.domain = x.domain AND cf.wildcard = x.wildcard AND cf.modifiers = x.modifiers AND cf.raw = x.raw)),
fin AS (SELECT rule_type, domain, wildcard, modifiers, raw, category, ords FROM fb UNION ALL SELECT rule_type, domain, wildcard, modifiers, raw, category, ords FROM al)"""

_TEXT = "CASE WHEN {p}domain = '' THEN {p}raw ELSE CASE WHEN {p}rule_type = 'allow' THEN '@@' ELSE '' END || '||' || CASE WHEN {p}wildcard THEN '*.' ELSE '' END || {p}domain || '^' || CASE WHEN {p}modifiers <> '' THEN '$' || {p}modifiers ELSE '' END END"
_FLAT = "rule_type, domain, wildcard, modifiers, raw, category, array_to_string(ords, ',') AS sources"

_STATS = r"""
ky AS (SELECT *, CASE WHEN domain = '' THEN raw ELSE domain END AS key FROM fin),
cv AS (SELECT key, arg_max(len(ords), (CASE WHEN rule_type = 'block' THEN 0 ELSE 1 END, NOT wildcard, modifiers, raw)) AS n FROM ky GROUP BY 1),
sr AS (SELECT category, n, unnest(ords) AS source_ord FROM ky JOIN cv USING (key)),
rw AS (SELECT source_ord, count(*) FILTER (drop_reason IS NULL) AS raw_rules FROM parsed_all GROUP BY 1),
ct AS (SELECT rw.source_ord, raw_rules, count(*) FILTER (n = 1) AS unique_rules, count(*) FILTER (n <> 1) AS shared_rules, count(n) AS effective_rules FROM rw LEFT JOIN sr USING (source_ord) GROUP BY 1, 2),
ef AS (SELECT unnest(ords) AS s, count(*) AS n FROM fin GROUP BY 1),
x AS (SELECT row_number() OVER () AS id, ords FROM fin),
y AS (SELECT id, unnest(ords) AS s FROM x),
op AS (SELECT a.s AS source_a, b.s AS source_b, count(*) AS overlap FROM y a JOIN y b ON a.id = b.id AND a.s < b.s GROUP BY 1, 2),
ov AS (SELECT source_a, source_b, overlap, ea.n AS effective_a, eb.n AS effective_b, ea.n + eb.n - overlap AS joint FROM op JOIN ef ea ON ea.s = source_a JOIN ef eb ON eb.s = source_b)"""

_CLASSES = r"""
dn AS (SELECT DISTINCT domain FROM {domains} WHERE domain <> ''),
rg AS (SELECT domain, regexp_extract(domain, '([^.]+\.(co\.uk|com|net|click))$', 1) AS registered FROM dn),
cx AS (SELECT domain, registered, CASE WHEN domain <> registered THEN regexp_extract(domain, '^([^.]+)\.', 1) END AS prefix FROM rg),
cs AS (SELECT domain, CASE WHEN registered = 'promo.click' THEN 'advertising' WHEN registered = 'test.net' THEN 'analytics' WHEN registered LIKE '%.click' THEN 'affiliate'
    WHEN prefix = 'ads' THEN 'advertising' WHEN prefix = 'cdn' THEN 'cdn' ELSE 'other' END AS category,
  CASE WHEN registered IN ('promo.click', 'test.net') OR registered LIKE '%.click' THEN 0.9 WHEN prefix IN ('ads', 'cdn') THEN 0.6 ELSE 0.0 END::DOUBLE AS confidence,
  CASE WHEN registered IN ('promo.click', 'test.net') OR registered LIKE '%.click' THEN 'registered' WHEN prefix IN ('ads', 'cdn') THEN 'prefix' ELSE 'none' END AS matched_by FROM cx)"""

_AUDIT = r"""
ah AS (SELECT *, length(domain) * 7 % 20 AS h, 'x' AS one FROM al WHERE domain <> ''),
ar AS (SELECT domain, {text} AS rule,
  CASE WHEN h IN (2, 3, 4) THEN 'malicious' WHEN h IN (0, 1, 5, 6, 7) OR risky THEN 'suspicious' WHEN h = 9 THEN 'unknown' ELSE 'safe' END AS rating,
  (CASE h WHEN 0 THEN 15 WHEN 1 THEN 20 WHEN 2 THEN 40 WHEN 3 THEN 40 WHEN 4 THEN 30 WHEN 5 THEN 15 WHEN 6 THEN 15 WHEN 7 THEN 20 ELSE 0 END + CASE WHEN risky THEN 10 ELSE 0 END)::INTEGER AS risk_score,
  array_to_string(list_filter([CASE h WHEN 0 THEN 'dns_nxdomain' WHEN 1 THEN 'dns_private_ip' WHEN 2 THEN 'threat_intel:URLhaus' WHEN 3 THEN 'threat_intel:ThreatFox' WHEN 4 THEN 'dnsbl_malicious:SpamhausDBL:phishing'
    WHEN 5 THEN 'dnsbl_listed:SpamhausDBL:spam' WHEN 6 THEN 'rdap_new_domain:5' WHEN 7 THEN 'scam_suspicious' END, CASE WHEN risky THEN 'heuristics' END], lambda z: z IS NOT NULL), '; ') AS reasons
  FROM (SELECT *, {score} >= 3 AS risky FROM ah)),
au AS (SELECT ar.*, CASE rating WHEN 'malicious' THEN 'remove' WHEN 'safe' THEN 'keep' ELSE 'review' END AS recommendation, cs.category AS domain_category, cs.confidence FROM ar JOIN cs USING (domain))"""

_SCORE = r"""(CASE WHEN domain LIKE 'xn--%' OR domain LIKE '%.xn--%' THEN 2 ELSE 0 END
  + CASE WHEN list_contains(string_split('xyz top click country cfd sbs zip mov gq tk ml cf ga work bond rest cyou qpon monster quest icu cam lol pics buzz', ' '), string_split(domain, '.')[-1]) THEN 1 ELSE 0 END
  + CASE WHEN len(string_split(domain, '.')) >= 6 THEN 1 ELSE 0 END + CASE WHEN length(domain) >= 60 THEN 1 ELSE 0 END
  + CASE WHEN length(regexp_replace(string_split(domain, '.')[-2], '[^0-9]', '', 'g')) >= 3 AND length(string_split(domain, '.')[-2]) <= 12 THEN 1 ELSE 0 END
  + CASE WHEN regexp_matches(string_split(domain, '.')[-2], '[01]') AND regexp_matches(string_split(domain, '.')[-2], '[oli]') THEN 2 ELSE 0 END)::INTEGER"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _parsed(strip_www: bool = False) -> list[str]:
    domain = "regexp_replace(bare, '^www\\.', '')" if strip_www else "bare"
    return [_LINES, _PARSED.replace("{domain}", domain)]


def _dedup(strip_www: bool = False) -> list[str]:
    return [*_parsed(strip_www), _DEDUPED]


def _cleared() -> list[str]:
    return [*_dedup(), _CLEARED]


def _fold() -> list[str]:
    return [*_cleared(), _BASE, _FOLD.format(promoted="false")]


def _promoting(at_least: int) -> list[str]:
    base = f"""px AS (SELECT * FROM pm WHERE children >= {at_least}),
base AS (SELECT rule_type, domain, wildcard, modifiers, raw, category, ords FROM bl UNION ALL SELECT 'block', parent, true, '', '', category, ords FROM px)"""
    promoted = "domain <> '' AND modifiers = '' AND NOT wildcard AND len(string_split(domain, '.')) >= 3 AND EXISTS (SELECT 1 FROM px WHERE px.parent = regexp_replace(fa.domain, '^[^.]*\\.', ''))"
    return [*_cleared(), _PROMOTIONS, base, _FOLD.format(promoted=promoted)]


def _final(cascade: bool = True) -> list[str]:
    return [*_fold(), _CONFLICTS.format(blocks="sv", cascade=str(cascade).lower())]


def _unfolded(cascade: bool) -> list[str]:
    return [*_cleared(), _CONFLICTS.format(blocks="bl", cascade=str(cascade).lower())]


def _diff(first: str, second: str) -> str:
    """Domains of the final blocks of one set of sources that the other lacks."""
    now = _with(*_final()) + "SELECT domain FROM fb WHERE domain <> ''"
    before = now.replace("(o_orderkey * 7 + 3) % 40 AS shape FROM orders)", "(o_orderkey * 7 + 3) % 40 AS shape FROM orders WHERE o_custkey % 6 <= 4)")
    sides = {"now": now, "before": before}
    return f"SELECT * FROM ({sides[first]}) EXCEPT SELECT * FROM ({sides[second]})"


def _allow_diff(first: str, second: str) -> str:
    """Domains of the allow rules of one set of sources that the other lacks."""
    now = _with(*_cleared()) + "SELECT domain FROM al WHERE domain <> ''"
    before = now.replace("(o_orderkey * 7 + 3) % 40 AS shape FROM orders)", "(o_orderkey * 7 + 3) % 40 AS shape FROM orders WHERE o_custkey % 6 <= 4)")
    sides = {"now": now, "before": before}
    return f"SELECT * FROM ({sides[first]}) EXCEPT SELECT * FROM ({sides[second]})"


_RECORDS = f"""SELECT domain, {_TEXT.format(p='')} AS blocked_rule, category AS blocked_category, array_to_string(ords, ',') AS blocked_sources,
  '@@||' || CASE WHEN m.bw THEN '*.' ELSE '' END || m.up || '^' || CASE WHEN m.aw.m <> '' THEN '$' || m.aw.m ELSE '' END AS whitelist_rule, array_to_string(m.aw.o, ',') AS whitelist_sources, m.kind AS conflict_type FROM cf"""

_CACHE = r"""WITH z AS (SELECT * FROM cache_entries WHERE url IS NOT NULL AND snapshot_no = (SELECT max(snapshot_no) FROM cache_entries)
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY fetched_at DESC, coalesce(content_hash, '') DESC, coalesce(size_bytes, 0) DESC) = 1)
"""


def oracle_sql() -> dict[str, str]:
    classes = [*_parsed(), _CLASSES.replace("{domains}", "r")]
    audit = [*_final(), _CLASSES.replace("{domains}", "al"), _AUDIT.replace("{text}", _TEXT.format(p="")).replace("{score}", _SCORE)]
    stats = [*_final(), _STATS]
    siblings = _with(_SIBLINGS, *_cleared()[1:], _PROMOTIONS) + "SELECT parent, children, category, array_to_string(ords, ',') AS sources FROM pm WHERE children >= 3"
    plain = "SELECT DISTINCT domain FROM fb WHERE modifiers = '' AND domain <> ''"
    out = {
        "fixture_lines": _with(_LINES) + "SELECT source_ord, line_no, line FROM l",
        "parse_rules": _with(*_parsed()) + "SELECT * FROM r",
        "parse_rules_strip_www": _with(*_parsed(True)) + "SELECT * FROM r",
        "parse_drops": _with(*_parsed()) + "SELECT drop_reason, count(*) AS lines FROM parsed_all WHERE drop_reason IS NOT NULL GROUP BY 1",
        "drop_counters": _with(*_parsed()) + "SELECT source_ord, " + ", ".join(f"count(*) FILTER (drop_reason = '{x}') AS {x}_dropped" for x in ("pattern", "quality", "css", "comment")) + ", count(*) FILTER (stripped) AS modifier_stripped FROM parsed_all GROUP BY 1",
        "raw_counts": _with(*_parsed()) + "SELECT source_ord, count(*) FILTER (drop_reason IS NULL) AS raw_rules FROM parsed_all GROUP BY 1",
        "dedup_rules": _with(*_dedup()) + f"SELECT {_FLAT} FROM dd",
        "category_counts": _with(*_dedup()) + "SELECT category, count(*) AS rules FROM dd WHERE rule_type = 'block' GROUP BY 1",
        "badfilter_survivors": _with(*_cleared()) + f"SELECT {_FLAT} FROM cl",
        "badfilter_removed": _with(*_cleared()) + "SELECT rule_type, domain, wildcard, modifiers, raw FROM dd EXCEPT SELECT rule_type, domain, wildcard, modifiers, raw FROM cl",
        "ancestors": _with(*_parsed()) + "SELECT domain, (i - 1)::INTEGER AS depth, array_to_string(lb[i + 1:], '.') AS parent FROM (SELECT domain, lb, unnest(range(1, len(lb))) AS i FROM (SELECT DISTINCT domain, string_split(domain, '.') AS lb FROM r WHERE domain <> '')) WHERE len(lb) - i >= 2",
        "fold_exact": _with(*_fold()) + "SELECT domain, wildcard, keeper.d AS keeper_domain, keeper.w AS keeper_wildcard FROM fo WHERE fate = 'exact'",
        "fold_wildcard": _with(*_fold()) + "SELECT domain, wildcard, CASE WHEN self_exact THEN domain ELSE keeper.d END AS keeper_domain, CASE WHEN self_exact THEN false ELSE keeper.w END AS keeper_wildcard FROM fo WHERE fate = 'wildcard'",
        "promote_count": _with(*_cleared(), _PROMOTIONS) + "SELECT parent, children, category, array_to_string(ords, ',') AS sources FROM pm WHERE children >= 5",
        "promote_siblings": siblings,
        "promote_pattern": siblings + " AND numbered >= 0.6 * children",
        "promote_guarded": siblings + r" AND NOT regexp_matches(parent, '^(co\.uk|x[0-9]+\.ck)$')",
        "promote_guarded_by_rule": siblings + " AND parent <> 'co.uk'",
        "conflicts_all": _with(*_unfolded(True)) + _RECORDS,
        "conflicts_nocascade": _with(*_unfolded(False)) + _RECORDS,
        "conflict_type_counts": _with(*_final()) + "SELECT m.kind AS conflict_type, count(*) AS rules FROM cf GROUP BY 1",
        "compiled_rules": _with(*_final()) + f"SELECT rule_type, domain, wildcard, modifiers, {_TEXT.format(p='')} AS rule, category, array_to_string(ords, ',') AS sources FROM fin",
        "allow_rules": _with(*_cleared()) + f"SELECT {_FLAT} FROM al",
        "funnel": _with(*_final()) + "SELECT (SELECT sum(copies)::BIGINT FROM dd) AS raw_rules, (SELECT count(*) FROM dd) AS after_dedup, (SELECT count(*) FROM cl) AS after_badfilter, (SELECT count(*) FROM sv) AS blocks_after_fold, (SELECT count(*) FROM fb) AS blocks, (SELECT count(*) FROM al) AS allows",
        "diff_added": _diff("now", "before"),
        "diff_removed": _diff("before", "now"),
        "contributions": _with(*stats) + "SELECT * FROM ct",
        "contribution_rates": _with(*stats) + "SELECT source_ord, effective_rules, raw_rules, unique_rules, coalesce(round_even(effective_rules / nullif(raw_rules, 0) * 100, 1), 0)::DOUBLE AS coverage_rate, coalesce(round_even(unique_rules / nullif(effective_rules, 0) * 100, 1), 0)::DOUBLE AS unique_rate FROM ct",
        "dedup_rate": _with(*stats) + "SELECT r AS raw_rules, e AS rules, coalesce(round_even((r - e) / nullif(r, 0) * 100, 1), 0)::DOUBLE AS dedup_rate FROM (SELECT sum(raw_rules)::BIGINT AS r, sum(effective_rules)::BIGINT AS e FROM ct)",
        "overlap_rates": _with(*stats) + "SELECT *, round_even(overlap / effective_a * 100, 1) AS rate_a, round_even(overlap / effective_b * 100, 1) AS rate_b, round_even(overlap / joint * 100, 1) AS jaccard, row_number() OVER (ORDER BY overlap DESC, source_a, source_b)::INTEGER AS place FROM ov",
        "modifier_total": _with(*_final()) + "SELECT count(*) AS rules FROM (SELECT unnest(string_split(modifiers, ',')) AS modifier FROM fin) WHERE modifier <> ''",
        "parse_rules_filter_ip": """WITH q AS (SELECT (o_custkey % 6)::INTEGER AS source_ord, o_orderkey AS line_no, o_orderkey AS k FROM orders)
SELECT source_ord, line_no, CASE WHEN k % 3 = 0 THEN (k % 256) || '.' || (k % 7) || '.' || (k * 3 % 300) || '.' || (k % 11) ELSE 'd' || (k % 61) || '.example.com' END AS domain FROM q WHERE k % 3 <> 0 OR k * 3 % 300 > 255""",
        "feed_hosts": "SELECT DISTINCT 'bad' || (o_orderkey % 97) || '.example.org' AS domain, 'URLhaus' AS source FROM orders WHERE o_orderkey % 11 > 4",
        "previous_domains": _with(_LINES) + r"SELECT DISTINCT regexp_extract(line, '^(@@)?\|\|(\*\.)?([^/^$\s]+)', 3) AS domain FROM l WHERE regexp_matches(line, '^(@@)?\|\|(\*\.)?[^/^$\s]')",
        "allow_diff": f"SELECT domain, 'added' AS side FROM ({_allow_diff('now', 'before')}) UNION ALL SELECT domain, 'removed' FROM ({_allow_diff('before', 'now')})",
        "sidecar_rules": _with(*_parsed()) + "SELECT source_ord, line_no, domain, modifiers FROM r WHERE source_ord = 1",
        "rdap_fields": """WITH q AS (SELECT o_orderkey, o_orderkey AS k, o_orderkey % 13 AS m, DATE '2024-01-01' + (o_orderkey % 300)::INTEGER AS reg, DATE '2024-01-01' + ((o_orderkey + 7) % 300)::INTEGER AS ex FROM orders)
SELECT o_orderkey, CASE WHEN m > 3 THEN strftime(reg, '%Y-%m-%d') END AS registered_on, CASE WHEN m > 3 THEN strftime(ex, '%Y-%m-%d') END AS expires_on, CASE WHEN m > 3 THEN date_diff('day', reg, DATE '2024-11-01') END AS age_days,
  CASE WHEN m > 3 THEN CASE WHEN k % 4 = 1 THEN 'Name ' || k % 5 ELSE 'H' || k % 3 END END AS registrar, m > 3 AND date_diff('day', reg, DATE '2024-11-01') < 30 AS is_new,
  CASE m WHEN 0 THEN 'RDAP error: No such name' WHEN 3 THEN 'RDAP error: not found' WHEN 1 THEN 'empty response' WHEN 2 THEN 'empty response' END AS error FROM q""",
        "audit_records": _with(*audit) + """SELECT domain, rule, rating, domain_category AS category, confidence AS category_confidence, reasons AS reason, h = 0 AS dns_nxdomain, CASE h WHEN 1 THEN '10.0.0.1' ELSE '192.0.2.10' END AS dns_ips, h = 2 AS urlhaus_malicious, h = 3 AS threatfox_malicious, h = 6 AS rdap_new_domain,
  CASE h WHEN 6 THEN 5 END AS rdap_domain_age_days, h = 7 AS scam_suspicious, CASE h WHEN 7 THEN 'SUSPICIOUS' WHEN 8 THEN 'CAUTION' END AS scam_decision, CASE h WHEN 7 THEN 55 WHEN 8 THEN 90 ELSE 0 END AS scam_risk_score, false AS virustotal_malicious, h IN (4, 5) AS dnsbl_listed, h = 4 AS dnsbl_malicious,
  CASE h WHEN 4 THEN 'SpamhausDBL:phishing' WHEN 5 THEN 'SpamhausDBL:spam' ELSE '' END AS dnsbl_hits, risk_score, {score} AS heuristics_score, recommendation, CASE recommendation WHEN 'remove' THEN '建议移除' WHEN 'review' THEN '建议复核' ELSE '建议保留' END AS recommendation_label, false AS ai_classified,
  row_number() OVER (ORDER BY CASE rating WHEN 'malicious' THEN 0 WHEN 'suspicious' THEN 1 WHEN 'unknown' THEN 2 ELSE 3 END, domain, rule)::INTEGER AS place FROM (SELECT *, length(domain) * 7 % 20 AS h FROM au)""".replace("{score}", _SCORE),
        "audit_failed": _with(*audit) + """SELECT DISTINCT domain, CASE WHEN f THEN 'unknown' ELSE rating END AS rating, CASE WHEN f THEN 0 ELSE risk_score END AS risk_score, CASE WHEN f THEN 'failed:down' ELSE reasons END AS reasons, CASE WHEN f THEN 'review' ELSE recommendation END AS recommendation, f AS failed FROM (SELECT *, length(domain) % 3 = 0 AS f FROM au)""",
        "ai_categories": _with(*classes) + """, b AS (SELECT domain FROM cs WHERE confidence < 0.6 ORDER BY domain LIMIT 500), z AS (SELECT *, domain IN (SELECT domain FROM b) AND length(domain) % 3 <> 1 AS u FROM cs)
SELECT domain, CASE WHEN u THEN CASE length(domain) % 3 WHEN 0 THEN 'social' ELSE 'cdn' END ELSE category END AS category, CASE WHEN u THEN round(greatest(confidence, least(length(domain) % 8 / 4.0, 1.0)::DOUBLE * 0.7::DOUBLE), 4) ELSE confidence END AS confidence, u AS ai_classified FROM z""",
        "source_categories": _with(*stats) + "SELECT source_ord, category, count(*) AS rules FROM sr GROUP BY 1, 2",
        "overlap_pairs": _with(*stats) + "SELECT * FROM ov",
        "overlap_heat": _with(*stats) + "SELECT source_a, source_b, CASE WHEN overlap * 5 < joint THEN 'low' WHEN overlap * 2 < joint THEN 'medium' WHEN overlap * 5 < joint * 4 THEN 'high' ELSE 'very high' END AS heat FROM ov",
        "overlap_matrix": _with(*stats) + "SELECT source_a AS source_ord, source_b AS other, overlap FROM ov UNION ALL SELECT source_b, source_a, overlap FROM ov",
        "modifier_stats": _with(*_final()) + "SELECT modifier, count(*) AS rules FROM (SELECT unnest(string_split(modifiers, ',')) AS modifier FROM fin) WHERE modifier <> '' GROUP BY 1",
        "rule_types": _with(*_final()) + r"SELECT rule_type, CASE WHEN domain = '' THEN 'regex' WHEN wildcard THEN 'wildcard' WHEN regexp_matches(domain, '^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$') THEN 'ip' ELSE 'domain' END AS kind, count(*) AS rules FROM fin GROUP BY 1, 2",
        "final_category_counts": _with(*_final()) + "SELECT category, count(*) AS rules FROM fb GROUP BY 1",
        "suffix_top20": _with(*_final()) + r"SELECT CASE WHEN regexp_matches(domain, '\.(co|com|net|org|gov|edu)\.[a-z]{2}$') THEN regexp_extract(domain, '([^.]+\.[^.]+\.[^.]+)$', 1) ELSE regexp_extract(domain, '([^.]+\.[^.]+)$', 1) END AS suffix, count(*) AS rules FROM fb WHERE domain <> '' GROUP BY 1 ORDER BY rules DESC, suffix LIMIT 20",
        "length_stats": _with(*_final()) + "SELECT count(*) AS domains, coalesce(sum(length(domain)), 0)::BIGINT AS total_length, min(length(domain))::INTEGER AS min_length, max(length(domain))::INTEGER AS max_length FROM fb WHERE domain <> ''",
        "self_dedup": _with(*stats) + "SELECT source_ord, raw_rules, effective_rules, raw_rules - effective_rules AS lost, coalesce(round_even((raw_rules - effective_rules) / nullif(raw_rules, 0) * 100, 1), 0)::DOUBLE AS self_dedup_rate FROM ct",
        "modifier_rules_skipped": _with(*_final()) + "SELECT count(*) FILTER (modifiers <> '') AS skipped FROM fb",
        "registered_domains": _with(*classes) + "SELECT domain, registered FROM rg",
        "domain_categories": _with(*classes) + "SELECT domain, category, confidence, matched_by FROM cs",
        "hinted_categories": _with(*classes) + """SELECT domain, CASE WHEN matched_by <> 'none' THEN category WHEN length(domain) % 4 = 0 THEN 'cdn' ELSE 'advertising' END AS category,
  CASE WHEN matched_by <> 'none' THEN confidence WHEN length(domain) % 4 = 2 THEN 0.72 ELSE 0.48 END::DOUBLE AS confidence, CASE WHEN matched_by <> 'none' THEN matched_by ELSE 'cname' END AS matched_by FROM cs""",
        "category_counts_zero": _with(*classes) + "SELECT v.category, count(cs.domain) AS domains FROM (VALUES ('advertising'), ('analytics'), ('cdn'), ('microsoft_telemetry'), ('affiliate'), ('social'), ('ecommerce_payment'), ('privacy_security'), ('other')) v(category) LEFT JOIN cs USING (category) GROUP BY 1",
        "heuristics": _with(*classes) + f"SELECT domain, {_SCORE} AS score FROM dn",
        "private_ip": r"""WITH q AS (SELECT DISTINCT a || CASE WHEN contains(a, '.') THEN '' ELSE '.' || (k * 7 % 40) END || '.' || (k * 11 % 256) || '.' || (k * 13 % 256) AS ip FROM
  (SELECT o_orderkey AS k, ['10', '172', '192.168', '127', '169.254', '0', '8', '203.0'][o_orderkey % 8 + 1] AS a FROM orders))
SELECT ip, split_part(ip, '.', 1) IN ('10', '127', '0') OR ip LIKE '192.168.%' OR ip LIKE '169.254.%' OR (ip LIKE '172.%' AND split_part(ip, '.', 2)::INTEGER BETWEEN 16 AND 31) AS is_private FROM q""",
        "feed_lookup": _with(*_cleared()) + "SELECT domain, CASE length(domain) * 7 % 20 WHEN 2 THEN 'URLhaus' WHEN 3 THEN 'ThreatFox' END AS feed_source FROM (SELECT DISTINCT domain FROM al WHERE domain <> '')",
        "rdap_age": "SELECT o_orderkey, floor(epoch(TIMESTAMP '2000-01-01 12:00:00' - date_trunc('second', o_orderdate)) / 86400)::BIGINT AS age_days FROM orders",
        "scam_decisions": """WITH q AS (SELECT DISTINCT ['CAUTION', 'trusted', ' SCAM ', 'UNKNOWN', 'SUSPICIOUS', 'BLOCKED', ''][o_orderkey % 7 + 1] AS decision, (o_custkey % 100)::INTEGER AS score FROM orders), u AS (SELECT *, upper(trim(decision)) AS t FROM q)
SELECT decision, score, t NOT IN ('CAUTION', 'TRUSTED') AND (t IN ('SUSPICIOUS', 'SCAM', 'BLOCKED', 'HIGH_RISK') OR score >= 50) AS suspicious, t NOT IN ('CAUTION', 'TRUSTED') AND (t IN ('SCAM', 'BLOCKED', 'MALICIOUS') OR score >= 70) AS confirmed FROM u""",
        "dnsbl_decode": r"""WITH q AS (SELECT DISTINCT CASE WHEN k % 2 = 0 THEN 'SpamhausDBL' ELSE 'SURBL' END AS list_name, CASE WHEN k % 5 = 0 THEN '127.255.255.' WHEN k % 11 = 0 THEN '8.8.8.' ELSE '127.0.0.' END || (k % 128) AS ip, k % 128 AS n FROM (SELECT o_orderkey AS k FROM orders)),
u AS (SELECT *, CASE WHEN ip NOT LIKE '127.0.0.%' THEN [] WHEN list_name = 'SpamhausDBL' THEN [CASE n WHEN 10 THEN 'spam' WHEN 11 THEN 'phishing' WHEN 12 THEN 'malware' WHEN 13 THEN 'botnet-c2' WHEN 14 THEN 'abused-spam' WHEN 15 THEN 'hijacked' ELSE 'code-' || n END]
  ELSE list_filter([CASE WHEN n & 4 > 0 THEN 'scam' END, CASE WHEN n & 8 > 0 THEN 'junk' END, CASE WHEN n & 16 > 0 THEN 'phishing' END, CASE WHEN n & 32 > 0 THEN 'malware' END, CASE WHEN n & 64 > 0 THEN 'abused-ads' END], lambda z: z IS NOT NULL) END AS x FROM q)
SELECT list_name, ip, len(list_filter(x, lambda z: z IN ('scam', 'phishing', 'malware', 'botnet-c2'))) > 0 AS malicious, coalesce(array_to_string(x, ','), '') AS labels FROM u""",
        "vt_scores": "WITH q AS (SELECT DISTINCT o_orderkey % 9 AS m, o_orderkey % 4 AS s, o_orderkey % 61 AS h, o_orderkey % 7 AS u FROM orders) SELECT m, s, h, u, m * 2 + s AS points, coalesce(round_even((m + s * 0.5::DOUBLE) / nullif(m + s + h + u, 0), 3) * 1000, 0)::INTEGER AS thousandths, m + s + h + u > 0 AND (m + 0.5 * s) * 10 >= m + s + h + u AS malicious FROM q",
        "audit_fused": _with(*audit) + "SELECT domain, rule, rating, risk_score, reasons, recommendation FROM au",
        "audit_summary": _with(*audit) + """SELECT measure, bucket, count(*) AS rules FROM (SELECT 'rating' AS measure, rating AS bucket FROM au UNION ALL SELECT 'category', domain_category FROM au
  UNION ALL SELECT 'confidence', CASE WHEN confidence >= 0.9 THEN 'high' WHEN confidence >= 0.6 THEN 'medium' ELSE 'low' END FROM au
  UNION ALL SELECT 'rating:category', rating || ':' || domain_category FROM au
  UNION ALL SELECT 'layer', l FROM (SELECT reasons, unnest(['dns_nxdomain', 'dns_private_ip', 'urlhaus', 'threatfox', 'rdap_new_domain', 'scam_check', 'dnsbl_malicious', 'dnsbl_listed', 'heuristics']) AS l, unnest(['dns_nxdomain', 'dns_private_ip', 'URLhaus', 'ThreatFox', 'rdap_new_domain', 'scam_suspicious', 'dnsbl_malicious', 'dnsbl_listed', 'heuristics']) AS w FROM au) WHERE contains(reasons, w)
  UNION ALL SELECT 'risk', CASE WHEN risk_score >= 50 THEN 'high' WHEN risk_score >= 20 THEN 'medium' WHEN risk_score >= 1 THEN 'low' ELSE 'none' END FROM au) GROUP BY 1, 2""",
        "top_risky": _with(*audit) + "SELECT domain, rule, rating, risk_score FROM au WHERE risk_score > 0 ORDER BY risk_score DESC, domain, rule LIMIT 10",
        "ai_budget": _with(*classes) + "SELECT domain FROM cs WHERE confidence < 0.6 ORDER BY domain LIMIT 100",
        "feed_freshness": "SELECT CASE WHEN s < 3600 THEN 'fresh' WHEN s < 21600 THEN 'stale' ELSE 'expired' END AS state, count(*) AS events FROM (SELECT epoch(TIMESTAMP '2024-01-15 00:00:00') - floor(epoch(ts)) AS s FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00') GROUP BY 1",
        "source_errors": "SELECT ['timeout', 'not_found', 'auth', 'dns', 'network', 'timeout', 'unknown'][o_orderkey % 7 + 1] AS kind, count(*) AS sources FROM orders GROUP BY 1",
        "cache_latest": _CACHE + "SELECT url, content_hash, size_bytes FROM z",
        "cache_eviction": _CACHE + ", s AS (SELECT *, sum(coalesce(size_bytes, 0)) OVER (ORDER BY fetched_at DESC, url ROWS UNBOUNDED PRECEDING) > 200000 AS gone FROM z) SELECT url, EXISTS (SELECT 1 FROM s k WHERE NOT k.gone AND k.content_hash = s.content_hash) AS content_kept FROM s WHERE gone",
        "cache_stats": _CACHE + "SELECT count(*) AS entries, coalesce(sum(size_bytes), 0)::BIGINT AS total_bytes, count(DISTINCT content_hash) AS contents FROM z",
        "cache_unchanged": _CACHE + "SELECT url FROM z WHERE EXISTS (SELECT 1 FROM cache_entries c WHERE c.content_hash = z.content_hash AND c.snapshot_no < z.snapshot_no)",
        "enabled_sources": "SELECT source_ord, name, category FROM sources WHERE enabled",
        "graded_allow": _with(*audit) + "SELECT rating, CASE WHEN domain_category IN ('advertising', 'analytics') THEN domain_category ELSE 'other' END AS category, rule AS line FROM au",
        "audit_cache_live": "SELECT user_id::VARCHAR AS domain, epoch_us(max(ts)) AS stored_us FROM events WHERE event_type = 'click' AND ts <= TIMESTAMP '2024-01-15 00:00:00' AND floor(epoch(ts)) > epoch(TIMESTAMP '2024-01-14 00:00:00') GROUP BY 1",
        "content_version": _with(*_final()) + f"SELECT left(sha256(string_agg(line || chr(10), '' ORDER BY t, domain, NOT wildcard, modifiers, raw)), 12) AS version FROM (SELECT CASE WHEN rule_type = 'block' THEN 0 ELSE 1 END AS t, domain, wildcard, modifiers, raw, {_TEXT.format(p='')} AS line FROM fin)",
        "export_block": _with(*_final()) + f"SELECT {_TEXT.format(p='')} AS line FROM fb",
        "export_allow": _with(*_cleared()) + f"SELECT {_TEXT.format(p='')} AS line FROM al",
        "export_tiered": _with(*_final()) + f"SELECT category, {_TEXT.format(p='')} AS line FROM fb",
        "export_hosts": _with(*_final()) + f"SELECT '0.0.0.0 ' || domain AS line FROM ({plain})",
        "export_domains": _with(*_final()) + f"SELECT domain AS line FROM ({plain})",
        "export_clash": _with(*_final()) + f"SELECT '  - DOMAIN-SUFFIX,' || domain AS line FROM ({plain})",
        "export_surge": _with(*_final()) + f"SELECT 'DOMAIN-SUFFIX,' || domain AS line FROM ({plain})",
        "export_smartdns": _with(*_final()) + f"SELECT 'address /' || domain || '/#' AS line FROM ({plain})",
    }
    fates = "SELECT count(*) FILTER (fate = 'exact') AS exact_aggregated, count(*) FILTER (fate = 'wildcard') AS wildcard_aggregated, count(*) FILTER (fate = 'promoted') AS wildcard_promoted FROM fo"
    out["fold_counters"] = _with(*_fold()) + fates
    out["fold_counters_promoting"] = _with(*_promoting(5)) + fates
    for name, www in (("dedup_counters", False), ("dedup_counters_strip_www", True)):
        out[name] = (
            _with(*_dedup(www))
            + """, first AS (SELECT rule_type, domain, wildcard, modifiers, CASE WHEN domain = '' THEN raw ELSE '' END AS pat, raw, row_number() OVER (PARTITION BY rule_type, domain, wildcard, modifiers, CASE WHEN domain = '' THEN raw ELSE '' END ORDER BY source_ord, line_no) AS n,
  first_value(raw) OVER (PARTITION BY rule_type, domain, wildcard, modifiers, CASE WHEN domain = '' THEN raw ELSE '' END ORDER BY source_ord, line_no) AS fr FROM r)
SELECT count(*) FILTER (domain <> '' AND n > 1 AND raw = fr) AS exact_merged, count(*) FILTER (domain <> '' AND raw <> fr) AS normalized_merged, count(*) FILTER (domain = '' AND n > 1) AS regex_merged FROM first"""
        )
    out["fold_provenance"] = (
        _with(*_fold())
        + """, sp AS (SELECT * FROM sv WHERE domain <> '' AND modifiers = ''),
gn AS (SELECT domain, wildcard, category, ords, string_split(domain, '.') AS lb FROM fo WHERE fate <> 'kept'),
pa AS (SELECT *, array_to_string(lb[i + 1:], '.') AS up FROM gn, unnest(range(0, 20)) u(i) WHERE i < len(lb)),
ro AS (SELECT pa.domain, pa.wildcard, any_value(pa.category) AS category, any_value(pa.ords) AS ords, arg_min({'d': sp.domain, 'w': sp.wildcard}, (i, NOT sp.wildcard)) AS root FROM pa JOIN sp ON sp.domain = pa.up AND (i > 0 OR (pa.wildcard AND NOT sp.wildcard)) GROUP BY 1, 2),
un AS (SELECT domain, wildcard, modifiers, raw, category, ords, 0 AS n FROM sv UNION ALL SELECT root.d, root.w, '', '', category, ords, 1 FROM ro)
SELECT domain, wildcard, modifiers, raw, arg_min(category, pri) AS category, array_to_string(list_sort(list_distinct(flatten(list(ords)))), ',') AS sources, sum(n)::BIGINT AS folded_in FROM un JOIN pr USING (category) GROUP BY 1, 2, 3, 4"""
    )
    out["fold_provenance_stepwise"] = (
        _with(*_promoting(5)).replace("WITH ", "WITH RECURSIVE ", 1)
        + r""", fx AS (SELECT *, CASE WHEN fate = 'promoted' THEN regexp_replace(domain, '^[^.]*\.', '') WHEN fate = 'wildcard' AND EXISTS (SELECT 1 FROM fo e WHERE e.domain = q.domain AND NOT e.wildcard AND e.modifiers = '' AND e.fate = 'kept') THEN domain ELSE keeper.d END AS td,
    CASE WHEN fate = 'promoted' THEN true WHEN fate = 'wildcard' AND EXISTS (SELECT 1 FROM fo e WHERE e.domain = q.domain AND NOT e.wildcard AND e.modifiers = '' AND e.fate = 'kept') THEN false ELSE keeper.w END AS tw FROM fo q WHERE fate <> 'kept'),
ed AS (SELECT fx.domain, fx.wildcard, fx.category, fx.ords, td, tw, t.fate = 'kept' AS there FROM fx JOIN fo t ON t.domain = td AND t.wildcard = tw AND t.modifiers = ''
  WHERE tw OR NOT (t.fate = 'promoted' OR (fx.fate = 'wildcard' AND t.fate <> 'kept'))),
ch AS (SELECT category, ords, td, tw, there FROM ed UNION ALL SELECT ch.category, ch.ords, ed.td, ed.tw, ed.there FROM ch JOIN ed ON ed.domain = ch.td AND ed.wildcard = ch.tw WHERE NOT ch.there),
un AS (SELECT domain, wildcard, modifiers, raw, category, ords, 0 AS n FROM sv UNION ALL SELECT td, tw, '', '', category, ords, 1 FROM ch WHERE there)
SELECT domain, wildcard, modifiers, raw, arg_min(category, pri) AS category, array_to_string(list_sort(list_distinct(flatten(list(ords)))), ',') AS sources, sum(n)::BIGINT AS folded_in FROM un JOIN pr USING (category) GROUP BY 1, 2, 3, 4"""
    )
    return out
