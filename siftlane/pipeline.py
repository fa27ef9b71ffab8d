"""From configured sources to output files."""

from __future__ import annotations

import time
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import AuditConfig, MergeConfig
from .operators import audit as A
from .operators import classify, stats
from .operators import compile as K
from .operators.parse import ParseOptions, drop_counters, parse, raw_counts, rules_of
from .plans import exports, report
from .runtime import settle
from .sources import files, landing
from .sources.store import Store


def compile_lines(spark: SparkSession, lines: DataFrame, config: MergeConfig) -> tuple[K.Compiled, DataFrame]:
    """(compiled rules, parsed lines) of ``source_ord, line_no, line, category``."""
    parsed = settle(parse(lines, config.parse))
    return _compiled(spark, parsed, config), parsed


def _compiled(spark: SparkSession, parsed: DataFrame, config: MergeConfig) -> K.Compiled:
    fold = config.compile.fold
    suffixes = classify.read_suffixes(spark, config.suffix_list) if config.suffix_list and fold.promotion_threshold else None
    return K.compile_rules(rules_of(parsed), config.compile, suffixes).keep()


def _parsed(spark: SparkSession, store: Store, ok: list[tuple[int, str, str, str]], folder: str, options: ParseOptions, keep: bool) -> tuple[DataFrame, int]:
    """(parsed lines of all sources, how many of them weren't parsed again).

    ``ok``: ``source_ord, path, category, content_hash``. With ``keep``, parsed lines are
    kept under their content's hash and the options, and read where both are there.
    """
    of = lambda rows: files.read_lists(spark, spark.createDataFrame([r[:3] for r in rows], "source_ord int, path string, category string"))
    if not keep:
        return settle(parse(of(ok), options)), 0
    names = {n.removeprefix("content_hash=") for n in store.names(folder)}
    key = "".join(str(int(x)) if isinstance(x, bool) else f"-{x}" for x in vars(options).values())
    known = {r[3] for r in ok if r[3] in names and store.exists(f"{folder}/content_hash={r[3]}/options={key}")}
    new = list({r[3]: r for r in ok if r[3] not in known}.values())  # the same content is parsed once
    if new:
        hashes = spark.createDataFrame([(r[0], r[3]) for r in new], "source_ord int, content_hash string")
        fresh = parse(of(new), options).join(F.broadcast(hashes), "source_ord").drop("source_ord", "category").withColumn("options", F.lit(key))
        files.write_parsed(fresh, folder)
    whose = spark.createDataFrame([(r[0], r[2], r[3]) for r in ok], "source_ord int, category string, content_hash string")
    read = files.read_parsed(spark, folder, whose, key).join(F.broadcast(whose), "content_hash")
    return read.select("source_ord", "line_no", "category", "rule_type", "domain", "wildcard", "modifiers", "raw", "modifier_stripped", "drop_reason"), len(known)


def audited(spark: SparkSession, allows: DataFrame, config: AuditConfig, suffix_list: str | None, cache: str, store: Store, now: datetime, opener: landing.Opener = landing.http) -> tuple[DataFrame, dict[str, str]]:
    """(audit of the allow rules, state of each feed)."""
    signals = {name: spark.read.parquet(path) for name, path in config.signals.items()}
    states: dict[str, str] = {}
    feed = signals.get("feed")
    for name, where in config.feeds.items():
        kind, source = name.split(":", 1)
        got, states[source] = landing.feed(where, f"{cache}/feeds", store, config.feed_ttl_seconds, opener=opener)
        if got.ok and got.path:
            rows = (files.read_host_feed if kind == "hosts" else files.read_csv_feed)(spark, got.path, source)
            feed = rows if feed is None else feed.select("domain", "source").unionByName(rows)
        else:
            states[source] = "failed"
    if feed is not None:
        signals["feed"] = feed
    known = classify.read_known(spark, config.known_domains) if config.known_domains else spark.createDataFrame([], "pattern string, category string, position int")
    suffixes = classify.read_suffixes(spark, suffix_list) if suffix_list else None
    domains = allows.filter("domain <> ''").select("domain").distinct()
    classes = classify.classify(domains, suffixes, known, classify.prefix_table(spark))
    replies = spark.read.parquet(config.ai_replies) if config.ai_replies else None
    at, o = F.lit(now).cast("timestamp"), config.options
    kept, folder = None, f"{cache}/audit"
    if config.cache_results and (marker := store.read_json(f"{folder}/current.json")):
        kept = spark.read.parquet(f"{folder}/{marker['name']}")
    live = A.live_cache(kept, o.fingerprint(), at, o.cache_ttl_seconds) if kept is not None else None
    result = settle(A.audit(allows, classes, signals, o, replies, live))
    if config.cache_results:
        name = f"at-{now:%Y%m%d%H%M%S%f}"
        A.next_cache(kept, result, o.fingerprint(), at, o.cache_ttl_seconds).write.parquet(f"{folder}/{name}")
        old = store.read_json(f"{folder}/current.json").get("name")
        store.write_json(f"{folder}/current.json", {"name": name})
        if old:
            store.remove(f"{folder}/{old}")
    return result, states


def _summary(result: DataFrame, o: A.AuditOptions) -> dict[str, object]:
    """The summary of an audit as one document, with every bucket."""
    found = {(r["measure"], r["bucket"]): r["rules"] for r in A.summary(result).collect()}  # a few dozen rows
    count = lambda measure, buckets, name="{}": {b: found.get((measure, name.format(b)), 0) for b in buckets}
    ratings = count("rating", A.RATINGS)
    return {
        "total": sum(ratings.values()),
        **ratings,
        "category_counts": count("category", classify.CATEGORIES),
        "by_rating": {r: count("rating:category", classify.CATEGORIES, r + ":{}") for r in A.RATINGS},
        "category_confidence": count("confidence", ["high", "medium", "low"]),
        "risk_score_buckets": count("risk", ["high", "medium", "low", "none"]),
        "top_risky": [r.asDict() for r in A.top_risky(result).collect()],
        "layer_hits": count("layer", [*A.HITS, "dnsbl_listed", "heuristics"]),
        "layers_enabled": {x: o.on(x) for x in A.LAYERS},
        "disk_cache": {"hits": result.filter("disk_cache").count()},
    }


def merge(spark: SparkSession, config: MergeConfig, out: str, cache: str | None = None, previous: str | None = None, previous_allow: str | None = None, opener: landing.Opener = landing.http) -> dict[str, object]:
    """Lands, compiles, audits and exports everything; gives the metrics that also go to ``stats.json``.

    ``cache`` must be a folder that executors can read. The lists and documents under
    ``out`` are written by the driver, a partition at a time.
    """
    begin, now = time.time(), datetime.now(UTC)
    sources, store = config.enabled, Store(spark)
    cache = cache or config.cache_folder or f"{out}/.cache"
    landed = landing.land_all(
        [s.url for s in sources], cache, store, config.concurrency, [float(s.timeout) for s in sources], opener=opener, retries=config.retries, delay=config.retry_delay, kind=config.backoff,
        deadline=config.source_deadline, negative_ttl=config.negative_ttl_seconds, ttl=config.cache_ttl_seconds, use_cache=config.use_cache,
    )
    ok = [(i, x["path"], s.category, x["content_hash"]) for i, (s, x) in enumerate(zip(sources, landed)) if x["ok"]]
    if not ok or 1 - len(ok) / len(sources) > config.failure_threshold:
        raise RuntimeError(f"{len(sources) - len(ok)} of {len(sources)} sources failed")
    parsed, reused = _parsed(spark, store, ok, f"{cache}/parsed", config.parse, config.cache_parsed and config.use_cache)  # type: ignore[arg-type]
    c = _compiled(spark, parsed, config)
    final = settle(c.rules)
    blocks, allows = K.split(final)
    version, written = exports.write_all(settle(exports.numbered(final)), out, config.formats, config.tiered)
    diff: dict[str, int] = {}
    for kind, rules, before in (("block", blocks, previous), ("allow", allows, previous_allow)):
        name = "" if kind == "block" else "allow_"
        diff |= {f"{name}added": 0, f"{name}removed": 0}
        if config.diff and before and store.exists(before):
            was, is_ = files.previous_domains(files.read_previous(spark, before)), rules.filter("domain <> ''").select("domain")
            for side, lines in (("added", stats.only_in(is_, was)), ("removed", stats.only_in(was, is_))):
                diff[name + side] = exports.write_list(lines.select(F.col("domain").alias("line")).orderBy("line"), f"{out}/diff_{name}{side}.txt", [f"version: {version}"])
    raw = raw_counts(parsed)
    named = lambda r: r | {"name": sources[r["source_ord"]].name, "url": sources[r["source_ord"]].url}
    by_category: dict[int, dict[str, int]] = {}
    for r in stats.source_categories(final).collect():  # at most one row per source and category
        by_category.setdefault(r["source_ord"], {})[r["category"]] = r["rules"]
    contributions = [named(r.asDict()) | {"rule_categories": by_category.get(r["source_ord"], {})} for r in stats.contribution_order(stats.self_dedup_of(stats.contributions(final, raw))).collect()]
    pairs = [r.asDict() for r in stats.overlap_order(stats.overlap_rates(stats.overlap_pairs(final))).collect()]
    before = raw.agg(F.coalesce(F.sum("raw_rules"), F.lit(0))).first()[0]
    after = written["block"] + written["allow"]
    conflicts = exports.write_json_rows(K.conflict_records(c.conflicts).orderBy("domain", "blocked_rule"), f"{out}/conflicts.json", report.CONFLICTS)
    modifiers = {r["modifier"]: r["rules"] for r in stats.modifier_counts(final).orderBy(F.desc("rules"), "modifier").collect()}
    sizes = stats.length_stats(blocks).first().asDict()
    dropped = drop_counters(parsed).groupBy().sum().first().asDict()
    metrics: dict[str, object] = {
        "content_version": version,
        "sources": {"total": len(sources), "ok": len(ok), "cached": sum(bool(x["cached"]) for x in landed), "not_parsed_again": reused, "failed": [x["url"] for x in landed if not x["ok"]], "errors": {x["url"]: x["error"] for x in landed if x["error"]}},
        "rules": {"before": before, "after_dedup": c.deduped.count(), "after": after, "block": written["block"], "allow": written["allow"], "dedup_rate": round((1 - after / before) * 100, 1) if before else 0.0},
        "files": written,
        "dedup": K.dedup_counters(c.deduped).first().asDict(),
        "folding": c.folded.counters().first().asDict() if c.folded else {},
        "conflicts": c.conflicts.count(),
        "badfilter_removed": c.deduped.count() - c.cleared.count(),
        "dropped": {k.removeprefix("sum(").removesuffix(")"): v or 0 for k, v in dropped.items() if "source_ord" not in k},
        "categories": {k: 0 for k in ("malware", "phishing", "mining", "tracking", "ads", "other")} | {r["category"]: r["rules"] for r in stats.category_counts(blocks).collect()},
        "kinds": {f"{r['rule_type']} {r['kind']}": r["rules"] for r in stats.kind_counts(final).orderBy("rule_type", "kind").collect()},
        "suffixes": {r["suffix"]: r["rules"] for r in stats.top_suffixes(blocks).collect()},
        "lengths": {k: sizes[k] for k in ("min_length", "max_length")} | {"average": round(sizes["total_length"] / sizes["domains"], 1) if sizes["domains"] else 0.0},
        "modifiers": modifiers,
        "modifier_total": sum(modifiers.values()),
        "modifier_rules_skipped": stats.with_modifiers(blocks).first()["skipped"],
        "diff": diff,
        "contributions": contributions,
        "overlap": pairs,
    }
    if config.audit.enabled:
        result, feeds = audited(spark, allows, config.audit, config.suffix_list, cache, store, now, opener)
        names = {i: s.name for i, s in enumerate(sources)}
        summary = _summary(result, config.audit.options) | {"threat_feeds": feeds}
        records = settle(A.records(result))
        exports.write_json({"summary": summary}, f"{out}/allow_audit_summary.json")
        exports.write_json_rows(records, f"{out}/allow_audit.json", change=lambda r: r | {"sources": [names[i] for i in r["sources"] or []]})
        a = config.audit
        metrics["audit"] = summary | {"files": exports.write_graded(records, out, a.by_rating, a.by_category, a.include_all_ratings, a.categories)}
    metrics["elapsed_seconds"] = round(time.time() - begin, 3)
    exports.write_json(metrics, f"{out}/stats.json")
    exports.write_json(contributions, f"{out}/contributions.json")
    shown = [r | {k: ", ".join(sources[i].name for i in r[k] or []) for k in ("blocked_sources", "whitelist_sources")} for r in conflicts]
    Path(out, "report.html").write_text(report.html(metrics, shown), encoding="utf-8")
    Path(out, "report.md").write_text(report.markdown(metrics, shown), encoding="utf-8")
    return metrics
