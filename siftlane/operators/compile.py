"""The compilation of parsed rules: one DataFrame in, one out, for each step.

Rules have ``rule_type, domain ('' for a pattern), wildcard, modifiers, raw,
category, source_ords``. Folding is set-based: whether a rule is folded depends on
membership alone, never on the order in which rules are looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import domains as D
from ..runtime import settle
from .classify import without_suffixes

RULE = ["rule_type", "domain", "wildcard", "modifiers", "raw", "category", "source_ords"]
KEY = ["rule_type", "domain", "wildcard", "modifiers", "pattern"]
#: First labels of machines that are numbered through.
NUMBERED = r"^(?:cdn\d+|ads?\d*|img\d+|static\d+|s\d+|ns\d+|\d+|server\d+)$"


@dataclass(frozen=True)
class FoldOptions:
    """``promotion_threshold`` 0 turns promotion off; ``mode`` is ``count`` or ``pattern``; ``suffix_guard`` keeps public suffixes from being promoted."""

    min_labels: int = 2
    fold_wildcards: bool = True
    promotion_threshold: int = 0
    mode: str = "count"
    pattern_ratio: float = 0.8
    suffix_guard: bool = True


def _least_category(priority: str = "_p") -> Column:
    """The category of highest priority among those of a group."""
    return F.min(F.struct(F.coalesce(F.col(priority), F.lit(D.LEAST_PRIORITY)), F.col("category")))["category"]


def _merged_ords(column: str) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(column))))


def dedup(rules: DataFrame) -> DataFrame:
    """One row per rule and identity (patterns: per text), with merged categories and the sources that bring it.

    ``copies`` counts the rows merged; ``first_raw`` is the raw text of the first by
    source and line; ``other_raw`` counts the rows with another raw text. An
    identity has at most two raw texts: its own, and one with what normalising
    the domain took off. Every aggregate is of fixed size (sources: one entry
    each), so a hot rule shrinks on the map side of the one shuffle.
    """
    keyed = rules.withColumn("pattern", F.when(F.col("domain") == "", F.col("raw")).otherwise(""))
    first = F.struct("source_ord", "line_no")
    own = D.output_text(F.col("rule_type"), F.col("domain"), F.col("wildcard"), F.col("modifiers"), F.col("raw"))
    merged = keyed.withColumn("_p", D.priority(F.col("category"))).withColumn("_own", F.col("raw") == own).groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("copies"),
        F.count_if("_own").alias("_own_n"),
        F.min_by(F.struct("raw", "_own"), first).alias("_first"),
        _least_category().alias("category"),
        F.array_sort(F.collect_set("source_ord")).alias("source_ords"),
    )
    other = F.when(F.col("_first._own"), F.col("copies") - F.col("_own_n")).otherwise(F.col("_own_n"))
    return merged.select("rule_type", "domain", "wildcard", "modifiers", F.col("pattern").alias("raw"), "category", "source_ords", "copies", F.col("_first.raw").alias("first_raw"), other.alias("other_raw"))


def dedup_counters(deduped: DataFrame) -> DataFrame:
    """``exact_merged, normalized_merged, regex_merged``: rows merged with the same text, with another text, and patterns."""
    named = F.col("domain") != ""
    zero = lambda c: F.coalesce(c, F.lit(0))
    return deduped.agg(
        zero(F.sum(F.when(named, F.col("copies") - 1 - F.col("other_raw")))).alias("exact_merged"),
        zero(F.sum(F.when(named, F.col("other_raw")))).alias("normalized_merged"),
        zero(F.sum(F.when(~named, F.col("copies") - 1))).alias("regex_merged"),
    )


def _modifier_set(column: Column) -> Column:
    return F.array_sort(F.array_distinct(D.modifier_list(column)))


def _with_badfilter(rules: DataFrame) -> DataFrame:
    return rules.withColumn("_set", _modifier_set(F.col("modifiers"))).withColumn("_bad", (F.col("domain") != "") & F.array_contains("_set", "badfilter"))


def badfilter(rules: DataFrame) -> DataFrame:
    """Rules left once voiding rules have taken themselves and their targets away.

    A target has the same type, domain and wildcard, and the voiding rule's other
    modifiers, compared as sets. Patterns have no part in it, and none in the join.
    """
    marked = _with_badfilter(rules.filter("domain <> ''"))
    voiding = marked.filter("_bad").select("rule_type", "domain", "wildcard", F.array_remove("_set", "badfilter").alias("_set")).distinct()
    left = marked.filter("NOT _bad").join(voiding, ["rule_type", "domain", "wildcard", "_set"], "left_anti").select(*rules.columns)
    return left.unionByName(rules.filter("domain = ''"))


def cancelled(rules: DataFrame) -> DataFrame:
    """``domain, wildcard`` that voiding rules name."""
    return _with_badfilter(rules).filter("_bad").select("domain", "wildcard").distinct()


def split(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Block and allow rules."""
    return rules.filter("rule_type = 'block'"), rules.filter("rule_type = 'allow'")


def _plain(blocks: DataFrame) -> DataFrame:
    """Rules that folding looks at: with a domain and without modifiers."""
    return blocks.filter("domain <> '' AND modifiers = ''")


def promotions(blocks: DataFrame, o: FoldOptions, voided: DataFrame | None = None, suffixes: DataFrame | None = None) -> DataFrame:
    """``parent, children, category, source_ords`` of sibling groups that a wildcard replaces.

    Counts siblings without a wildcard below one parent. A parent that is a rule
    itself, that a voiding rule names, or that is a public suffix (by ``suffixes``, see
    :func:`.classify.with_suffix`), stays. In pattern mode enough first labels must be numbered ones.
    """
    plain = _plain(blocks)
    exact = plain.filter("NOT wildcard").withColumn("parent", D.immediate_parent(F.col("domain"))).filter(F.size(D.labels(F.col("domain"))) >= o.min_labels + 1)
    numbered = F.when(F.regexp_extract("domain", r"^([^.]*)", 1).rlike(NUMBERED), 1).otherwise(0)
    groups = exact.withColumn("_p", D.priority(F.col("category"))).groupBy("parent").agg(F.count(F.lit(1)).alias("children"), F.sum(numbered).alias("_numbered"), _least_category().alias("category"), _merged_ords("source_ords").alias("source_ords"))
    enough = groups.filter(F.col("children") >= o.promotion_threshold)
    if o.mode == "pattern":
        enough = enough.filter(F.col("_numbered") >= F.lit(o.pattern_ratio) * F.col("children"))
    free = enough.join(plain.select(F.col("domain").alias("parent")).distinct(), "parent", "left_anti")
    if voided is not None:
        free = free.join(voided.filter("wildcard").select(F.col("domain").alias("parent")), "parent", "left_anti")
    if o.suffix_guard:
        free = without_suffixes(free, "parent", suffixes)
    return free.drop("_numbered")


def _lookup(blocks: DataFrame | None, allows: DataFrame) -> DataFrame:
    """One row per domain ``up``: whether an exact or wildcard block rule without modifiers stands there, and the allow rules of both kinds."""
    none = F.lit(None).cast("boolean")
    by = F.struct("modifiers", "source_ords")
    rows = allows.filter("domain <> ''").select(F.col("domain").alias("up"), none.alias("has_exact"), none.alias("has_wild"), F.when(~F.col("wildcard"), by).alias("exact_by"), F.when(F.col("wildcard"), by).alias("wild_by"))
    if blocks is not None:
        no_by = F.lit(None).cast(rows.schema["exact_by"].dataType)
        rows = rows.unionByName(_plain(blocks).select(F.col("domain").alias("up"), (~F.col("wildcard")).alias("has_exact"), F.col("wildcard").alias("has_wild"), no_by.alias("exact_by"), no_by.alias("wild_by")))
    return rows.groupBy("up").agg(F.max("has_exact").alias("has_exact"), F.max("has_wild").alias("has_wild"), F.min("exact_by").alias("exact_by"), F.min("wild_by").alias("wild_by"))


def _fewest_labels(allows: DataFrame) -> int:
    """Labels of the shortest allow domain: no parent below can match one, so top-level domains needn't meet in one task."""
    least = allows.filter("domain <> ''").agg(F.min(F.size(D.labels(F.col("domain"))))).first()[0]
    return least or 1_000


def _met(asking: DataFrame, lookup: DataFrame, min_labels: int, fewest: int, cascade: bool) -> DataFrame:
    """``domain, _self, _near, _allowed, match`` of the distinct domains in ``asking``, from one walk over themselves and their parents.

    ``_self``: an exact rule stands at the domain; ``_near``: the nearest parent of at
    least ``min_labels`` labels that is a rule; ``_allowed``: an allow rule stands at the
    domain; ``match``: the allow rule that overrules it.
    """
    names = asking.select("domain").distinct().withColumn("_n", F.size(D.labels(F.col("domain"))))
    up = names.select("domain", "_n", F.posexplode(F.concat(F.array("domain"), D.ancestors(F.col("domain"), min(min_labels, fewest)))).alias("depth", "up"))
    rows = up.join(lookup, "up")
    strict, e, w = F.col("depth") > 0, F.col("exact_by").isNotNull(), F.col("wild_by").isNotNull()
    covers = strict & (F.col("_n") - F.col("depth") >= min_labels) & (F.col("has_exact").isNotNull() | F.col("has_wild").isNotNull())
    case = lambda exact, kind, by: F.struct("depth", F.lit(exact).alias("e"), "up", F.lit(kind).alias("kind"), F.col(by).alias("by"))
    match = F.when(~strict & e, case(True, "exact", "exact_by")).when(strict & w, case(False, "wildcard", "wild_by"))
    if cascade:
        match = match.when(strict & e, case(True, "cascade", "exact_by"))
    return rows.groupBy("domain").agg(
        F.max(F.when(~strict & F.col("has_exact"), True)).alias("_self"),
        F.min(F.when(covers, F.struct("depth", (~F.coalesce("has_wild", F.lit(False))).alias("exact"), "up"))).alias("_near"),
        F.max(F.when(~strict & (e | w), True)).alias("_allowed"),
        F.min(match).alias("match"),
    )


@dataclass(frozen=True)
class Folded:
    """``marked``: rules with ``fate`` (kept, exact, wildcard, promoted), ``keeper_domain, keeper_wildcard`` of folded ones, ``near_domain, near_wildcard``, the nearest covering parent, and ``match``, the allow rule that overrules one."""

    marked: DataFrame

    @property
    def survivors(self) -> DataFrame:
        return self.marked.filter("fate = 'kept'").select(*RULE)

    def counters(self) -> DataFrame:
        count = lambda f: F.count_if(F.col("fate") == f)
        return self.marked.agg(count("exact").alias("exact_aggregated"), count("wildcard").alias("wildcard_aggregated"), count("promoted").alias("wildcard_promoted"))


def fold(blocks: DataFrame, allows: DataFrame, o: FoldOptions = FoldOptions(), voided: DataFrame | None = None, suffixes: DataFrame | None = None, cascade: bool = True) -> Folded:
    """Folds rules without modifiers under parents that cover them.

    An exact rule goes if a parent of at least ``min_labels`` labels is a rule; a
    wildcard goes if its own domain is an exact rule, or a parent is a rule. Domains
    of allow rules are never folded. The keeper is the nearest parent, a wildcard
    before an exact rule of the same domain. Promotion comes first and ignores
    allow rules. The same walk over parents finds the allow rule that overrules each
    rule. Patterns, which share the domain '', take no part in any join.
    """
    base = blocks.filter("domain <> ''").select(*RULE).withColumn("_promoted", F.lit(False))
    plain = F.col("modifiers") == ""
    if o.promotion_threshold > 0:
        new = promotions(base, o, voided, suffixes)
        made = new.select(F.lit("block").alias("rule_type"), F.col("parent").alias("domain"), F.lit(True).alias("wildcard"), F.lit("").alias("modifiers"), F.lit("").alias("raw"), "category", "source_ords", F.lit(False).alias("_promoted"))
        children = plain & ~F.col("wildcard") & (F.size(D.labels(F.col("domain"))) >= o.min_labels + 1)
        parents = new.select("parent", F.lit(True).alias("_under"))
        with_parent = base.filter(children).withColumn("parent", D.immediate_parent(F.col("domain"))).join(parents, "parent", "left").withColumn("_promoted", F.coalesce("_under", F.lit(False)))
        base = with_parent.select(*base.columns).unionByName(base.filter(~children)).unionByName(made)
    met = _met(base.filter(~F.col("_promoted")), _lookup(base, allows), o.min_labels, _fewest_labels(allows), cascade)
    seen = base.join(met, "domain", "left")
    open_ = plain & ~F.col("_promoted") & F.col("_allowed").isNull()
    near, own = F.col("_near").isNotNull(), F.coalesce("_self", F.lit(False))
    fate = F.when(F.col("_promoted"), "promoted").when(open_ & ~F.col("wildcard") & near, "exact")
    if o.fold_wildcards:
        fate = fate.when(open_ & F.col("wildcard") & (own | near), "wildcard")
    marked = seen.withColumn("fate", fate.otherwise("kept"))
    gone, to_self = F.col("fate") != "kept", (F.col("fate") == "wildcard") & own
    promoted = F.col("fate") == "promoted"
    added = {
        "keeper_domain": F.when(promoted, D.immediate_parent(F.col("domain"))).when(to_self, F.col("domain")).when(gone, F.col("_near.up")),
        "keeper_wildcard": F.when(promoted, True).when(to_self, False).when(gone, ~F.col("_near.exact")),
        "near_domain": F.col("_near.up"),
        "near_wildcard": ~F.col("_near.exact"),
    }
    named = marked.withColumns(added).select(*RULE, "fate", *added, F.when(~_exempt(), F.col("match")).alias("match"))
    patterns = blocks.filter("domain = ''").select(*RULE, F.lit("kept").alias("fate"))
    return Folded(named.unionByName(patterns, allowMissingColumns=True))


def fold_provenance(folded: Folded, o: FoldOptions = FoldOptions()) -> DataFrame:
    """Survivors with the sources and best category of all rules folded into them, however deep.

    A folded rule's root is the first survivor among: the exact rule of its domain
    (for a wildcard), a promoted parent, then each parent, wildcard before exact.
    No source is lost.
    """
    marked = folded.marked.withColumn("_plain", (F.col("domain") != "") & (F.col("modifiers") == ""))
    kept = marked.filter("fate = 'kept' AND _plain").select(F.col("domain").alias("up"), F.col("wildcard").alias("up_wild"))
    gone = marked.filter("fate <> 'kept'")
    path = gone.select("domain", "wildcard", "category", "source_ords", F.posexplode(F.concat(F.array("domain"), D.ancestors(F.col("domain"), o.min_labels))).alias("depth", "up"))
    candidates = path.join(kept, "up").filter((F.col("depth") > 0) | (F.col("wildcard") & ~F.col("up_wild")))
    rooted = candidates.groupBy("domain", "wildcard").agg(F.min(F.struct("depth", (~F.col("up_wild")).alias("exact"), "up")).alias("root"), F.first("category").alias("category"), F.first("source_ords").alias("source_ords"))
    brought = rooted.select(F.col("root.up").alias("domain"), (~F.col("root.exact")).alias("wildcard"), F.lit("").alias("modifiers"), F.lit("").alias("raw"), "category", "source_ords", F.lit("block").alias("rule_type"), F.lit(1).alias("_in"))
    own = folded.survivors.withColumn("_in", F.lit(0))
    both = own.unionByName(brought).withColumn("_p", D.priority(F.col("category")))
    return both.groupBy("rule_type", "domain", "wildcard", "modifiers", "raw").agg(_least_category().alias("category"), _merged_ords("source_ords").alias("source_ords"), F.sum("_in").alias("folded_in"))


def fold_provenance_stepwise(folded: Folded) -> DataFrame:
    """As :func:`fold_provenance`, but along keepers only, as a rule-by-rule fold has it.

    What is merged into a rule that went before is lost: into a promoted exact rule,
    or by a wildcard into an exact rule that was folded. Keepers are followed one
    level at a time; a chain is at most as long as a domain has labels.
    """
    marked = settle(folded.marked.filter("domain <> '' AND modifiers = ''"))
    fates = marked.select(F.col("domain").alias("to"), F.col("wildcard").alias("to_wild"), F.col("fate").alias("to_fate"))
    gone = marked.filter("fate <> 'kept'")
    own = gone.join(fates.filter("NOT to_wild").select(F.col("to").alias("domain"), F.col("to_fate").alias("own_fate")), "domain", "left")
    to_own = (F.col("fate") == "wildcard") & (F.col("own_fate") == "kept")
    promoted = F.col("fate") == "promoted"
    target = F.when(promoted, F.col("keeper_domain")).when(to_own, F.col("domain")).otherwise(F.col("near_domain"))
    target_wild = F.when(promoted, True).when(to_own, False).otherwise(F.col("near_wildcard"))
    aimed = own.select("domain", "wildcard", "category", "source_ords", "fate", target.alias("to"), target_wild.alias("to_wild")).join(fates, ["to", "to_wild"], "left")
    # an exact rule that went before takes nothing on
    dead = ~F.col("to_wild") & ((F.col("to_fate") == "promoted") | ((F.col("fate") == "wildcard") & (F.col("to_fate") != "kept")))
    edges = settle(aimed.filter(F.col("to").isNotNull() & ~F.coalesce(dead, F.lit(True))).select("domain", "wildcard", "category", "source_ords", "to", "to_wild", (F.col("to_fate") == "kept").alias("arrived")))
    step = edges.select(F.col("domain").alias("to"), F.col("wildcard").alias("to_wild"), F.col("to").alias("next"), F.col("to_wild").alias("next_wild"), F.col("arrived").alias("there"))
    here, rooted = edges, []
    while True:
        rooted.append(here.filter("arrived").select("to", "to_wild", "category", "source_ords"))
        rest = here.filter("NOT arrived")
        if rest.isEmpty():
            break
        here = settle(rest.join(step, ["to", "to_wild"]).select("category", "source_ords", F.col("next").alias("to"), F.col("next_wild").alias("to_wild"), F.col("there").alias("arrived")))
    brought = rooted[0]
    for more in rooted[1:]:
        brought = brought.unionByName(more)
    given = brought.select(F.lit("block").alias("rule_type"), F.col("to").alias("domain"), F.col("to_wild").alias("wildcard"), F.lit("").alias("modifiers"), F.lit("").alias("raw"), "category", "source_ords", F.lit(1).alias("_in"))
    both = folded.survivors.withColumn("_in", F.lit(0)).unionByName(given).withColumn("_p", D.priority(F.col("category")))
    return both.groupBy("rule_type", "domain", "wildcard", "modifiers", "raw").agg(_least_category().alias("category"), _merged_ords("source_ords").alias("source_ords"), F.sum("_in").alias("folded_in"))


def _exempt() -> Column:
    return (F.col("domain") == "") | F.array_contains(D.modifier_list(F.col("modifiers")), "important")


def _overruled(marked: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a ``match``, which is spelled out."""
    m = F.col("match")
    return marked.filter(m.isNotNull()).select(*columns, m["kind"].alias("conflict_type"), m["up"].alias("by_domain"), (~m["e"]).alias("by_wildcard"), m["by"]["modifiers"].alias("by_modifiers"), m["by"]["source_ords"].alias("by_sources"))


def conflicts(blocks: DataFrame, allows: DataFrame, cascade: bool = True) -> DataFrame:
    """Block rules that an allow rule overrules, with that rule.

    Result: the block rule's columns, ``conflict_type`` (exact, wildcard, cascade) and
    ``by_domain, by_wildcard, by_modifiers, by_sources``. Patterns and important rules are
    exempt. An exact allow rule of the domain comes first, else the nearest strict
    parent, a wildcard before an exact rule. Of several allow rules the one with the
    smallest modifiers is named. Parents go down to the shortest domain of an allow rule.
    """
    open_, fewest = blocks.filter(~_exempt()), _fewest_labels(allows)
    met = _met(open_, _lookup(None, allows), fewest, fewest, cascade).filter("match IS NOT NULL")
    return _overruled(open_.join(met.select("domain", "match"), "domain"), blocks.columns)


def without_conflicts(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """Block rules that no allow rule overrules."""
    named = blocks.filter("domain <> ''").join(found.select("domain", "wildcard", "modifiers").distinct(), ["domain", "wildcard", "modifiers"], "left_anti").select(*blocks.columns)
    return named.unionByName(blocks.filter("domain = ''"))


def conflict_records(found: DataFrame) -> DataFrame:
    """The record of each conflict: both rules as text, category and sources of both."""
    blocked = D.output_text(F.lit("block"), F.col("domain"), F.col("wildcard"), F.col("modifiers"), F.col("raw"))
    allow = D.output_text(F.lit("allow"), F.col("by_domain"), F.col("by_wildcard"), F.col("by_modifiers"), F.lit(""))
    return found.select("domain", blocked.alias("blocked_rule"), F.col("category").alias("blocked_category"), F.col("source_ords").alias("blocked_sources"), allow.alias("whitelist_rule"), F.col("by_sources").alias("whitelist_sources"), "conflict_type")


def ordered(rules: DataFrame) -> DataFrame:
    """Total order: block before allow, domain, wildcard first, modifiers, pattern text; by code points."""
    return rules.orderBy(F.when(F.col("rule_type") == "block", 0).otherwise(1), "domain", F.col("wildcard").desc(), "modifiers", "raw")


@dataclass(frozen=True)
class CompileOptions:
    fold: FoldOptions = FoldOptions()
    cascade: bool = True
    folding: bool = True
    resolve_conflicts: bool = True
    provenance: bool = False

    def with_(self, **changes: object) -> CompileOptions:
        return replace(self, **changes)  # type: ignore[arg-type]


class Compiled:
    """The stages of a compilation, each computed when it is asked for.

    The rules without doubles and those that voiding rules leave are written to the
    checkpoint folder, as each is read several times. What folding and allow rules
    make of the block rules is one plan; :meth:`keep` writes it too, for those who
    read several of its results.
    """

    def __init__(self, rules: DataFrame, o: CompileOptions, suffixes: DataFrame | None):
        self._rules, self._o, self._suffixes = rules, o, suffixes

    @cached_property
    def deduped(self) -> DataFrame:
        return settle(dedup(self._rules))

    @cached_property
    def cleared(self) -> DataFrame:
        return settle(badfilter(self.deduped.select(*RULE)))

    @cached_property
    def allows(self) -> DataFrame:
        return self.cleared.filter("rule_type = 'allow'")

    @cached_property
    def _blocks(self) -> DataFrame:
        return self.cleared.filter("rule_type = 'block'")

    @cached_property
    def folded(self) -> Folded | None:
        if not self._o.folding:
            return None
        voided = cancelled(self.deduped.select(*RULE)) if self._o.fold.promotion_threshold else None
        found = fold(self._blocks, self.allows, self._o.fold, voided, self._suffixes, self._o.cascade)
        return Folded(settle(found.marked)) if self._o.provenance else found  # provenance reads them several times

    def keep(self) -> Compiled:
        """Writes the marked block rules once; before any stage behind them is asked for."""
        if self.folded is not None and not self._o.provenance:
            self.folded = Folded(settle(self.folded.marked))
        return self

    @cached_property
    def conflicts(self) -> DataFrame:
        if self.folded is None:
            return conflicts(self._blocks, self.allows, self._o.cascade)
        if not self._o.provenance:
            return _overruled(self.folded.marked.filter("fate = 'kept'"), RULE)
        matches = self.folded.marked.filter("fate = 'kept' AND match IS NOT NULL").select("domain", "wildcard", "modifiers", "match")
        return _overruled(self._survivors.join(matches, ["domain", "wildcard", "modifiers"]), RULE)

    @cached_property
    def _survivors(self) -> DataFrame:
        """Block rules behind folding, with the provenance asked for."""
        assert self.folded is not None
        return settle(fold_provenance(self.folded, self._o.fold).select(*RULE)) if self._o.provenance else self.folded.survivors

    @cached_property
    def blocks(self) -> DataFrame:
        if self.folded is None:
            return without_conflicts(self._blocks, self.conflicts) if self._o.resolve_conflicts else self._blocks
        if not self._o.resolve_conflicts:
            return self._survivors
        if not self._o.provenance:
            return self.folded.marked.filter("fate = 'kept' AND match IS NULL").select(*RULE)
        return without_conflicts(self._survivors, self.conflicts)

    @property
    def rules(self) -> DataFrame:
        return self.blocks.unionByName(self.allows)


def compile_rules(rules: DataFrame, o: CompileOptions = CompileOptions(), suffixes: DataFrame | None = None) -> Compiled:
    """Parsed rules to the final rule set; nothing runs before a stage is asked for."""
    return Compiled(rules, o, suffixes)
