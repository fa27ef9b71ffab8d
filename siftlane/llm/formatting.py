"""Records that differ only in how they are written (problem 2).

Three steps, as the counts shrink: byte-identical rows are collapsed with their
count and smallest id; only the distinct forms left are brought to a canonical
text; these are grouped again on the whole canonical text, summing the counts.
The way back from a group to its rows goes over 128-bit digests of form and
canonical text, and through a join that spreads hot keys.

What a canonical text keeps: run, rule type, wildcard, domain (or pattern) and
the sorted set of modifiers. It drops letter case, blanks of any kind, outer dots
and ``^`` of the domain, separators with nothing behind them, order and
repetition of modifiers. A row's raw text decides; where it is null, the other
columns do. Null run, type or wildcard equal only null; a null domain equals an
empty one, null modifiers equal none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import attach

#: Blanks of any kind: Unicode white space and separators, control separators, zero-width spaces and the byte order mark.
BLANKS = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}\x{180e}\x{200b}-\x{200d}\x{2060}\x{feff}]+"
#: Stands between the parts of a key; a blank, so it occurs in no canonical part.
BETWEEN = "\x1f"
NULL = "\x1e"


def squeezed(text: Column) -> Column:
    """Lower case without blanks."""
    return F.lower(F.regexp_replace(text, BLANKS, ""))


def modifier_set(text: Column) -> Column:
    """Modifiers as a sorted set, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(text, ","), lambda m: m != ""))), ",")


def form() -> Column:
    """The bytes that state a rule: run and raw, or the other fields where raw is null."""
    # the two marks are blanks, which don't count, so no field may hold them here
    fields = [F.coalesce(F.translate(F.col(c).cast("string"), BETWEEN + NULL, ""), F.lit(NULL)) for c in ("rule_type", "wildcard", "normalized_domain", "modifiers")]
    run = F.coalesce(F.col("run_id").cast("string"), F.lit(NULL))
    return F.when(F.col("raw").isNotNull(), F.concat(run, F.lit(BETWEEN + "r"), F.col("raw"))).otherwise(F.concat(run, F.lit(BETWEEN + "f"), F.concat_ws(BETWEEN, *fields)))


def canonical(forms: DataFrame) -> DataFrame:
    """Adds ``canonical`` to rows with ``form``."""
    parted = forms.withColumn("_run", F.substring_index("form", BETWEEN, 1)).withColumn("_rest", F.expr("substring(form, length(_run) + 2)"))
    from_raw = F.col("_rest").startswith("r")
    parted = parted.withColumn("_text", F.when(from_raw, squeezed(F.expr("substring(_rest, 2)")))).withColumn("_fields", F.when(~from_raw, F.split(F.expr("substring(_rest, 2)"), BETWEEN)))
    body = parted.withColumn("_allow", F.col("_text").startswith("@@")).withColumn("_body", F.regexp_replace("_text", r"^@@", "")).withColumn("_is_pattern", F.col("_body").rlike(r"^/.*/(\$.*)?$"))
    null_as_empty = lambda c: F.regexp_replace(c, NULL, "")
    field = lambda i: F.col("_fields")[i]
    head = F.when(F.col("_body").contains("$"), F.substring_index("_body", "$", 1)).otherwise(F.col("_body"))
    name = F.when(from_raw, F.regexp_replace(head, r"^\|+", "")).otherwise(squeezed(null_as_empty(field(2))))
    trim_marks = lambda c: F.regexp_replace(c, r"^[.^]+|[.^]+$", "")
    named = body.withColumn("_name", trim_marks(name)).withColumn("_star", F.col("_name").startswith("*."))
    star_text = F.when(from_raw, F.col("_star").cast("string")).otherwise(F.lower(field(1)))
    kind = F.when(from_raw, F.when(F.col("_allow"), "allow").otherwise("block")).otherwise(F.when(field(0) == NULL, NULL).otherwise(squeezed(field(0))))
    modifiers = F.when(from_raw, F.when(F.col("_body").contains("$"), F.expr("substring(_body, instr(_body, '$') + 1)")).otherwise("")).otherwise(squeezed(null_as_empty(field(3))))
    pattern = F.regexp_extract("_body", r"^(/.*/)(?:\$.*)?$", 1)
    flags = F.regexp_extract("_body", r"^/.*/(?:\$(.*))?$", 1)
    text = F.when(F.col("_is_pattern"), F.concat_ws(BETWEEN, "_run", kind, F.lit("p"), pattern, modifier_set(flags))).otherwise(
        F.concat_ws(BETWEEN, "_run", kind, F.concat(F.lit("d"), star_text), trim_marks(F.regexp_replace("_name", r"^\*\.", "")), modifier_set(modifiers))
    )
    return named.select(*forms.columns, text.alias("canonical"))


def digest(text: str, name: str) -> list[Column]:
    """128 bits of a column's text as two columns."""
    return [F.xxhash64(text).alias(f"{name}1"), F.xxhash64(F.lit(0x5EED), text).alias(f"{name}2")]


def forms(parsed: DataFrame) -> DataFrame:
    """Byte-identical rows once: ``form, n, first``."""
    return parsed.select("parsed_id", form().alias("form")).groupBy("form").agg(F.count(F.lit(1)).alias("n"), F.min("parsed_id").alias("first"))


def rules(parsed: DataFrame) -> DataFrame:
    """One row per rule and run: ``keep_id, run_id, rule, copies, forms``; ``rule`` is the canonical text without the run."""
    grouped = canonical(forms(parsed)).groupBy("canonical").agg(F.min("first").alias("keep_id"), F.sum("n").alias("copies"), F.count(F.lit(1)).alias("forms"))
    run = F.substring_index("canonical", BETWEEN, 1)
    rule = F.translate(F.expr(f"substring(canonical, instr(canonical, '{BETWEEN}') + 1)"), BETWEEN + NULL, " -")
    return grouped.select("keep_id", F.when(run != NULL, run).cast("int").alias("run_id"), rule.alias("rule"), "copies", "forms")


def copies(parsed: DataFrame) -> DataFrame:
    """``keep_id, copy_id`` for every row that isn't the first of its rule in its run.

    ``keep_id`` is the smallest id of the rule; null ids are never smallest. An
    empty table gives no rows; columns other than those named above aren't read.
    """
    total = parsed.count()
    written = canonical(forms(parsed))
    grouped = written.groupBy("canonical").agg(F.min("first").alias("keep_id"), F.sum("n").alias("copies"), F.count(F.lit(1)).alias("forms"))
    several = grouped.filter("copies > 1").select(*digest("canonical", "c"), "keep_id", "forms")
    of_form = attach(
        written.select(*digest("form", "f"), *digest("canonical", "c"), "n"), several, ["c1", "c2"], ["keep_id"], F.col("forms"), total, F.struct("f1", "f2")
    )
    rows = parsed.select("parsed_id", form().alias("form")).select("parsed_id", *digest("form", "f"))
    found = attach(rows, of_form.withColumnRenamed("n", "_n"), ["f1", "f2"], ["keep_id"], F.col("_n"), total, F.col("parsed_id"))
    return found.filter(~F.col("parsed_id").eqNullSafe(F.col("keep_id"))).select("keep_id", F.col("parsed_id").alias("copy_id"))
