"""Rule lists derived from the ``orders`` table, for queries without list files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stages import computed
from ..runtime import spread, table

CATEGORY_OF = ["ads", "tracking", "malware", "phishing", "mining", "other"]
BASES = ["example.com", "example.co.uk", "test.net", "promo.click"]


def rule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source_ord, line_no, line, category``: one line per order, of one of forty shapes."""
    k = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    pick = lambda options, i: F.get(F.array(*options), i.cast("int"))
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    base = F.concat(F.lit("d"), text(k * 13 % 61), F.lit("."), pick([F.lit(b) for b in BASES], F.floor(k / 40) % 4))
    sub = pick([F.concat(F.lit("ads"), text(k % 7)), F.concat(F.lit("cdn"), text(k % 9)), F.lit("www"), F.lit("m.track"), F.concat(F.lit("x"), text(k % 11))], F.floor(k / 7) % 5)
    parts = computed(orders, {"k": k, "b": base, "s": sub, "shape": (k * 7 + 3) % 40})
    k, b, s, n = F.col("k"), F.col("b"), F.col("s"), F.col("shape")
    c = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    allow = F.when(k % 3 == 0, c("@@||", s, ".", b, "^")).when(k % 3 == 1, c("@@||*.", b, "^")).otherwise(c("@@||", b, "^"))
    shapes = [
        (n <= 11, c("||", s, ".", b, "^")),
        (n <= 14, c("||", b, "^")),
        (n == 15, c("||*.", b, "^")),
        (n == 16, c("||*.", s, ".", b, "^")),
        (n <= 19, c("0.0.0.0 ", s, ".", b)),
        (n == 20, c("::1 ", s, ".", b)),
        (n <= 23, c(s, ".", b)),
        (n == 24, c("*.", s, ".", b)),
        (n == 25, allow),
        (n == 26, c("||", s, ".", b, "^$important")),
        (n == 27, c("||", s, ".", b, "$script,third-party")),
        (n == 28, c("||", s, ".", b, "^$badfilter")),
        (n == 29, c("||", F.upper(b), ".^$dnstype=A")),
        (n == 30, c("! note ", text(k))),
        (n == 31, c("# note ", text(k))),
        (n == 32, c(b, "##.banner")),
        (n == 33, c("/^ads", text(k % 13), "\\./$b,a")),
        (n == 34, c("||", b, "/path^")),
        (n == 35, c("||*-", b, "^")),
        (n == 36, c("https://", b, "/x")),
        (n == 37, F.lit("127.0.0.1 localhost")),
        (n == 38, F.lit("||a.b^")),
        (n == 39, c("@@/^cdn", text(k % 5), "\\./")),
    ]
    line = F.lit(None).cast("string")
    for cond, value in reversed(shapes):
        line = F.when(cond, value).otherwise(line)
    ord_ = (F.col("o_custkey") % 6).cast("int")
    category = pick([F.lit(x) for x in CATEGORY_OF], ord_)
    return computed(parts, {"source_ord": ord_, "line_no": k, "line": line, "category": category}).select("source_ord", "line_no", "line", "category")


def sibling_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`rule_lines`, but siblings below parents that are no rules: numbered ones in a share that differs from parent to parent, and parents that are public suffixes of each kind."""
    k = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    parent = F.get(F.array(F.concat(F.lit("s"), text(k * 7 % 23), F.lit(".example.com")), F.lit("co.uk"), F.concat(F.lit("x"), text(k % 5), F.lit(".ck")), F.lit("www.ck"), F.concat(F.lit("t"), text(k * 3 % 11), F.lit(".test.net"))), (F.floor(k / 3) % 5).cast("int"))
    numbered = F.floor(k / 15) % 4 <= k * 7 % 23 % 5
    label = F.when(numbered, F.concat(F.lit("cdn"), text(k % 89))).otherwise(F.concat(F.lit("w"), text(k % 37), F.lit("x")))
    ord_ = (F.col("o_custkey") % 6).cast("int")
    category = F.get(F.array(*[F.lit(x) for x in CATEGORY_OF]), ord_)
    return orders.select(ord_.alias("source_ord"), k.alias("line_no"), F.concat(F.lit("||"), label, F.lit("."), parent, F.lit("^")).alias("line"), category.alias("category"))
