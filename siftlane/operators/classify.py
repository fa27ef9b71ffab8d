"""Categories of domains, by registered domain and by the first label in front of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import domains as D
from ..runtime import settle

#: First labels that tell a category, first-listed category first.
PREFIXES = {
    "advertising": ["ads", "advert", "adv", "banner", "banners", "creative", "creatives", "impression", "impressions", "pixel", "pixels", "tracker", "trackers", "serving", "ssp", "dsp", "exchange", "rtb", "bid", "bidding"],
    "analytics": ["analytics", "analytic", "metrics", "metric", "stats", "stat", "telemetry", "monitor", "monitoring", "logging", "events", "event", "collect", "collector", "ingest", "ingestion", "trace", "tracing", "report", "reports", "dashboard", "insights"],
    "cdn": ["cdn", "static", "assets", "asset", "media", "files", "file", "content", "contents", "resource", "resources", "download", "downloads", "cache", "caching", "edge", "edges", "proxy", "proxies", "mirror", "mirrors"],
    "affiliate": ["affiliate", "aff", "partner", "partners", "referral", "refer", "click", "clicks", "redirect", "redirects"],
    "ecommerce_payment": ["shop", "store", "cart", "checkout", "payment", "pay", "order", "orders", "billing", "buy", "purchase", "product", "products", "catalog", "inventory", "price", "pricing"],
    "social": ["social", "share", "shares", "like", "likes", "follow", "follows", "comment", "comments", "post", "posts", "feed", "feeds", "timeline", "profile", "profiles"],
}
#: All categories in the order of reports.
CATEGORIES = ["advertising", "analytics", "cdn", "microsoft_telemetry", "affiliate", "social", "ecommerce_payment", "privacy_security", "other"]
BY_REGISTERED, BY_PREFIX, BY_NOTHING = 0.9, 0.6, 0.0


#: Last labels that never are public suffixes.
RESERVED = ["local", "localhost", "localdomain", "internal", "lan", "home", "corp", "test", "example", "invalid", "onion"]
#: Labels that make a public suffix in front of a country code.
COUNTRY_SECOND = ["ac", "co", "com", "edu", "gob", "gouv", "gov", "mil", "net", "org"]


def read_suffixes(spark: SparkSession, path: str) -> DataFrame:
    """``rule_domain, kind`` (plain, wildcard, exception) of a file in the public suffix list's format, without its private part.

    The file is small (about 300 kB) whatever the data; an absent one fails here.
    """
    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    lines = [x.split()[0] for x in text.split("===BEGIN PRIVATE DOMAINS===")[0].splitlines() if x.strip() and not x.lstrip().startswith("//")]
    kind = lambda x: "exception" if x.startswith("!") else "wildcard" if x.startswith("*.") else "plain"
    return spark.createDataFrame([(x.removeprefix("!").removeprefix("*.").lower(), kind(x)) for x in lines], "rule_domain string, kind string")


def _by_rule(domain: Column) -> Column:
    """How many labels the suffix of a domain has where no list is given: one, or two where a country code follows a general label; null for none."""
    parts = D.labels(domain)
    last, second = F.get(parts, F.size(parts) - 1), F.get(parts, F.size(parts) - 2)
    usable = last.rlike(r"^(?:[a-z]{2,}|xn--[a-z0-9-]+)$") & ~last.isin(RESERVED)
    two = (F.size(parts) >= 2) & (F.length(last) == 2) & second.isin(COUNTRY_SECOND)
    return F.when(usable & two, 2).when(usable, 1)


def with_suffix(df: DataFrame, column: str, suffixes: DataFrame | None = None) -> DataFrame:
    """``df`` with ``suffix_labels``: the number of labels of the public suffix of ``column``, null if it has none.

    ``suffixes`` is a list as :func:`read_suffixes` gives it (an exception beats the
    rest, else the longest rule holds); without one, the suffix follows from a
    rule: the last label, or the last two where a country code follows com, co, org
    and the like. That misses suffixes that only the list knows.
    """
    if suffixes is None:
        return df.withColumn("suffix_labels", _by_rule(F.col(column)))
    names = df.select(F.col(column).alias("_d")).filter("_d IS NOT NULL").distinct()
    up = names.select("_d", F.posexplode(F.concat(F.array("_d"), D.ancestors(F.col("_d"), 1))).alias("_depth", "_up"))
    size = F.size(D.labels(F.col("_up")))
    labels = F.when(F.col("kind") == "exception", size - 1).when(F.col("kind") == "wildcard", size + 1).otherwise(size)
    # the size of the list is Spark's to judge
    rules = up.join(suffixes, F.col("_up") == F.col("rule_domain")).filter("kind <> 'wildcard' OR _depth > 0")
    best = rules.groupBy("_d").agg(F.max(F.struct((F.col("kind") == "exception").alias("e"), labels.alias("n")))["n"].alias("suffix_labels"))
    return df.join(best, F.col(column) == F.col("_d"), "left").drop("_d")


def without_suffixes(df: DataFrame, column: str, suffixes: DataFrame | None = None) -> DataFrame:
    """Rows whose ``column`` isn't a public suffix itself."""
    marked = with_suffix(df, column, suffixes)
    return marked.filter(F.coalesce(F.col("suffix_labels") < F.size(D.labels(F.col(column))), F.lit(True))).drop("suffix_labels")


def registered(df: DataFrame, suffixes: DataFrame | None = None, column: str = "domain") -> DataFrame:
    """Distinct ``column`` with ``registered``: the public suffix and one label more.

    A domain without a known suffix, or that is one, is its own registered domain.
    """
    names = df.select(column).filter(F.col(column).isNotNull()).distinct()
    parts, n, total = D.labels(F.col(column)), F.col("suffix_labels"), F.size(D.labels(F.col(column)))
    own = F.when(n.isNotNull() & (total > n), F.array_join(F.slice(parts, total - n, n + 1), ".")).otherwise(F.col(column))
    return with_suffix(names, column, suffixes).select(column, own.alias("registered"))


def read_known(spark: SparkSession, path: str) -> DataFrame:
    """``pattern, category, position`` of a table of registered domains: a text file of ``category,domain`` lines, the first category of a domain holding; ``#`` begins a comment."""
    parts = F.split(F.lower(D.strip_space(F.col("value"))), r"\s*,\s*", 2)
    rows = spark.read.text(path).filter("trim(value) <> '' AND NOT trim(value) LIKE '#%'").select(parts.alias("x"), F.monotonically_increasing_id().alias("position")).filter("size(x) = 2")
    return rows.select(F.col("x")[1].alias("pattern"), F.col("x")[0].alias("category"), "position")


def prefix_table(spark: SparkSession) -> DataFrame:
    first: dict[str, str] = {}
    for category, words in PREFIXES.items():
        for word in words:
            first.setdefault(word, category)
    return spark.createDataFrame(list(first.items()), "prefix string, category string")


def classify(df: DataFrame, suffixes: DataFrame | None, by_domain: DataFrame, prefixes: DataFrame, column: str = "domain") -> DataFrame:
    """Distinct ``column`` with ``registered, category, confidence, matched_by``.

    ``by_domain``: ``pattern, category, position``; a registered domain or one of its
    parents that is listed decides, the nearest first, the first-listed category for
    doubles. Else the first label in front of the registered domain does. The tables
    are parameters; their sizes are Spark's to judge.
    """
    known = settle(registered(df, suffixes, column))  # read twice
    listed = by_domain.groupBy("pattern").agg(F.min_by("category", "position").alias("listed"))
    roots = known.select("registered").distinct()
    up = roots.select("registered", F.posexplode(F.concat(F.array("registered"), D.ancestors(F.col("registered"), 1))).alias("depth", "pattern"))
    named = up.join(listed, "pattern").groupBy("registered").agg(F.min_by("listed", "depth").alias("listed"))
    front = F.when(F.col(column) != F.col("registered"), F.regexp_extract(F.col(column), r"^([^.]+)\.", 1))
    joined = known.join(named, "registered", "left").withColumn("prefix", front).join(prefixes.withColumnRenamed("category", "by_prefix"), "prefix", "left")
    listed_, prefixed = F.col("listed").isNotNull(), F.col("by_prefix").isNotNull()
    return joined.select(
        column,
        "registered",
        F.coalesce("listed", "by_prefix", F.lit("other")).alias("category"),
        F.when(listed_, BY_REGISTERED).when(prefixed, BY_PREFIX).otherwise(BY_NOTHING).alias("confidence"),
        F.when(listed_, "registered").when(prefixed, "prefix").otherwise("none").alias("matched_by"),
    )


#: Share of its confidence that a category keeps when it comes from a name the domain points to.
BY_HINT = 0.8


def with_hints(classified: DataFrame, hints: DataFrame, suffixes: DataFrame | None, by_domain: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Domains without a category take that of the first name they point to that has one.

    ``hints``: ``domain, hint, position``. Categories that are there already stay; hints of
    other domains, null hints and hints without a category don't count.
    """
    given = hints.select("domain", F.lower("hint").alias("_hint"), "position").filter("domain IS NOT NULL AND _hint IS NOT NULL")
    known = classify(given, suffixes, by_domain, prefixes, "_hint").filter((F.col("category") != "other") & (F.col("confidence") >= BY_PREFIX))
    first = given.join(known.select("_hint", F.col("category").alias("_c"), F.col("confidence").alias("_f")), "_hint").groupBy("domain").agg(F.min(F.struct("position", "_hint", "_c", "_f")).alias("_h"))
    joined = classified.join(first, "domain", "left")
    use = (F.col("matched_by") == "none") & F.col("_h").isNotNull()
    changed = {"category": F.when(use, F.col("_h._c")).otherwise(F.col("category")), "confidence": F.when(use, F.col("_h._f") * BY_HINT).otherwise(F.col("confidence")), "matched_by": F.when(use, "cname").otherwise(F.col("matched_by"))}
    return joined.withColumns(changed).drop("_h")


def counts_with_zero(classified: DataFrame) -> DataFrame:
    """``category, domains`` for every category, also those without a domain."""
    spark = classified.sparkSession
    every = spark.createDataFrame([(c,) for c in CATEGORIES], "category string")
    found = classified.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return every.join(found, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("domains"))
