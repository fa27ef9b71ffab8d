"""Lists, feeds, earlier results and configuration from files."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.domains import strip_space


def enabled(sources: DataFrame) -> DataFrame:
    return sources.filter("enabled")


def read_lists(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """``source_ord, line_no, line, category`` of sources with ``source_ord, path, category``.

    Any line ends; bytes that aren't UTF-8 become replacement characters. ``line_no``
    grows within a file but has gaps. A path may be named by several sources.
    """
    named = sources.select("source_ord", "path", "category").collect()  # configuration: one row per list
    paths = sorted({r["path"] for r in named})
    if not paths:
        return spark.createDataFrame([], "source_ord int, line_no bigint, line string, category string")
    text = spark.read.text(paths).select(F.make_valid_utf8("value").alias("line"), F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("line_no"))
    key = F.regexp_replace(F.url_decode(F.regexp_replace("_file", r"\+", "%2B")), r"^file:/+", "/")
    here = lambda path: re.sub(r"^file:/+", "/", path) if ":/" in path else str(Path(path).resolve())
    where = spark.createDataFrame([(r["source_ord"], here(r["path"]), r["category"]) for r in named], "source_ord int, _path string, category string")
    return text.withColumn("_path", key).join(F.broadcast(where), "_path").select("source_ord", "line_no", "line", "category")


def read_host_feed(spark: SparkSession, path: str, source: str) -> DataFrame:
    """``domain, source`` of a feed with one host per line, see :func:`host_feed`."""
    return host_feed(spark.read.text(path), source)


def host_feed(lines: DataFrame, source: str) -> DataFrame:
    """``domain, source`` of lines ``value``; comments and lines with markup, paths or blanks are passed over, null lines too."""
    line = F.lower(strip_space(F.col("value")))
    return lines.select(line.alias("domain")).filter(F.col("domain").contains(".") & ~F.col("domain").rlike(r"^#|[<>/ ]")).distinct().withColumn("source", F.lit(source))


def read_csv_feed(spark: SparkSession, path: str, source: str) -> DataFrame:
    """``domain, source`` of a feed with a header, where ``ioc_type`` is domain."""
    rows = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return rows.filter("ioc_type = 'domain'").select(F.lower(strip_space(F.col("ioc_value"))).alias("domain")).filter("domain <> ''").distinct().withColumn("source", F.lit(source))


def read_previous(spark: SparkSession, path: str) -> DataFrame:
    """``line`` of an earlier result, see :func:`previous_lines`."""
    return previous_lines(spark.read.text(path))


def previous_lines(lines: DataFrame) -> DataFrame:
    """``line``: the distinct lines ``value`` that aren't comments."""
    return lines.select(strip_space(F.col("value")).alias("line")).filter("line <> '' AND NOT (line LIKE '!%' OR line LIKE '#%')").distinct()


def previous_domains(previous: DataFrame) -> DataFrame:
    """``domain`` of the rule lines of an earlier result; patterns have none."""
    name = F.regexp_extract("line", r"^(?:@@)?\|\|(?:\*\.)?([^/^$\s]+)", 1)
    return previous.select(name.alias("domain")).filter("domain <> ''").distinct()


def write_parsed(parsed: DataFrame, path: str) -> None:
    """Adds parsed lines by content hash and options, to be read instead of parsing again. Needs ``content_hash, options``; those must not be there yet."""
    parsed.write.mode("append").partitionBy("content_hash", "options").parquet(path)


def read_parsed(spark: SparkSession, path: str, hashes: DataFrame, options: str) -> DataFrame:
    """Rows of :func:`write_parsed` for ``content_hash`` in ``hashes``; other folders aren't read."""
    return spark.read.parquet(path).filter(F.col("options") == options).join(hashes.select("content_hash").distinct(), "content_hash", "left_semi")


def failure_guard(fetch_log: DataFrame, threshold: float = 0.5) -> None:
    """Raises if no source succeeded, or if more than ``threshold`` of them failed. Needs ``ok``."""
    total, failed = fetch_log.agg(F.count(F.lit(1)), F.count_if(~F.col("ok"))).first()
    if total == failed or failed / total > threshold:
        raise RuntimeError(f"{failed} of {total} sources failed")
