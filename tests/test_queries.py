"""Every query with SQL, against that SQL."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from siftlane import queries

SOME = ["parse_rules", "dedup_rules", "fold_exact", "conflicts_all", "compiled_rules", "fold_provenance", "contributions", "overlap_pairs", "audit_fused", "cache_eviction", "export_hosts", "promote_pattern", "promote_guarded", "overlap_rates", "rdap_fields", "audit_records", "hinted_categories", "sidecar_rules", "feed_hosts", "p1_found", "p3_found", "p3_loaded"]


def test_names_match():
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", SOME)
def test_equals_sql(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for table in ("orders", "events", "merged_rules", "cache_entries", "rule_feed", "sources"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    got = queries.queries()[name](spark, sf)
    want = db.sql(queries.oracle_sql()[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    text = lambda rows: sorted(tuple(str(v) for v in r) for r in rows)
    assert text(got.select(columns).collect()) == text(want.select(*columns).fetchall())


def test_core_does_without_the_subpackage(tmp_path):
    root = Path(__file__).resolve().parent.parent
    for name in ("siftlane", "__spark_entry__.py"):
        (shutil.copytree if (root / name).is_dir() else shutil.copy)(root / name, tmp_path / name)
    shutil.rmtree(tmp_path / "siftlane" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; assert 'p1_found' in e.queries() and 'p2_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)})
