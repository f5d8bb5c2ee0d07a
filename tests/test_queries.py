"""Every registered query against its SQL, and what its plan must not hold."""

from __future__ import annotations

import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from check import digest
from visitmill.functions import skew
from visitmill.plans import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name, capsys):
    df = QUERIES[name](spark, FOLDER)
    result = db.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    want = digest(columns, result.fetchall())
    assert digest(df.columns, df.collect())[0] == want[0]
    df.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert not re.search("PythonUDF|BatchEvalPython|MapInPandas|FlatMapGroups", plan)
    # One task only sees one row of a lookup, or one row per million numbered rows.
    assert "Exchange SinglePartition" not in plan or name in ("first_active", "upsert_with_ids")


# Queries that join lookups.
JOINING = [
    "api_records", "arm_hybrid", "landed_by_folder", "landing_round_trip", "mapping_rule_join", "page_cutoff",
    "registry_immutability", "row_status", "schedule_join", "source_mode_union", "upsert_by_key", "upsert_with_ids",
]


@pytest.mark.parametrize("name", JOINING)
def test_query_with_large_lookups_and_hot_keys(spark, db, name, monkeypatch):
    found = skew.hot_key_hashes
    monkeypatch.setattr(skew, "fits_broadcast", lambda *_, **__: False)
    monkeypatch.setattr(skew, "hot_key_hashes", lambda df, keys: found(df, keys, 0.0004))
    df = QUERIES[name](spark, FOLDER)
    result = db.execute(ORACLES[name])
    want = digest([c[0] for c in result.description], result.fetchall())
    assert digest(df.columns, df.collect())[0] == want[0]


def test_preview_cuts_before_the_shuffle(spark, capsys):
    QUERIES["preview_top_n"](spark, FOLDER).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_entry(spark):
    assert entry.entry(spark).count() == 1500


def test_entry_without_an_optional_dependency():
    """What only the optional operators need may be missing; the other queries are there."""
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(len([q for q in e.queries() if not q.startswith('op')]), any(q.startswith('op1_') for q in e.queries()))"
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(entry.__file__).parent, check=True)
    assert found.stdout.split()[-2:] == [str(len(QUERIES)), "False"]
