"""A few registered queries against SQL on another engine, on the smallest test data."""

from __future__ import annotations

import pathlib

import pytest

pytest.importorskip("duckdb")
SF_DIR = "/root/testdata/sf0.001"
if not pathlib.Path(SF_DIR).exists():
    pytest.skip("no test data", allow_module_level=True)

import __spark_entry__ as registered  # noqa: E402
from checks.compare import compare  # noqa: E402


def test_every_oracle_belongs_to_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())
    corpus = {q for q in registered.queries() if q.startswith("op") and q[2].isdigit()} | {"pipeline"}
    assert set(registered.queries()) - set(registered.oracle_sql()) <= corpus


@pytest.mark.parametrize(
    "name",
    ["quarantine_json", "staging", "kpi_daily_keyed", "exceptions_page", "append_once", "raw_key_map", "row_account", "constraint_audit"],
)
def test_same_rows(spark, name):
    assert compare(spark, SF_DIR, name).startswith("ok")


def test_entry(spark):
    assert registered.entry(spark).count() > 0
