from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowledger.plans import reports
from flowledger.store import Warehouse
from flowledger.tables import ALL_TABLES, FACT_EXCEPTION

IDS = 200_000  # a day holds too many ids for a dictionary, so only the filters can tell


def rows_read(df) -> int:
    """Rows that the scans of a collected frame took out of the row groups they did not skip."""
    plan, found = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
        if name == "FileSourceScanExec":
            found += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Three days of exceptions; the ids of each day go from the lowest to the highest."""
    store = Warehouse(spark, str(tmp_path_factory.mktemp("lookups") / "warehouse")).create()
    facts = spark.range(3 * IDS).select(
        F.concat(F.lit("W"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("workflow_id"),
        (20250101 + F.col("id") % 3).cast("int").alias("date_key"),
        F.col("id").alias("exception_key"),
        *[F.lit(1).alias(c) for c in ("team_key", "workflow_type_key", "priority_key", "error_count")],
        F.lit("sla_breach").alias("exception_type"),
        F.lit("queued").alias("status_name"),
        F.lit(True).alias("open_flag"),
        F.lit("2025-01-01 00:00:00").cast("timestamp").alias("detected_at"),
    )
    store.replace(FACT_EXCEPTION, FACT_EXCEPTION.conform(facts), [20250101, 20250102, 20250103])
    return store


def test_a_look_up_reads_only_the_row_groups_that_hold_the_id(store):
    found = store["fact_exception"].where(F.col("workflow_id") == "W000000301")
    assert [r.date_key for r in found.collect()] == [20250102]
    assert 0 < rows_read(found) <= IDS
    missing = store["fact_exception"].where(F.col("workflow_id") == "W000000301x")
    assert missing.collect() == []
    assert rows_read(missing) < IDS // 10


def test_exceptions_of_a_workflow_are_looked_up_once(spark, store):
    members = {
        "dim_date": "(20250102, DATE'2025-01-02') AS t(date_key, calendar_date)",
        "dim_team": "(1, 'alpha') AS t(team_key, team_name)",
        "dim_workflow_type": "(1, 'x') AS t(workflow_type_key, workflow_type)",
        "dim_priority": "(1, 'low') AS t(priority_key, priority_name)",
    }
    tables = {name: spark.sql(f"SELECT * FROM VALUES {sql}") for name, sql in members.items()}
    found = reports.workflow_exceptions({**tables, "fact_exception": store["fact_exception"]}, "W000000301")
    assert [(r.workflow_id, r.team_name) for r in found.collect()] == [("W000000301", "alpha")]
    assert rows_read(found) <= 2  # the answer, which sorting may read twice, not the facts again


def test_only_facts_have_look_up_filters(store):
    from flowledger.store import _lookup_options

    assert {t.name for t in ALL_TABLES.values() if _lookup_options(t)} == {"fact_workflow_run", "fact_exception"}
