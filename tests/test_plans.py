"""What the physical plans must look like."""

from __future__ import annotations

import contextlib
import io

import pytest
from helpers import event, events
from pyspark.sql import functions as F

from flowledger.operators.keyed import pick_one
from flowledger.operators.staging import latest_per_workflow
from flowledger.operators.validation import normalise_source
from flowledger.plans import reports
from flowledger.store import Warehouse
from flowledger.tables import KPI_DAILY_SUMMARY


def plan(df, mode="formatted") -> str:
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain(mode)
    return out.getvalue()


def test_deduplication_limits_each_key_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100).select(
        F.col("id").cast("string").alias("workflow_id"), F.current_timestamp().alias("updated_at")
    ).write.parquet(path)
    tree = plan(latest_per_workflow(spark.read.parquet(path)), "simple")
    above, below = tree.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above
    assert "WindowGroupLimit" in below


def test_cells_are_cleaned_in_a_projection_of_their_own(spark):
    df = normalise_source(events(spark, event()))
    text = plan(df, "simple")
    assert text.count("Project [") == 3
    assert text.count("try_cast(created_at") == 1


def test_only_needed_columns_are_read_and_keys_pushed_down(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(10).select(
        F.col("id").cast("string").alias("workflow_id"), F.lit(1).alias("a"), F.lit(2).alias("b")
    ).write.parquet(path)
    facts = spark.read.parquet(path).where(F.col("workflow_id") == "3")
    text = plan(pick_one(facts, ["workflow_id"], [F.col("a").desc()]).select("a"))
    assert "EqualTo(workflow_id,3)" in text
    assert "ReadSchema: struct<workflow_id:string,a:int>" in text


def test_date_bounds_prune_partitions(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "w")).create()
    rows = KPI_DAILY_SUMMARY.conform(
        spark.sql(
            "SELECT * FROM VALUES (20250101), (20250215), (20250320) AS t(date_key)"
        ).withColumns({c: F.lit(1) for c in (KPI_DAILY_SUMMARY.surrogate, *reports.MEASURES)})
    )
    store.replace(KPI_DAILY_SUMMARY, rows, [202501, 202502, 202503])
    with pytest.raises(ValueError, match="replaced"):
        store.append(KPI_DAILY_SUMMARY, rows)
    tables = {n: store[n] for n in ("kpi_daily_summary", "dim_date", "dim_team", "dim_workflow_type")}
    tables["dim_date"] = spark.sql("SELECT 20250215 AS date_key, DATE'2025-02-15' AS calendar_date")
    df = reports.team_performance_daily(tables, "2025-02-01", "2025-02-28")
    text = plan(df)
    assert "PartitionFilters: [isnotnull(month_key" in text
    assert "202502" in text.split("PartitionFilters:")[1].split("\n")[0]
    assert df.count() == 1


@pytest.mark.parametrize("page", [2, 90])
def test_pages_are_a_top_k_at_every_depth(spark, page):
    df = spark.range(1000)
    found = reports.paginate(df, [reports.SortKey("id", True)], page, 10)
    assert "TakeOrderedAndProject" in plan(found.rows, "simple")
    assert [r.id for r in found.rows.collect()][:2] == [1009 - 10 * page, 1008 - 10 * page]
    cursor = reports.paginate(df, [reports.SortKey("id", True)], 1, 10, {"id": 500})
    assert "TakeOrderedAndProject" in plan(cursor.rows, "simple")
    assert [r.id for r in cursor.rows.collect()][:2] == [499, 498]


@pytest.mark.parametrize("name", ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"])
def test_staging_needs_no_cross_join_and_no_python(spark, name):
    from flowledger.operators.facts import build_kpi_daily
    from flowledger.operators.staging import prepare_staging

    df = build_kpi_daily(prepare_staging(normalise_source(events(spark, event())), "2031-03-11"))
    assert name not in plan(df, "simple")
