from __future__ import annotations

from decimal import Decimal

import pytest
from helpers import AS_OF, event, events
from pyspark.sql import functions as F

from flowledger.functions.numeric import ratio_half_even, ratio_half_up
from flowledger.operators.facts import build_backlog_daily, build_kpi_daily, quality_score
from flowledger.operators.keyed import INPUT_POSITION, first_per_key, last_per_key
from flowledger.operators.staging import latest_per_workflow, prepare_staging
from flowledger.operators.validation import validate


def staged(spark, *rows, as_of=AS_OF):
    return prepare_staging(validate(events(spark, *rows)).valid, as_of)


def test_spans(spark):
    row = staged(spark, event()).first()
    assert (row.turnaround_hours, row.age_hours) == (3.5, 3.5)
    assert row.processing_minutes == Decimal("210.00")


def test_open_workflow_ages_until_as_of_and_never_below_zero(spark):
    row = staged(spark, event(status="queued", completed_at="", started_at="")).first()
    assert (row.turnaround_hours, row.age_hours) == (0.0, 18.0)
    early = staged(spark, event(status="queued", completed_at=""), as_of="2030-01-01T00:00:00Z")
    assert early.first().age_hours == 0.0


def test_latest_version_wins_and_ties_keep_the_first(spark):
    rows = [
        event(queue_name="old"),
        event(queue_name="new", completed_at="2031-03-10T10:30:00Z"),
        event(queue_name="tie", completed_at="2031-03-10T10:30:00Z"),
        event(workflow_id="REQ-2", queue_name="other"),
    ]
    kept = {r.workflow_id: r.queue_name for r in staged(spark, *rows).collect()}
    assert kept == {"REQ-1": "new", "REQ-2": "other"}


def test_a_row_without_time_never_beats_one_with(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', NULL, 1), ('a', TIMESTAMP'2031-03-10', 2), ('b', NULL, 3) "
        "AS t(workflow_id, updated_at, n)"
    )
    assert sorted(r.n for r in latest_per_workflow(df).collect()) == [2, 3]


def test_deduplication_needs_updated_at(spark):
    with pytest.raises(ValueError, match="updated_at"):
        latest_per_workflow(spark.sql("SELECT 'a' AS workflow_id"))


def outcomes(spark, cases, *columns):
    """The given columns of one staged row per case."""
    rows = [event(workflow_id=f"REQ-{i:03d}", **changes) for i, changes in enumerate(cases)]
    found = staged(spark, *rows).orderBy("workflow_id").select(*columns).collect()
    return [tuple(r) for r in found]


def test_sla_breach(spark):
    cases = [
        ({"due_at": "2031-03-10T09:00:00Z"}, True),
        ({"due_at": "2031-03-10T09:30:00Z"}, False),
        ({"due_at": ""}, False),
        ({"status": "queued", "completed_at": "", "due_at": "2031-03-10T20:00:00Z"}, True),
    ]
    assert outcomes(spark, [c for c, _ in cases], "sla_breached") == [(b,) for _, b in cases]


def test_exception_rules(spark):
    late = {"due_at": "2031-03-10T08:00:00Z"}
    cases = [
        ({}, (False, None)),
        ({"exception_flag": "t", "exception_type": "sla_breach"}, (True, "sla_breach")),
        ({"exception_type": "noted"}, (False, "noted")),
        ({"assignee_id": "", "completed_at": "2031-03-11T10:30:00Z"}, (True, "missing_assignee")),
        (
            {"status": "queued", "completed_at": "", "assignee_id": "", **late},
            (True, "overdue_workflow"),
        ),
        ({"status": "failed", **late}, (False, None)),
        ({"completed_at": ""}, (True, "invalid_lifecycle_pattern")),
        ({"started_at": "2031-03-10T05:59:59Z"}, (True, "invalid_lifecycle_pattern")),
        ({"completed_at": "2031-03-11T06:00:00Z"}, (False, None)),
        ({"completed_at": "2031-03-11T06:00:00.000001Z"}, (True, "high_processing_time")),
    ]
    found = outcomes(spark, [c for c, _ in cases], "exception_flag", "exception_type")
    assert found == [expected for _, expected in cases]


def test_quality_score(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 0, 'x', false), (2, 1, NULL, true), (3, 12, NULL, true), "
        "(4, -3, 'x', false) AS t(n, error_count, assignee_id, sla_breached)"
    )
    rows = df.select("n", quality_score().alias("score")).orderBy("n").collect()
    assert [r.score for r in rows] == [100, 70, 0, 100]


def test_exact_rounding(spark):
    df = spark.range(1).select(
        ratio_half_up(F.lit(1), F.lit(8)).alias("up"),
        ratio_half_up(F.lit(2675), F.lit(1000)).alias("up2"),
        ratio_half_even(F.lit(7_500_000), 60_000_000).alias("even"),
        ratio_half_even(F.lit(8_100_000), 60_000_000).alias("even2"),
    )
    assert df.first().asDict() == {
        "up": Decimal("0.13"),
        "up2": Decimal("2.68"),
        "even": Decimal("0.12"),
        "even2": Decimal("0.14"),
    }


def test_kpi_counts_only_the_source_backlog_flag(spark):
    rows = [
        event(),
        event(workflow_id="REQ-2", status="in_progress", completed_at="", assignee_id="", backlog_flag="n"),
    ]
    frame = staged(spark, *rows)
    kpi = build_kpi_daily(frame).first()
    assert (kpi.total_workflows, kpi.completed_workflows, kpi.backlog_workflows) == (2, 1, 0)
    assert (kpi.throughput_per_assignee, kpi.data_quality_score) == (Decimal("2.00"), Decimal("72.50"))
    backlog = build_backlog_daily(frame).collect()
    assert [(r.open_workflow_count, r.overdue_workflow_count) for r in backlog] == [(1, 0)]


def test_first_and_last_follow_the_input_position(spark):
    df = spark.sql(
        f"SELECT * FROM VALUES ('f', 1, 'x', 3), ('f', 1, 'y', 1), ('f', 1, 'z', 2) "
        f"AS t(source_file_name, source_row_number, v, {INPUT_POSITION})"
    )
    key = ["source_file_name", "source_row_number"]
    assert first_per_key(df, key).first().v == "y"
    assert last_per_key(df, key).first().v == "x"
